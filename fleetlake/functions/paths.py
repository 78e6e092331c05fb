"""Object-path expressions: layout parts, prefixes, extensions, envelopes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Log file extensions, compared without regard to case (fixed values: MF4 MFC MFE MFM).
LOG_FILE = r"(?i)\.mf[4cem]$"

# Device and session prefixes; the closing slash is optional (fixed patterns).
DEVICE_ID = r"^[0-9A-F]{8}$"
DEVICE_PREFIX = r"^[0-9A-F]{8}/?$"
SESSION_PREFIX = r"^[0-9A-F]{8}/[0-9]{8}/?$"


def is_log_file(path: Column) -> Column:
    return F.coalesce(path.rlike(LOG_FILE), F.lit(False))


def forward_slashes(path: Column) -> Column:
    return F.translate(path, "\\", "/")


def last_part(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def looks_like_file(path: Column) -> Column:
    return is_log_file(path) | F.contains(last_part(path), F.lit("."))


def as_prefix(path: Column) -> Column:
    """Close prefixes with a slash; files and empty entries stay as they are."""
    keep = (path == "") | looks_like_file(path) | F.endswith(path, F.lit("/"))
    return F.when(keep, path).otherwise(F.concat(path, F.lit("/")))


def is_device_prefix(path: Column) -> Column:
    return path.rlike(DEVICE_PREFIX)


def is_session_prefix(path: Column) -> Column:
    return path.rlike(SESSION_PREFIX)


def device_of(path: Column) -> Column:
    """Device id of a ``device/session/file`` path, empty for any other path."""
    parts = F.split(path, "/")
    known = (F.size(parts) == 3) & F.get(parts, F.lit(0)).rlike(DEVICE_ID)
    return F.when(known, F.get(parts, F.lit(0))).otherwise("")


def plain_path(uri: Column) -> Column:
    """The path that a URI such as ``_metadata.file_path`` stands for: blanks, ``#`` and others as they are."""
    # Decoding takes a plus for a blank; in paths it is a plus.
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def stored_name(name: str) -> str:
    """The name to store a file under: Hadoop's file systems have none with a colon."""
    return name.replace("%", "%25").replace(":", "%3A") if ":" in name or "%3A" in name else name


def named(stored: Column) -> Column:
    """The name that ``stored_name`` was made of."""
    colons = F.replace(F.replace(stored, F.lit("%3A"), F.lit(":")), F.lit("%25"), F.lit("%"))
    return F.when(F.contains(stored, F.lit("%3A")), colons).otherwise(stored)


def lake_parts(path: Column) -> dict[str, Column]:
    """``.../device/message/yyyy/mm/dd/file`` taken apart from the right."""
    parts = F.split(path, "/")

    def part(k: int) -> Column:
        return named(F.try_element_at(parts, F.lit(-k)))

    return {
        "device": part(6),
        "message": part(5),
        "date": F.to_date(F.concat_ws("-", part(4), part(3), part(2)), "yyyy-MM-dd"),
        "file_name": part(1),
    }
