"""Backlog manifests expanded to log files and cut into batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import as_prefix, is_device_prefix, is_log_file, is_session_prefix
from ..operators.chunks import ordered_index

#: Longest manifest (in entries) that is broadcast.
BROADCAST_ENTRIES = 500_000


def manifest(spark: SparkSession, entries: Sequence[str]) -> DataFrame:
    """``pos, entry`` in manifest order."""
    return spark.createDataFrame(list(enumerate(entries)), "pos long, entry string")


def classify_backlog(entries: DataFrame) -> DataFrame:
    """Add ``path`` (normalised), ``kind`` (device, session, file or reject), and the first
    two path parts as ``device`` and ``session``.

    Entries that no rule accepts - lower-case devices, unknown extensions, files above the
    session level - stay visible as rejects.
    """
    entry = F.col("entry")
    parts = F.split(entry, "/")
    kind = (
        F.when(is_device_prefix(entry), "device")
        .when(is_session_prefix(entry), "session")
        .when(is_log_file(entry) & (F.size(parts) >= 3), "file")
        .otherwise("reject")
    )
    return entries.select(
        "*",
        as_prefix(entry).alias("path"),
        kind.alias("kind"),
        F.get(parts, F.lit(0)).alias("device"),
        F.get(parts, F.lit(1)).alias("session"),
    )


def _listed(listing: DataFrame) -> DataFrame:
    """Log files of a listing, with device and session taken from the path."""
    pattern = r"^([0-9A-F]{8})/([0-9]{8})/"
    return (
        listing.where(is_log_file(F.col("path")) & F.col("path").rlike(pattern))
        .select(
            "path",
            F.regexp_extract("path", pattern, 1).alias("device"),
            F.regexp_extract("path", pattern, 2).alias("session"),
        )
    )


def expand_backlog(
    entries: DataFrame, listing: DataFrame, entry_count: int | None = None
) -> DataFrame:
    """Distinct log files a manifest asks for: ``device, session, path, session_pos, file_pos``.

    Both prefix kinds become equi-joins on keys taken from the path. A file listed twice - by
    itself, by its session, by its device - is one row. ``session_pos`` is the first entry
    that asks for the session; ``file_pos`` is -1 for files found by a prefix and the entry
    position for files named by themselves only.

    What is asked for is worked out session by session, from the sessions that the listing has and those that entries
    name; files then meet this table once. A manifest of known length (``entry_count``) up to
    ``BROADCAST_ENTRIES`` is broadcast to the sessions; else Spark decides, and splits hot devices where it joins by shuffle.
    """
    keys = ["device", "session"]
    known = classify_backlog(entries)
    kind = F.col("kind")
    devices = known.where(kind == "device").groupBy("device").agg(F.min("pos").alias("_device_pos"))
    listed = _listed(listing).withColumn("file_pos", F.lit(None).cast("long"))
    named = known.where(kind == "file").select(*keys, "path", F.col("pos").alias("file_pos"))
    # Sessions of the listing (without a position), of session entries, and of file entries.
    wishes = known.where(kind.isin("session", "file")).select(
        *keys,
        F.when(kind == "session", F.col("pos")).alias("_session_pos"),
        F.when(kind == "file", F.col("pos")).alias("_named_pos"),
        F.lit(False).alias("_there"),
    )
    none = F.lit(None).cast("long")
    there = listed.select(*keys, none.alias("_session_pos"), none.alias("_named_pos"), F.lit(True).alias("_there"))
    few = entry_count is not None and entry_count <= BROADCAST_ENTRIES
    # Prefixes ask for a session only if the listing has any of its files.
    by_prefix = F.when(F.col("_there"), F.least("_device_pos", "_session_pos"))
    asked = (
        there.unionByName(wishes)
        .groupBy(*keys)
        .agg(F.min("_session_pos").alias("_session_pos"), F.min("_named_pos").alias("_named_pos"), F.max("_there").alias("_there"))
        .join(F.broadcast(devices) if few else devices, "device", "left")
        .select(*keys, by_prefix.alias("_prefix_pos"), F.least(by_prefix, "_named_pos").alias("session_pos"))
        .where(F.col("session_pos").isNotNull())
    )
    return (
        listed.unionByName(named)
        .join(asked, keys)
        .where(F.col("file_pos").isNotNull() | F.col("_prefix_pos").isNotNull())
        .groupBy(*keys, "path")
        .agg(F.min("session_pos").alias("session_pos"), F.min(F.coalesce("file_pos", F.lit(-1))).alias("file_pos"))
    )


def plan_batches(
    files: DataFrame, entries: int, smallest: int, largest: int, always_split: bool = False
) -> DataFrame:
    """``device, session, path, batch, place`` - the batch of each file and its place in it.

    Normally a batch is a session. A manifest of fewer than ``smallest`` entries that covers
    more than one session is regrouped: each device's files, in order, in batches of at most
    ``largest``. ``always_split`` regroups in any case.
    """
    # Two rows decide whether there is more than one session.
    regroup = always_split or (
        entries < smallest and len(files.select("device", "session").distinct().take(2)) > 1
    )
    within = ["file_pos", "path"]
    if not regroup:
        placed = ordered_index(
            files.withColumn("_part", F.col("path").substr(19, 6)),
            ["device", "session"],
            ["file_pos", "_part"],
            within,
            "place",
        )
        return placed.select(
            "device", "session", "path", F.concat_ws("/", "device", "session").alias("batch"), "place"
        )
    # Sessions follow each other within a device; a session's files are numbered by parts of
    # the file name, so that not even a huge session is numbered by one task.
    indexed = ordered_index(
        files.withColumn("_part", F.col("path").substr(19, 6)),
        ["device"],
        ["session_pos", "session", "file_pos", "_part"],
        within,
    )
    number = F.floor(F.col("index") / largest).cast("long")
    return indexed.select(
        "device",
        "session",
        "path",
        F.concat_ws("/", F.col("device"), number.cast("string")).alias("batch"),
        F.pmod(F.col("index"), F.lit(largest)).alias("place"),
    )
