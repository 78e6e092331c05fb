"""Object-created notices of different stores, reduced to log file paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.paths import is_log_file

_RECORDS = "Records array<struct<s3: struct<bucket: struct<name: string>, `object`: struct<key: string>>>>"


def _blob_path(url: Column) -> Column:
    # "/container/a/b.MF4": the first part is empty, the second the container.
    parts = F.split(F.parse_url(url, F.lit("PATH")), "/")
    return F.when(F.size(parts) >= 3, F.array_join(F.slice(parts, F.lit(3), F.size(parts)), "/"))


def paths_in(envelope: Column, provider: Column) -> Column:
    """All object paths named by one envelope (JSON text), as an array."""
    keys = F.transform(
        F.from_json(envelope, _RECORDS)["Records"], lambda r: F.try_url_decode(r["s3"]["object"]["key"])
    )
    return (
        F.when(F.startswith(F.ltrim(envelope), F.lit("[")), F.from_json(envelope, "array<string>"))
        .when(provider == "Amazon", keys)
        .when(provider == "Azure", F.array(_blob_path(F.get_json_object(envelope, "$.url"))))
        .when(provider == "Google", F.array(F.get_json_object(envelope, "$.data.name")))
    )


def trigger_paths(
    envelopes: DataFrame, envelope: str = "envelope", provider: str = "provider"
) -> DataFrame:
    """One row per log file path, with the envelope's other columns.

    Envelopes of four shapes are understood: a list of paths (any provider), storage records
    with URL-encoded keys, a blob URL, and an object name. Unreadable envelopes and paths that
    are not log files give no rows.
    """
    others = [c for c in envelopes.columns if c not in (envelope, provider)]
    return (
        envelopes.select(
            *others, F.explode(paths_in(F.col(envelope), F.col(provider))).alias("path")
        )
        .where(is_log_file(F.col("path")))
    )
