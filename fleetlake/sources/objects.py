"""Object listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import is_log_file, lake_parts


def list_objects(
    spark: SparkSession, root: str, prefix: str = "", suffix: str | None = None
) -> DataFrame:
    """``path, size, last_modified`` of all objects below ``root``.

    Paths are relative to ``root``; ``prefix`` and ``suffix`` compare case-sensitively. The
    contents are never read. Listing pages and parallel listing are the file system's part.
    """
    base = root.rstrip("/") + "/"
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(base)
        .select("path", F.col("length").alias("size"), F.col("modificationTime").alias("last_modified"))
    )
    # Listed paths carry a scheme that ``root`` may lack: cut after the root's own text.
    bare = base.split(":", 1)[1].lstrip("/") if ":" in base else base.lstrip("/")
    relative = F.substring_index("path", bare, -1)
    return filter_objects(files.withColumn("path", relative), prefix, suffix)


def filter_objects(listing: DataFrame, prefix: str = "", suffix: str | None = None) -> DataFrame:
    if prefix:
        listing = listing.where(F.startswith(F.col("path"), F.lit(prefix)))
    if suffix:
        listing = listing.where(F.endswith(F.col("path"), F.lit(suffix)))
    return listing


def log_files(listing: DataFrame) -> DataFrame:
    """Only raw log files."""
    return listing.where(is_log_file(F.col("path")))


def with_lake_parts(listing: DataFrame) -> DataFrame:
    """Add the layout parts (device, message, date, file_name) of each lake path."""
    return listing.withColumns(lake_parts(F.col("path")))
