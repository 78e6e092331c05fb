"""Which log files have which messages, and which of them a rule selects."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import SERIES_KEYS


def file_groups(listing: DataFrame, keys: Sequence[str] = SERIES_KEYS) -> DataFrame:
    """``keys, messages`` - the sorted names of the messages each log file was decoded to.

    ``listing`` has one row per object with its layout parts. The number of names per file is
    bounded by the signal catalog, not by the data.
    """
    return listing.groupBy(*keys).agg(F.sort_array(F.collect_set("message")).alias("messages"))


def matching_messages(groups: DataFrame, match_type: str, spec) -> F.Column:
    """The messages of a file group that ``spec`` names, as an array column."""
    names = F.col("messages")
    if match_type == "equals":
        return F.array_intersect(names, F.lit(list(spec)))
    if match_type == "contains":
        return F.filter(names, lambda m: F.contains(m, F.lit(spec)))
    if match_type == "all_messages":
        return names
    raise ValueError(f"unknown match type: {match_type}")


def select_messages(
    groups: DataFrame, match_type: str, spec=None, mode: str = "each"
) -> DataFrame:
    """Restrict file groups to selected messages and drop groups without any.

    ``mode="each"``: whatever is selected counts by itself. ``mode="all_present"``: a group
    qualifies only if it has every wanted message - the listed ones for ``equals``, every
    matching one of the whole run for ``contains``.
    """
    chosen = groups.withColumn("messages", matching_messages(groups, match_type, spec))
    if mode == "all_present" and match_type == "equals":
        wanted = F.lit(list(spec))
        return chosen.where(
            (F.size(F.array_except(wanted, F.col("messages"))) == 0) & (F.size("messages") > 0)
        )
    if mode == "all_present" and match_type == "contains":
        # A group's matches are part of the run's matches: it has all if it has as many. The
        # count is a single row, which Spark knows and broadcasts.
        wanted = (
            chosen.select(F.explode("messages").alias("m"))
            .agg(F.countDistinct("m").cast("int").alias("_wanted"))
        )
        return chosen.where(F.size("messages") > 0).join(
            wanted, F.size("messages") == F.col("_wanted"), "left_semi"
        )
    return chosen.where(F.size("messages") > 0)
