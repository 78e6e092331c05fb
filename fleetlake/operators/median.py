"""Exact medians without gathering a group in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Slots per doubling of magnitude in the first narrowing step.
_LOG_STEPS = 1024.0
#: Equal slices of the remaining interval in each later step.
_SLICES = 4_194_304.0
#: A slot holds less than 2^43 different doubles: after 2^22 slices less than 2^21 are left, which 2^22 more part.
_STEPS = 2


def _slot(v: Column) -> Column:
    """Never smaller for a larger value: by sign and order of magnitude, zeros, infinities and NaN apart."""
    size = F.floor(F.least(F.log2(F.abs(v)) * _LOG_STEPS, F.lit(2_000_000.0))) + 3_000_000
    signed = F.when(v < 0, -size).when(v > 0, size).otherwise(F.lit(0))
    return F.when(F.isnan(v), F.lit(10_000_000)).otherwise(signed).cast("long")


def _hits(rows: DataFrame, inside: Sequence[str]) -> DataFrame:
    """The cells that hold wanted ranks: ``inside, _cell, _lo, _hi, _ranks`` (counted within the cell).

    ``rows`` have ``inside, _cell, value, n``, and ``_wanted`` ranks, equal for all rows of one ``inside``, or none
    where the middle of all is wanted. Only counts are put in order, at most four million for each ``inside``.
    """
    group = Window.partitionBy(*inside)
    given = "_wanted" in rows.columns
    cells = rows.groupBy(*inside, "_cell").agg(
        F.sum("n").alias("_size"),
        F.min("value").alias("_lo"),
        F.max("value").alias("_hi"),
        *([F.first("_wanted").alias("_wanted")] if given else []),
    )
    if not given:
        after = F.sum("_size").over(group) + 1
        cells = cells.withColumn("_wanted", F.array_distinct(F.array(F.floor(after / 2), F.ceil(after / 2))))
    upto = F.sum("_size").over(group.orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0))
    within = F.transform("_wanted", lambda r: r - (F.col("_upto") - F.col("_size")))
    return (
        cells.withColumn("_upto", upto)
        .withColumn("_ranks", F.filter(within, lambda r: (r > 0) & (r <= F.col("_size"))))
        .where(F.size("_ranks") > 0)
        .select(*inside, "_cell", "_lo", "_hi", "_ranks")
    )


def exact_median(df: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """``keys, median`` of the non-null values; the mid-point for even counts.

    Equal values are counted map-side first. Each group's middle rank(s) are then located by narrowing steps over
    counts only - slots by order of magnitude, then equal slices of the cell that was hit - until the cell holds
    a single value. Values themselves are never put in order, however many there are in however
    narrow an interval. The last step mostly finds nothing left to do. NaN ranks above all.
    """
    rows = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).cast("double").alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("_cell", _slot(F.col("value")))
    )
    # A cell is named by its smallest value: cells of a group don't overlap.
    inside, found = list(keys), []
    for step in range(_STEPS + 1):
        hits = _hits(rows, inside)
        single = F.col("_lo") == F.col("_hi")
        settled = hits if step == _STEPS else hits.where(single)
        found.append(settled.select(*keys, F.explode("_ranks"), F.col("_lo").alias("value")).drop("col"))
        if step == _STEPS:
            break
        share = (F.col("value") - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))
        rows = (
            rows.select(*inside, "_cell", "value", "n")
            .join(hits.where(~single), [*inside, "_cell"])
            .select(
                *keys,
                F.col("_lo").alias("_in"),
                "value",
                "n",
                F.col("_ranks").alias("_wanted"),
                F.floor(share * _SLICES).alias("_cell"),
            )
        )
        inside = [*keys, "_in"]
    return reduce(DataFrame.unionAll, found).groupBy(*keys).agg(F.avg("value").alias("median"))
