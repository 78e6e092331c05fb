"""Trips: gap sessionization and the trip x row interval join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timegrid import bucket, duration_us, micros
from ..schema import DAY_KEYS

WINDOW_BUCKET = "_bucket"


def trip_windows(
    df: DataFrame,
    gap: str | int,
    min_length: str | int = 0,
    keys: Sequence[str] = DAY_KEYS,
    t: str = "t",
) -> DataFrame:
    """One row per trip: ``keys, trip_start, trip_end``.

    A trip ends where the next row is more than ``gap`` later (strictly); trips shorter than
    ``min_length`` are left out. Rows within one interval of length ``gap`` can never be cut
    apart, so each interval is first reduced to its earliest and latest time, map-side, and
    only these few pairs are put in order per series.
    """
    gap_us = duration_us(gap)
    us = micros(t)
    spans = (
        df.where(F.col(t).isNotNull())
        .groupBy(*keys, bucket(us, gap_us + 1).alias("_span"))
        .agg(F.min(us).alias("_lo"), F.max(us).alias("_hi"))
    )
    order = Window.partitionBy(*keys).orderBy("_span")
    previous = F.lag("_hi").over(order)
    starts = F.coalesce(F.col("_lo") - previous > gap_us, F.lit(True)).cast("int")
    numbered = spans.withColumn("_starts", starts).withColumn(
        "_trip", F.sum("_starts").over(order.rowsBetween(Window.unboundedPreceding, 0))
    )
    return (
        numbered.groupBy(*keys, "_trip")
        .agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"))
        .where(F.col("_hi") - F.col("_lo") >= duration_us(min_length))
        .select(
            *keys,
            F.timestamp_micros("_lo").alias("trip_start"),
            F.timestamp_micros("_hi").alias("trip_end"),
        )
    )


def trip_rows(
    rows: DataFrame,
    windows: DataFrame,
    bucket_width: str | int = "10 minutes",
    keys: Sequence[str] = DAY_KEYS,
    t: str = "t",
) -> DataFrame:
    """Rows inside a trip (both ends included), with ``trip_start`` and ``trip_end``.

    The interval join runs as an equi-join: windows are listed under every time bucket they
    touch, rows know their bucket, and the exact bounds are checked on the match. A series of
    any length is thereby spread over its buckets. Where Spark knows the windows to be small
    (see ``plans.trip_summary``, which stores them) it broadcasts them by its own size check
    and the rows are not shuffled at all.
    """
    width = duration_us(bucket_width)
    listed = windows.withColumn(
        WINDOW_BUCKET,
        F.explode(
            F.sequence(bucket(micros("trip_start"), width), bucket(micros("trip_end"), width))
        ),
    )
    keyed = rows.withColumn(WINDOW_BUCKET, bucket(micros(t), width))
    return keyed.join(listed, [*keys, WINDOW_BUCKET]).where(
        F.col(t).between(F.col("trip_start"), F.col("trip_end"))
    )
