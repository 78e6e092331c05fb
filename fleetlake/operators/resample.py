"""Resampling to a time grid, grid joins and stacking."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timegrid import ceil_to, micros, raster_us
from ..schema import PATH_COLUMNS, SERIES_KEYS
from .chunks import salt_of, salted


def signal_columns(df: DataFrame, keys: Sequence[str] = SERIES_KEYS, t: str = "t") -> list[str]:
    """Everything that is neither key, path part nor time."""
    return [c for c in df.columns if c not in {*keys, *PATH_COLUMNS, t}]


def resample_grid(
    df: DataFrame,
    raster: str | int,
    signals: Sequence[str] | None = None,
    keys: Sequence[str] = SERIES_KEYS,
    t: str = "t",
) -> DataFrame:
    """One row per grid label ``L``: the last whole row with a time in ``[L - raster, L]``.

    The grid of a series reaches from the label at or before its first row to the label at or
    before its last row. Labels without a row, or whose row is all null, are left out; of rows
    with equal time one is kept.

    Every row names the label(s) it can fill, and a label keeps its latest row by an aggregate
    with map-side combine: no sort, no window, no range join. Keys include the label, so a
    long series is spread over all tasks.
    """
    step = raster_us(raster)
    signals = list(signals) if signals is not None else signal_columns(df, keys, t)
    us = F.col("_us")
    up = ceil_to(us, step)
    labels = F.when(up == us, F.array(up, up + step)).otherwise(F.array(up))
    rows = df.where(F.col(t).isNotNull()).select(*keys, *signals, micros(t).alias("_us"))
    filled = (
        rows.select("*", F.explode(labels).alias("_label"))
        # The label becomes the new time before grouping, so that joins on the time find rows
        # already partitioned by it.
        .select(*keys, *signals, "_us", F.timestamp_micros("_label").alias(t))
        .groupBy(*keys, t)
        .agg(*(F.max_by(s, us).alias(s) for s in signals))
    )
    # The only label that can lie after a series' last row: the one that follows its grid.
    last = F.max(us)
    beyond = rows.groupBy(*keys).agg(
        F.timestamp_micros(last - F.pmod(last, F.lit(step)) + F.lit(step)).alias(t)
    )
    kept = filled.join(beyond, [*keys, t], "left_anti").na.drop("all", subset=signals)
    return kept.select(*keys, t, *signals)


def prefixed(df: DataFrame, message: str, signals: Sequence[str]) -> DataFrame:
    """Signals renamed to ``<message>_<signal>``."""
    return df.select(
        *(F.col(c).alias(f"{message}_{c}") if c in signals else F.col(c) for c in df.columns)
    )


def grid_join(
    frames: Mapping[str, DataFrame],
    keys: Sequence[str] = SERIES_KEYS,
    prefix: bool = False,
    t: str = "t",
) -> DataFrame:
    """Inner join of resampled messages on series and grid label.

    Resampled frames are already partitioned by (series, label), so the join adds no shuffle
    of its own.
    """
    named = [
        prefixed(df, message, signal_columns(df, keys, t)) if prefix else df
        for message, df in frames.items()
    ]
    return reduce(lambda left, right: left.join(right, [*keys, t]), named)


def stack_messages(frames: Mapping[str, DataFrame], tag: str | None = "Message") -> DataFrame:
    """Rows of all messages one after the other; missing signals are null."""
    tagged = [
        df.withColumn(tag, F.lit(message)) if tag else df for message, df in frames.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def with_position(
    grid: DataFrame,
    candidates: Sequence[tuple[DataFrame, DataFrame]],
    keys: Sequence[str] = SERIES_KEYS,
    lat: str = "Latitude",
    lon: str = "Longitude",
    t: str = "t",
    salts: int = 32,
) -> DataFrame:
    """Join the grid of the first position message that a log file has.

    ``candidates`` are pairs (message rows, the same rows resampled) in order of preference.
    Where a file has one, rows without a position at the same label are dropped (inner join);
    files without any keep all rows, with null coordinates. The per-file choice is one small
    row per file, repeated under each salt so that a long file does not meet it in one task.
    """
    chosen = (
        reduce(
            DataFrame.unionByName,
            [rows.select(*keys, F.lit(k).alias("_rank")) for k, (rows, _) in enumerate(candidates)],
        )
        .groupBy(*keys)
        .agg(F.min("_rank").alias("_rank"))
    )
    # Per label the best-ranked candidate present there; it counts only if it is the
    # candidate the file as a whole uses.
    at_label = (
        reduce(
            DataFrame.unionByName,
            [
                df.select(
                    *keys,
                    t,
                    F.lit(k).alias("_here"),
                    F.col(lat).cast("double").alias("_lat"),
                    F.col(lon).cast("double").alias("_lon"),
                )
                for k, (_, df) in enumerate(candidates)
            ],
        )
        .groupBy(*keys, t)
        .agg(
            F.min_by("_lat", "_here").alias("Latitude"),
            F.min_by("_lon", "_here").alias("Longitude"),
            F.min("_here").alias("_here"),
        )
    )
    return (
        grid.drop("Latitude", "Longitude")
        .join(at_label, [*keys, t], "left")
        .withColumn("_salt", salt_of(F.col(t), salts))
        .join(salted(chosen, salts), [*keys, "_salt"], "left")
        .where(F.col("_rank").isNull() | F.coalesce(F.col("_here") == F.col("_rank"), F.lit(False)))
        .drop("_salt", "_rank", "_here")
    )
