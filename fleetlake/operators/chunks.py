"""Ordered computations over long series, cut into time chunks.

A window partitioned by the series key alone puts a whole series into one task. One device
may hold a large share of all rows, so every ordered operator here works in two levels:

1. rows are windowed per (series, time chunk), which spreads a long series over many tasks;
2. one small row per chunk, made by an ordinary aggregate with map-side combine, carries what
   later chunks need to know (last row, positions, counts) and is joined back on
   (series, chunk) - the partitioning the rows already have.

A chunk is a function of the time alone, so equal times never straddle two chunks and a
recomputed task always gets the same chunk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timegrid import bucket, duration_us, micros, raster_us

CHUNK = "_chunk"
DEFAULT_CHUNK = "10 minutes"


def chunk_width(
    df: DataFrame,
    keys: Sequence[str],
    t: str = "t",
    target_rows: int = 2_000_000,
    widest: str = "1 day",
    probe: str = "10 minutes",
) -> int:
    """A chunk width (microseconds) for which the densest chunk has about ``target_rows``.

    Counts rows per (series, probe interval) with map-side combine; only the largest count
    reaches the driver. Sparse data gets the widest chunk, dense data ever finer ones.
    """
    probe_us = duration_us(probe)
    densest = (
        df.groupBy(*keys, bucket(micros(t), probe_us).alias(CHUNK))
        .count()
        .agg(F.max("count"))
        .first()[0]
    )
    width = duration_us(widest)
    if not densest:
        return width
    while width > 1_000 and densest * (width / probe_us) > target_rows:
        width = max(width // 2, 1_000)
    return width


def raster_width(raster: str, target_rows: int = 2_000_000, widest: str = "1 day") -> int:
    """The width (microseconds) of a chunk that holds about ``target_rows`` labels of a raster at most."""
    return min(raster_us(raster) * target_rows, duration_us(widest))


def with_chunk(df: DataFrame, t: str, width: int | str) -> DataFrame:
    return df.withColumn(CHUNK, bucket(micros(t), duration_us(width) if isinstance(width, str) else width))


def chunk_rows(keys: Sequence[str], order: Sequence[str]) -> Window:
    """Window over the rows of one chunk."""
    return Window.partitionBy(*keys, CHUNK).orderBy(*order)


def earlier_chunks(keys: Sequence[str]) -> Window:
    """Window over the summaries of all earlier chunks of the series."""
    return (
        Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    )


def previous_row(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    t: str = "t",
    width: int | str = DEFAULT_CHUNK,
    prefix: str = "prev_",
) -> DataFrame:
    """Add ``prev_<column>`` of the preceding row of the series (null on its first row).

    ``prev_<t>`` is always added; it tells a first row from a previous null.
    """
    wanted = list(dict.fromkeys([t, *columns]))
    rows = with_chunk(df, t, width)
    tails = rows.groupBy(*keys, CHUNK).agg(
        *(F.max_by(c, micros(t)).alias(f"_tail_{c}") for c in wanted)
    )
    neighbour = Window.partitionBy(*keys).orderBy(CHUNK)
    carry = tails.select(
        *keys, CHUNK, *(F.lag(f"_tail_{c}").over(neighbour).alias(f"_carry_{c}") for c in wanted)
    )
    w = chunk_rows(keys, [t])
    local = rows.select(
        "*",
        F.row_number().over(w).alias("_n"),
        *(F.lag(c).over(w).alias(f"_lag_{c}") for c in wanted),
    )
    first = F.col("_n") == 1
    joined = local.join(carry, [*keys, CHUNK], "left")
    return joined.select(
        *(F.col(c) for c in df.columns),
        *(
            F.when(first, F.col(f"_carry_{c}")).otherwise(F.col(f"_lag_{c}")).alias(prefix + c)
            for c in wanted
        ),
    )


def run_ids(
    df: DataFrame,
    keys: Sequence[str],
    flag: str,
    t: str = "t",
    width: int | str = DEFAULT_CHUNK,
    output: str = "run_id",
) -> DataFrame:
    """Number the runs of equal ``flag`` values within each series, from 1.

    The first row always opens a run. Null flags form runs of their own.
    """
    prev = previous_row(df, keys, [flag], t, width)
    changed = F.col("prev_" + t).isNull() | ~F.col("prev_" + flag).eqNullSafe(F.col(flag))
    rows = with_chunk(prev.withColumn("_change", changed.cast("long")), t, width)
    changes = rows.groupBy(*keys, CHUNK).agg(F.sum("_change").alias("_changes"))
    carry = changes.select(
        *keys,
        CHUNK,
        F.coalesce(F.sum("_changes").over(earlier_chunks(keys)), F.lit(0)).alias("_before"),
    )
    running = chunk_rows(keys, [t]).rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumn("_here", F.sum("_change").over(running))
    return local.join(carry, [*keys, CHUNK], "left").select(
        *df.columns, (F.col("_before") + F.col("_here")).alias(output)
    )


def ordered_index(
    df: DataFrame,
    keys: Sequence[str],
    coarse: Sequence[str],
    fine: Sequence[str],
    output: str = "index",
) -> DataFrame:
    """0-based position of each row within ``keys``, ordered by ``coarse`` then ``fine``.

    Positions inside one coarse value are counted by separate tasks; the counts of all
    earlier coarse values are added as an offset.
    """
    sizes = df.groupBy(*keys, *coarse).agg(F.count(F.lit(1)).alias("_size"))
    before = (
        Window.partitionBy(*keys).orderBy(*coarse).rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = sizes.select(
        *keys, *coarse, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    w = Window.partitionBy(*keys, *coarse).orderBy(*fine)
    local = df.withColumn("_n", F.row_number().over(w))
    return local.join(offsets, [*keys, *coarse]).select(
        *df.columns, (F.col("_offset") + F.col("_n") - 1).alias(output)
    )


def salted(series: DataFrame, salts: int, name: str = "_salt") -> DataFrame:
    """Repeat one-row-per-key facts under every salt, to join them to salted rows."""
    return series.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


def salt_of(column: Column, salts: int) -> Column:
    return F.pmod(F.hash(column), F.lit(salts))
