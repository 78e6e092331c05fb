"""Two-threshold event detection: rising and falling edges of a signal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timegrid import micros
from ..schema import SERIES_KEYS
from .chunks import CHUNK, DEFAULT_CHUNK, chunk_rows, earlier_chunks, with_chunk


def thresholds(
    signal: Column, lower: float, upper: float, exact: bool = False
) -> tuple[Column, Column]:
    """``(below, above)`` predicates, null for a missing value."""
    if exact:
        return signal == F.lit(lower), signal == F.lit(upper)
    return signal <= F.lit(lower), signal >= F.lit(upper)


def threshold_flags(
    signal: Column, lower: float, upper: float, exact: bool = False
) -> tuple[Column, Column]:
    """``(below, above)`` flags; a missing value is neither."""
    below, above = thresholds(signal, lower, upper, exact)
    return F.coalesce(below, F.lit(False)), F.coalesce(above, F.lit(False))


def never_both(lower: float, upper: float, exact: bool = False) -> bool:
    """No value can be below and above at once."""
    return lower != upper if exact else lower < upper


# What later rows need to know about earlier ones: the time of the last (first) row with a
# given flag value. Each is a running maximum (minimum), so prefixes of chunks simply merge.
# Where the flags exclude each other, the last row below and above say everything.
_BASIC = {"last_below": ("_below", True), "last_above": ("_above", True)}
_FULL = {
    **_BASIC,
    "last_not_below": ("_below", False),
    "last_not_above": ("_above", False),
    "first_below": ("_below", True),
    "first_above": ("_above", True),
}


def _running(name: str, column: Column) -> Column:
    return F.max(column) if name.startswith("last") else F.min(column)


def _occurrence(flag: str, value: bool) -> Column:
    return F.when(F.col(flag) if value else ~F.col(flag), F.col("_us"))


def _facts(lower: float, upper: float, exact: bool) -> dict[str, tuple[str, bool]]:
    return _BASIC if never_both(lower, upper, exact) else _FULL


def _flagged(
    df: DataFrame, signal: str, lower: float, upper: float, exact: bool, t: str
) -> DataFrame:
    """Rows with their flags; those that cannot matter are left out at the scan."""
    value = F.col(signal)
    below, above = threshold_flags(value, lower, upper, exact)
    rows = df
    if never_both(lower, upper, exact):
        # Bare comparisons, which Spark can push to the scan.
        low, high = thresholds(value, lower, upper, exact)
        rows = df.where(low | high)
    return rows.select("*", below.alias("_below"), above.alias("_above"), micros(t).alias("_us"))


def edge_memory(
    df: DataFrame,
    signal: str,
    lower: float,
    upper: float,
    exact: bool = False,
    keys: Sequence[str] = SERIES_KEYS,
    t: str = "t",
) -> DataFrame:
    """What each series must remember of its rows to go on later: one row per series."""
    facts = _facts(lower, upper, exact)
    return (
        _flagged(df, signal, lower, upper, exact, t)
        .groupBy(*keys)
        .agg(*(_running(n, _occurrence(*f)).alias(n) for n, f in facts.items()))
    )


def merge_memory(memories: DataFrame, keys: Sequence[str] = SERIES_KEYS) -> DataFrame:
    facts = [c for c in memories.columns if c not in keys]
    return memories.groupBy(*keys).agg(*(_running(n, F.col(n)).alias(n) for n in facts))


def detect_edges(
    df: DataFrame,
    signal: str,
    lower: float,
    upper: float,
    exact: bool = False,
    rising_as_start: bool = True,
    keys: Sequence[str] = SERIES_KEYS,
    t: str = "t",
    width: int | str = DEFAULT_CHUNK,
    memory: DataFrame | None = None,
) -> DataFrame:
    """The rows of ``df`` that are edges, with ``EventType`` (Start/Stop) and ``EventValue``.

    Rising edge: the first row above within a run of rows with the same below flag, provided
    an earlier row was below. Falling edge: the same with the roles swapped. A row is the
    first one above in its run exactly if no qualifying row lies between the start of the run
    and the row itself, which the latest earlier occurrences of each flag decide.

    Expects distinct times within a series. Where the thresholds exclude each other, rows
    between them cannot influence any edge and are dropped at the scan. ``memory`` (see
    ``edge_memory``) stands for rows of the same series that were processed before.
    """
    facts = _facts(lower, upper, exact)
    rows = with_chunk(_flagged(df, signal, lower, upper, exact, t), t, width)
    summary = rows.groupBy(*keys, CHUNK).agg(
        *(_running(n, _occurrence(*f)).alias(n) for n, f in facts.items())
    )
    if memory is not None:
        # Earlier rows of the series count as one more chunk before all others.
        summary = summary.unionByName(memory.withColumn(CHUNK, F.lit(-(2**62)).cast("long")))
    past = earlier_chunks(keys)
    carry = summary.select(
        *keys, CHUNK, *(_running(n, F.col(n)).over(past).alias("_c_" + n) for n in facts)
    )

    here = chunk_rows(keys, ["_us"]).rowsBetween(Window.unboundedPreceding, -1)
    local = rows.select(
        "*", *(_running(n, _occurrence(*f)).over(here).alias("_h_" + n) for n, f in facts.items())
    )

    def known(name: str) -> Column:
        later = F.greatest if name.startswith("last") else F.least
        return later("_c_" + name, "_h_" + name).alias(name)

    joined = local.join(carry, [*keys, CHUNK], "left").select(
        *df.columns, "_below", "_above", *map(known, facts)
    )

    def edge(hit: str, run: str, armed: str, other: str) -> Column:
        if facts is _BASIC:
            already = F.col(other) > F.col(armed)
        else:
            before_run = F.when(F.col("_" + run), F.col("last_not_" + run)).otherwise(F.col(armed))
            already = (F.col(other) > F.coalesce(before_run, F.lit(-(2**62)))) & (
                F.col(other) > F.col("first_" + run)
            )
        return F.col("_" + hit) & F.col(armed).isNotNull() & ~F.coalesce(already, F.lit(False))

    rising = edge("above", "below", "last_below", "last_above")
    falling = edge("below", "above", "last_above", "last_below")
    start, stop = (rising, falling) if rising_as_start else (falling, rising)
    kinds = F.array(
        F.when(start, F.struct(F.lit("Start").alias("type"), F.lit(1).cast("long").alias("value"))),
        F.when(stop, F.struct(F.lit("Stop").alias("type"), F.lit(0).cast("long").alias("value"))),
    )
    return (
        joined.withColumn("_kind", F.explode(F.array_compact(kinds)))
        .withColumn("EventType", F.col("_kind.type"))
        .withColumn("EventValue", F.col("_kind.value"))
        .select(*df.columns, "EventType", "EventValue")
    )
