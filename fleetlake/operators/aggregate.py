"""The ten trip aggregates, in long form."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timegrid import micros
from ..schema import AGGREGATIONS
from .median import exact_median
from .trips import WINDOW_BUCKET

log = logging.getLogger(__name__)

TRIP_KEYS = ("device", "date", "trip_start", "trip_end")

# Aggregates that depend on the order of rows.
DELTAS = {"delta_sum", "delta_sum_pos", "delta_sum_neg"}


def known_aggregations(names: Sequence[str]) -> list[str]:
    """The supported names, in the given order; others are reported and skipped."""
    unknown = [n for n in names if n not in AGGREGATIONS]
    if unknown:
        log.warning("skipping unsupported aggregations: %s", ", ".join(unknown))
    return [n for n in names if n in AGGREGATIONS]


def numeric_signals(df: DataFrame, signals: Sequence[str]) -> list[str]:
    """The listed signals that the message has; text signals are an error."""
    types = dict(df.dtypes)
    present = [s for s in signals if s in types]
    text = [s for s in present if types[s] == "string"]
    if text:
        raise TypeError(f"cannot aggregate text signals: {', '.join(text)}")
    return present


def _partial_states(
    rows: DataFrame, signals: Sequence[str], keys: Sequence[str], t: str, deltas: bool
) -> DataFrame:
    """One row per (trip, time bucket) with mergeable states of all signals."""
    group = [*keys, WINDOW_BUCKET]
    us = micros(t)
    if deltas:
        order = Window.partitionBy(*group).orderBy(t)
        rows = rows.select(
            "*", *((F.col(s) - F.lag(s).over(order)).alias(f"_d_{s}") for s in signals)
        )
    states = [F.min(us).alias("_t_lo"), F.max(us).alias("_t_hi")]
    for s in signals:
        states += [
            F.count(s).alias(f"_n_{s}"),
            F.sum(s).alias(f"_sum_{s}"),
            F.min(s).alias(f"_min_{s}"),
            F.max(s).alias(f"_max_{s}"),
            F.min_by(s, us).alias(f"_first_{s}"),
            F.max_by(s, us).alias(f"_last_{s}"),
        ]
        if deltas:
            d = F.col(f"_d_{s}")
            states += [
                F.sum(F.when(d > 0, d)).alias(f"_up_{s}"),
                F.sum(F.when(d < 0, d)).alias(f"_down_{s}"),
            ]
    return rows.groupBy(*group).agg(*states)


def _merge_states(
    states: DataFrame, signals: Sequence[str], keys: Sequence[str], deltas: bool
) -> DataFrame:
    """Merge bucket states to one wide row per trip."""
    if deltas:
        # The step from one bucket to the next is the difference of two edge rows.
        order = Window.partitionBy(*keys).orderBy(WINDOW_BUCKET)
        states = states.select(
            "*",
            *(
                (F.col(f"_first_{s}") - F.lag(f"_last_{s}").over(order)).alias(f"_step_{s}")
                for s in signals
            ),
        )
    zero = F.lit(0.0)
    merged = [((F.max("_t_hi") - F.min("_t_lo")) / F.lit(1_000_000.0)).alias("Duration")]
    for s in signals:
        n, total = F.sum(f"_n_{s}"), F.sum(f"_sum_{s}")
        merged += [
            n.alias(f"SignalCount_{s}"),
            F.try_divide(total, n).alias(f"avg_{s}"),
            F.coalesce(total.cast("double"), zero).alias(f"sum_{s}"),
            F.min(f"_min_{s}").alias(f"min_{s}"),
            F.max(f"_max_{s}").alias(f"max_{s}"),
            F.min_by(f"_first_{s}", WINDOW_BUCKET).alias(f"first_{s}"),
            F.max_by(f"_last_{s}", WINDOW_BUCKET).alias(f"last_{s}"),
        ]
        if deltas:
            step = F.col(f"_step_{s}")
            up = F.coalesce(F.sum(f"_up_{s}"), zero) + F.coalesce(
                F.sum(F.when(step > 0, step)), zero
            )
            down = F.coalesce(F.sum(f"_down_{s}"), zero) + F.coalesce(
                F.sum(F.when(step < 0, step)), zero
            )
            merged += [
                (up + down).alias(f"delta_sum_{s}"),
                up.alias(f"delta_sum_pos_{s}"),
                down.alias(f"delta_sum_neg_{s}"),
            ]
    return states.groupBy(*keys).agg(*merged)


def trip_aggregate(
    rows: DataFrame,
    signals: Sequence[str],
    aggregations: Sequence[str],
    keys: Sequence[str] = TRIP_KEYS,
    t: str = "t",
) -> DataFrame:
    """Long table ``keys, Signal, Aggregation, SignalValue, SignalCount, Duration``.

    ``rows`` come from ``trip_rows``. All signals and aggregates of a message share one pass:
    rows are reduced to a state per (trip, time bucket), the states are merged per trip, and
    only the merged table is unpivoted. Rows are ordered (and so shuffled) only if a delta
    aggregate is asked for. An all-null signal keeps its row: 0.0 for the sums, else null.
    """
    names = known_aggregations(aggregations)
    present = numeric_signals(rows, signals)
    if not names or not present:
        return rows.sparkSession.createDataFrame([], _long_schema(rows, keys))
    unique = list(dict.fromkeys(present))
    deltas = bool(DELTAS & set(names))
    states = _partial_states(
        rows.select(*keys, WINDOW_BUCKET, t, *unique), unique, keys, t, deltas
    )
    wide = _merge_states(states, unique, keys, deltas)
    plain = [n for n in names if n != "median"]
    long = None
    if plain:
        long = _unpivot(wide, keys, present, plain)
    if "median" in names:
        medians = exact_median(_signal_values(rows, keys, unique), [*keys, "Signal"])
        counts = _unpivot(wide, keys, present, ["max"], value=False)
        repeated = counts.withColumn(
            "Aggregation", F.explode(F.lit(["median"] * names.count("median")))
        )
        with_median = repeated.join(medians, [*keys, "Signal"], "left").select(
            *keys,
            "Signal",
            "Aggregation",
            F.col("median").alias("SignalValue"),
            "SignalCount",
            "Duration",
        )
        long = with_median if long is None else long.unionByName(with_median)
    return long


def _long_schema(rows: DataFrame, keys: Sequence[str]) -> T.StructType:
    return (
        T.StructType(list(rows.select(*keys).schema.fields))
        .add("Signal", "string")
        .add("Aggregation", "string")
        .add("SignalValue", "double")
        .add("SignalCount", "bigint")
        .add("Duration", "double")
    )


def _unpivot(
    wide: DataFrame,
    keys: Sequence[str],
    signals: Sequence[str],
    names: Sequence[str],
    value: bool = True,
) -> DataFrame:
    lines = [
        F.struct(
            F.lit(s).alias("Signal"),
            F.lit(n).alias("Aggregation"),
            (F.col(f"{n}_{s}").cast("double") if value else F.lit(None).cast("double")).alias(
                "SignalValue"
            ),
            F.col(f"SignalCount_{s}").alias("SignalCount"),
        )
        for s in signals
        for n in names
    ]
    return wide.select(*keys, "Duration", F.explode(F.array(*lines)).alias("_line")).select(
        *keys, "_line.Signal", "_line.Aggregation", "_line.SignalValue", "_line.SignalCount", "Duration"
    )


def _signal_values(rows: DataFrame, keys: Sequence[str], signals: Sequence[str]) -> DataFrame:
    """Long non-null values ``keys, Signal, value``."""
    pairs = F.array(
        *(F.struct(F.lit(s).alias("Signal"), F.col(s).cast("double").alias("value")) for s in signals)
    )
    return (
        rows.select(*keys, F.explode(pairs).alias("_p"))
        .select(*keys, "_p.Signal", "_p.value")
        .where(F.col("value").isNotNull())
    )
