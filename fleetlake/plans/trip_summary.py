"""Per-trip aggregates of the configured signals, one long row each."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codes import trip_id
from ..functions.timegrid import duration_us
from ..operators.aggregate import (
    DELTAS,
    TRIP_KEYS,
    known_aggregations,
    numeric_signals,
    trip_aggregate,
)
from ..operators.chunks import chunk_width
from ..operators.trips import trip_rows, trip_windows
from ..schema import DAY_KEYS, TRIP_SUMMARY_SCHEMA
from ..session import stored
from ..sources.configs import Cluster, TripConfig
from ..sources.lake import Lake

#: Widest time bucket of the trip join; a bucket never spans two trips.
TRIP_BUCKET = "10 minutes"


def _wanted(df: DataFrame, config: TripConfig, cluster: Cluster) -> DataFrame:
    """The period's rows of the cluster's devices, which are a table as small as the document."""
    devices = df.sparkSession.createDataFrame([(d,) for d in cluster.devices], "device string").distinct()
    period = df.where(F.col("date").between(F.lit(config.start), F.lit(config.end)))
    return period.join(F.broadcast(devices), "device", "left_semi")


def _layouts(config: TripConfig) -> list[tuple[Cluster, list[tuple[str, str]]]]:
    """Clusters that share trip message and specs are computed together."""
    merged: dict[tuple, list[Cluster]] = {}
    for cluster in config.clusters:
        merged.setdefault((cluster.trip_message, cluster.specs), []).append(cluster)
    return [
        (
            Cluster(
                group[0].name,
                tuple(dict.fromkeys(d for c in group for d in c.devices)),
                group[0].trip_message,
                group[0].specs,
            ),
            [(d, c.name) for c in group for d in c.devices],
        )
        for group in merged.values()
    ]


def trip_summary(spark: SparkSession, lake: Lake, config: TripConfig) -> DataFrame:
    """The trip-summary table with the folder ``date`` it is stored under.

    A device that is in two clusters gets rows for each.
    """
    parts = []
    windows_of: dict[tuple, DataFrame] = {}
    widest = min(config.gap_us + 1, duration_us(TRIP_BUCKET))
    for cluster, members in _layouts(config):
        trip_message = lake.message(cluster.trip_message)
        if trip_message is None:
            continue
        key = (cluster.trip_message, cluster.devices)
        if key not in windows_of:
            windows_of[key] = stored(
                trip_windows(
                    _wanted(trip_message, config, cluster).select("device", "date", "t"),
                    config.gap_us / 1e6,
                    config.min_length_us / 1e6,
                ),
                "trip-windows",
            )
        clusters = spark.createDataFrame(members, "device string, Cluster string")
        for spec in cluster.specs:
            rows = lake.message(spec.message)
            if rows is None or not known_aggregations(spec.aggregations):
                continue
            signals = numeric_signals(rows, spec.signals)
            if not signals:
                continue
            width = widest
            pruned = _wanted(rows, config, cluster).select(
                "device", "date", "t", *dict.fromkeys(signals)
            )
            if DELTAS & set(spec.aggregations):
                # Rows are put in order per bucket: no bucket may hold too many of them.
                width = min(width, chunk_width(pruned, DAY_KEYS))
            inside = trip_rows(pruned, windows_of[key], width / 1e6)
            parts.append(
                trip_aggregate(inside, signals, spec.aggregations, TRIP_KEYS)
                .withColumn("Message", F.lit(spec.message))
                .join(clusters, "device")
            )
    if not parts:
        return spark.createDataFrame([], TRIP_SUMMARY_SCHEMA).withColumn(
            "date", F.lit(None).cast("date")
        )
    return reduce(DataFrame.unionByName, parts).select(
        F.col("device").alias("DeviceID"),
        "Message",
        "Signal",
        "Aggregation",
        "SignalValue",
        "SignalCount",
        "Duration",
        F.col("trip_start").alias("TripStart"),
        F.col("trip_end").alias("TripEnd"),
        trip_id(F.col("device"), F.col("trip_start")).alias("TripID"),
        "Cluster",
        "date",
    )


def days_processed(summary: DataFrame) -> DataFrame:
    """How many days produced any row."""
    return summary.agg(F.countDistinct("date").alias("days_processed"))
