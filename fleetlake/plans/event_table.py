"""Start/Stop events of configured signals, with positions and notifications."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codes import event_id
from ..operators.chunks import chunk_width, raster_width
from ..operators.edges import detect_edges, never_both, thresholds
from ..operators.resample import resample_grid, signal_columns, with_position
from ..schema import EVENT_SCHEMA, SERIES_KEYS
from ..sources.configs import EVENT_DEFAULTS
from ..sources.lake import Lake

log = logging.getLogger(__name__)

EVENT_COLUMNS = [f.name for f in EVENT_SCHEMA]


def event_messages(lake: Lake, event: Mapping) -> list[str]:
    """Messages an event looks at, one by one; of ``equals`` lists only the first counts."""
    match_type, filtered = event["messages_match_type"], event.get("messages_filtered_list")
    if match_type == "equals":
        return list(filtered[0])
    names = lake.names()
    if match_type == "contains":
        return [n for n in names if filtered in n]
    if match_type == "all_messages":
        return names
    raise ValueError(f"unknown match type: {match_type}")


def _triggers(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per trigger signal: all triggers of an event share scan, sort and join."""
    if len(names) == 1:
        # A plain column, so that thresholds can reach the scan.
        others = [c for c in df.columns if c not in names]
        value = F.col(names[0]).cast("double").alias("SignalValue")
        return df.select(*others, F.lit(names[0]).alias("Signal"), value)
    pairs = [F.struct(F.lit(n).alias("Signal"), F.col(n).cast("double").alias("v")) for n in names]
    others = [c for c in df.columns if c not in names]
    return df.select(*others, F.explode(F.array(*pairs)).alias("_p")).select(
        *others, F.col("_p.Signal"), F.col("_p.v").alias("SignalValue")
    )


def _near(signals: Sequence[str], lower: float, upper: float, exact: bool):
    """Which stored rows can matter to the edges of signals, where both states exclude each other.

    A NaN passes as large; it becomes a missing value, and goes, once it is read.
    """
    if not never_both(lower, upper, exact):
        return None

    def condition(columns: Sequence[str]) -> Column | None:
        pairs = [thresholds(F.col(f"`{s}`"), lower, upper, exact) for s in signals if s in columns]
        return reduce(Column.__or__, [c for pair in pairs for c in pair]) if pairs else None

    return condition


def detect_event(
    lake: Lake,
    event: Mapping,
    general: Mapping = EVENT_DEFAULTS,
    width: int | str | None = None,
) -> DataFrame | None:
    """Event rows of one configured event, or None if the lake has nothing to look at.

    Without a chunk ``width``, it is fitted to the densest interval of the rows.
    """
    general = {**EVENT_DEFAULTS, **general}
    lower, upper, exact = event["lower_threshold"], event["upper_threshold"], event["exact_match"]
    raster = event.get("raster", "")
    near = None if raster else _near(event["trigger_signals"], lower, upper, exact)
    rows = lake.messages(event_messages(lake, event), near)
    if rows is None:
        log.warning("event %s is skipped: none of its messages is in the lake", event["event_name"])
        return None
    triggers = [s for s in event["trigger_signals"] if s in rows.columns]
    absent = [s for s in event["trigger_signals"] if s not in triggers]
    if absent:
        log.warning("event %s: no file has its trigger signals %s", event["event_name"], ", ".join(absent))
    if not triggers:
        return None
    keys = [*SERIES_KEYS, "message"]
    if width is None:
        # A raster limits how dense rows can be, so that none have to be counted.
        width = raster_width(raster) if raster else chunk_width(rows, keys)
    if raster:
        # Rows without any trigger value matter only where they can end a run.
        signals = triggers if never_both(lower, upper, exact) else signal_columns(rows)
        grid = resample_grid(rows, raster, signals, keys).select(*keys, "t", *triggers)
    else:
        grid = rows.select(*keys, "t", *triggers)
    series = _triggers(grid, triggers)
    if raster and general["include_gps_data"]:
        lat, lon = general["signal_latitude"], general["signal_longitude"]
        found = [f for f in map(lake.message, general["messages_gps"]) if f is not None]
        found = [f for f in found if lat in f.columns and lon in f.columns]
        if found:
            series = with_position(
                series,
                [(f, resample_grid(f, raster, [lat, lon])) for f in found],
                lat=lat,
                lon=lon,
            )
    for name in ("Latitude", "Longitude"):
        if name not in series.columns:
            series = series.withColumn(name, F.lit(None).cast("double"))
    edges = detect_edges(
        series,
        "SignalValue",
        lower,
        upper,
        exact,
        event["rising_as_start"],
        [*keys, "Signal"],
        width=width,
    )
    name = F.lit(event["event_name"])
    return edges.select(
        "t",
        name.alias("EventName"),
        F.col("device").alias("DeviceID"),
        event_id(name, F.col("device"), F.col("t")).alias("EventId"),
        F.col("message").alias("Message"),
        "Signal",
        "EventType",
        "EventValue",
        "SignalValue",
        "Latitude",
        "Longitude",
        "date",
        "file_name",
    )


def event_table(
    spark: SparkSession,
    lake: Lake,
    general: Mapping,
    events: Sequence[Mapping],
    width: int | str | None = None,
) -> DataFrame:
    """All events; ``date`` and ``file_name`` tell which log file an event came from."""
    found = [e for e in (detect_event(lake, event, general, width) for event in events) if e is not None]
    if not found:
        return (
            spark.createDataFrame([], EVENT_SCHEMA)
            .withColumn("date", F.lit(None).cast("date"))
            .withColumn("file_name", F.lit(None).cast("string"))
        )
    return reduce(DataFrame.unionByName, found)


def _shown_time(t: Column) -> Column:
    whole = F.date_format(t, "yyyy-MM-dd HH:mm:ss")
    return F.when(F.pmod(F.unix_micros(t), F.lit(1_000_000)) == 0, whole).otherwise(
        F.date_format(t, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    )


def first_notifications(events: DataFrame, static_body: str) -> DataFrame:
    """One notice per event name, for its first Start event.

    The earliest row is kept by an aggregate with map-side combine. ``dedupe_id`` lets a
    receiver drop repeated notices.
    """
    first = (
        events.where(F.col("EventValue") == 1)
        .groupBy("EventName")
        .agg(F.min(F.struct("t", "DeviceID", "Message", "Signal", "file_name")).alias("e"))
        .select("EventName", "e.*", _shown_time(F.col("e.t")).alias("time"))
    )
    subject = F.concat(
        F.lit("- EVENT: "), F.concat_ws(" | ", F.col("EventName"), F.col("DeviceID"), F.col("time"))
    )
    body = F.concat(
        F.col("EventName"),
        F.lit(f" was triggered. {static_body}\n\nDetails:\n- device: "),
        F.col("DeviceID"),
        F.lit("\n- message(s): ['"),
        F.col("Message"),
        F.lit("']\n- file: "),
        F.col("file_name"),
        F.lit("\n- time: "),
        F.col("time"),
    )
    return first.select(
        "EventName",
        "DeviceID",
        "t",
        subject.alias("subject"),
        body.alias("body"),
        F.translate(subject, " |", "_").alias("dedupe_id"),
    )
