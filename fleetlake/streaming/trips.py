"""Trips over a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timegrid import duration_us, micros


def stream_trips(
    stream: DataFrame,
    gap: str,
    min_length: str | int = 0,
    late: str = "1 hour",
    keys: Sequence[str] = ("device",),
    t: str = "t",
) -> DataFrame:
    """Trips as they close: ``keys, trip_start, trip_end`` in append mode.

    A trip is closed once the watermark has passed its last row by the gap. Unlike the batch
    form it runs across midnight, unless ``keys`` include the day. The session setting
    ``spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition`` merges rows to
    sessions before the shuffle, so that a busy device does not send all its rows to one task.
    """
    session = F.session_window(t, f"{duration_us(gap)} microseconds")
    return (
        stream.withWatermark(t, late)
        .groupBy(*keys, session)
        .agg(F.min(t).alias("trip_start"), F.max(t).alias("trip_end"))
        .where(micros("trip_end") - micros("trip_start") >= duration_us(min_length))
        .select(*keys, "trip_start", "trip_end")
    )
