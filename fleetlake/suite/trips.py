"""Trips and trip aggregates."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.aggregate import trip_aggregate
from ..operators.trips import trip_rows, trip_windows
from ..plans import trip_summary as plan
from ..schema import AGGREGATIONS
from ..sources.configs import cluster_plan, date_range, trip_config
from ..sources.lake import Lake
from .base import DEVICES, signals, with_signals

GAP, SHORTEST = "60 min", "1 min"

# Enough decimals that means of two-decimal values do not end in a tie.
DIGITS = 8

# Trips of every device, in full.
_TRIPS_SQL = """
marked AS (
  SELECT *, CASE WHEN lag(t) OVER w IS NULL OR t - lag(t) OVER w > INTERVAL 60 MINUTE THEN 1 ELSE 0 END AS opens
  FROM signals WINDOW w AS (PARTITION BY device, date ORDER BY t, event_id)
),
numbered AS (
  SELECT *, sum(opens) OVER (PARTITION BY device, date ORDER BY t, event_id ROWS UNBOUNDED PRECEDING) AS trip_no
  FROM marked
),
trips AS (
  SELECT device, date, min(t) AS trip_start, max(t) AS trip_end
  FROM numbered GROUP BY device, date, trip_no
  HAVING max(t) - min(t) >= INTERVAL 1 MINUTE
)
"""

_ROWS_SQL = _TRIPS_SQL + """,
inside AS (
  SELECT s.*, trip_start, trip_end
  FROM signals s JOIN trips p ON s.device = p.device AND s.date = p.date AND s.t BETWEEN trip_start AND trip_end
),
long AS (
  SELECT device, date, message, trip_start, t, event_id, 'Speed' AS Signal, Speed AS v FROM inside
  UNION ALL
  SELECT device, date, message, trip_start, t, event_id, 'Load', Load FROM inside
),
stepped AS (
  SELECT *, v - lag(v) OVER (PARTITION BY device, date, message, trip_start, Signal ORDER BY t, event_id) AS d
  FROM long
)
"""


def _windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trip_windows(signals(spark, sf_dir), GAP, SHORTEST)


def _inside(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = signals(spark, sf_dir)
    return trip_rows(rows, trip_windows(rows, GAP, SHORTEST))


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _inside(spark, sf_dir).select(
        "device", "date", "trip_start", "trip_end", "t", "event_id", "Speed"
    )


_KEYS = ("device", "date", "trip_start", "trip_end", "message")


def _aggregate(name: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return trip_aggregate(_inside(spark, sf_dir), ["Speed", "Load"], [name], _KEYS).select(
            "device", "date", "message", "trip_start", "Signal", F.round("SignalValue", DIGITS).alias("SignalValue")
        )

    return query


# The ordered and sum forms spell out what happens to nulls; the others ignore them anyway.
_AGGREGATE_SQL = {
    "avg": "avg(v)",
    "median": "median(v)",
    "max": "max(v)",
    "min": "min(v)",
    "sum": "coalesce(sum(v), 0)",
    "first": "list(v ORDER BY t, event_id)[1]",
    "last": "list(v ORDER BY t DESC, event_id DESC)[1]",
    "delta_sum": "coalesce(sum(d), 0)",
    "delta_sum_pos": "coalesce(sum(d) FILTER (d > 0), 0)",
    "delta_sum_neg": "coalesce(sum(d) FILTER (d < 0), 0)",
}


def _aggregate_sql(expression: str) -> str:
    return with_signals(
        _ROWS_SQL
        + f"""
SELECT device, date, message, trip_start, Signal, round({expression}, {DIGITS}) AS SignalValue
FROM stepped GROUP BY device, date, message, trip_start, Signal"""
    )


def _count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trip_aggregate(_inside(spark, sf_dir), ["Speed", "Load"], ["max"], _KEYS).select(
        "device", "date", "message", "trip_start", "Signal", "SignalCount"
    )


def _duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trip_aggregate(_inside(spark, sf_dir), ["Load"], ["max"], _KEYS).select(
        "device", "date", "message", "trip_start", F.round("Duration", 6).alias("Duration")
    )


# Two device clusters with one device in both, and one cluster without details.
CONFIG = {
    "config": {
        "date": {"mode": "specific_period", "start_date": "2024-01-01", "end_date": "2024-01-30"},
        "trip": {"trip_gap_min": 60, "trip_min_length_min": 1},
    },
    "device_clusters": [
        {"devices": DEVICES[:9], "cluster": "north"},
        {"devices": DEVICES[8:], "cluster": "south"},
        {"devices": DEVICES[:2], "cluster": "unlisted"},
    ],
    "cluster_details": [
        {
            "clusters": ["north", "south"],
            "details": {
                "trip_identifier": {"message": "view"},
                "aggregations": [
                    {"message": "view", "signal": ["Speed", "Missing"], "aggregation": ["avg", "max", "p99"]},
                    {"message": "click", "signal": ["Load"], "aggregation": ["median", "sum"]},
                    {"message": "purchase", "signal": ["Latitude", "Longitude"], "aggregation": ["first", "last"]},
                    {"message": "error", "signal": ["DistanceTrip"], "aggregation": ["delta_sum"]},
                ],
            },
        }
    ],
}


def trip_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = trip_config(CONFIG)
    summary = plan.trip_summary(spark, Lake.of_frame(signals(spark, sf_dir)), config)
    return summary.withColumns(
        {"SignalValue": F.round("SignalValue", DIGITS), "Duration": F.round("Duration", 6)}
    )


_SUMMARY_SQL = """
members AS (
  SELECT printf('%08X', n) AS device, c AS Cluster
  FROM range(16) r(n), (VALUES ('north'), ('south')) v(c)
  WHERE (c = 'north' AND n <= 8) OR (c = 'south' AND n >= 8)
),
marked AS (
  SELECT *, CASE WHEN lag(t) OVER w IS NULL OR t - lag(t) OVER w > INTERVAL 60 MINUTE THEN 1 ELSE 0 END AS opens
  FROM signals WHERE message = 'view' WINDOW w AS (PARTITION BY device, date ORDER BY t, event_id)
),
numbered AS (
  SELECT *, sum(opens) OVER (PARTITION BY device, date ORDER BY t, event_id ROWS UNBOUNDED PRECEDING) AS trip_no
  FROM marked
),
trips AS (
  SELECT device, date, min(t) AS trip_start, max(t) AS trip_end
  FROM numbered GROUP BY device, date, trip_no HAVING max(t) - min(t) >= INTERVAL 1 MINUTE
),
inside AS (
  SELECT s.*, trip_start, trip_end FROM signals s JOIN trips p
  ON s.device = p.device AND s.date = p.date AND s.t BETWEEN trip_start AND trip_end
),
long AS (
  SELECT *, 'Speed' AS Signal, Speed AS v FROM inside WHERE message = 'view'
  UNION ALL SELECT *, 'Load', Load FROM inside WHERE message = 'click'
  UNION ALL SELECT *, 'Latitude', Latitude FROM inside WHERE message = 'purchase'
  UNION ALL SELECT *, 'Longitude', Longitude FROM inside WHERE message = 'purchase'
  UNION ALL SELECT *, 'DistanceTrip', DistanceTrip FROM inside WHERE message = 'error'
),
stepped AS (
  SELECT *, v - lag(v) OVER (PARTITION BY device, date, trip_start, Signal ORDER BY t, event_id) AS d FROM long
),
wide AS (
  SELECT device, date, message, Signal, trip_start, trip_end,
         count(v) AS n, epoch_us(max(t)) - epoch_us(min(t)) AS us,
         avg(v) AS v_avg, median(v) AS v_median, max(v) AS v_max, coalesce(sum(v), 0) AS v_sum,
         list(v ORDER BY t, event_id)[1] AS v_first, list(v ORDER BY t DESC, event_id DESC)[1] AS v_last,
         coalesce(sum(d), 0) AS v_delta
  FROM stepped GROUP BY device, date, message, Signal, trip_start, trip_end
),
results AS (
  SELECT *, 'avg' AS Aggregation, v_avg AS v FROM wide WHERE message = 'view'
  UNION ALL SELECT *, 'max', v_max FROM wide WHERE message = 'view'
  UNION ALL SELECT *, 'median', v_median FROM wide WHERE message = 'click'
  UNION ALL SELECT *, 'sum', v_sum FROM wide WHERE message = 'click'
  UNION ALL SELECT *, 'first', v_first FROM wide WHERE message = 'purchase'
  UNION ALL SELECT *, 'last', v_last FROM wide WHERE message = 'purchase'
  UNION ALL SELECT *, 'delta_sum', v_delta FROM wide WHERE message = 'error'
)
"""


def days_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.days_processed(trip_summary(spark, sf_dir))


def _cluster_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The configured plan, with how many rows each planned message has."""
    planned = cluster_plan(spark, trip_config(CONFIG))
    rows = signals(spark, sf_dir).groupBy("device", "message").agg(F.count(F.lit(1)).alias("rows"))
    return planned.join(rows, ["device", "message"]).select(
        "cluster", "trip_message", "device", "message", "signal", "aggregation", "rows"
    )


def _date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per day of a period (both ends included) and of the day before a given one."""
    rows = signals(spark, sf_dir)
    modes = {
        "specific_period": date_range(
            {"mode": "specific_period", "start_date": "2024-01-05", "end_date": "2024-01-20"}
        ),
        "previous_day": date_range({"mode": "previous_day"}, today=date(2024, 1, 30)),
    }
    days = [(m, lo, hi) for m, (lo, hi) in modes.items()]
    wanted = spark.createDataFrame(days, "mode string, first date, last date").select(
        "mode", F.explode(F.sequence("first", "last")).alias("date")
    )
    per_day = rows.groupBy("date").agg(F.count(F.lit(1)).alias("rows"))
    return wanted.join(per_day, "date").select("mode", "date", "rows")


QUERIES = {
    "trip_summary": trip_summary,
    "trip_windows": _windows,
    "trip_rows": _rows,
    **{f"trip_{name}": _aggregate(name) for name in AGGREGATIONS},
    "trip_count": _count,
    "trip_duration": _duration,
    "days_processed": days_processed,
    "cluster_plan": _cluster_plan,
    "date_range": _date_range,
}

ORACLES = {
    "trip_summary": with_signals(
        _SUMMARY_SQL
        + f"""
SELECT r.device AS DeviceID, message AS Message, Signal, Aggregation, round(v, {DIGITS}) AS SignalValue,
       n AS SignalCount, round(us / 1000000.0, 6) AS Duration, trip_start AS TripStart, trip_end AS TripEnd,
       r.device || '_' || strftime(trip_start, '%Y%m%dT%H%M%S.%f') AS TripID, Cluster, date
FROM results r JOIN members m ON r.device = m.device"""
    ),
    "trip_windows": with_signals(_TRIPS_SQL + "SELECT * FROM trips"),
    "trip_rows": with_signals(
        _ROWS_SQL + "SELECT device, date, trip_start, trip_end, t, event_id, Speed FROM inside"
    ),
    **{f"trip_{name}": _aggregate_sql(sql) for name, sql in _AGGREGATE_SQL.items()},
    "trip_count": with_signals(
        _ROWS_SQL
        + """
SELECT device, date, message, trip_start, Signal, count(v) AS SignalCount
FROM long GROUP BY device, date, message, trip_start, Signal"""
    ),
    "trip_duration": with_signals(
        _ROWS_SQL
        + """
SELECT device, date, message, trip_start, round((epoch_us(max(t)) - epoch_us(min(t))) / 1000000.0, 6) AS Duration
FROM inside GROUP BY device, date, message, trip_start"""
    ),
    "days_processed": with_signals(
        _SUMMARY_SQL + "SELECT count(DISTINCT date) AS days_processed FROM results"
    ),
    "cluster_plan": with_signals(
        """
members AS (
  SELECT printf('%08X', n) AS device, c AS cluster
  FROM range(16) r(n), (VALUES ('north'), ('south')) v(c)
  WHERE (c = 'north' AND n <= 8) OR (c = 'south' AND n >= 8)
),
specs(message, signal, aggregation) AS (VALUES
  ('view', 'Speed', 'avg'), ('view', 'Speed', 'max'), ('view', 'Speed', 'p99'),
  ('view', 'Missing', 'avg'), ('view', 'Missing', 'max'), ('view', 'Missing', 'p99'),
  ('click', 'Load', 'median'), ('click', 'Load', 'sum'),
  ('purchase', 'Latitude', 'first'), ('purchase', 'Latitude', 'last'),
  ('purchase', 'Longitude', 'first'), ('purchase', 'Longitude', 'last'),
  ('error', 'DistanceTrip', 'delta_sum')
)
SELECT cluster, 'view' AS trip_message, m.device, p.message, signal, aggregation, count(*) AS rows
FROM members m, specs p JOIN signals s ON s.device = m.device AND s.message = p.message
GROUP BY ALL"""
    ),
    "date_range": with_signals(
        """
SELECT 'specific_period' AS mode, date, count(*) AS rows FROM signals
WHERE date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' GROUP BY date
UNION ALL
SELECT 'previous_day', date, count(*) FROM signals WHERE date = DATE '2024-01-29' GROUP BY date"""
    ),
}
