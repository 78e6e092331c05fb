"""Event detection, positions and notifications."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.chunks import run_ids
from ..operators.edges import detect_edges
from ..operators.resample import resample_grid, with_position
from ..plans.event_table import event_table, first_notifications
from ..schema import SERIES_KEYS
from ..sources.configs import events_config
from ..sources.lake import Lake
from .base import measured_width, signals, with_signals

_DAY = ["device", "date"]


def _edges(signal: str, lower: float, upper: float, exact: bool = False, rising_as_start: bool = True):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = signals(spark, sf_dir).select("device", "date", "t", "event_id", signal)
        width = measured_width(rows, _DAY)
        return detect_edges(rows, signal, lower, upper, exact, rising_as_start, _DAY, width=width)

    return query


def edge_ctes(
    source: str, partition: str, below: str, above: str, prefix: str = "", order: str = "t, event_id"
) -> str:
    """The run definition, word for word: flags, ever-before flags, run numbers, first per run."""
    p = prefix
    return f"""
{p}flagged AS (
  SELECT *, coalesce({below}, false) AS b, coalesce({above}, false) AS a FROM {source}
),
{p}armed AS (
  SELECT *,
    coalesce(max(CAST(b AS INT)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS was_b,
    coalesce(max(CAST(a AS INT)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS was_a,
    CASE WHEN lag(b) OVER w IS DISTINCT FROM b THEN 1 ELSE 0 END AS cb,
    CASE WHEN lag(a) OVER w IS DISTINCT FROM a THEN 1 ELSE 0 END AS ca
  FROM {p}flagged WINDOW w AS (PARTITION BY {partition} ORDER BY {order})
),
{p}runs AS (
  SELECT *, sum(cb) OVER (w ROWS UNBOUNDED PRECEDING) AS run_b, sum(ca) OVER (w ROWS UNBOUNDED PRECEDING) AS run_a
  FROM {p}armed WINDOW w AS (PARTITION BY {partition} ORDER BY {order})
),
{p}rising AS (
  SELECT * FROM {p}runs WHERE a AND was_b = 1
  QUALIFY row_number() OVER (PARTITION BY {partition}, run_b ORDER BY {order}) = 1
),
{p}falling AS (
  SELECT * FROM {p}runs WHERE b AND was_a = 1
  QUALIFY row_number() OVER (PARTITION BY {partition}, run_a ORDER BY {order}) = 1
)"""


def _edges_sql(signal: str, below: str, above: str, rising_as_start: bool = True) -> str:
    start, stop = ("rising", "falling") if rising_as_start else ("falling", "rising")
    return with_signals(
        edge_ctes("signals", "device, date", below, above).strip()
        + f"""
SELECT device, date, t, event_id, {signal}, 'Start' AS EventType, CAST(1 AS BIGINT) AS EventValue FROM {start}
UNION ALL
SELECT device, date, t, event_id, {signal}, 'Stop', 0 FROM {stop}"""
    )


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of equal below flags: number, length and extent."""
    rows = signals(spark, sf_dir).select(
        *_DAY, "t", F.coalesce(F.col("Load") <= 20, F.lit(False)).alias("below")
    )
    numbered = run_ids(rows, _DAY, "below", width=measured_width(rows, _DAY))
    return numbered.groupBy(*_DAY, "run_id", "below").agg(
        F.count(F.lit(1)).alias("rows"), F.min("t").alias("first_t"), F.max("t").alias("last_t")
    )


# The events document of these queries: stacked and resampled input, with positions.
EVENTS = {
    "general": {
        "include_gps_data": True,
        "signal_latitude": "Latitude",
        "signal_longitude": "Longitude",
        "messages_gps": ["absent", "purchase", "error"],
        "static_body_content": "See the fleet board",
    },
    "events": [
        {
            "event_name": "Fast",
            "messages_match_type": "equals",
            "messages_filtered_list": [["view", "click"], ["error"]],
            "trigger_signals": ["Speed", "Load", "Missing"],
            "lower_threshold": 20,
            "upper_threshold": 60,
            "rising_as_start": True,
            "exact_match": False,
            "raster": "",
        },
        {
            "event_name": "Slow",
            "messages_match_type": "contains",
            "messages_filtered_list": "i",
            "trigger_signals": ["Speed"],
            "lower_threshold": 30,
            "upper_threshold": 31,
            "rising_as_start": False,
            "exact_match": False,
            "raster": "15min",
        },
    ],
}


def _event_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    general, events = events_config(EVENTS)
    rows = signals(spark, sf_dir)
    width = measured_width(rows, [*SERIES_KEYS, "message"])
    return event_table(spark, Lake.of_frame(rows), general, events, width)


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in ("SignalValue", "Latitude", "Longitude")})


def grid_cte(name: str, source: str, keys: str, columns: str, step: str, nonnull: str, tie: str = "event_id") -> str:
    """Labels of every series and, per label, the last row in the closed step before it."""
    return f"""
{name}_labels AS (
  SELECT {keys}, unnest(generate_series(time_bucket(INTERVAL {step}, min(t), TIMESTAMP '2000-01-01'),
                                        time_bucket(INTERVAL {step}, max(t), TIMESTAMP '2000-01-01'),
                                        INTERVAL {step})) AS label
  FROM {source} GROUP BY {keys}
),
{name} AS (
  SELECT * FROM (
    SELECT {", ".join("l." + k.strip() for k in keys.split(","))}, l.label AS t, {columns}
    FROM {name}_labels l JOIN {source} s
      ON {" AND ".join(f"l.{k.strip()} = s.{k.strip()}" for k in keys.split(","))}
     AND s.t BETWEEN l.label - INTERVAL {step} AND l.label
    QUALIFY row_number() OVER (PARTITION BY {", ".join("l." + k.strip() for k in keys.split(","))}, l.label
                               ORDER BY s.t DESC, s.{tie} DESC) = 1
  ) WHERE {nonnull}
)"""


_SERIES = "device, date, file_name"

# Purchase rows if the file has any, else error rows, else none.
_GPS_SQL = (
    """
gps_rank AS (
  SELECT device, date, file_name, min(CASE message WHEN 'purchase' THEN 0 ELSE 1 END) AS rank
  FROM signals WHERE message IN ('purchase', 'error') GROUP BY device, date, file_name
),
gps_rows AS (
  SELECT s.* FROM signals s JOIN gps_rank g ON s.device = g.device AND s.date = g.date AND s.file_name = g.file_name
  WHERE (rank = 0 AND message = 'purchase') OR (rank = 1 AND message = 'error')
),"""
    + grid_cte("gps", "gps_rows", _SERIES, "Latitude, Longitude", "15 MINUTE", "true")
)


def _located_sql(grid: str) -> str:
    """Inner join where the file has a position message, all rows where not."""
    return f"""
located AS (
  SELECT g.*, p.Latitude, p.Longitude
  FROM {grid} g
  LEFT JOIN gps p ON g.device = p.device AND g.date = p.date AND g.file_name = p.file_name AND g.t = p.t
  LEFT JOIN gps_rank r ON g.device = r.device AND g.date = r.date AND g.file_name = r.file_name
  WHERE r.rank IS NULL OR p.t IS NOT NULL
)"""


def _event_gps(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = signals(spark, sf_dir)
    grid = resample_grid(rows.where(F.col("message") == "click"), "15 min", ["Speed"])
    candidates = [rows.where(F.col("message") == m) for m in ("purchase", "error")]
    located = with_position(
        grid, [(c, resample_grid(c, "15 min", ["Latitude", "Longitude"])) for c in candidates]
    )
    return located.select(
        *SERIES_KEYS, "t", "Speed", F.round("Latitude", 6).alias("Latitude"), F.round("Longitude", 6).alias("Longitude")
    )


_EVENT_TABLE_SQL = (
    """
fast_in AS (
  SELECT device, date, file_name, message, t, event_id, 'Speed' AS Signal, Speed AS v FROM signals WHERE message IN ('view', 'click')
  UNION ALL
  SELECT device, date, file_name, message, t, event_id, 'Load', Load FROM signals WHERE message IN ('view', 'click')
),"""
    + edge_ctes("fast_in", "device, date, file_name, message, Signal", "v <= 20", "v >= 60", "fast_")
    + ","
    + _GPS_SQL
    + """,
slow_src AS (SELECT * FROM signals WHERE message LIKE '%i%'),"""
    + grid_cte("slow_grid", "slow_src", _SERIES + ", message", "Speed AS v", "15 MINUTE", "v IS NOT NULL")
    + ","
    + _located_sql("slow_grid")
    + ","
    + edge_ctes("located", "device, date, file_name, message", "v <= 30", "v >= 31", "slow_", order="t")
    + """,
found AS (
  SELECT 'Fast' AS n, 'Start' AS e, 1 AS ev, device, date, file_name, message, t, Signal, v, CAST(NULL AS DOUBLE) AS lat, CAST(NULL AS DOUBLE) AS lon FROM fast_rising
  UNION ALL SELECT 'Fast', 'Stop', 0, device, date, file_name, message, t, Signal, v, NULL, NULL FROM fast_falling
  UNION ALL SELECT 'Slow', 'Start', 1, device, date, file_name, message, t, 'Speed', v, Latitude, Longitude FROM slow_falling
  UNION ALL SELECT 'Slow', 'Stop', 0, device, date, file_name, message, t, 'Speed', v, Latitude, Longitude FROM slow_rising
)
"""
)

QUERIES = {
    "event_edges": _edges("Load", 20, 60),
    "event_edges_falling": _edges("Load", 20, 60, rising_as_start=False),
    "event_edges_exact": _edges("SpeedValid", 0, 1, exact=True),
    "event_edges_equal": _edges("K", 50, 50),
    "event_edges_crossed": _edges("K", 60, 40),
    "event_runs": _runs,
    "event_gps": _event_gps,
    "event_table": lambda spark, sf_dir: _rounded(_event_table(spark, sf_dir)),
    "event_notifications": lambda spark, sf_dir: first_notifications(
        _event_table(spark, sf_dir), EVENTS["general"]["static_body_content"]
    ),
}

ORACLES = {
    "event_edges": _edges_sql("Load", "Load <= 20", "Load >= 60"),
    "event_edges_falling": _edges_sql("Load", "Load <= 20", "Load >= 60", rising_as_start=False),
    "event_edges_exact": _edges_sql("SpeedValid", "SpeedValid = 0", "SpeedValid = 1"),
    "event_edges_equal": _edges_sql("K", "K <= 50", "K >= 50"),
    "event_edges_crossed": _edges_sql("K", "K <= 60", "K >= 40"),
    "event_runs": with_signals(
        edge_ctes("signals", "device, date", "Load <= 20", "false").strip()
        + """
SELECT device, date, CAST(run_b AS BIGINT) AS run_id, b AS below, count(*) AS rows, min(t) AS first_t, max(t) AS last_t
FROM runs GROUP BY device, date, run_b, b"""
    ),
    "event_gps": with_signals(
        _GPS_SQL.strip()
        + """,
click AS (SELECT * FROM signals WHERE message = 'click'),"""
        + grid_cte("grid", "click", _SERIES, "Speed", "15 MINUTE", "Speed IS NOT NULL")
        + ","
        + _located_sql("grid")
        + """
SELECT device, date, file_name, t, Speed, round(Latitude, 6) AS Latitude, round(Longitude, 6) AS Longitude FROM located"""
    ),
    "event_table": with_signals(
        _EVENT_TABLE_SQL.strip()
        + """
SELECT t, n AS EventName, device AS DeviceID, n || '_' || device || '_' || strftime(t, '%Y%m%dT%H%M%S') AS EventId,
       message AS Message, Signal, e AS EventType, CAST(ev AS BIGINT) AS EventValue, round(v, 6) AS SignalValue,
       round(lat, 6) AS Latitude, round(lon, 6) AS Longitude, date, file_name
FROM found"""
    ),
    "event_notifications": with_signals(
        _EVENT_TABLE_SQL.strip()
        + """,
firsts AS (
  SELECT *, CASE WHEN epoch_us(t) % 1000000 = 0 THEN strftime(t, '%Y-%m-%d %H:%M:%S')
                 ELSE strftime(t, '%Y-%m-%d %H:%M:%S.%f') END AS shown
  FROM found WHERE ev = 1
  QUALIFY row_number() OVER (PARTITION BY n ORDER BY t, device, message, Signal, file_name) = 1
)
SELECT n AS EventName, device AS DeviceID, t, '- EVENT: ' || n || ' | ' || device || ' | ' || shown AS subject,
       n || ' was triggered. See the fleet board' || chr(10) || chr(10) || 'Details:' || chr(10) || '- device: ' || device
         || chr(10) || '- message(s): [''' || message || ''']' || chr(10) || '- file: ' || file_name
         || chr(10) || '- time: ' || shown AS body,
       replace(replace('- EVENT: ' || n || ' | ' || device || ' | ' || shown, ' ', '_'), '|', '') AS dedupe_id
FROM firsts"""
    ),
}
