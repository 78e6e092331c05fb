"""The streaming forms, run over the events table until everything is processed."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geo import with_fence
from ..operators.custom import CustomContext
from ..plans.custom_messages import write_custom_messages
from ..plans.event_table import event_table
from ..session import use_utc, work_folder
from ..sources.configs import EVENT_DEFAULTS, events_config, trip_config
from ..sources.lake import Lake, write_path_layout
from ..streaming.detector import EdgeDetector
from ..streaming.incremental import Incremental, latest, run_incremental, run_whole_files, stream_files
from ..streaming.keyed import stream_edges, use_rocksdb
from ..streaming.notices import NoticeLedger
from ..streaming.publishing import DECODED, DERIVED, EVENTS as EVENT_ROWS, Publication
from ..streaming.summaries import read_summary, run_trip_summary
from ..streaming.trips import stream_trips
from .base import as_signals, table, with_signals
from .events import edge_ctes
from .grid import FENCES, fence_hits_sql
from .grid import ORACLES as GRID_ORACLES
from .trips import CONFIG, DIGITS
from .trips import ORACLES as TRIP_ORACLES


#: Devices where a query writes a lake: few, so that the test tables do not turn into tiny files.
_FEW = 2


def _stream(spark: SparkSession, sf_dir: str, devices: int = 16) -> DataFrame:
    """The events file as a stream of message rows."""
    use_utc(spark)
    schema = table(spark, sf_dir, "events").schema
    return as_signals(stream_files(spark, sf_dir, schema, glob="events.parquet"), devices)


def _appended(stream: DataFrame, label: str) -> DataFrame:
    """What an append-mode query has written once it is through."""
    spark = stream.sparkSession
    folder = work_folder(spark, label)
    query = (
        stream.writeStream.format("parquet")
        .option("path", f"{folder}/rows")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows")


def _ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _stream(spark, sf_dir).select("device", "message", "date", "t", "event_id", "Speed", "Load")
    return _appended(rows, "ingest")


def _geofence(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_fence(_stream(spark, sf_dir), FENCES).select("event_id", "GeofenceId")
    return _appended(rows, "fences")


def _trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    setting = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "true")
    try:
        return _appended(stream_trips(_stream(spark, sf_dir), "60 min", "1 min"), "trips")
    finally:
        spark.conf.set(setting, before)


# A derived message, and an event that is triggered by it.
CUSTOM = [
    {
        "custom_message_name": "Fences",
        "messages_match_type": "equals",
        "messages_filtered_list": [["view"]],
        "raster": "",
        "prefix": False,
        "function": "custom_geofences",
    }
]
EVENTS = {
    "general": {"include_gps_data": False},
    "events": [
        {
            "event_name": "AtDepot",
            "messages_match_type": "equals",
            "messages_filtered_list": [["Fences"]],
            "trigger_signals": ["GeofenceId"],
            "lower_threshold": 0,
            "upper_threshold": 7,
            "rising_as_start": True,
            "exact_match": True,
            "raster": "",
        }
    ],
}


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_folder(spark, "incremental")
    general, events = events_config(EVENTS)
    job = Incremental(
        custom=CUSTOM,
        general=general,
        events=events,
        messages_root=f"{folder}/lake",
        events_root=f"{folder}/events",
        context=CustomContext(fences=FENCES),
        width="6 hours",
    )
    run_incremental(_stream(spark, sf_dir, _FEW), job, f"{folder}/checkpoint")
    return spark.read.parquet(f"{folder}/events").select(
        "t", "EventName", "DeviceID", "EventId", "Message", "Signal", "EventType", "EventValue", "SignalValue", "date", "file_name"
    )


_EVENT_COLUMNS = [
    "t", "EventName", "DeviceID", "EventId", "Message", "Signal", "EventType", "EventValue", "SignalValue", "date", "file_name",
]


def _path_lake(spark: SparkSession, sf_dir: str) -> str:
    """All rows as a lake of stored files by device, message and day."""
    root = work_folder(spark, "path-lake")
    rows = as_signals(table(spark, sf_dir, "events"), _FEW)
    write_path_layout(rows.select("device", "message", "date", "file_name", "t", "event_id", "Latitude", "Longitude"), root)
    return root


def _derived_then_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Derived messages are written, and events triggered by what is read back."""
    root, derived = _path_lake(spark, sf_dir), work_folder(spark, "derived")
    lake = Lake.of_path_layout(spark, root)
    write_custom_messages(lake, CUSTOM, derived, CustomContext(fences=FENCES))
    general, events = events_config(EVENTS)
    both = Lake.joined(lake, Lake.of_folder(spark, derived))
    return event_table(spark, both, general, events, "6 hours").select(*_EVENT_COLUMNS)


def _whole_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over a stream of stored files; a log file's messages come in different batches."""
    folder = work_folder(spark, "whole-files")
    general, events = events_config(EVENTS)
    job = Incremental(
        CUSTOM, general, events, f"{folder}/lake", f"{folder}/events", CustomContext(fences=FENCES), "6 hours"
    )
    run_whole_files(spark, _path_lake(spark, sf_dir), job, f"{folder}/checkpoint", files_per_batch=500)
    return latest(spark, f"{folder}/events").select(*_EVENT_COLUMNS)


def _continuous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges of endless series: nothing is cut at midnight or at the end of a file."""
    folder = work_folder(spark, "detector")
    rows = _stream(spark, sf_dir).select("device", "message", "t", "event_id", "Load")
    return EdgeDetector(folder, "Load", 20, 60, width="6 hours").run(rows, f"{folder}/checkpoint")


def _fed(spark: SparkSession, sf_dir: str, order: Sequence[int], run: Callable[[DataFrame], object]) -> None:
    """The events handed out by six days at a time, in this order; the stream is started anew for each."""
    folder = work_folder(spark, "fed")
    events = table(spark, sf_dir, "events")
    for part in order:
        events.where(F.floor((F.dayofmonth("ts") - 1) / 6) == part).write.mode("append").parquet(folder)
        run(as_signals(stream_files(spark, folder, events.schema)))


def _keyed_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges of endless series from keyed state, of files that come in the wrong order."""
    folder = work_folder(spark, "keyed")
    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting)
    use_rocksdb(spark)

    def run(rows: DataFrame) -> None:
        edges = stream_edges(rows.select("device", "message", "t", "event_id", "Load"), "Load", 20, 60, late="12 days")
        writer = edges.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
        writer.option("path", f"{folder}/rows").option("checkpointLocation", f"{folder}/checkpoint").start().awaitTermination()

    try:
        _fed(spark, sf_dir, (1, 0, 3, 2, 4), run)
    finally:
        spark.conf.set(setting, before)
    return spark.read.parquet(f"{folder}/rows")


def _notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The notices of a stream that was stopped and started again: one per event name."""
    folder = work_folder(spark, "notices")
    general, events = events_config(EVENTS)

    def run(rows: DataFrame) -> None:
        job = Incremental(
            CUSTOM, general, events, None, f"{folder}/events", CustomContext(fences=FENCES), "6 hours", deliver=lambda new: None
        )
        run_incremental(rows, job, f"{folder}/checkpoint")

    _fed(spark, sf_dir, range(5), run)
    return NoticeLedger(f"{folder}/events/_notices").sent(spark).drop("batch_id")


#: Device-days whose trip message comes late.
LATE = [("00000001", "2024-01-10"), ("00000008", "2024-01-10"), ("00000003", "2024-01-20")]


def _late_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trip summary kept up to date: late files make their own device-days be computed again."""
    root, folder = work_folder(spark, "late-lake"), work_folder(spark, "late-summary")
    rows = as_signals(table(spark, sf_dir, "events")).withColumn("file_name", F.lit("day.parquet"))
    rows = rows.select("device", "message", "date", "file_name", "t", "Speed", "Load", "Latitude", "Longitude", "DistanceTrip")
    days = [(F.col("device") == device) & (F.col("date") == F.lit(day).cast("date")) for device, day in LATE]
    late = (F.col("message") == "view") & (days[0] | days[1] | days[2])
    for part in (~late, late):
        write_path_layout(rows.where(part & (F.col("message") != "signup")), root)
        run_trip_summary(spark, root, f"{folder}/out", trip_config(CONFIG), f"{folder}/checkpoint", 100_000)
    return read_summary(spark, f"{folder}/out").withColumns(
        {"SignalValue": F.round("SignalValue", DIGITS), "Duration": F.round("Duration", 6)}
    )


def _last_say(kind: str, rows: DataFrame) -> DataFrame:
    """What is published of each kind of rows: no sign-ups, and derived rows only inside of a fence."""
    if kind == DECODED:
        return rows.where(F.col("message") != "signup")
    return rows.where(F.col("GeofenceId") > 0) if kind == DERIVED else rows


def _published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, derived messages and events of a stream, each batch published in one step."""
    folder = work_folder(spark, "publication")
    general, events = events_config(EVENTS)
    publication = Publication(f"{folder}/out", _last_say)

    def run(rows: DataFrame) -> None:
        job = Incremental(
            CUSTOM, general, events, context=CustomContext(fences=FENCES), width="6 hours", publication=publication, deliver=lambda new: None
        )
        run_incremental(rows, job, f"{folder}/checkpoint")

    _fed(spark, sf_dir, range(5), run)
    shown = {
        DECODED: ["device", "message", "date", "file_name", "t", F.col("Speed").alias("value")],
        DERIVED: ["device", "message", "date", "file_name", "t", F.col("GeofenceId").cast("double").alias("value")],
        EVENT_ROWS: [
            F.col("DeviceID").alias("device"), F.col("Message").alias("message"), "date", "file_name", "t", F.col("EventValue").cast("double").alias("value"),
        ],
    }
    kinds = [publication.rows(spark, kind).select(F.lit(kind).alias("kind"), *columns) for kind, columns in shown.items()]
    return kinds[0].unionByName(kinds[1]).unionByName(kinds[2])


def _merged_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of many batches, folded into base files on the way."""
    folder = work_folder(spark, "merged-files")
    general, events = events_config(EVENTS)
    job = Incremental(
        CUSTOM, general, events, f"{folder}/lake", f"{folder}/events", CustomContext(fences=FENCES), "6 hours", compact_every=2
    )
    run_whole_files(spark, _path_lake(spark, sf_dir), job, f"{folder}/checkpoint", files_per_batch=300)
    return latest(spark, f"{folder}/events").select(*_EVENT_COLUMNS)


QUERIES = {
    "stream_ingest": _ingest,
    "stream_geofence": _geofence,
    "stream_trips": _trips,
    "stream_events": _events,
    "stream_whole_files": _whole_files,
    "derived_then_events": _derived_then_events,
    "stream_edges": _continuous,
    "stream_edges_state": _keyed_edges,
    "stream_notices": _notices,
    "trip_summary_late": _late_summary,
    "stream_merged_files": _merged_files,
    "publish_batch": _published,
}

_PLACED = """,
placed AS (
  SELECT s.*, coalesce(h.id, 0) AS GeofenceId FROM signals s LEFT JOIN hits h ON s.event_id = h.event_id WHERE message = 'view'
)"""


def _fence_events(devices: int) -> str:
    return with_signals(
        fence_hits_sql("s.Latitude", FENCES).strip()
        + f"{_PLACED},"
        + edge_ctes("placed", "device, date, file_name", "GeofenceId = 0", "GeofenceId = 7")
        + """
SELECT t, 'AtDepot' AS EventName, device AS DeviceID, 'AtDepot_' || device || '_' || strftime(t, '%Y%m%dT%H%M%S') AS EventId,
       'Fences' AS Message, 'GeofenceId' AS Signal, e AS EventType, CAST(ev AS BIGINT) AS EventValue,
       CAST(GeofenceId AS DOUBLE) AS SignalValue, date, file_name
FROM (SELECT *, 'Start' AS e, 1 AS ev FROM rising UNION ALL SELECT *, 'Stop', 0 FROM falling)""",
        devices,
    )


_FENCE_EVENTS = _fence_events(_FEW)

ORACLES = {
    "stream_ingest": with_signals("SELECT device, message, date, t, event_id, Speed, Load FROM signals"),
    "stream_geofence": GRID_ORACLES["geofence"],
    # Trips across midnight; those the watermark (latest row less one hour) has not closed yet
    # are still open when the stream ends.
    "stream_trips": with_signals(
        """
marked AS (
  SELECT *, CASE WHEN lag(t) OVER w IS NULL OR t - lag(t) OVER w > INTERVAL 60 MINUTE THEN 1 ELSE 0 END AS opens
  FROM signals WINDOW w AS (PARTITION BY device ORDER BY t, event_id)
),
numbered AS (
  SELECT *, sum(opens) OVER (PARTITION BY device ORDER BY t, event_id ROWS UNBOUNDED PRECEDING) AS trip_no FROM marked
)
SELECT device, min(t) AS trip_start, max(t) AS trip_end FROM numbered GROUP BY device, trip_no
HAVING max(t) - min(t) >= INTERVAL 1 MINUTE
   AND max(t) + INTERVAL 60 MINUTE <= date_trunc('millisecond', (SELECT max(t) FROM signals)) - INTERVAL 60 MINUTE"""
    ),
    "stream_events": _FENCE_EVENTS,
    "stream_whole_files": _FENCE_EVENTS,
    "derived_then_events": _FENCE_EVENTS,
    "stream_merged_files": _FENCE_EVENTS,
    "publish_batch": with_signals(
        fence_hits_sql("s.Latitude", FENCES).strip()
        + f"""{_PLACED}
SELECT 'decoded' AS kind, device, message, date, file_name, t, Speed AS value FROM signals WHERE message <> 'signup'
UNION ALL
SELECT 'derived', device, 'Fences', date, file_name, t, CAST(GeofenceId AS DOUBLE) FROM placed WHERE GeofenceId > 0
UNION ALL
SELECT 'events', DeviceID, Message, date, file_name, t, CAST(EventValue AS DOUBLE) FROM ({_fence_events(16)})"""
    ),
    "trip_summary_late": TRIP_ORACLES["trip_summary"],
    "stream_notices": f"""
WITH firsts AS (
  SELECT *, CASE WHEN epoch_us(t) % 1000000 = 0 THEN strftime(t, '%Y-%m-%d %H:%M:%S')
                 ELSE strftime(t, '%Y-%m-%d %H:%M:%S.%f') END AS shown
  FROM ({_fence_events(16)}) WHERE EventType = 'Start'
  QUALIFY row_number() OVER (PARTITION BY EventName ORDER BY t, DeviceID, Message, Signal, file_name) = 1
)
SELECT EventName, DeviceID, t, '- EVENT: ' || EventName || ' | ' || DeviceID || ' | ' || shown AS subject,
       EventName || ' was triggered. {EVENT_DEFAULTS["static_body_content"]}' || chr(10) || chr(10) || 'Details:' || chr(10) || '- device: ' || DeviceID
         || chr(10) || '- message(s): [' || chr(39) || Message || chr(39) || ']' || chr(10) || '- file: ' || file_name
         || chr(10) || '- time: ' || shown AS body,
       replace(replace('- EVENT: ' || EventName || ' | ' || DeviceID || ' | ' || shown, ' ', '_'), '|', '') AS dedupe_id
FROM firsts""",
    # Rows after the watermark are still held when the stream ends.
    "stream_edges_state": with_signals(
        edge_ctes("signals", "device, message", "Load <= 20", "Load >= 60").strip()
        + """,
passed AS (
  SELECT date_trunc('millisecond', max(t)) - INTERVAL 12 DAY AS upto FROM signals WHERE Load <= 20 OR Load >= 60
)
SELECT device, message, t, event_id, Load, 'Start' AS EventType, CAST(1 AS BIGINT) AS EventValue FROM rising, passed WHERE t <= upto
UNION ALL
SELECT device, message, t, event_id, Load, 'Stop', 0 FROM falling, passed WHERE t <= upto"""
    ),
    "stream_edges": with_signals(
        edge_ctes("signals", "device, message", "Load <= 20", "Load >= 60").strip()
        + """
SELECT device, message, t, event_id, Load, 'Start' AS EventType, CAST(1 AS BIGINT) AS EventValue FROM rising
UNION ALL
SELECT device, message, t, event_id, Load, 'Stop', 0 FROM falling"""
    ),
}
