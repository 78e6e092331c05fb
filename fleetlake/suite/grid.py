"""Time grids, derived messages, fences and code columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geo import haversine, with_fence
from ..operators.custom import CustomContext, apply_custom
from ..operators.resample import resample_grid, stack_messages
from ..plans.custom_messages import custom_message
from ..schema import SERIES_KEYS
from ..sources.lake import Lake
from .base import measured_width, signals, with_signals
from .events import grid_cte

_MESSAGE_SERIES = ["device", "date", "file_name", "message"]
_DAY = ["device", "date"]

# Overlapping fences around the area the positions cover; the first one in the list wins.
FENCES = [
    {"id": 7, "name": "depot", "latitude": 56.05, "longitude": 10.05, "radius": 2.5},
    {"id": 3, "name": "yard", "latitude": 56.06, "longitude": 10.06, "radius": 4.0},
    {"id": 9, "name": "port", "latitude": 56.15, "longitude": 10.15, "radius": 3.0},
]

# More fences than fit one expression: a 20 x 20 lattice, ids in list order.
MANY_FENCES = [
    {
        "id": 1000 + 20 * i + j,
        "name": f"cell {i} {j}",
        "latitude": 56 + i * 0.01,
        "longitude": 10 + j * 0.01,
        "radius": 0.55,
    }
    for i in range(20)
    for j in range(20)
]

# A few wide fences, one around the globe's half, among thousands of small ones.
MIXED_FENCES = [
    {"id": 10 + 50 * i + j, "name": f"spot {i} {j}", "latitude": 56 + i * 0.004, "longitude": 10 + j * 0.004, "radius": 0.2}
    for i in range(50)
    for j in range(50)
] + [
    {"id": 1, "name": "region", "latitude": 56.4, "longitude": 10.4, "radius": 45.0},
    {"id": 2, "name": "country", "latitude": 55.0, "longitude": 9.0, "radius": 130.0},
    {"id": 3, "name": "half", "latitude": -20.0, "longitude": 100.0, "radius": 10007.0},
]

_DISTANCE = (
    "2 * 6371.0 * asin(sqrt(pow(sin(radians({lat2} - {lat1}) / 2), 2)"
    " + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2)))"
)


def _distance_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return _DISTANCE.format(lat1=lat1, lon1=lon1, lat2=lat2, lon2=lon2)


def _resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample_grid(signals(spark, sf_dir), "2h", ["Speed", "Load"], _MESSAGE_SERIES)


def _null_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A grid of a signal with gaps: a label whose last row is null is left out."""
    return resample_grid(signals(spark, sf_dir), "30min", ["Load"], _DAY)


def _named(custom_message_name: str, **config):
    """A custom message of the lake, by its config."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = signals(spark, sf_dir)
        context = CustomContext(fences=FENCES, width=measured_width(rows, SERIES_KEYS))
        lake = Lake.of_frame(rows.drop("event_id"))
        return custom_message(lake, {"custom_message_name": custom_message_name, "prefix": False, **config}, context)

    return query


def _grid_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = _named(
        "Joined",
        messages_match_type="equals",
        messages_filtered_list=[["click", "view"]],
        raster="2h",
        prefix=True,
        function="resample",
    )(spark, sf_dir)
    return joined.select(*SERIES_KEYS, "t", "click_Speed", "view_Speed", "click_Load", "view_K")


def _grid_join_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = _named(
        "Everything", messages_match_type="all_messages", raster="2h", prefix=True, function="resample"
    )(spark, sf_dir)
    return joined.select(*SERIES_KEYS, "t", "click_Speed", "view_Speed", "purchase_Speed", "signup_Speed", "error_Speed")


def _stack(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = signals(spark, sf_dir)
    return stack_messages(
        {
            "click": rows.where(F.col("message") == "click").select("device", "t", "Speed"),
            "view": rows.where(F.col("message") == "view").select("device", "t", "K", "Load"),
        }
    )


def _stack_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the messages with "i" in their name, of the files that have all of them."""
    return _named(
        "Stacked", messages_match_type="contains", messages_filtered_list="i", raster="", function="none"
    )(spark, sf_dir).select(*SERIES_KEYS, "t", "Speed", "K")


def _delta_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = signals(spark, sf_dir)
    context = CustomContext(keys=_DAY, width=measured_width(rows, _DAY))
    return apply_custom(rows, "delta_distance", context)


def _geofence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_fence(signals(spark, sf_dir), FENCES).select("event_id", "GeofenceId")


def _many_fences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_fence(signals(spark, sf_dir), MANY_FENCES).select("event_id", "GeofenceId")


def _mixed_fences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_fence(signals(spark, sf_dir), MIXED_FENCES).select("event_id", "GeofenceId")


def _no_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a latitude get 0, not null."""
    rows = signals(spark, sf_dir).withColumn("Latitude", F.when(F.col("K") % 5 != 0, F.col("Latitude")))
    return with_fence(rows, FENCES).select("event_id", "GeofenceId")


def _haversine(spark: SparkSession, sf_dir: str) -> DataFrame:
    distance = haversine(F.col("Latitude"), F.col("Longitude"), F.lit(56.05), F.lit(10.05))
    return signals(spark, sf_dir).select("event_id", F.round(distance, 6).alias("km"))


def _combine_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fault-code rows with the hex source address at the end of the message name."""
    rows = signals(spark, sf_dir).select(
        "device",
        "t",
        "event_id",
        F.concat(F.lit("CAN1_DM01_DTC_01"), F.lpad(F.hex(F.col("event_id") % 256), 2, "0")).alias("Message"),
        F.col("K").alias("DM01_SPN"),
        (F.col("SpeedValid") * 65536).alias("DM01_SPN_High"),
    )
    return apply_custom(rows, "combine_dtcs")


def fence_hits_sql(lat: str, fences) -> str:
    """CTEs with the first fence around each position."""
    lines = ", ".join(
        f"({i}, {f['id']}, {f['latitude']!r}, {f['longitude']!r}, {f['radius']!r})" for i, f in enumerate(fences)
    )
    distance = _distance_sql(lat, "s.Longitude", "f.latitude", "f.longitude")
    return f"""
fences(pos, id, latitude, longitude, radius) AS (VALUES {lines}),
hits AS (
  SELECT event_id, arg_min(f.id, f.pos) AS id FROM signals s JOIN fences f ON {distance} <= f.radius GROUP BY event_id
)"""


def _first_fence_sql(lat: str, fences) -> str:
    return (
        fence_hits_sql(lat, fences)
        + """
SELECT s.event_id, CAST(coalesce(h.id, 0) AS BIGINT) AS GeofenceId FROM signals s LEFT JOIN hits h ON s.event_id = h.event_id"""
    )


_FILE = "device, date, file_name"


def _message_grid(message: str, step: str, columns: str = "Speed, Load, K") -> str:
    return f"""
{message}_rows AS (SELECT * FROM signals WHERE message = '{message}'),""" + grid_cte(
        message, f"{message}_rows", _FILE, columns, step, "true"
    )


_EVERY = ["click", "view", "purchase", "signup", "error"]

QUERIES = {
    "resample_grid": _resample,
    "resample_grid_nulls": _null_rows,
    "grid_join": _grid_join,
    "grid_join_all": _grid_join_all,
    "stack_messages": _stack,
    "stack_complete_files": _stack_complete,
    "delta_distance": _delta_distance,
    "geofence": _geofence,
    "geofence_many": _many_fences,
    "geofence_mixed": _mixed_fences,
    "geofence_no_position": _no_position,
    "haversine": _haversine,
    "combine_codes": _combine_codes,
}

ORACLES = {
    "resample_grid": with_signals(
        grid_cte("grid", "signals", "device, date, file_name, message", "Speed, Load", "2 HOUR", "true").strip()
        + "\nSELECT device, date, file_name, message, t, Speed, Load FROM grid"
    ),
    "resample_grid_nulls": with_signals(
        grid_cte("grid", "signals", "device, date", "Load", "30 MINUTE", "Load IS NOT NULL").strip()
        + "\nSELECT device, date, t, Load FROM grid"
    ),
    "grid_join": with_signals(
        (_message_grid("click", "2 HOUR") + "," + _message_grid("view", "2 HOUR")).strip()
        + """
SELECT c.device, c.date, c.file_name, c.t, c.Speed AS click_Speed, v.Speed AS view_Speed, c.Load AS click_Load, v.K AS view_K
FROM click c JOIN view v ON c.device = v.device AND c.date = v.date AND c.file_name = v.file_name AND c.t = v.t"""
    ),
    "grid_join_all": with_signals(
        ",".join(_message_grid(m, "2 HOUR", "Speed") for m in _EVERY).strip()
        + ",\nmet AS ("
        + " UNION ALL ".join(f"SELECT device, date, file_name, t, '{m}' AS message, Speed FROM {m}" for m in _EVERY)
        + """),
wanted AS (SELECT device, date, file_name, count(DISTINCT message) AS n FROM signals GROUP BY ALL)
SELECT m.device, m.date, m.file_name, m.t, """
        + ", ".join(f"max(Speed) FILTER (message = '{m}') AS {m}_Speed" for m in _EVERY)
        + """
FROM met m JOIN wanted w ON m.device = w.device AND m.date = w.date AND m.file_name = w.file_name
GROUP BY m.device, m.date, m.file_name, m.t, n HAVING count(DISTINCT message) = n"""
    ),
    "stack_messages": with_signals(
        """
SELECT device, t, Speed, CAST(NULL AS BIGINT) AS K, CAST(NULL AS DOUBLE) AS Load, message AS Message FROM signals WHERE message = 'click'
UNION ALL
SELECT device, t, NULL, K, Load, message FROM signals WHERE message = 'view'"""
    ),
    "stack_complete_files": with_signals(
        """
complete AS (
  SELECT device, date, file_name FROM signals WHERE message LIKE '%i%'
  GROUP BY ALL HAVING count(DISTINCT message) = (SELECT count(DISTINCT message) FROM signals WHERE message LIKE '%i%')
)
SELECT s.device, s.date, s.file_name, t, Speed, K FROM signals s JOIN complete c
ON s.device = c.device AND s.date = c.date AND s.file_name = c.file_name WHERE message LIKE '%i%'"""
    ),
    "delta_distance": with_signals(
        """
deltas AS (
  SELECT *, DistanceTrip - lag(DistanceTrip) OVER (PARTITION BY device, date ORDER BY t, event_id) AS d FROM signals
)
SELECT device, date, t, d AS DeltaDistance,
       CASE WHEN Speed > 20 AND SpeedValid = 1 THEN d END AS DeltaDistanceHighSpeed,
       CASE WHEN Speed <= 20 AND SpeedValid = 1 THEN d END AS DeltaDistanceLowSpeed
FROM deltas WHERE d IS NOT NULL"""
    ),
    "geofence": with_signals(_first_fence_sql("s.Latitude", FENCES)),
    "geofence_many": with_signals(_first_fence_sql("s.Latitude", MANY_FENCES)),
    "geofence_mixed": with_signals(_first_fence_sql("s.Latitude", MIXED_FENCES)),
    "geofence_no_position": with_signals(
        _first_fence_sql("(CASE WHEN s.K % 5 <> 0 THEN s.Latitude END)", FENCES)
    ),
    "haversine": with_signals(
        f"SELECT event_id, round({_distance_sql('Latitude', 'Longitude', '56.05', '10.05')}, 6) AS km FROM signals"
    ),
    "combine_codes": with_signals(
        """
SELECT device, t, event_id, K AS DM01_SPN, SpeedValid * 65536 AS DM01_SPN_High,
       CAST(event_id % 256 AS INT) AS SA, K + SpeedValid * 65536 AS DM01_SPN_Final
FROM signals"""
    ),
}
