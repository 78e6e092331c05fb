"""Backlog manifests over a listing of raw log files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import is_log_file, looks_like_file
from ..plans.backlog import classify_backlog, expand_backlog, plan_batches
from .base import table


def _listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw objects: one per event, in the session of its user; some are no log files."""
    name = F.concat(
        F.lpad(F.col("event_id").cast("string"), 8, "0"),
        F.when(F.col("event_id") % 11 == 0, ".txt").when(F.col("event_id") % 3 == 0, ".mfc").otherwise(".MF4"),
    )
    return table(spark, sf_dir, "events").select(
        F.concat_ws(
            "/",
            F.lpad(F.hex(F.col("user_id") % 16), 8, "0"),
            F.lpad(F.col("user_id").cast("string"), 8, "0"),
            name,
        ).alias("path")
    )


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries made from all users: devices, sessions, files and things to reject."""
    users = table(spark, sf_dir, "events").groupBy("user_id").agg(F.min("event_id").alias("event_id"))
    device = F.lpad(F.hex(F.col("user_id") % 16), 8, "0")
    session = F.lpad(F.col("user_id").cast("string"), 8, "0")
    number = F.lpad(F.col("event_id").cast("string"), 8, "0")
    kind = F.col("user_id") % 8
    return users.select(
        F.col("user_id").alias("pos"),
        F.when((kind == 0) & (F.col("user_id") % 16 == 0), F.concat(device, F.lit("/")))
        .when(kind == 0, device)
        .when(kind == 1, F.concat_ws("/", device, session))
        .when(kind == 2, F.concat_ws("/", device, session, F.lit("")))
        .when(kind == 3, F.concat_ws("/", F.lower(F.concat(F.lit("A"), device.substr(2, 7))), session))
        .when(kind == 4, F.concat_ws("/", device, F.concat(number, F.lit(".MF4"))))
        .when(kind == 5, F.concat_ws("/", device, session, F.concat(number, F.lit(".dat"))))
        .when(kind == 6, F.lit(""))
        .otherwise(F.concat_ws("/", device, session, F.concat(number, F.lit(".MF4"))))
        .alias("entry"),
    )


_SQL = """
WITH objects AS (
  SELECT printf('%08X', user_id % 16) AS device, printf('%08d', user_id) AS session,
    printf('%08d', event_id) || CASE WHEN event_id % 11 = 0 THEN '.txt' WHEN event_id % 3 = 0 THEN '.mfc' ELSE '.MF4' END AS name
  FROM events
),
users AS (
  SELECT user_id AS pos, printf('%08X', user_id % 16) AS d, printf('%08d', user_id) AS s, printf('%08d', min(event_id)) AS n
  FROM events GROUP BY user_id
),
entries AS (
  SELECT *, CASE pos % 8
    WHEN 0 THEN CASE WHEN pos % 16 = 0 THEN d || '/' ELSE d END
    WHEN 1 THEN d || '/' || s
    WHEN 2 THEN d || '/' || s || '/'
    WHEN 3 THEN 'a' || lower(substr(d, 2)) || '/' || s
    WHEN 4 THEN d || '/' || n || '.MF4'
    WHEN 5 THEN d || '/' || s || '/' || n || '.dat'
    WHEN 6 THEN ''
    ELSE d || '/' || s || '/' || n || '.MF4' END AS entry
  FROM users
),
found AS (
  SELECT device, session, device || '/' || session || '/' || name AS path, pos, -1 AS file_pos
  FROM objects JOIN users ON pos % 8 = 0 AND d = device WHERE NOT name LIKE '%.txt'
  UNION ALL
  SELECT device, session, device || '/' || session || '/' || name, pos, -1
  FROM objects JOIN users ON pos % 8 IN (1, 2) AND d = device AND s = session WHERE NOT name LIKE '%.txt'
  UNION ALL
  SELECT d, s, entry, pos, pos FROM entries WHERE pos % 8 = 7
),
files AS (SELECT device, session, path, min(pos) AS pos, min(file_pos) AS file_pos FROM found GROUP BY ALL),
expanded AS (
  SELECT device, session, path, min(pos) OVER (PARTITION BY device, session) AS session_pos, file_pos FROM files
),
ordered AS (
  SELECT *,
    row_number() OVER (PARTITION BY device ORDER BY session_pos, session, file_pos, path) - 1 AS i,
    row_number() OVER (PARTITION BY device, session ORDER BY file_pos, path) - 1 AS k
  FROM expanded
)
"""


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_backlog(_manifest(spark, sf_dir)).select(
        "pos",
        "path",
        "kind",
        is_log_file(F.col("path")).alias("log_file"),
        looks_like_file(F.col("path")).alias("file_like"),
    )


def _expanded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expand_backlog(_manifest(spark, sf_dir), _listing(spark, sf_dir))


def _batches(always_split: bool):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        files = _expanded(spark, sf_dir)
        return plan_batches(files, entries=256, smallest=10, largest=100, always_split=always_split)

    return query


QUERIES = {
    "classify_backlog": _classified,
    "backlog_expand": _expanded,
    "backlog_batches": _batches(always_split=True),
    "backlog_batches_by_session": _batches(always_split=False),
}

ORACLES = {
    "classify_backlog": _SQL
    + """
SELECT pos, CASE WHEN pos % 8 IN (0, 1, 3) AND NOT ends_with(entry, '/') THEN entry || '/' ELSE entry END AS path,
  CASE pos % 8 WHEN 0 THEN 'device' WHEN 1 THEN 'session' WHEN 2 THEN 'session' WHEN 7 THEN 'file' ELSE 'reject' END AS kind,
  pos % 8 IN (4, 7) AS log_file, pos % 8 IN (4, 5, 7) AS file_like
FROM entries""",
    "backlog_expand": _SQL + "SELECT device, session, path, session_pos, CAST(file_pos AS BIGINT) AS file_pos FROM expanded",
    "backlog_batches": _SQL
    + "SELECT device, session, path, device || '/' || (i // 100) AS batch, i % 100 AS place FROM ordered",
    "backlog_batches_by_session": _SQL
    + "SELECT device, session, path, device || '/' || session AS batch, k AS place FROM ordered",
}
