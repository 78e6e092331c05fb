"""Lake scans, listings, message selection, configs, triggers and paths."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import device_of, forward_slashes
from ..operators.select import file_groups, select_messages
from ..schema import SERIES_KEYS
from ..session import work_folder
from ..sources.configs import (
    BACKLOG_DOC,
    GEOFENCES_DOC,
    catalog_groups,
    parse_documents,
)
from ..sources.lake import read_lake, write_message, write_trip_summary
from ..sources.objects import filter_objects, list_objects, with_lake_parts
from ..sources.triggers import trigger_paths
from .base import signals, table, with_signals
from .trips import trip_summary

#: Devices of the written lake: few, so that the test tables do not turn into tiny files.
_LAKE_DEVICES = 2


def _written_lake(spark: SparkSession, sf_dir: str) -> str:
    """The signals, stored as a lake; missing loads are stored as NaN, as decoders do."""
    rows = signals(spark, sf_dir, _LAKE_DEVICES).select(
        "device",
        "message",
        "date",
        "file_name",
        "t",
        "event_id",
        "Speed",
        F.coalesce("Load", F.lit(float("nan"))).alias("Load"),
    )
    folder = work_folder(spark, "lake")
    write_message(rows, folder)
    return folder


def _scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_lake(spark, _written_lake(spark, sf_dir)).select(
        "device", "message", "date", "file_name", "t", "event_id", "Speed", "Load"
    )


def _pruned_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One message of one device over two days: only these folders are read."""
    lake = read_lake(spark, _written_lake(spark, sf_dir), "view")
    return lake.where(
        (F.col("device") == "00000001") & F.col("date").between(date(2024, 1, 9), date(2024, 1, 10))
    ).select("device", "date", "t", "event_id", "Speed", "Load")


def _list_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lake folders that a listing finds Parquet files in."""
    listed = list_objects(spark, _written_lake(spark, sf_dir), "device=", ".parquet")
    part = {n: F.regexp_extract("path", f"{n}=([^/]+)/", 1) for n in ("device", "message", "date")}
    return (
        listed.where(F.col("size") > 0)
        .select(*(c.alias(n) for n, c in part.items()))
        .distinct()
        .withColumn("date", F.to_date("date"))
    )


def _object_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing in path layout: one object per device, message, day and log file."""
    rows = signals(spark, sf_dir)
    path = F.concat_ws("/", "device", "message", F.date_format("date", "yyyy/MM/dd"), "file_name")
    return rows.select(path.alias("path")).groupBy("path").agg(F.count(F.lit(1)).alias("size"))


def _filtered_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_objects(_object_names(spark, sf_dir), "0000000A/view/", "_3.parquet")


def _groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return file_groups(with_lake_parts(_object_names(spark, sf_dir)))


def _joined(groups: DataFrame) -> DataFrame:
    return groups.withColumn("messages", F.array_join("messages", ","))


def _select(mode: str):
    """All three match types of one mode."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        groups = _groups(spark, sf_dir)
        specs = {"equals": ["view", "click"], "contains": "i", "all_messages": None}
        parts = [
            select_messages(groups, kind, spec, mode).select(F.lit(kind).alias("match_type"), *SERIES_KEYS, "messages")
            for kind, spec in specs.items()
        ]
        return _joined(parts[0].unionByName(parts[1]).unionByName(parts[2]))

    return query


def _paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw log paths of different shapes, made from the event rows."""
    number = F.lpad(F.col("event_id").cast("string"), 8, "0")
    session = F.lpad(F.col("user_id").cast("string"), 8, "0")
    device = F.lpad(F.hex(F.col("user_id") % 16), 8, "0")
    shape = F.col("event_id") % 7
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.when(shape == 0, F.concat_ws("/", F.lower(device), session, F.concat(number, F.lit(".MF4"))))
        .when(shape == 1, F.concat_ws("/", device, F.concat(number, F.lit(".MFC"))))
        .when(shape == 2, F.concat_ws("\\", device, session, F.concat(number, F.lit(".mfe"))))
        .when(shape == 3, F.concat_ws("/", device, session, F.lit("a"), F.concat(number, F.lit(".MF4"))))
        .when(shape == 4, F.concat_ws("/", device, session, F.concat(number, F.lit(".txt"))))
        .otherwise(F.concat_ws("/", device, session, F.concat(number, F.lit(".MFM"))))
        .alias("path"),
    )


_PATHS_SQL = """
parts AS (
  SELECT event_id, printf('%08X', user_id % 16) AS d, printf('%08d', user_id) AS s, printf('%08d', event_id) AS n FROM events
),
paths AS (
  SELECT event_id, CASE event_id % 7
    WHEN 0 THEN lower(d) || '/' || s || '/' || n || '.MF4'
    WHEN 1 THEN d || '/' || n || '.MFC'
    WHEN 2 THEN d || chr(92) || s || chr(92) || n || '.mfe'
    WHEN 3 THEN d || '/' || s || '/a/' || n || '.MF4'
    WHEN 4 THEN d || '/' || s || '/' || n || '.txt'
    ELSE d || '/' || s || '/' || n || '.MFM' END AS path
  FROM parts
)"""


def _normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _paths(spark, sf_dir).select("event_id", forward_slashes(F.col("path")).alias("path"))


def _extract_device(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _paths(spark, sf_dir).select("event_id", device_of(F.col("path")).alias("device"))


def _envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trigger envelopes of four shapes around the log paths."""
    paths = _paths(spark, sf_dir)
    path = F.col("path")
    record = F.struct(F.struct(F.struct(F.lit("b").alias("name")).alias("bucket"), F.struct(F.url_encode(path).alias("key")).alias("object")).alias("s3"))
    url = F.concat(F.lit("https://store.example/container/"), F.translate(path, "\\", "/"))
    kind = F.col("event_id") % 4
    envelope = (
        F.when(kind == 0, F.to_json(F.array(path, F.lit("x/y/z.csv"))))
        .when(kind == 1, F.to_json(F.struct(F.array(record, record).alias("Records"))))
        .when(kind == 2, F.to_json(F.struct(url.alias("url"))))
        .otherwise(F.to_json(F.struct(F.struct(path.alias("name")).alias("data"))))
    )
    provider = F.element_at(F.array(*map(F.lit, ["Google", "Amazon", "Azure", "Google"])), (kind + 1).cast("int"))
    return paths.select("event_id", provider.alias("provider"), envelope.alias("envelope"))


def _group_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One catalog-group document: a group per nation, with the devices of its customers."""
    customers = table(spark, sf_dir, "customer")
    per_nation = customers.groupBy("c_nationkey").agg(
        F.sort_array(F.collect_set(F.lpad(F.hex(F.col("c_custkey") % 40), 8, "0"))).alias("devices")
    )
    group = F.struct(
        "c_nationkey",
        "devices",
        F.array(
            F.concat(F.lit("can1-type"), F.col("c_nationkey").cast("string"), F.lit(".dbc")), F.lit("can2-common.dbc")
        ).alias("dbc_files"),
    )
    # At most 25 nations with at most 40 devices each.
    return per_nation.agg(
        F.to_json(F.struct(F.sort_array(F.collect_list(group)).alias("dbc_groups"))).alias("document")
    )


def _catalog_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files per device of all users; devices without a group use every catalog (empty list)."""
    groups = catalog_groups(_group_documents(spark, sf_dir))
    devices = (
        table(spark, sf_dir, "events")
        .select(F.lpad(F.hex(F.col("user_id") % 64), 8, "0").alias("device"))
        .groupBy("device")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    return devices.join(groups, "device", "left").select(
        "device", "rows", F.coalesce(F.array_join("files", ","), F.lit("")).alias("files")
    )


def _config_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents made from tables, read back by their schemas; broken ones are left out."""
    supplier = table(spark, sf_dir, "supplier")
    fence = F.struct(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        (F.col("s_nationkey") + 40.5).alias("latitude"),
        (F.col("s_nationkey") - 9.25).alias("longitude"),
        F.abs("s_acctbal").alias("radius"),
    )
    fences = supplier.select(
        F.when(F.col("s_suppkey") % 10 == 0, F.lit("[{oops")).otherwise(F.to_json(F.array(fence))).alias("document")
    )
    read = parse_documents(fences, GEOFENCES_DOC).select(F.explode("parsed").alias("f"))
    from_fences = read.select(
        F.lit("geofence").alias("kind"),
        F.col("f.id").alias("id"),
        F.col("f.name").alias("name"),
        F.round(F.col("f.latitude") + F.col("f.longitude"), 6).alias("number"),
    )
    documents = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.to_json(
            F.struct(
                F.struct(F.struct(F.lit(10).alias("min"), F.lit(256).alias("max")).alias("batch_size")).alias("config"),
                F.array(*(F.concat(F.lit(p), F.col(c).cast("string")) for p, c in (("D", "o_orderkey"), ("C", "o_custkey")))).alias("files"),
            )
        ).alias("document"),
    )
    backlog = parse_documents(documents, BACKLOG_DOC).select("o_orderkey", "parsed.config", F.explode("parsed.files").alias("file"))
    from_backlog = backlog.select(
        F.lit("backlog").alias("kind"),
        F.col("o_orderkey").alias("id"),
        F.col("file").alias("name"),
        F.col("config.batch_size.max").cast("double").alias("number"),
    )
    return from_fences.unionByName(from_backlog)


def _summary_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored trip summary after a rerun of some days: they are replaced, not doubled."""
    folder = work_folder(spark, "tripsummary")
    summary = trip_summary(spark, sf_dir)
    write_trip_summary(summary, folder)
    later = summary.where(F.col("date") >= date(2024, 1, 20))
    write_trip_summary(later.withColumn("Cluster", F.lit("rerun")), folder)
    return spark.read.parquet(folder).groupBy("date", "Cluster").agg(F.count(F.lit(1)).alias("rows"))


QUERIES = {
    "lake_scan": _scan,
    "lake_scan_pruned": _pruned_scan,
    "list_objects": _list_objects,
    "filter_objects": _filtered_names,
    "file_groups": lambda spark, sf_dir: _joined(_groups(spark, sf_dir)),
    "message_select": _select("each"),
    "message_select_all_present": _select("all_present"),
    "normalize_path": _normalize,
    "extract_device": _extract_device,
    "trigger_paths": lambda spark, sf_dir: trigger_paths(_envelopes(spark, sf_dir)),
    "device_catalog_lookup": _catalog_lookup,
    "config_tables": _config_tables,
    "trip_summary_rerun": _summary_rerun,
}

_GROUPS_SQL = """
groups AS (
  SELECT device, date, file_name, list_sort(list(DISTINCT message)) AS m FROM signals GROUP BY ALL
),
every AS (SELECT list(DISTINCT message) AS i FROM signals WHERE message LIKE '%i%')"""


def _select_sql(equals: str, contains: str) -> str:
    return with_signals(
        _GROUPS_SQL.strip()
        + f""",
chosen AS (
  SELECT 'equals' AS match_type, g.* REPLACE (list_filter(m, lambda x: x IN ('view', 'click')) AS m), {equals} AS ok FROM groups g
  UNION ALL
  SELECT 'contains', g.* REPLACE (list_filter(m, lambda x: contains(x, 'i')) AS m), {contains} FROM groups g, every
  UNION ALL
  SELECT 'all_messages', g.*, true FROM groups g
)
SELECT match_type, device, date, file_name, array_to_string(m, ',') AS messages FROM chosen WHERE ok AND len(m) > 0"""
    )


ORACLES = {
    "lake_scan": with_signals(
        "SELECT device, message, date, file_name, t, event_id, Speed, Load FROM signals", _LAKE_DEVICES
    ),
    "lake_scan_pruned": with_signals(
        """SELECT device, date, t, event_id, Speed, Load FROM signals
WHERE device = '00000001' AND message = 'view' AND date BETWEEN DATE '2024-01-09' AND DATE '2024-01-10'""",
        _LAKE_DEVICES,
    ),
    "list_objects": with_signals("SELECT DISTINCT device, message, date FROM signals", _LAKE_DEVICES),
    "filter_objects": with_signals(
        """SELECT device || '/' || message || '/' || strftime(date, '%Y/%m/%d') || '/' || file_name AS path, count(*) AS size
FROM signals WHERE device = '0000000A' AND message = 'view' AND hour(t) >= 18 GROUP BY ALL"""
    ),
    "file_groups": with_signals(
        _GROUPS_SQL.strip()
        + "\nSELECT device, date, file_name, array_to_string(m, ',') AS messages FROM groups"
    ),
    "message_select": _select_sql("true", "true"),
    "message_select_all_present": _select_sql(
        "list_has_all(g.m, ['view', 'click'])", "list_has_all(g.m, i)"
    ),
    "normalize_path": "WITH " + _PATHS_SQL.strip() + "\nSELECT event_id, replace(path, chr(92), '/') AS path FROM paths",
    "extract_device": "WITH "
    + _PATHS_SQL.strip()
    + """
SELECT event_id, CASE WHEN regexp_full_match(path, '[0-9A-F]{8}/[^/]*/[^/]*') THEN left(path, 8) ELSE '' END AS device FROM paths""",
    "trigger_paths": "WITH "
    + _PATHS_SQL.strip()
    + """,
repeated AS (
  SELECT event_id, path FROM paths
  UNION ALL SELECT event_id, path FROM paths WHERE event_id % 4 = 1
)
SELECT event_id, CASE WHEN event_id % 4 = 2 THEN replace(path, chr(92), '/') ELSE path END AS path
FROM repeated WHERE NOT path LIKE '%.txt'""",
    "device_catalog_lookup": """
WITH first_group AS (
  SELECT printf('%08X', c_custkey % 40) AS device, min(c_nationkey) AS g FROM customer GROUP BY 1
),
devices AS (SELECT printf('%08X', user_id % 64) AS device, count(*) AS rows FROM events GROUP BY 1)
SELECT d.device, rows, CASE WHEN g IS NULL THEN '' ELSE 'can1-type' || g || '.dbc,can2-common.dbc' END AS files
FROM devices d LEFT JOIN first_group f ON d.device = f.device""",
    "config_tables": """
SELECT 'geofence' AS kind, s_suppkey AS id, s_name AS name, round(CAST(2 * s_nationkey AS DOUBLE) + 31.25, 6) AS number
FROM supplier WHERE s_suppkey % 10 <> 0
UNION ALL
SELECT 'backlog', o_orderkey, 'D' || o_orderkey, CAST(256 AS DOUBLE) FROM orders
UNION ALL
SELECT 'backlog', o_orderkey, 'C' || o_custkey, CAST(256 AS DOUBLE) FROM orders""",
    "trip_summary_rerun": None,
}


def _rerun_sql() -> str:
    from .trips import ORACLES as trip_oracles

    return f"""
SELECT date, CASE WHEN date >= DATE '2024-01-20' THEN 'rerun' ELSE Cluster END AS Cluster, count(*) AS rows
FROM ({trip_oracles["trip_summary"]}) GROUP BY 1, 2"""


ORACLES["trip_summary_rerun"] = _rerun_sql()
