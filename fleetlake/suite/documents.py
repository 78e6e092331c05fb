"""Rules of many configuration documents, made from the customers: a document each, some of them unreadable."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.configs import aggregation_rules, custom_rules, event_rules
from .base import table

def _key() -> Column:
    return F.col("c_custkey")


def _text(number: Column) -> Column:
    return number.cast("string")


def _documents(spark: SparkSession, sf_dir: str, json: Column) -> DataFrame:
    """``customer`` and its ``document``; every eleventh breaks off."""
    broken = F.when(_key() % 11 == 0, F.substring(json, 1, 9)).otherwise(json)
    return table(spark, sf_dir, "customer").select(_key().cast("long").alias("customer"), broken.alias("document"))


def _aggregations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two clusters a document; the second detail block lists the first cluster again, in vain."""

    def block(clusters: list[Column], trip: Column, *specs: Column) -> Column:
        trip = F.struct(F.struct(trip.alias("message")).alias("trip_identifier"), F.array(*specs).alias("aggregations"))
        return F.struct(F.array(*clusters).alias("clusters"), trip.alias("details"))

    def spec(message: Column, signals: list[str], names: list[str]) -> Column:
        listed = [F.array(*map(F.lit, x)) for x in (signals, names)]
        return F.struct(message.alias("message"), listed[0].alias("signal"), listed[1].alias("aggregation"))

    def members(name: Column, *devices: Column) -> Column:
        return F.struct(F.array(*devices).alias("devices"), name.alias("cluster"))

    segment, rest = F.col("c_mktsegment"), F.lit("rest")
    device = F.lpad(F.hex(_key()), 8, "0")
    trip = F.when(_key() % 5 != 0, F.concat(F.lit("Trip"), _text(F.col("c_nationkey")))).otherwise("")
    first = block([segment], trip, spec(F.concat(F.lit("M"), _text(_key() % 7)), ["Speed", "Load"], ["avg", "max"]))
    second = block([segment, rest], F.lit("Other"), spec(F.lit("Gnss"), ["Height"], ["first"]), spec(F.lit(""), ["None"], ["sum"]))
    settings = F.struct(F.struct((_key() % 9 / 2).alias("trip_gap_min"), F.lit(0.25).alias("trip_min_length_min")).alias("trip"))
    json = F.to_json(
        F.struct(
            settings.alias("config"),
            F.array(members(segment, device, F.lit("0000000X")), members(rest, device), members(F.lit("unlisted"), device)).alias("device_clusters"),
            F.array(first, second).alias("cluster_details"),
        )
    )
    return aggregation_rules(_documents(spark, sf_dir, json))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two events a document; every third document names its own settings."""

    def event(name: Column, messages: Column, lower: Column) -> Column:
        return F.struct(
            name.alias("event_name"),
            F.lit("equals").alias("messages_match_type"),
            messages.alias("messages_filtered_list"),
            F.array(F.lit("Speed"), F.col("c_mktsegment")).alias("trigger_signals"),
            lower.alias("lower_threshold"),
            (lower + 1).alias("upper_threshold"),
            (_key() % 2 == 0).alias("rising_as_start"),
        )

    general = F.struct(F.array(F.lit("Gnss"), F.lit("Pos")).alias("messages_gps"), F.lit(False).alias("include_gps_data"))
    nested = F.array(F.array(F.lit("A"), F.lit("B")), F.array(F.lit("C")))
    events = F.array(
        event(F.concat(F.lit("low "), _text(_key())), nested, _key() / 4),
        event(F.lit("high"), F.array(F.array(F.concat(F.lit("M"), _text(_key() % 7)))), F.lit(-1.5)),
    )
    json = F.to_json(F.struct(F.when(_key() % 3 == 0, general).alias("general"), events.alias("events")))
    rules = event_rules(_documents(spark, sf_dir, json))
    return rules.withColumns({c: F.array_join(c, ",") for c in ("messages_gps", "trigger_signals")})


def _custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many derived messages as the key says, none up to four."""
    message = lambda i: F.struct(
        F.array(F.concat(F.lit("M"), _text(i)), F.lit("Gnss")).alias("messages_filtered_list"),
        F.lit("contains").alias("messages_match_type"),
        F.concat(_text(i + 1), F.lit("s")).alias("raster"),
        F.concat(F.col("c_mktsegment"), _text(i)).alias("custom_message_name"),
        F.when(i % 2 == 0, True).alias("prefix"),
        F.lit("distance").alias("function"),
    )
    json = F.to_json(F.transform(F.slice(F.sequence(F.lit(0), F.lit(3)), F.lit(1), (_key() % 5).cast("int")), message))
    return custom_rules(_documents(spark, sf_dir, json))


QUERIES = {"config_aggregations": _aggregations, "config_events": _events, "config_custom": _custom}

_SQL = "WITH c AS (SELECT *, CAST(c_custkey AS BIGINT) AS customer FROM customer WHERE c_custkey % 11 <> 0)"

ORACLES = {
    "config_aggregations": _SQL
    + """,
rules AS (
  SELECT customer, c_mktsegment AS cluster, 'Trip' || c_nationkey AS trip_message, unnest([printf('%08X', customer), '0000000X']) AS device,
    'M' || customer % 7 AS message, signal, aggregation
  FROM c, (VALUES ('Speed'), ('Load')) AS s(signal), (VALUES ('avg'), ('max')) AS a(aggregation) WHERE customer % 5 <> 0
  UNION ALL
  SELECT customer, 'rest', 'Other', printf('%08X', customer), 'Gnss', 'Height', 'first' FROM c
)
SELECT customer, customer % 9 * 30000000 AS gap_us, CAST(15000000 AS BIGINT) AS min_length_us, cluster, trip_message, device, message, signal, aggregation
FROM rules""",
    "config_events": _SQL
    + """
SELECT customer, pos, CASE WHEN customer % 3 = 0 THEN 'Gnss,Pos' ELSE 'CAN9_GnssPos' END AS messages_gps, customer % 3 <> 0 AS include_gps_data,
  'Latitude' AS signal_latitude, 'Longitude' AS signal_longitude, 'Review details via e.g. your event dashboard' AS static_body_content,
  CASE pos WHEN 0 THEN 'low ' || customer ELSE 'high' END AS event_name, 'equals' AS messages_match_type,
  CASE pos WHEN 0 THEN '[["A","B"],["C"]]' ELSE '[["M' || customer % 7 || '"]]' END AS messages_filtered_list,
  'Speed,' || c_mktsegment AS trigger_signals, CASE pos WHEN 0 THEN customer / 4 ELSE -1.5 END AS lower_threshold,
  CASE pos WHEN 0 THEN customer / 4 + 1 ELSE -0.5 END AS upper_threshold, customer % 2 = 0 AS rising_as_start,
  CAST(NULL AS BOOLEAN) AS exact_match, CAST(NULL AS VARCHAR) AS raster
FROM c, (VALUES (0), (1)) AS p(pos)""",
    "config_custom": _SQL
    + """
SELECT customer, pos, '["M' || pos || '","Gnss"]' AS messages_filtered_list, 'contains' AS messages_match_type, (pos + 1) || 's' AS raster,
  c_mktsegment || pos AS custom_message_name, CASE WHEN pos % 2 = 0 THEN true END AS "prefix", 'distance' AS "function"
FROM c, (VALUES (0), (1), (2), (3)) AS p(pos) WHERE pos < customer % 5""",
}
