"""The lake view all queries share, once in Spark and once in SQL.

The ``events`` table plays the lake: users are spread over 16 devices, the event type is the
message, and the value is the speed signal. Other signals follow from the remaining columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.chunks import chunk_width
from ..session import use_utc

DEVICES = [f"{n:08X}" for n in range(16)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def as_signals(events: DataFrame, devices: int = 16) -> DataFrame:
    """Event rows as message rows of a lake."""
    t = F.col("ts").cast("timestamp")
    k = F.get_json_object("props", "$.k").cast("long")
    return events.select(
        F.lpad(F.hex(F.col("user_id") % devices), 8, "0").alias("device"),
        F.col("event_type").alias("message"),
        F.to_date(t).alias("date"),
        F.concat(F.date_format(t, "yyyyMMdd_"), F.floor(F.hour(t) / 6), F.lit(".parquet")).alias("file_name"),
        t.alias("t"),
        F.col("value").alias("Speed"),
        F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("Load"),
        (F.col("event_id") % 2).alias("SpeedValid"),
        F.floor(F.pmod(F.unix_seconds(t), F.lit(86400)) / 10).cast("double").alias("DistanceTrip"),
        (56 + k * 0.002).alias("Latitude"),
        (10 + (F.col("event_id") % 100) * 0.002).alias("Longitude"),
        k.alias("K"),
        "event_id",
    )


def signals(spark: SparkSession, sf_dir: str, devices: int = 16) -> DataFrame:
    return as_signals(table(spark, sf_dir, "events"), devices)


def measured_width(df: DataFrame, keys) -> int:
    """Chunk width fitted to the density of the rows at hand."""
    return chunk_width(df, keys)


def signals_sql(devices: int = 16) -> str:
    return f"""
signals AS (
  SELECT printf('%08X', user_id % {devices}) AS device,
         event_type AS message,
         CAST(ts AS DATE) AS date,
         strftime(ts, '%Y%m%d_') || CAST(hour(ts) // 6 AS VARCHAR) || '.parquet' AS file_name,
         ts AS t,
         value AS Speed,
         CASE WHEN event_id % 7 <> 0 THEN value END AS Load,
         event_id % 2 AS SpeedValid,
         CAST((hour(ts) * 3600 + minute(ts) * 60 + second(ts)) // 10 AS DOUBLE) AS DistanceTrip,
         CAST(56 AS DOUBLE) + K * CAST(0.002 AS DOUBLE) AS Latitude,
         CAST(10 AS DOUBLE) + (event_id % 100) * CAST(0.002 AS DOUBLE) AS Longitude,
         K,
         event_id
  FROM (SELECT *, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS K FROM events)
)"""


def with_signals(rest: str, devices: int = 16) -> str:
    """``WITH signals AS (...)`` followed by more CTEs and the final SELECT."""
    rest = rest.strip()
    joint = "\n" if rest.upper().startswith("SELECT") else ",\n"
    return f"WITH {signals_sql(devices)}{joint}{rest}"
