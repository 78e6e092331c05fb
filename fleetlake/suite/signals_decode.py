"""Signal catalogs as text, and frames decoded with them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.signals import decode_frames, field_layouts, parse_catalog
from .base import signals, table, with_signals


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog text made from the parts: a message per part, with three signals each."""
    p = table(spark, sf_dir, "part")
    key, size = F.col("p_partkey").cast("string"), F.col("p_size").cast("string")
    length = (1 + F.col("p_size") % 32).cast("string")
    texts = F.array(
        F.concat(F.lit("BO_ "), key, F.lit(" Part"), key, F.lit(": 8 Vector")),
        F.concat(F.lit(" SG_ Size M : 0|8@1+ (1,0) [0|255] \"\" Vector")),
        F.concat(F.lit(" SG_ Price m"), size, F.lit(" : 8|"), length, F.lit("@1- (0.01,"), key, F.lit(") [-10|1e3] \"EUR\" Vector")),
        F.concat(F.lit(" SG_ Brand : 39|8@0+ (0.5,-1) [0|10] \"deg\" Vector")),
        F.lit("CM_ BO_ 1 \"a comment: SG_ none\";"),
    )
    return p.select(
        F.concat(F.lit("can"), (F.col("p_partkey") % 9 + 1).cast("string"), F.lit("-parts.dbc")).alias("file"),
        F.posexplode(texts).alias("n", "line"),
        (F.col("p_partkey") * 10).alias("first"),
    ).select("file", (F.col("first") + F.col("n")).alias("line_no"), "line")


def _catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_catalog(_lines(spark, sf_dir)).select(
        "bus", "frame_id", "message", "signal", "start_bit", "length", "little_endian", "signed", "factor", "offset", "min", "max", "unit", "mux", "mux_signal"
    )


# An invented catalog in the same text format: little- and big-endian, signed and multiplexed
# fields, 63 and 64 bits, selectors over three levels.
CATALOG_TEXT = """
BO_ 321 Pump: 8 Maker
 SG_ Running : 3|1@1+ (1,0) [0|1] "" Maker
 SG_ Flow : 4|21@1+ (0.002,-3) [-3|4000] "l" Maker
 SG_ Tilt : 28|11@1- (0.25,-7) [-300|300] "grad" Maker
 SG_ Batch : 55|16@0+ (1,0) [0|65535] "" Maker
 SG_ Beyond : 61|9@1+ (1,0) [0|7] "" Maker

BO_ 655 State: 4 Maker
 SG_ Kind M : 0|4@1+ (1,0) [0|15] "" Maker
 SG_ Even m0 : 15|16@0- (0.5,0) [0|100] "" Maker
 SG_ Odd m1 : 4|12@1+ (2,1) [0|100] "" Maker

BO_ 654 Deep: 20 Maker
 SG_ Top M : 2|3@1+ (1,0) [0|0] "" Maker
 SG_ Middle m1M : 11|4@0+ (1,0) [0|0] "" Maker
 SG_ Low m2M : 16|6@1+ (1,0) [0|0] "" Maker
 SG_ Leaf m3 : 24|8@1- (0.5,1) [0|0] "bar" Maker
 SG_ Wide : 39|64@0+ (1e-12,0) [0|0] "" Maker
 SG_ Long : 97|63@1- (1e-07,0) [0|0] "" Maker

SG_MUL_VAL_ 654 Middle Top 1-1;
SG_MUL_VAL_ 654 Low Middle 2-3;
SG_MUL_VAL_ 654 Leaf Low 3-3;
"""


def _big(number, digits: int):
    """Hex text of a number, highest byte first."""
    return F.lpad(F.hex(number.cast("long")), digits, "0")


def _little(number, digits: int):
    """The same, lowest byte first."""
    text = _big(number, digits)
    return F.concat(*(F.substring(text, i, 2) for i in range(digits - 1, 0, -2)))


def _frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three frames per event row, packed bit by bit as the catalog says."""
    centred, event, k = F.col("K") - 50, F.col("event_id"), F.col("K")
    flow = F.col("SpeedValid") * 8 + F.round(F.col("Speed") * 1000).cast("long") * 16
    pump = F.concat(
        _little(flow + F.pmod(centred, F.lit(2048)) * (1 << 28), 10), F.lit("00"), _big(event % 65536, 4)
    )
    state = F.when(
        event % 2 == 1, F.concat(_little(1 + k * 16, 4), F.lit("0000"))
    ).otherwise(F.concat(F.lit("00"), _big(F.pmod(centred, F.lit(65536)), 4), F.lit("00")))
    deep = F.concat(
        _big(k % 3 * 4, 2), _big(event % 5, 2), _big(k % 4, 2), _big(F.pmod(centred, F.lit(256)), 2),
        _big(65535 - event % 65536, 4), _big(k, 12), _little(centred * (1 << 41), 16),
    )
    frames = [
        F.struct(F.lit(frame_id).cast("long").alias("frame_id"), F.unhex(text).alias("payload"))
        for frame_id, text in ((321, pump), (655, state), (654, deep))
    ]
    return (
        signals(spark, sf_dir)
        .select("device", "t", "event_id", F.explode(F.array(*frames)).alias("f"))
        .select("device", "t", "event_id", "f.frame_id", "f.payload")
    )


def _decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The frames decoded again."""
    lines = spark.createDataFrame(
        [("can9-fleet.dbc", n, line) for n, line in enumerate(CATALOG_TEXT.splitlines())],
        "file string, line_no int, line string",
    )
    layouts = field_layouts(parse_catalog(lines))
    return decode_frames(_frames(spark, sf_dir), layouts).select(
        "device", "t", "event_id", "frame_id", "message", "signal", F.round("value", 6).alias("value"), "unit"
    )


_DECODED = [
    (321, "Pump", "Running", "SpeedValid", "", "true"),
    (321, "Pump", "Flow", "round(Speed * 1000) * 0.002 - 3", "l", "true"),
    (321, "Pump", "Tilt", "(K - 50) * 0.25 - 7", "grad", "true"),
    (321, "Pump", "Batch", "event_id % 65536", "", "true"),
    (655, "State", "Kind", "event_id % 2", "", "true"),
    (655, "State", "Even", "(K - 50) * 0.5", "", "event_id % 2 = 0"),
    (655, "State", "Odd", "K * 2 + 1", "", "event_id % 2 = 1"),
    (654, "Deep", "Top", "K % 3", "", "true"),
    (654, "Deep", "Middle", "event_id % 5", "", "K % 3 = 1"),
    (654, "Deep", "Low", "K % 4", "", "K % 3 = 1 AND event_id % 5 IN (2, 3)"),
    (654, "Deep", "Leaf", "(K - 50) * 0.5 + 1", "bar", "K % 3 = 1 AND event_id % 5 IN (2, 3) AND K % 4 = 3"),
    (654, "Deep", "Wide", "(CAST(65535 - event_id % 65536 AS DOUBLE) * 281474976710656 + K) * 1e-12", "", "true"),
    (654, "Deep", "Long", "CAST((K - 50) * 1099511627776 AS DOUBLE) * 1e-7", "", "true"),
]

QUERIES = {"signal_catalog": _catalog, "decode_frames": _decoded}

ORACLES = {
    "signal_catalog": """
WITH p AS (SELECT *, 'can' || (p_partkey % 9 + 1) AS bus, 'Part' || p_partkey AS message FROM part)
SELECT bus, p_partkey AS frame_id, message, 'Size' AS signal, 0 AS start_bit, 8 AS length, true AS little_endian,
  false AS signed, CAST(1 AS DOUBLE) AS factor, CAST(0 AS DOUBLE) AS offset, CAST(0 AS DOUBLE) AS min,
  CAST(255 AS DOUBLE) AS max, '' AS unit, 'M' AS mux, CAST(NULL AS VARCHAR) AS mux_signal FROM p
UNION ALL
SELECT bus, p_partkey, message, 'Price', 8, 1 + p_size % 32, true, true, 0.01, p_partkey, -10, 1000, 'EUR', 'm' || p_size, 'Size' FROM p
UNION ALL
SELECT bus, p_partkey, message, 'Brand', 39, 8, false, false, 0.5, -1, 0, 10, 'deg', NULL, NULL FROM p""",
    "decode_frames": with_signals(
        "\nUNION ALL\n".join(
            f"""SELECT device, t, event_id, CAST({frame_id} AS BIGINT) AS frame_id, '{message}' AS message, '{signal}' AS signal,
round(CAST({value} AS DOUBLE), 6) AS value, '{unit}' AS unit FROM signals WHERE {where}"""
            for frame_id, message, signal, value, unit, where in _DECODED
        )
    ),
}
