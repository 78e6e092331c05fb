"""Sharding by jump consistent hashing, in column expressions.

A key's jumps over shard numbers are drawn from digests of (key, shard it stands on), so the walk
is the same for every shard count and merely ends sooner: appending a shard moves only the rows
that jump onto it. There is no table of shards. Slots number the rows of a shard; they are counted
in blocks of the key's digest, so no task sorts a whole shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .common import id_digest

#: Jumps are independent events with mean ln(shards) + 1 in all, so that more than this many have
#: a probability below 1e-100 for any shard count that fits 31 bits.
MOST_JUMPS = 256
#: Hex digits of the digest that name a block: 4096 blocks for each shard.
BLOCK_DIGITS = 3


def _uniform(key: Column, at: Column) -> Column:
    """A number in (0, 1] for each key and shard, from 52 bits of a digest."""
    digits = F.substring(F.md5(F.concat(key, F.lit(":"), at.cast("string")).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 1.0) / float(1 << 52)


def jump_shard(key: Column, shards: int) -> Column:
    """The shard, from 0, of a text key among ``shards``."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    start = F.struct(F.lit(-1).cast("long").alias("at"), F.lit(0).cast("long").alias("next"))

    def jump(state: Column, _: Column) -> Column:
        landed = F.floor((state["next"] + 1).cast("double") / _uniform(key, state["next"])).cast("long")
        moved = F.struct(state["next"].alias("at"), landed.alias("next"))
        return F.when(state["next"] < shards, moved).otherwise(state)

    steps = F.sequence(F.lit(1), F.lit(min(shards, MOST_JUMPS)))
    return F.aggregate(steps, start, jump, lambda state: state["at"]).cast("int")


def shard_documents(docs: DataFrame, shards: int = 24) -> DataFrame:
    """Places of all documents: ``doc_id``, ``size`` (UTF-8 bytes and 8 more), ``text_crc32``,
    ``law`` ('key'), ``shard``, ``slot`` and ``grown_shard`` (with one shard more).

    A missing text has no bytes; a missing doc_id is the empty key. Repeated rows share a shard and
    get a slot each. An empty table gives no rows. Texts are read once and never shuffled.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    content = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    placed = docs.select(
        "doc_id",
        (F.octet_length(content) + 8).cast("long").alias("size"),
        F.crc32(content).alias("text_crc32"),
        jump_shard(key, shards).alias("shard"),
        jump_shard(key, shards + 1).alias("grown_shard"),
        id_digest().alias("digest"),
    ).withColumn("block", F.substring("digest", 1, BLOCK_DIGITS))
    placed = stored(placed, "placed")
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("shard", "block").agg(F.count("*").alias("n")).select(
        "shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")
    )
    within = Window.partitionBy("shard", "block").orderBy("digest", "doc_id", "size", "text_crc32")
    return placed.join(offsets, ["shard", "block"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("offset") + F.row_number().over(within) - 1).cast("long").alias("slot"),
        "grown_shard",
    )
