"""Mixing sources to target weights by weighted fair queueing.

Each source's documents are shuffled by a digest of their id and queued, as often as repeats are
allowed. A queued copy's virtual time is the source's cumulative words, up to the copy's middle,
divided by the source's weight. All copies are put in order of virtual time, and the order is cut
where the words reach the budget. Sources that end before the cut leave their share to the others.

Running sums are taken per (source, block of the digest) and shifted by the sums of earlier blocks,
so no task sorts a whole source. The cut is found by narrowing histograms; the rows of the last,
narrow interval alone are ordered in one task. Texts are read once, for their sizes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored
from .common import carried, id_digest, whole_text, word_count

#: Hex digits of the digest that name a block: 4096 blocks for each source.
BLOCK_DIGITS = 3
#: Intervals of one narrowing step, and steps.
INTERVALS, STEPS = 4096, 2
KEY = (T.DoubleType(), T.StringType(), T.LongType(), T.IntegerType())


def _sized(docs: DataFrame) -> DataFrame:
    return docs.select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("queue"),
        word_count(whole_text()).alias("size"),
        id_digest().alias("digest"),
    ).withColumn("block", F.substring("digest", 1, BLOCK_DIGITS))


def source_targets(sized: DataFrame, weights: Sequence[float], share: float, repeats: int) -> DataFrame:
    """A row for each source: its ``weight``, ``source_size`` and ``target`` in words.

    Sources take the weights in turn, in order of code points, the missing source last. Targets are
    in proportion to the weights, and sum up to ``share`` of all sizes; a target that would exceed
    ``repeats`` times its source stops there, and the others share the rest.
    """
    sources = sized.groupBy("queue", "source").agg(F.sum("size").alias("source_size"))
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    most = (F.col("source_size") * repeats).cast("double")
    weighed = sources.select("*", F.element_at(cycle, F.pmod(nth - 1, F.lit(len(weights))) + 1).alias("weight"), most.alias("most"))
    order = Window.orderBy(F.col("most") / F.col("weight"), "queue")
    everything = Window.partitionBy()
    upto, after = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(1, Window.unboundedFollowing)
    filled = weighed.select(
        "*",
        (F.sum("source_size").over(everything) * share).alias("budget"),
        F.sum("most").over(upto).alias("most_upto"),
        F.coalesce(F.sum("weight").over(after), F.lit(0.0)).alias("weight_after"),
    )
    full = F.col("most_upto") + F.col("most") / F.col("weight") * F.col("weight_after") <= F.col("budget")
    filled = filled.withColumn("full", full)
    level = (F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("most"))).over(everything), F.lit(0.0))) / F.sum(
        F.when(~F.col("full"), F.col("weight"))
    ).over(everything)
    return filled.select(
        "queue",
        "weight",
        "source_size",
        "budget",
        level.alias("level"),
        F.when(F.col("full"), F.col("most")).otherwise(level * F.col("weight")).alias("target"),
    )


def _queued(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Rows with the words queued before them in their source."""
    blocks = sized.groupBy("queue", "block").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("queue").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("queue", "block", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset"))
    offsets = offsets.join(targets, "queue")
    order = Window.partitionBy("queue", "block").orderBy("digest", "doc_id", "size")
    inside = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    return sized.join(offsets, ["queue", "block"]).withColumn("before", F.col("offset") + inside).drop("offset")


def virtual_time(copy: int) -> Column:
    """Where the middle of the ``copy``-th copy of a document comes in the common order."""
    words = (F.col("before") + F.col("source_size") * copy).cast("double") + F.col("size") / 2.0
    return words / F.col("weight")


def _key(time: Column, copy: Column) -> Column:
    """What the common order sorts by; missing ids come first."""
    doc_id = F.coalesce(F.col("doc_id").cast("long"), F.lit(-1).cast("long"))
    return F.struct(time.alias("time"), F.col("digest").alias("digest"), doc_id.alias("doc_id"), copy.alias("copy"))


def _cut(copies: DataFrame, budget: float, level: float) -> tuple | None:
    """The key of the copy where the budget ends, and whether it is still in; None if all are.

    A copy (``key``, ``size``) is in if its middle in the common order is within the budget.
    """
    low, high, sent, inside, time = 0.0, 2.0 * level, 0, copies, F.col("key.time")
    for _ in range(STEPS):
        if not low < high:
            break
        number = F.least(F.floor((time - low) / ((high - low) / INTERVALS)), F.lit(INTERVALS))
        sums = inside.groupBy(number.alias("number")).agg(F.sum("size").alias("words"), F.min(time).alias("low"), F.max(time).alias("high"))
        running = F.sum("words").over(Window.orderBy("number").rowsBetween(Window.unboundedPreceding, 0))
        found = sums.withColumn("upto", running + sent).where(F.col("upto") > budget).orderBy("number").limit(1).collect()
        if not found:
            return None
        low, high, sent = found[0]["low"], found[0]["high"], found[0]["upto"] - found[0]["words"]
        inside = inside.where(time.between(low, high))
    upto = F.sum("size").over(Window.orderBy("key").rowsBetween(Window.unboundedPreceding, 0)) + sent
    placed = inside.select("key", (upto - F.col("size") / 2.0 <= budget).alias("held"))
    last = placed.orderBy(F.col("held").desc(), F.when(F.col("held"), F.col("key")).desc(), "key").limit(1).collect()
    return tuple(last[0]["key"]), last[0]["held"]


def mix_sources(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, repeats: int = 2) -> DataFrame:
    """How many words of each document the mix takes: ``doc_id``, ``size``, ``source_size``,
    ``target``, ``copies`` and ``taken``.

    Whole copies are taken, so ``taken`` is 0 to ``repeats`` times the size, and a source misses
    its target by about half a document at most. Documents without words are taken 0 times. Equal rows
    are queued one after the other. The order depends on the rows alone, so reruns agree. An empty
    table gives an empty result.
    """
    sized = stored(_sized(docs), "sized")
    targets = stored(source_targets(sized, weights, share, repeats), "targets")
    queued = stored(_queued(sized, targets), "queued")
    whole = targets.agg(F.max("budget"), F.max("level")).collect()[0]
    if whole[1]:
        each = F.explode(F.array(*[_key(virtual_time(c), F.lit(c)) for c in range(repeats)]))
        end = _cut(queued.where("size > 0").select("size", each.alias("key")), whole[0], whole[1])
    else:
        end = None

    def taken(copy: int) -> Column:
        if end is None:
            return F.lit(1)
        key = _key(virtual_time(copy), F.lit(copy))
        limit = F.struct(*[F.lit(v).cast(kind) for v, kind in zip(end[0], KEY, strict=True)])
        return F.when(key <= limit if end[1] else key < limit, 1).otherwise(0)

    copies = F.when(F.col("size") > 0, sum((taken(c) for c in range(repeats)), F.lit(0))).otherwise(0)
    found = queued.select("doc_id", "size", "source_size", "target", copies.cast("int").alias("copies"))
    return found.withColumn("taken", F.col("size") * F.col("copies"))


def stage(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, repeats: int = 2) -> DataFrame:
    """The mix as rows: each document as often as it is taken, with all its columns.

    Rows of equal id and size share their copies evenly.
    """
    same = ["id", "words"]
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id")
    taken = mix_sources(docs, weights, share, repeats).where("copies > 0")
    taken = taken.groupBy(key, F.col("size").alias("words")).agg(F.sum("copies").alias("copies"))
    rows = carried(docs).withColumn("doc_id", F.col("whole.doc_id"))
    named = rows.select("whole", key, word_count(whole_text("whole.text")).alias("words"))
    group = Window.partitionBy(*same)
    numbered = named.join(taken, same).select(
        "whole", "copies", F.count("*").over(group).alias("many"), F.row_number().over(group.orderBy("id")).alias("nth")
    )
    part = F.floor((F.col("copies") + F.col("many") - F.col("nth")) / F.col("many")).cast("int")
    repeated = numbered.withColumn("part", part).where("part > 0")
    return repeated.select("whole", F.explode(F.sequence(F.lit(1), F.col("part")))).select("whole.*")
