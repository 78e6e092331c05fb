"""Line dedup without moving texts: hashed lines are compared, run-length keep bitmaps come back.

Lines are reduced to (hash, document, position). These slim rows are range-partitioned by hash
and sorted by document and position, so each document's first occurrence of a line is streamed
off the sorted rows. A slice of the document id is part of the range key: a line in a third of all
documents is spread over ``SLICES`` ranges, and its holders are counted by partial aggregates.
Only DataFrame functions run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .common import SPACES, UPPER, carried, identified, whole_text

#: Ranges over which the holders of one line are spread.
SLICES = 1024


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_hashes(rows: DataFrame, min_chars: int) -> DataFrame:
    """A row for each line of at least ``min_chars``: 128-bit ``hash`` of its key, and its place."""
    lines = rows.where(F.col("doc_id").isNotNull()).select(
        "doc_id", "row", F.posexplode(_lines(F.col("text"))).alias("pos", "line")
    )
    trimmed = lines.withColumn("line", F.btrim("line", F.lit(SPACES))).where(F.length("line") >= min_chars)
    key = F.translate("line", UPPER, UPPER.lower()).cast("binary")
    return trimmed.select(
        F.substring(F.unhex(F.sha2(key, 256)), 1, 16).alias("hash"),
        F.pmod(F.xxhash64("doc_id"), F.lit(SLICES)).cast("int").alias("slice"),
        "doc_id",
        "row",
        "pos",
    )


def keep_bitmaps(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """Which lines stay, for each document that loses some.

    A line's key is the line without white space at its ends, A-Z lower-cased. Keys of
    ``min_chars`` code points or more that ``min_docs`` documents or more hold stay in the
    largest doc_id only, there with all their lines. Returns ``doc_id``, ``row`` (see
    ``identified``) and ``dropped``, the sorted positions whose bits are 0. Documents that lose
    nothing have no row: their bitmap is one run. Rows without doc_id hold nothing and lose nothing.
    """
    lines = stored(line_hashes(identified(docs), min_chars), "lines")
    ranged = lines.repartitionByRange("hash", "slice").sortWithinPartitions("hash", "slice", "doc_id", "pos")
    place = Window.partitionBy("hash", "slice", "doc_id").orderBy("pos")
    firsts = ranged.withColumn("nth", F.row_number().over(place)).where("nth = 1")
    holders = firsts.groupBy("hash").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last_doc"))
    # Stored, so that Spark knows its size, and can split the lines of a hot hash in the join.
    repeated = stored(holders.where(F.col("n_docs") >= min_docs).select("hash", "last_doc"), "repeated")
    lost = lines.join(repeated, "hash").where(F.col("doc_id") != F.col("last_doc"))
    return lost.groupBy("doc_id", "row").agg(F.sort_array(F.collect_set("pos")).alias("dropped"))


def keep_runs(dropped: Column, n_lines: Column) -> Column:
    """The keep bitmap as runs (start, length) of lines that stay, from the positions that go."""
    before = F.concat(F.array(F.lit(-1)), dropped)
    after = F.concat(dropped, F.array(n_lines))
    runs = F.zip_with(before, after, lambda a, b: F.struct((a + 1).alias("start"), (b - a - 1).alias("length")))
    return F.filter(runs, lambda r: r["length"] > 0)


def kept_text(text: Column, runs: Column) -> Column:
    """The lines of the runs, joined; cut from the split text in one pass."""
    lines = _lines(text)
    return F.array_join(F.flatten(F.transform(runs, lambda r: F.slice(lines, r["start"] + 1, r["length"]))), "\n")


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """Every document with its bitmap applied: ``doc_id``, ``text``, ``n_lines``, ``n_dropped``,
    ``keep_runs`` and ``row``.

    A missing or empty text is one empty line, which stays. Equal rows get equal results. An empty
    table gives an empty result. Other columns of ``docs`` are not read.
    """
    bitmaps = keep_bitmaps(docs, min_chars, min_docs)
    joined = identified(docs).join(bitmaps.hint("shuffle_hash"), ["doc_id", "row"], "left")
    n_lines = F.size(_lines(F.col("text")))
    counted = joined.withColumn("n_lines", n_lines).withColumn(
        "keep_runs", F.when(F.col("dropped").isNotNull(), keep_runs(F.col("dropped"), F.col("n_lines")))
    )
    return counted.select(
        "doc_id",
        F.when(F.col("keep_runs").isNull(), F.col("text")).otherwise(kept_text(F.col("text"), F.col("keep_runs"))).alias("text"),
        F.col("n_lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.coalesce("keep_runs", F.array(F.struct(F.lit(0).alias("start"), F.col("n_lines").alias("length")))).alias("keep_runs"),
        "row",
    )


def stage(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """``docs`` with all its columns, texts reduced to the lines that stay.

    Missing texts stay missing. A column ``n_chars`` is counted anew.
    """
    bitmaps = keep_bitmaps(docs, min_chars, min_docs)
    old = F.col("whole.text")
    rows = carried(docs).select("whole", F.col("whole.doc_id").alias("doc_id"), F.xxhash64(whole_text("whole.text")).alias("row"))
    joined = rows.join(bitmaps.hint("shuffle_hash"), ["doc_id", "row"], "left")
    runs = keep_runs(F.col("dropped"), F.size(_lines(old)))
    text = F.when(F.col("dropped").isNull(), old).otherwise(kept_text(old, runs))
    new = {"text": text}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length(F.coalesce(text, F.lit(""))).cast(docs.schema["n_chars"].dataType)
    return joined.select(*[new.get(c, F.col(f"whole.`{c}`")).alias(c) for c in docs.columns])
