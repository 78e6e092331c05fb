"""What the operators share: words, row identity, merging of partial results."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored

#: White space of all contracts: space, tab, line feed, vertical tab, form feed, return.
SPACES = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD = r"[^\x20\x09-\x0D]+"


def whole_text(name: str = "text") -> Column:
    """The text; a missing one is empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def carried(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` inside one column ``whole``, so that none clashes with what a stage adds."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def identified(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``row`` and ``text`` alone, so that no other column can clash.

    (doc_id, row) names a row by what it holds: equal rows share it, and they get equal
    results, so a repeated doc_id never mixes up two texts.
    """
    text = whole_text()
    return docs.select("doc_id", F.xxhash64(text).alias("row"), text.alias("text"))


def id_digest(name: str = "doc_id") -> Column:
    """A uniform key of an id that any engine can compute; missing ids count as empty text."""
    return F.md5(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary"))


def combined(parts: DataFrame, merge: Callable[[list[dict]], dict], fan_in: int = 16) -> dict | None:
    """All rows of ``parts`` merged into one; None if there are none.

    ``parts`` holds one bounded row per partition, numbered by ``slot`` (from ``spark_partition_id()``);
    ``merge`` makes one row of several, which come in order of their slots. Rows are merged by
    ``fan_in`` in tasks, level by level, so that neither a task nor the driver meets more at once.
    """
    schema, names = parts.schema, parts.columns

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda row: row["slot"])
        one = rows[0] if len(rows) == 1 else merge(rows) | {"slot": rows[0]["slot"]}
        return pa.Table.from_pylist([one | {"slot": one["slot"] // fan_in}], schema=table.select(names).schema)

    parts = stored(parts, "parts")
    slots = parts.agg(F.max("slot")).first()[0]
    slots = 0 if slots is None else slots + 1
    while slots > 1:
        group = F.expr(f"slot div {fan_in}").alias("_group")
        parts = parts.groupBy(group).applyInArrow(run, schema)
        slots = -(-slots // fan_in)
    row = parts.first()
    return row.asDict() if row else None
