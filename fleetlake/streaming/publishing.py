"""Publishing a batch in one step: decoded, derived and event rows together, or none of them."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.lake import PublishedNothing, _folders, write_counted
from .results import BATCH, _below, _delete, _numbers

#: What a batch publishes, and the folders of each kind below that of the batch.
DECODED, DERIVED, EVENTS = "decoded", "derived", "events"
KINDS: Mapping[str, Sequence[str]] = {
    DECODED: ["device", "message", "date"],
    DERIVED: ["device", "message", "date"],
    EVENTS: ["date"],
}
#: Below the root: a note for each published batch, with the rows of each kind.
PUBLISHED = "_published"
_NOTE = f"kind string, rows long, columns string, {BATCH} int"

#: Given the kind and its rows, the rows to publish.
Hook = Callable[[str, DataFrame], DataFrame]


class Publication:
    """The output of a stream: a folder for each kind of rows, and a note for each published batch.

    ``hook`` sees the rows of every kind last, once events were found in them, and returns what is
    published. A batch counts once its note is there, which is written after all its rows: readers see
    the whole batch or nothing of it. A batch that fails on the way leaves no note, and its next attempt
    replaces what it wrote; a batch that has its note is not written again.
    """

    def __init__(self, root: str, hook: Hook | None = None):
        self.root, self.hook = root.rstrip("/"), hook

    def publish(self, parts: Mapping[str, DataFrame], batch_id: int) -> dict[str, int]:
        """Write the rows of each kind and return their numbers, counted while writing.

        No rows of any kind is an error (``PublishedNothing``), and so is a kind that isn't in ``KINDS``.
        """
        unknown = sorted(set(parts) - set(KINDS))
        if unknown:
            raise ValueError(f"unknown kinds of rows: {unknown}")
        if not parts:
            raise PublishedNothing(f"batch {batch_id} has nothing to publish to {self.root}")
        spark = next(iter(parts.values())).sparkSession
        if _folders(spark, _below(self.root, PUBLISHED, batch_id, "_SUCCESS")):
            return {r.kind: r.rows for r in self.counts(spark).where(F.col(BATCH) == batch_id).collect()}
        note = []
        for kind, df in parts.items():
            _delete(spark, _below(self.root, kind, f"{BATCH}={batch_id}"))
            rows = (self.hook(kind, df) if self.hook else df).withColumn(BATCH, F.lit(batch_id))
            written = write_counted(rows, _below(self.root, kind), [BATCH, *KINDS[kind]])
            # With its columns in the note, no reader has to look for them in the files.
            note.append((kind, written, rows.schema.json(), batch_id))
        if not any(written for _, written, *_ in note):
            raise PublishedNothing(f"batch {batch_id} has no rows to publish to {self.root}")
        spark.createDataFrame(note, _NOTE).coalesce(1).write.mode("overwrite").parquet(_below(self.root, PUBLISHED, batch_id))
        return {kind: written for kind, written, *_ in note}

    def _notes(self, spark: SparkSession) -> DataFrame:
        notes = [_below(self.root, PUBLISHED, n) for n in _numbers(spark, self.root, PUBLISHED)]
        return spark.read.schema(_NOTE).parquet(*notes) if notes else spark.createDataFrame([], _NOTE)

    def counts(self, spark: SparkSession) -> DataFrame:
        """``kind``, ``rows`` and ``batch_id`` of all published batches."""
        return self._notes(spark).drop("columns")

    def rows(self, spark: SparkSession, kind: str, batch_id: int | None = None) -> DataFrame | None:
        """The rows of a kind with their ``batch_id``, of all published batches or one; None if there are none at all.

        Columns that a batch lacks are null there; where batches disagree on a type, the newest one's counts.
        """
        notes = self._notes(spark).where((F.col("kind") == kind) & (F.col("rows") > 0))
        if batch_id is not None:
            notes = notes.where(F.col(BATCH) == batch_id)
        # A number and a list of columns per batch.
        found = notes.orderBy(F.desc(BATCH)).select(BATCH, "columns").collect()
        if not found:
            return None
        fields: dict[str, T.StructField] = {}
        for columns in dict.fromkeys(r.columns for r in found):
            for field in T.StructType.fromJson(json.loads(columns)):
                fields.setdefault(field.name, T.StructField(field.name, field.dataType))
        root = _below(self.root, kind)
        folders = [_below(root, f"{BATCH}={r[BATCH]}") for r in found]
        return spark.read.schema(T.StructType(list(fields.values()))).options(basePath=root).parquet(*folders)
