"""New files in, derived messages and events out, whatever order and batches files arrive in."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.paths import lake_parts, plain_path
from ..operators.chunks import DEFAULT_CHUNK
from ..operators.custom import CustomContext
from ..plans.custom_messages import custom_messages
from ..plans.event_table import event_table, first_notifications
from ..schema import SERIES_KEYS
from ..sources.configs import EVENT_DEFAULTS
from ..sources.lake import Lake, Near, _union, normalise, write_partitioned
from .notices import NoticeLedger
from .publishing import DECODED, DERIVED, EVENTS, Publication
from .results import BATCH, compact, latest, write_note

__all__ = ["BATCH", "Incremental", "drain", "latest", "run_incremental", "run_whole_files", "stream_files", "stream_lake", "stream_names", "with_derived"]

Deliver = Callable[[Sequence[Row]], None]


def stream_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    glob: str | None = None,
    files_per_batch: int = 1000,
) -> DataFrame:
    """New Parquet files below ``path`` as a stream; the checkpoint remembers seen files."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def stream_lake(
    spark: SparkSession, root: str, schema: T.StructType, files_per_batch: int = 1000
) -> DataFrame:
    """The same for a path-layout lake, with the path parts as columns.

    ``schema`` lists ``t`` and the signals. Every stored file comes whole, but the messages of one
    log file are stored files of their own and may come in different batches: this suits rules that
    look at one message. ``run_whole_files`` is for rules over several.
    """
    rows = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("recursiveFileLookup", True)
        .parquet(root)
    )
    parts = lake_parts(plain_path(F.col("_metadata.file_path")))
    return normalise(rows.select("*", *(c.alias(n) for n, c in parts.items())))


def drain(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, **options
) -> StreamingQuery:
    """Process everything that is there now, batch by batch, and wait for the end."""
    query = (
        stream.writeStream.options(**options)
        .foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


@dataclass(frozen=True)
class Incremental:
    """What one run derives from each batch of files, and where it goes.

    Writes are keyed by the batch number and replace what a failed attempt of the same batch
    left behind, so that a repeated batch changes nothing. With a ``publication``, the batch's own rows,
    derived messages and events all go there in one step, in place of the two roots.
    """

    custom: Sequence[Mapping] = ()
    general: Mapping | None = None
    events: Sequence[Mapping] = ()
    messages_root: str | None = None
    events_root: str | None = None
    context: CustomContext | None = None
    width: int | str = DEFAULT_CHUNK
    final: Callable[[DataFrame], DataFrame] | None = None
    deliver: Deliver | None = None
    #: After so many batches, ``run_whole_files`` folds older results into base files; 0 for never.
    compact_every: int = 0
    publication: Publication | None = None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        """Process a batch of rows on its own: for rules that need no rows of other batches."""
        # Every rule reads the batch again; its size is bounded by the files per batch.
        batch = batch.persist()
        try:
            if not batch.isEmpty():
                self.process(batch.sparkSession, Lake.of_frame(batch), batch_id)
        finally:
            batch.unpersist()

    def _store(self, df: DataFrame, root: str, partition: Sequence[str], batch_id: int) -> DataFrame:
        """Write the rows of this batch and hand back what was written, without listing other batches."""
        rows = df.withColumn(BATCH, F.lit(batch_id))
        write_partitioned(rows, root, [*partition, BATCH])
        own = f"{root.rstrip('/')}/" + "/".join(f"{c}=*" for c in partition) + f"/{BATCH}={batch_id}"
        try:
            stored = df.sparkSession.read.schema(rows.schema).options(basePath=root).parquet(own)
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return df.limit(0)
        return stored.drop(BATCH)

    def process(self, spark: SparkSession, lake: Lake, batch_id: int) -> None:
        """Derive and store everything for the rows of ``lake`` under the number of the batch."""
        derived = custom_messages(lake, self.custom, self.context)
        if self.final:
            derived = {name: self.final(df) for name, df in derived.items()}
        if self.publication:
            self._publish(spark, lake, derived, batch_id)
            return
        if self.messages_root:
            for name, df in derived.items():
                stored = self._store(
                    df.withColumn("message", F.lit(name)),
                    self.messages_root,
                    ["device", "message", "date"],
                    batch_id,
                )
                derived[name] = stored.where(F.col("message") == name).drop("message")
        if not self.events_root or not self.events:
            return
        # Events may be triggered by derived messages, which is why these come first.
        found = event_table(
            spark, with_derived(lake, derived), self.general or EVENT_DEFAULTS, self.events, self.width
        )
        self._notify(self._store(found, self.events_root, ["date"], batch_id), self.events_root, batch_id)

    def _notify(self, events: DataFrame, root: str, batch_id: int) -> None:
        if self.deliver:
            body = (self.general or {}).get("static_body_content", "")
            ledger = NoticeLedger(f"{root.rstrip('/')}/_notices")
            ledger.deliver_new(first_notifications(events, body), batch_id, self.deliver)

    def _publish(self, spark: SparkSession, lake: Lake, derived: Mapping[str, DataFrame], batch_id: int) -> None:
        """Everything of the batch in one step; notices go out once it is published."""
        # Both written and looked at for events.
        derived = {name: df.persist() for name, df in derived.items()}
        try:
            parts = {DECODED: lake.messages(lake.names())}
            if derived:
                parts[DERIVED] = _union([df.withColumn("message", F.lit(name)) for name, df in derived.items()])
            if self.events:
                parts[EVENTS] = event_table(
                    spark, with_derived(lake, derived), self.general or EVENT_DEFAULTS, self.events, self.width
                )
            self.publication.publish({kind: df for kind, df in parts.items() if df is not None}, batch_id)
        finally:
            for df in derived.values():
                df.unpersist()
        found = self.publication.rows(spark, EVENTS, batch_id) if self.deliver else None
        if found is not None:
            self._notify(found.drop(BATCH), self.publication.root, batch_id)


def with_derived(lake: Lake, derived: Mapping[str, DataFrame]) -> Lake:
    """The lake as it looks after the derived messages were written to it."""

    def rows(names: Sequence[str], near: Near | None) -> DataFrame | None:
        frames = [
            derived[n].withColumn("message", F.lit(n)) for n in names if n in derived
        ]
        base = [n for n in names if n not in derived]
        found = lake.messages(base, near) if base else None
        frames = ([found] if found is not None else []) + frames
        if not frames:
            return None
        merged = frames[0]
        for frame in frames[1:]:
            merged = merged.unionByName(frame, allowMissingColumns=True)
        return merged

    return Lake(rows, lambda: sorted({*lake.names(), *derived}))


def run_incremental(stream: DataFrame, job: Incremental, checkpoint: str) -> StreamingQuery:
    return drain(stream, job, checkpoint)


def stream_names(spark: SparkSession, root: str, files_per_batch: int = 1000) -> DataFrame:
    """The path parts of new files of a path-layout lake; contents are not read."""
    paths = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(root)
    )
    return paths.select(*(c.alias(n) for n, c in lake_parts(F.col("path")).items()))


def run_whole_files(
    spark: SparkSession, root: str, job: Incremental, checkpoint: str, files_per_batch: int = 1000
) -> StreamingQuery:
    """Run ``job`` over a path-layout lake, log file by log file.

    The stored files of a log file, one per message, may come in any batches. So a batch only says
    which log files it touches; each of these is processed again as the lake has it now, with all its
    messages. Results are kept per batch with a note of the log files it touched, and
    ``latest`` reads each log file's newest result. What a batch holds is therefore a matter of
    load alone: after the last one the results are those of one run over the whole lake. As a log file may
    be processed several times, its rows can't be published by batch.
    """
    if job.publication:
        raise ValueError("log files that are processed again can't be published by batch")
    everything = Lake.of_path_layout(spark, root)
    units = {job.messages_root: ["device", "message", "date"], job.events_root: ["date"]}
    units.pop(None, None)

    def handle(batch: DataFrame, batch_id: int) -> None:
        # No more rows than files per batch.
        touched = spark.createDataFrame(batch.select(*SERIES_KEYS).distinct().collect(), "device string, date date, file_name string")
        rows = touched.collect()
        if not rows:
            return
        if job.compact_every and batch_id % job.compact_every == 0:
            # All batches before this one have ended.
            for place, unit in units.items():
                compact(spark, place, unit, batch_id - 1)
        near_by = Lake.of_path_layout(spark, root, sorted({r.device for r in rows}), sorted({r.date for r in rows}))

        def of_touched(names: Sequence[str], near: Near | None) -> DataFrame | None:
            found = near_by.messages(names, near)
            return None if found is None else found.join(F.broadcast(touched), list(SERIES_KEYS), "left_semi")

        job.process(spark, Lake(of_touched, everything.names), batch_id)
        for place in units:
            write_note(touched, place, batch_id)

    return drain(stream_names(spark, root, files_per_batch), handle, checkpoint)
