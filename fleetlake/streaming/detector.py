"""Edge detection that carries on from one batch of rows to the next."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.chunks import DEFAULT_CHUNK
from ..operators.edges import detect_edges, edge_memory, merge_memory
from .incremental import BATCH, drain


class EdgeDetector:
    """A ``foreachBatch`` handler that detects edges of endless series.

    What a series must remember is one small row (times of the latest and first occurrences of
    each flag). It is kept as a table in the shared folder, in its last two versions; each batch
    runs the batch detector on top of the previous version. No series is pinned to one task,
    and a repeated batch reads the same memory and rewrites the same results.

    Rows of a series must arrive in time order from batch to batch.
    """

    def __init__(
        self,
        folder: str,
        signal: str,
        lower: float,
        upper: float,
        exact: bool = False,
        rising_as_start: bool = True,
        keys: Sequence[str] = ("device", "message"),
        t: str = "t",
        width: int | str = DEFAULT_CHUNK,
    ):
        self.folder = folder.rstrip("/")
        self.signal, self.thresholds, self.rising_as_start = signal, (lower, upper, exact), rising_as_start
        self.keys, self.t, self.width = list(keys), t, width

    def _memory_path(self, batch_id: int) -> str:
        return f"{self.folder}/memory/{BATCH}={batch_id}"

    def _memory(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        return None if batch_id < 0 else spark.read.parquet(self._memory_path(batch_id))

    def _forget(self, spark: SparkSession, batch_id: int) -> None:
        path = spark._jvm.org.apache.hadoop.fs.Path(self._memory_path(batch_id))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        memory = self._memory(batch.sparkSession, batch_id - 1)
        edges = detect_edges(
            batch,
            self.signal,
            *self.thresholds,
            rising_as_start=self.rising_as_start,
            keys=self.keys,
            t=self.t,
            width=self.width,
            memory=memory,
        )
        edges.write.mode("overwrite").parquet(f"{self.folder}/edges/{BATCH}={batch_id}")
        fresh = edge_memory(batch, self.signal, *self.thresholds, keys=self.keys, t=self.t)
        merged = fresh if memory is None else merge_memory(memory.unionByName(fresh), self.keys)
        merged.write.mode("overwrite").parquet(self._memory_path(batch_id))
        # A repeated batch needs the version before its own; older ones are of no use.
        self._forget(batch.sparkSession, batch_id - 2)

    def edges(self, spark: SparkSession) -> DataFrame:
        """All edges found so far."""
        return spark.read.parquet(f"{self.folder}/edges").drop(BATCH)

    def run(self, stream: DataFrame, checkpoint: str) -> DataFrame:
        drain(stream, self, checkpoint)
        return self.edges(stream.sparkSession)
