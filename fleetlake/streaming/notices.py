"""Notices over a stream: each once, whatever batches its events come in."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from .results import BATCH, _delete, _folders

Deliver = Callable[[Sequence[Row]], None]
NOTICE = "EventName string, DeviceID string, t timestamp, subject string, body string, dedupe_id string"


def _names(schema: str) -> list[str]:
    return [field.split(" ")[0] for field in schema.split(", ")]


class NoticeLedger:
    """The notices a stream has sent, in a folder of its own: one for each value of ``once``.

    ``once`` is ``EventName`` for one notice per configured event over the whole life of the stream
    (the folder), or ``dedupe_id`` for one per event. A batch's notices are written down before they
    are delivered, and marked afterwards: a repeated batch delivers again only what was not marked, and
    other batches never do. So a notice can only come twice if delivery itself ended and its mark
    did not; its ``dedupe_id`` is then the same.
    """

    def __init__(self, folder: str, once: str = "EventName"):
        self.folder, self.once = folder.rstrip("/"), once

    def sent(self, spark: SparkSession) -> DataFrame:
        """All notices so far, with the batch that sent them."""
        schema = f"{NOTICE}, {BATCH} int"
        try:
            return spark.read.schema(schema).options(basePath=self.folder).parquet(f"{self.folder}/{BATCH}=*")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return spark.createDataFrame([], schema)

    def deliver_new(self, notices: DataFrame, batch_id: int, deliver: Deliver) -> int:
        """Deliver the notices that no other batch has sent; returns their number.

        ``notices`` has a row per ``once`` at most; for event names that is as many as are configured.
        """
        spark = notices.sparkSession
        own, mark = f"{self.folder}/{BATCH}={batch_id}", f"{self.folder}/_delivered/{batch_id}"
        if _folders(spark, mark):
            return 0
        others = self.sent(spark).where(F.col(BATCH) != batch_id).select(self.once).distinct()
        notices = notices.join(others, self.once, "left_anti")
        # Written first: what is delivered is what is read back.
        new = notices.dropDuplicates([self.once]).select(*_names(NOTICE)).collect()
        if not new:
            # What a failed attempt of this batch may have left.
            _delete(spark, own)
            return 0
        spark.createDataFrame(new, NOTICE).coalesce(1).write.mode("overwrite").parquet(own)
        deliver(new)
        path = spark._jvm.org.apache.hadoop.fs.Path(mark)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path).close()
        return len(new)


def stream_notices(starts: DataFrame, late: str = "1 hour", t: str = "t") -> DataFrame:
    """A stream of notices with each ``dedupe_id`` once: repeats within the delay are dropped by keyed state."""
    return starts.withWatermark(t, late).dropDuplicatesWithinWatermark(["dedupe_id"])
