"""The trip summary over a stream of stored files: only the device-days that new files touch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.trip_summary import trip_summary
from ..schema import DAY_KEYS
from ..session import stored
from ..sources.configs import TripConfig
from ..sources.lake import Lake, Near, write_partitioned
from .incremental import drain, stream_names
from .results import BATCH, _delete

#: Which device-days a batch has computed anew; below the root of the summary.
LEDGER = "_computed"
_UNIT = ["date", "device"]


def run_trip_summary(
    spark: SparkSession, root: str, out: str, config: TripConfig, checkpoint: str, files_per_batch: int = 1000
) -> StreamingQuery:
    """Keep the trip summary of a path-layout lake up to date.

    A batch of new files says which device-days it touches; trips never leave a device-day, so each of
    these is computed again from all its files as the lake has them now, and replaces its own folder
    ``date=/device=`` of the summary. All others stay as they are. A device-day that has no rows any more
    loses its folder. Days outside the configured period are not looked at. A repeated batch does the
    same again; ``read_ledger`` tells what each batch has computed.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        within = batch.where(F.col("date").between(F.lit(config.start), F.lit(config.end)))
        # No more rows than files per batch.
        rows = within.select(*DAY_KEYS).distinct().collect()
        if not rows:
            return
        touched = spark.createDataFrame(rows, "device string, date date")
        days = Lake.of_path_layout(spark, root, sorted({r.device for r in rows}), sorted({r.date for r in rows}))

        def of_touched(names: Sequence[str], near: Near | None) -> DataFrame | None:
            found = days.messages(names, near)
            return None if found is None else found.join(F.broadcast(touched), list(DAY_KEYS), "left_semi")

        summary = trip_summary(spark, Lake(of_touched, days.names), config)
        fresh = stored(summary.withColumn("device", F.col("DeviceID")), "touched-days")
        write_partitioned(fresh, out, _UNIT)
        for row in touched.join(fresh.select(*DAY_KEYS).distinct(), list(DAY_KEYS), "left_anti").collect():
            _delete(spark, f"{out.rstrip('/')}/date={row.date}/device={row.device}")
        touched.withColumn(BATCH, F.lit(batch_id)).coalesce(1).write.mode("overwrite").parquet(f"{out.rstrip('/')}/{LEDGER}/{batch_id}")

    return drain(stream_names(spark, root, files_per_batch), handle, checkpoint)


def read_summary(spark: SparkSession, out: str) -> DataFrame:
    """The summary with its folder ``date``."""
    return spark.read.options(basePath=out).parquet(f"{out.rstrip('/')}/date=*").drop("device").withColumn("date", F.col("date").cast("date"))


def read_ledger(spark: SparkSession, out: str) -> DataFrame:
    """``device``, ``date`` and ``batch_id`` of everything computed so far."""
    return spark.read.parquet(f"{out.rstrip('/')}/{LEDGER}/*")
