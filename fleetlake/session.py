"""Session helpers: recommended settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the benchmark; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("fleetlake")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def use_utc(spark: SparkSession) -> SparkSession:
    """Zone-less log times are UTC, so sessions must compute in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def _shared_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A local folder is created only for local masters, where driver and executors
    share one disk; on a cluster a missing setting is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    in_use = spark.sparkContext.getCheckpointDir()
    if in_use:
        return in_use
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="fleetlake-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def work_folder(spark: SparkSession, label: str) -> str:
    """A fresh, not yet existing folder below the shared root."""
    return f"{_shared_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    It is computed once for all its uses, survives lost executors, and Spark plans with its
    real size: small tables get broadcast, large ones do not.
    """
    folder = work_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
