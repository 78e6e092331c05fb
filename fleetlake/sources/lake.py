"""The message lake: reading it with pruning, and writing derived tables to it."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from functools import reduce
from typing import Any
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.paths import lake_parts, plain_path, stored_name
from ..schema import PATH_COLUMNS


def normalise(df: DataFrame, t: str = "t") -> DataFrame:
    """Times as ``TIMESTAMP`` and NaN as null, so that both engines' missing values agree."""
    types = dict(df.dtypes)
    columns = []
    for name in df.columns:
        c = F.col(f"`{name}`")
        if name == t:
            c = c.cast("timestamp").alias(name)
        elif types[name] in ("double", "float"):
            c = F.when(~F.isnan(c), c).alias(name)
        columns.append(c)
    return df.select(*columns)


def _alternatives(values: Sequence[str] | None, anything: str = "*") -> str:
    return anything if values is None else "{" + ",".join(values) + "}"


def _path_not_found(error: Exception) -> bool:
    return "PATH_NOT_FOUND" in str(error)


#: A condition on stored columns, given their names; None if all rows are wanted.
Near = Callable[[Sequence[str]], Column | None]


def _only(rows: DataFrame, near: Near | None) -> DataFrame:
    """The rows that ``near`` lets through. It sees the stored columns, so the scan can use it."""
    condition = near(rows.columns) if near else None
    return rows if condition is None else rows.where(condition)


_PATH_ONLY = T.StructType(
    [T.StructField("t", T.TimestampType())]
    + [T.StructField(c, T.DateType() if c == "date" else T.StringType()) for c in PATH_COLUMNS]
)


def _path_globs(root: str, messages, devices, dates) -> str:
    days = None if dates is None else [d.strftime("%Y/%m/%d") for d in dates]
    return "/".join([root.rstrip("/"), _alternatives(devices), _alternatives(messages), _alternatives(days, "*/*/*")])


def read_path_layout(
    spark: SparkSession,
    root: str,
    messages: Sequence[str] | None = None,
    devices: Sequence[str] | None = None,
    dates: Sequence[date] | None = None,
    t: str = "t",
    drift: bool = True,
    near: Near | None = None,
) -> DataFrame:
    """A lake laid out as ``device/message/yyyy/mm/dd/file.parquet``.

    The path parts become columns. Wanted devices, messages and days select the folders that
    are listed and read at all, which is partition pruning for a layout without ``k=v`` names.
    The schema is that of all files together: signals that only some files have are null
    elsewhere. Without ``drift`` one file's schema stands for all, which spares looking into the
    others; that is for lakes whose files are known to be alike.
    """
    try:
        rows = spark.read.option("mergeSchema", drift).parquet(_path_globs(root, messages, devices, dates) + "/*.parquet")
    except AnalysisException as error:
        if not _path_not_found(error):
            raise
        return spark.createDataFrame([], _PATH_ONLY)
    parts = lake_parts(plain_path(F.col("_metadata.file_path")))
    return normalise(_only(rows, near).select("*", *(c.alias(n) for n, c in parts.items())), t)


def read_lake(
    spark: SparkSession,
    root: str,
    message: str | None = None,
    t: str = "t",
    drift: bool = True,
    schema: T.StructType | None = None,
    near: Near | None = None,
) -> DataFrame | None:
    """A lake written by ``write_message``: folders by device, message and date.

    With ``message``, only that message's folders are listed and the schema is its own; None
    if there are none. Filters on the folder columns prune (``PartitionFilters``), all others
    reach the files. ``drift`` as in ``read_path_layout``; a known ``schema`` (with the folder
    columns) spares looking into any file.
    """
    root = root.rstrip("/")
    path = root if message is None else f"{root}/device=*/message={message}"
    try:
        if schema is not None:
            return normalise(_only(spark.read.schema(schema).options(basePath=root).parquet(path), near), t)
        found = spark.read.options(mergeSchema=drift, basePath=root).parquet(path).schema
    except AnalysisException as error:
        if not _path_not_found(error):
            raise
        return None
    # Folder values such as 00000001 are text, whatever inference makes of them.
    folder_types = {"device": T.StringType(), "message": T.StringType(), "date": T.DateType()}
    schema = T.StructType([T.StructField(f.name, folder_types.get(f.name, f.dataType)) for f in found])
    return normalise(_only(spark.read.schema(schema).options(basePath=root).parquet(path), near), t)


def _folders(spark: SparkSession, glob: str) -> list[str]:
    """Names of what a glob matches: folders are looked at, never the files below."""
    path = spark._jvm.org.apache.hadoop.fs.Path(glob)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return [status.getPath().toString() for status in found or []]


def _union(frames: Sequence[DataFrame | None]) -> DataFrame | None:
    """Rows of all frames; columns that some lack are null there."""
    known = [f for f in frames if f is not None]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), known) if known else None


class Lake:
    """Messages by name, however they are stored."""

    def __init__(
        self,
        rows: Callable[[Sequence[str], Near | None], DataFrame | None],
        names: Callable[[], Sequence[str]],
    ):
        self._rows = rows
        self._names = names

    @classmethod
    def of_frame(cls, df: DataFrame) -> Lake:
        """One table with a ``message`` column; all messages share its signals."""

        def names() -> list[str]:
            # As many names as the catalog has messages, not as the lake has rows.
            return sorted(r[0] for r in df.select("message").distinct().collect())

        return cls(lambda wanted, near: _only(df, near).where(F.col("message").isin(list(wanted))), names)

    @classmethod
    def of_folder(cls, spark: SparkSession, root: str, drift: bool = True) -> Lake:
        """Message folders written by ``write_message``."""

        def names() -> list[str]:
            # As many names as the catalog has messages.
            found = _folders(spark, f"{root.rstrip('/')}/device=*/message=*")
            return sorted({f.rsplit("message=", 1)[1] for f in found})

        def rows(wanted: Sequence[str], near: Near | None) -> DataFrame | None:
            return _union([read_lake(spark, root, m, drift=drift, near=near) for m in wanted])

        return cls(rows, names)

    @classmethod
    def of_path_layout(
        cls,
        spark: SparkSession,
        root: str,
        devices: Sequence[str] | None = None,
        dates: Sequence[date] | None = None,
        drift: bool = True,
    ) -> Lake:
        """Files under ``device/message/yyyy/mm/dd``, limited to devices and days if given.

        Names and rows come from the same folders. Each message is read on its own, with the
        schema of its own files.
        """

        def names() -> list[str]:
            if dates is None:
                return sorted({f.rsplit("/", 1)[1] for f in _folders(spark, f"{root.rstrip('/')}/{_alternatives(devices)}/*")})
            return sorted({f.rsplit("/", 4)[1] for f in _folders(spark, _path_globs(root, None, devices, dates))})

        def one(message: str, near: Near | None) -> DataFrame | None:
            found = read_path_layout(spark, root, [message], devices, dates, drift=drift, near=near)
            return found if set(found.columns) - {"t", *PATH_COLUMNS} else None

        return cls(lambda wanted, near: _union([one(m, near) for m in wanted]), names)

    @classmethod
    def joined(cls, *lakes: Lake) -> Lake:
        """Several lakes as one, such as one of decoded and one of derived messages."""
        return cls(
            lambda wanted, near: _union([lake.messages(wanted, near) for lake in lakes]),
            lambda: sorted({n for lake in lakes for n in lake.names()}),
        )

    def names(self) -> list[str]:
        return list(self._names())

    def message(self, name: str, near: Near | None = None) -> DataFrame | None:
        return self._rows([name], near)

    def messages(self, names: Sequence[str], near: Near | None = None) -> DataFrame | None:
        """Rows of several messages; signals are meant to have the same names in all."""
        return self._rows(names, near) if names else None


def write_partitioned(df: DataFrame, root: str, partition: Sequence[str]) -> None:
    """Write below ``root``, replacing exactly the partitions that ``df`` has rows for.

    Rerunning a day therefore replaces the day; days without results keep what they had. Rows
    are rebalanced by partition: AQE lets one task write many small partitions, and splits a
    hot one over as many tasks as its size needs. Within each file rows are in time order, so
    that later scans can skip row groups by time.
    """
    times = [c for c in ("t", "TripStart") if c in df.columns]
    (
        df.hint("rebalance", *(F.col(c) for c in partition))
        .sortWithinPartitions(*partition, *times)
        .write.option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .partitionBy(*partition)
        .parquet(root)
    )


def write_message(df: DataFrame, root: str, message: str | None = None) -> None:
    """Store a derived message in the lake, under its own name and its source's file name."""
    named = df.withColumn("message", F.lit(message)) if message else df
    write_partitioned(named, root, ["device", "message", "date"])


#: Files moved at once; a move is a request to the store and no work for the driver.
MOVES_AT_ONCE = 16


class MoveFailed(RuntimeError):
    """Finished files that could not be moved to their places; they are still in the staging folder."""


def _move_all(spark: SparkSession, fs: Any, moves: Mapping[str, Any]) -> list[str]:
    """Move files to the places named; returns the places that were not reached."""
    path = spark._jvm.org.apache.hadoop.fs.Path

    def move(name: str) -> bool:
        target = path(name)
        try:
            fs.mkdirs(target.getParent())
            if fs.exists(target):
                fs.delete(target, False)
            return bool(fs.rename(moves[name], target))
        except (Py4JJavaError, PySparkException):
            return False

    with ThreadPoolExecutor(MOVES_AT_ONCE) as pool:
        return [name for name, moved in zip(moves, pool.map(move, moves), strict=True) if not moved]


def write_path_layout(df: DataFrame, root: str, message: str | None = None) -> int:
    """Store a message as ``device/message/yyyy/mm/dd/file``, one file per log file; returns their number.

    Replaces files of the same name; names are kept as they are, but for colons (``stored_name``). The rows are written by Spark into a
    folder of their own below ``root``, with one task per file, and each finished file is moved to its
    place, several at once. A log file that Spark wrote in several parts is an error, raised before any
    file is replaced. So is a file that can't be moved (``MoveFailed``): it stays in the staging folder,
    which the error names.
    """
    spark = df.sparkSession
    named = df.withColumn("message", F.lit(message)) if message else df
    keys = ["device", "message", "date", "file_name"]
    staging = f"{root.rstrip('/')}/_staging-{uuid.uuid4().hex}"
    ordered = named.repartition(*keys).sortWithinPartitions(*keys, *(c for c in ("t",) if c in df.columns))
    # No bound of the session on rows may cut a log file in parts.
    ordered.write.option("maxRecordsPerFile", 0).partitionBy(*keys).parquet(staging)
    folder = spark._jvm.org.apache.hadoop.fs.Path(staging)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files, moves = fs.listFiles(folder, True), {}
    while files.hasNext():
        source = files.next().getPath()
        # Folder names escape what can't be part of them.
        parts = {k: stored_name(unquote(v)) for k, v in (p.split("=", 1) for p in source.getParent().toString().split("/")[-4:] if "=" in p)}
        if len(parts) < 4:
            continue
        day = parts["date"].replace("-", "/")
        target = f"{root.rstrip('/')}/{parts['device']}/{parts['message']}/{day}/{parts['file_name']}"
        if target in moves:
            fs.delete(folder, True)
            raise RuntimeError(f"several part files for {target}")
        moves[target] = source
    left = _move_all(spark, fs, moves)
    if left:
        raise MoveFailed(f"{len(left)} of {len(moves)} files are still in {staging}, such as the one for {left[0]}")
    fs.delete(folder, True)
    return len(moves)


def write_events(events: DataFrame, root: str) -> None:
    """Store event rows by day; device, message, signal and event name are columns."""
    write_partitioned(events, root, ["date"])


def write_trip_summary(summary: DataFrame, root: str) -> None:
    """Store trip rows by (folder) day."""
    write_partitioned(summary, root, ["date"])


class PublishedNothing(RuntimeError):
    """A run that was to publish rows had none."""


def write_counted(df: DataFrame, root: str, partition: Sequence[str]) -> int:
    """``write_partitioned``, returning the number of rows, which are counted while they are written."""
    seen = Observation()
    write_partitioned(df.observe(seen, F.count(F.lit(1)).alias("rows")), root, partition)
    try:
        return seen.get["rows"]
    except Py4JJavaError:
        # Rows that Spark knows to be none without looking are not observed at all.
        return 0


def publish(df: DataFrame, root: str, partition: Sequence[str]) -> int:
    """Write and return the number of rows, counted while writing; none is an error."""
    rows = write_counted(df, root, partition)
    if not rows:
        raise PublishedNothing(f"no rows to publish to {root}")
    return rows
