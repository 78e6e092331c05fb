"""Results of a stream by batch: notes of what a batch touched, snapshots, and merging.

Below a root of results, a batch writes its rows to ``<unit>/batch_id=n`` (a unit is a day, or a
device's message and day) and a note of the log files it processed. A log file's newest result counts.
So that old results don't pile up, ``compact`` folds them into base files: for every unit touched since
the last snapshot it writes the rows that count, and then a snapshot that says which version of each
unit is the valid one. A snapshot is complete or not there at all; readers take the newest one and the
batches after it. What the snapshot before it needs is kept for readers that are still at work.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import SERIES_KEYS
from ..sources.lake import _folders, write_partitioned

BATCH = "batch_id"
#: Below the root of the results: notes by batch, snapshots by their last batch, base files by version.
TOUCHED, SNAPSHOTS, BASE = "_touched", "_snapshots", "_base"
VERSION = "version"
_KINDS = {"device": T.StringType(), "message": T.StringType(), "date": T.DateType(), BATCH: T.IntegerType(), VERSION: T.IntegerType()}


def _below(root: str, *parts: object) -> str:
    return "/".join([root.rstrip("/"), *map(str, parts)])


def _numbers(spark: SparkSession, root: str, kind: str) -> list[int]:
    """Numbers of the finished notes or snapshots, ascending."""
    done = _folders(spark, _below(root, kind, "*", "_SUCCESS"))
    return sorted(int(f.rsplit("/", 2)[1]) for f in done)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _read(spark: SparkSession, base: str, glob: str) -> DataFrame | None:
    """Rows below ``base`` with their folders as columns; None if there are none at all."""
    path = f"{base}/{glob}"
    try:
        # The newest schema has all columns; folder values that look like numbers are text.
        found = spark.read.options(basePath=base, mergeSchema=True).parquet(path).schema
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return None
    schema = T.StructType([T.StructField(f.name, _KINDS.get(f.name, f.dataType)) for f in found])
    return spark.read.schema(schema).options(basePath=base).parquet(path)


def write_note(touched: DataFrame, root: str, batch_id: int) -> None:
    """Note the log files that a batch processed; no more rows than files per batch."""
    note = touched.withColumn(BATCH, F.lit(batch_id))
    note.coalesce(1).write.mode("overwrite").parquet(_below(root, TOUCHED, batch_id))


def _notes(spark: SparkSession, root: str, after: int, upto: int | None = None) -> DataFrame:
    """The newest batch after ``after`` for each log file touched since."""
    wanted = [n for n in _numbers(spark, root, TOUCHED) if n > after and (upto is None or n <= upto)]
    if not wanted:
        return spark.createDataFrame([], "device string, date date, file_name string, batch_id int")
    notes = spark.read.parquet(*[_below(root, TOUCHED, n) for n in wanted])
    return notes.groupBy(*SERIES_KEYS).agg(F.max(BATCH).cast("int").alias(BATCH))


def _snapshot(spark: SparkSession, root: str) -> int:
    return max(_numbers(spark, root, SNAPSHOTS), default=-1)


def _device(rows: DataFrame) -> str:
    return "device" if "device" in rows.columns else "DeviceID"


def _valid(spark: SparkSession, root: str, glob: str, upto: int | None = None) -> DataFrame | None:
    """The rows that count, up to a batch, with their folders as columns."""
    snapshot = _snapshot(spark, root)
    newest = _notes(spark, root, snapshot, upto)
    parts = []
    fresh = _read(spark, root.rstrip("/"), glob)
    if fresh is not None:
        of = newest.withColumnRenamed("device", _device(fresh))
        # The bound on batches prunes folders.
        fresh = fresh.where(F.col(BATCH) > snapshot).join(of, [_device(fresh), "date", "file_name", BATCH], "left_semi")
        parts.append(fresh.drop(BATCH))
    base = _read(spark, _below(root, BASE), f"{VERSION}=*/{glob}") if snapshot >= 0 else None
    if base is not None:
        units = spark.read.parquet(_below(root, SNAPSHOTS, snapshot))
        keys = [c for c in units.columns if c in base.columns]
        of = newest.drop(BATCH).withColumnRenamed("device", _device(base))
        # One row per unit, against one row per result: Spark prunes the folders by it.
        base = base.join(units, keys, "left_semi").join(of, [_device(base), "date", "file_name"], "left_anti")
        parts.append(base.drop(VERSION))
    if not parts:
        return None
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)


def latest(spark: SparkSession, root: str, message: str | None = None) -> DataFrame | None:
    """The newest results of each log file below a root that ``run_whole_files`` wrote to.

    ``message`` picks a derived message; None if there are no rows at all. Reads the newest snapshot and
    the batches after it, so a merge that runs meanwhile changes nothing.
    """
    return _valid(spark, root, "date=*" if message is None else f"device=*/message={message}/date=*")


def compact(spark: SparkSession, root: str, unit: Sequence[str], upto: int | None = None) -> int | None:
    """Fold the batches up to ``upto`` (all that have ended) into base files; the number of the snapshot made.

    ``unit`` names the folders of the results, such as ``["date"]``. Only units that the batches since the
    last snapshot touched are written again. Superseded versions, batches and notes are removed as soon
    as no snapshot but the newest two could need them, so the number of files is bounded by the results
    and by what two rounds touch. None if there is nothing new. A merge that fails leaves no snapshot,
    and the next one does its work again; it must not run twice at once.
    """
    before = _snapshot(spark, root)
    ended = [n for n in _numbers(spark, root, TOUCHED) if n > before and (upto is None or n <= upto)]
    if not ended:
        return None
    number = max(ended)
    shared = [c for c in unit if c in ("device", "date")]
    touched = _notes(spark, root, before, number).select(*shared).distinct()
    rows = _valid(spark, root, "/".join(f"{c}=*" for c in unit), number)
    base = _below(root, BASE)
    if rows is not None:
        again = rows.join(touched, shared, "left_semi").withColumn(VERSION, F.lit(number))
        _delete(spark, _below(base, f"{VERSION}={number}"))
        write_partitioned(again, base, [VERSION, *unit])
    made = _read(spark, base, f"{VERSION}={number}/" + "/".join(f"{c}=*" for c in unit))
    units = None if made is None else made.select(*unit, VERSION).distinct()
    old = spark.read.parquet(_below(root, SNAPSHOTS, before)) if before >= 0 else None
    kept = None if old is None else old.join(touched, shared, "left_anti")
    parts = [p.select(*unit, VERSION) for p in (units, kept) if p is not None]
    none = spark.createDataFrame([], T.StructType([T.StructField(c, _KINDS[c]) for c in (*unit, VERSION)]))
    every = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1]) if parts else none
    every.coalesce(1).write.mode("overwrite").parquet(_below(root, SNAPSHOTS, number))
    _forget(spark, root, unit, before)
    return number


def _forget(spark: SparkSession, root: str, unit: Sequence[str], before: int) -> None:
    """Remove what neither the newest snapshot nor the one before it, ``before``, refers to."""
    folder = "/".join(f"{c}=*" for c in unit)
    for path in _folders(spark, _below(root, folder, f"{BATCH}=*")):
        if int(path.rsplit("=", 1)[1]) <= before:
            _delete(spark, path)
    for n in _numbers(spark, root, TOUCHED):
        if n <= before:
            _delete(spark, _below(root, TOUCHED, n))
    snapshots = _numbers(spark, root, SNAPSHOTS)
    # One row per unit and snapshot: the folders that one of two snapshots names.
    valid = {tuple(r) for n in snapshots if n >= before for r in spark.read.parquet(_below(root, SNAPSHOTS, n)).select(VERSION).distinct().collect()}
    for path in _folders(spark, _below(root, BASE, f"{VERSION}=*")):
        if (int(path.rsplit("=", 1)[1]),) not in valid:
            _delete(spark, path)
    superseded = [n for n in snapshots if n < before]
    if superseded:
        gone = spark.read.parquet(*[_below(root, SNAPSHOTS, n) for n in superseded]).select(*unit, VERSION)
        still = spark.read.parquet(*[_below(root, SNAPSHOTS, n) for n in snapshots if n >= before]).select(*unit, VERSION)
        # As many as units that one round touched.
        for row in gone.exceptAll(still.distinct()).distinct().toLocalIterator():
            _delete(spark, _below(root, BASE, f"{VERSION}={row[VERSION]}", *(f"{c}={row[c]}" for c in unit)))
    for n in superseded:
        _delete(spark, _below(root, SNAPSHOTS, n))
