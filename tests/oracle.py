"""Compare Spark results with their SQL oracles, as multisets of rows.

Also a command: ``python -m tests.oracle <folder> [query ...]``.
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from fleetlake.suite import ORACLES, QUERIES


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return round(value, 8) + 0.0
    return value


def _rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


# Spark type -> SQL type of the oracle.
_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp": "TIMESTAMP",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def compare(spark: SparkSession, con, name: str, sf_dir: str) -> tuple[int, str]:
    """Number of rows and an empty text, or a description of the difference."""
    df = QUERIES[name](spark, sf_dir)
    found = _rows(df.columns, df.collect())
    if name not in ORACLES:
        return sum(found.values()), ""
    result = con.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    expected = _rows(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return sum(found.values()), f"columns {sorted(df.columns)} != {sorted(names)}"
    sql_types = {d[0]: str(d[1]) for d in result.description}
    wrong = [f"{c} {t} != {sql_types[c]}" for c, t in df.dtypes if _TYPES.get(t) != sql_types[c]]
    if wrong:
        return sum(found.values()), f"types: {', '.join(wrong)}"
    if found != expected:
        extra, missing = found - expected, expected - found
        return sum(found.values()), (
            f"{sum(extra.values())} extra, {sum(missing.values())} missing;\n"
            f"  extra   {sorted(map(str, extra))[:3]}\n  missing {sorted(map(str, missing))[:3]}"
        )
    return sum(found.values()), ""


def main(sf_dir: str, names: list[str]) -> None:
    from fleetlake.session import local_session

    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(sf_dir)
    bad = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            rows, problem = compare(spark, con, name, sf_dir)
        except Exception as error:
            rows, problem = -1, f"{type(error).__name__}: {str(error)[:1500]}"
        bad += bool(problem)
        kind = "oracle" if name in ORACLES else "rows-only"
        print(f"{'FAIL' if problem else 'ok':5}{name:28}{rows:8} rows {time.time() - start:6.2f}s {kind} {problem}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
