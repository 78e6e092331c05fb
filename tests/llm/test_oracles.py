"""Queries with a SQL form, on the smallest tables."""

import duckdb
import pytest

from fleetlake.llm.queries import ORACLES, QUERIES
from tests.oracle import _rows, oracle_connection

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con() -> duckdb.DuckDBPyConnection:
    return oracle_connection(SF)


def test_every_operator_has_one_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    result = con.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    assert _rows(df.columns, df.collect()) == _rows(names, result.fetchall())
