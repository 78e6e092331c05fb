"""Every registered query against its SQL oracle, on the smallest tables."""

import pytest

from fleetlake.suite import ORACLES, QUERIES

from .oracle import compare, oracle_connection

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, con, name):
    _, problem = compare(spark, con, name, SF)
    assert not problem, problem
