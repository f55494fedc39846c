"""Every named query against its SQL, and the shape of its plan."""

import duckdb
import pytest

import __spark_entry__ as contract
from corpuskit.catalogue import ORACLES, QUERIES
from tests.compare import difference, duck


@pytest.fixture(scope="module")
def con(sf) -> duckdb.DuckDBPyConnection:
    return duck(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf, name):
    seen = []

    def run(session, folder):
        seen.append(QUERIES[name](session, folder))
        return seen[-1]

    assert difference(spark, con, sf, run, ORACLES[name]) is None
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("CartesianProduct", "NestedLoopJoin", "RoundRobin"))


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_contract(spark):
    assert set(QUERIES) <= contract.queries().keys() and set(ORACLES) <= contract.oracle_sql().keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()
    assert contract.entry(spark).count() == 3
