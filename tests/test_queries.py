"""The registered queries against DuckDB, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from check_queries import database, differences
from conftest import SMALL

ORACLE = contract.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return database(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, connection, name):
    assert differences(contract.queries()[name](spark, SMALL), connection, ORACLE[name]) == []


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(contract.queries())


def test_flagship(spark):
    rows = contract.entry(spark).collect()
    assert [row["k"] for row in rows] == list(range(2, 10))


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(ORACLE)))
def test_runs_without_sql(spark, name):
    df = contract.queries()[name](spark, SMALL)
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_no_plan_pairs_rows(spark, name):
    plan = contract.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
