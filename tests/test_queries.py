"""Every registered query against its SQL, over whole tables."""

import re

import pytest
from conftest import SF

import __spark_entry__ as entry_points
from compare import differences, duck

# Queries on training data have tests of their own beside their operators.
QUERIES = {k: q for k, q in entry_points.queries().items() if not re.match(r"op\d+_|pipeline$", k)}
ORACLES = {k: q for k, q in entry_points.oracle_sql().items() if not re.match(r"op\d+_|pipeline$", k)}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, con):
    df = QUERIES[name](spark, SF)
    assert differences(df, con, ORACLES[name]) == []
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "MapInPandas"):
        assert node not in plan


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
