"""Every registered query against its SQL on the smallest sample tables."""

import os

import oracle
import pytest

import __spark_entry__ as entry_points
from plazaframe.plans.registered import QUERIES

FOLDER = entry_points.SMALL
# Python workers and joins without keys have no place in any plan.
SLOW_NODES = ["EvalPython", "InPandas", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin"]
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="sample tables not here")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


def test_entry(spark):
    assert entry_points.entry(spark).count() >= 25


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    df = entry_points.queries()[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in SLOW_NODES if node in plan]
    columns, rows = oracle.of_spark(df)
    sql = entry_points.oracle_sql().get(name)
    if sql is None:
        assert name in ("random_sample", "pca") and rows
        return
    wanted = oracle.of_sql(con, sql)
    assert columns == wanted[0]
    assert rows == wanted[1]


def test_every_oracle_has_its_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
