"""Every registered query: against its SQL where it has one, else for shape."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as driver  # noqa: E402
from check_oracle import compare, connect  # noqa: E402

QUERIES, ORACLE = driver.queries(), driver.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, sf, duck, name):
    assert compare(duck, QUERIES[name](spark, sf), ORACLE[name]) == ""


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - ORACLE.keys()))
def test_query_without_sql_has_rows(spark, small_sf, name):
    df = QUERIES[name](spark, small_sf)
    assert df.count() > 0 and df.columns


def test_entry(spark):
    assert driver.entry(spark).columns == ["bin", "n_alumni", "n_former", "rate"]


def test_every_oracle_has_a_query():
    assert ORACLE.keys() <= QUERIES.keys()


PYTHON_FREE = sorted(name for name in ORACLE if not name.startswith("stream_"))


@pytest.mark.parametrize("name", PYTHON_FREE)
def test_no_python_worker_in_any_plan(spark, small_sf, name):
    plan = QUERIES[name](spark, small_sf)._jdf.queryExecution().executedPlan().toString()
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan
