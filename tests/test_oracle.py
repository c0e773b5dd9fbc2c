"""Every query against its SQL counterpart, and the shape of every plan."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect
from workload.registry import QUERIES

# Their plans only read what they have written.
WRITERS = {
    "landed_tables", "landed_points", "published_dashboard", "landed_counts", "declared_sources", "merged_winners", "kept_fact",
    "kept_monthly_normal",
}
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, database, name):
    problem, rows = compare(spark, database, entry.queries()[name], entry.oracle_sql()[name], SMALL)
    assert problem is None
    assert rows > 0 or name == "coverage_missing"


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITERS))
def test_plan_has_no_cross_join_and_no_python(spark, name):
    plan = entry.queries()[name](spark, SMALL)._jdf.queryExecution().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval"):
        assert operator not in plan


def test_entry(spark):
    assert entry.entry(spark).count() > 0
