"""What the plans of all registered queries must and must not hold."""

import os

import pytest

from skyloom.catalog import ORACLES, QUERIES

TABLES = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(TABLES), reason="no tables")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan(spark, name):
    df = QUERIES[name](spark, TABLES)
    text = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert bad not in text, bad
    # one task only ever merges counters that were combined before
    assert all("Aggregate(" in parent for parent in parents(text, "Exchange SinglePartition"))


def parents(text, name):
    """The lines right above each occurrence of an operator in a plan tree."""
    lines = [(len(line) - len(line.lstrip(" :+-*()0123456789")), line) for line in text.splitlines()]
    for i, (depth, line) in enumerate(lines):
        if name in line:
            yield next(other for d, other in reversed(lines[:i]) if d < depth)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


def test_filters_and_columns_reach_the_scan(spark):
    text = QUERIES["silver_parquet_scan"](spark, TABLES)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(event_type), IsNotNull(ts), Not(EqualTo(event_type,error))" in text
    assert "props" not in text.split("ReadSchema")[1]
