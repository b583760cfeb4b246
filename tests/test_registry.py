"""Every registered query agrees with its SQL, and no plan does what a cluster cannot carry."""

import os

import pytest

import parity
from __spark_entry__ import entry
from citelight.registry import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")

# Constructs that would hold a table in one task, pair all rows, or leave the JVM.
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "BatchEvalPython",
             "MapInPandas", "FlatMapGroupsInPandas", "collect_list", "collect_set")


@pytest.fixture(scope="module")
def con():
    return parity.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_its_sql(spark, con, name):
    assert parity.compare(spark, con, name, QUERIES[name], ORACLE[name], FOLDER) is None


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan(spark, plan_of, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    assert not [word for word in FORBIDDEN if word in plan]
    # A window without partition would pull all rows into one task.
    assert "Window [" not in plan or "Exchange SinglePartition, ENSURE" not in plan.split("Window [")[1][:400]


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["snapshot_week", "search_term_id", "brand_name", "visibility_score", "ai_share_of_voice"]
    assert df.count() > 0


@pytest.mark.parametrize("name, columns", [
    ("domain_totals", {"l_partkey", "l_suppkey", "l_quantity"}),
    ("counts_by_dim", {"lang", "source", "n_chars"}),
    ("moving_avg_7", {"ts", "event_type", "value"}),
])
def test_only_needed_columns_are_read(spark, plan_of, name, columns):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    schema = plan.split("ReadSchema: struct<")[1].split(">")[0]
    assert {field.split(":")[0] for field in schema.split(",")} == columns


@pytest.mark.parametrize("name", ["tag_filter", "sentiment_by_model", "product_breakdown"])
def test_filters_reach_the_scan(spark, plan_of, name):
    assert "PushedFilters: [IsNotNull" in plan_of(QUERIES[name](spark, FOLDER))
