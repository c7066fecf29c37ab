"""What the printed plans promise: bounds at the scan, one scan, no repeated work."""

import os
import re

import pytest

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


def plan_of(spark, name):
    df = contract.queries()[name](spark, FOLDER)
    text = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return text


def pushed(text):
    """Pushed filters of the main plan's scans, subqueries left out."""
    return re.findall(r"PushedFilters: (.*)", text.split("===== Subqueries =====")[0])


@pytest.mark.parametrize("name,column", [
    ("clean_source", "l_shipdate"), ("last_n_periods", "o_orderdate"), ("period_membership", "l_shipdate"),
    ("nth_snapshot", "o_orderdate"), ("snapshot_retention", "o_orderdate"), ("recent_years", "l_shipdate"),
])
def test_lower_bounds_reach_the_scan(spark, name, column):
    assert any(f"GreaterThanOrEqual({column}" in p for p in pushed(plan_of(spark, name)))


def test_refresh_bounds_reach_the_scan(spark):
    found = pushed(plan_of(spark, "window_refresh"))
    assert any("LessThan(o_orderdate" in p for p in found)
    assert any("GreaterThanOrEqual(o_orderdate" in p for p in found)


def test_documents_are_parsed_once(spark):
    for name in ("decode_all", "decode_payload", "selectable_items"):
        assert plan_of(spark, name).count("from_json(") == 1


def test_shares_come_out_of_one_scan_and_one_aggregation(spark):
    from cotejo.operators import shares

    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    df = shares.share_index(lines, "l_suppkey", "l_partkey", "l_quantity")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("HashAggregate") == 2 and "Join" not in plan
