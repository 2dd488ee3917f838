"""Shapes of physical plans that matter at scale."""

import re

import pytest
from pyspark.sql import functions as F

from tallyrill.operators.recommend import top_per
from tallyrill.plans import QUERIES, TWINS
from tallyrill.plans.registry import table

FOLDER = "/root/testdata/sf0.001"
LAZY = [n for n in sorted(TWINS) if re.match(r"(prj|fil|joi0[1-7]|agg|set|srt|sca|rec|win05|win06|imp0[123]|eva|fea1)", n)]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python_worker(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "ArrowEvalPython" not in text and "BatchEvalPython" not in text and "FlatMapGroupsInPandas" not in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(table(spark, FOLDER, "orders").filter("o_totalprice > 300000").select("o_custkey"))
    assert "GreaterThan(o_totalprice,300000.0)" in text
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double>" in text
    flights = plan(QUERIES["agg08_speed_per_carrier"](spark, FOLDER))
    assert "l_shipdate" not in re.search(r"ReadSchema: struct<[^>]*l_suppkey[^>]*>", flights).group(0)


def test_top_n_is_cut_before_the_shuffle(spark):
    df = top_per(table(spark, FOLDER, "orders"), ["o_custkey"], [F.col("o_totalprice").desc()], 3)
    text = plan(df)
    assert text.count("WindowGroupLimit") == 2
    assert "TakeOrderedAndProject" in plan(QUERIES["srt05_top_k"](spark, FOLDER))


def test_one_scan_for_all_columns(spark):
    for name in ("agg11_null_and_blank_counts", "agg13_distinct_counts", "agg09_summary"):
        text = plan(QUERIES[name](spark, FOLDER))
        assert text.count("orders.parquet") + text.count("lineitem.parquet") == 1
