"""What the physical plans must and must not contain."""

import os

import pytest

import __spark_entry__ as entry
from lodestrata.operators.keys import one_per_key, sample_per_group
from lodestrata.sources.extract import pruned_extract

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
MODELS = {"model_compare", "forest_importance", "ridge_importance", "ridge_metrics", "residual_summary", "kmeans_select",
          "cluster_profile", "mart_priority"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - MODELS))
def test_no_pairwise_joins_and_no_row_functions(spark, name):
    text = plan(entry.queries()[name](spark, DATA))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert operator not in text
    if name != "scan_cost":
        assert "MapInPandas" not in text


def test_groups_are_cut_before_the_shuffle(spark):
    lines = spark.read.parquet(f"{DATA}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_quantity")
    for df in (one_per_key(lines, ["l_orderkey"]), sample_per_group(lines, ["l_linenumber"], ["l_orderkey"], 5)):
        text = plan(df)
        assert text.count("WindowGroupLimit") == 2 and text.count("Exchange") == 1


def test_extract_reaches_the_scan(spark):
    text = plan(pruned_extract(spark.read.parquet(f"{DATA}/orders.parquet"), ["o_orderkey"], "o_custkey", [7, 9]))
    assert "PushedFilters: [In(o_custkey, [7,9])]" in text and "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in text
