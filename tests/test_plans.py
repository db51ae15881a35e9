"""Physical plans: what reaches the scan, what is shuffled, and that no Python runs needlessly."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from compare import DATA

SF_DIR = f"{DATA}/sf0.001"
QUERIES = entry.queries()


def plan(spark, name):
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


def test_filter_and_columns_reach_the_scan(spark):
    text = plan(spark, "scan_parquet")
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>" in text


def test_aggregate_reads_only_its_columns(spark):
    assert "ReadSchema: struct<event_type:string>" in plan(spark, "group_count")


@pytest.mark.parametrize("name, exchanges", [
    ("combine_per_key", 1), ("group_two_keys", 1), ("dq_report", 1), ("null_profile", 1), ("describe_table", 1),
    ("win_top_n", 1), ("win_nth_occurrence", 1), ("drop_duplicates_keys", 1), ("param_grid", None),
])
def test_shuffles(spark, name, exchanges):
    text = plan(spark, name)
    if exchanges is not None:
        assert text.count("Exchange ") - text.count("BroadcastExchange") == exchanges
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["win_top_n", "win_latest_per_key", "win_nth_occurrence", "drop_duplicates_keys"])
def test_group_limits_run_before_the_shuffle(spark, name):
    assert plan(spark, name).count("WindowGroupLimit") == 2


def test_broadcast_and_merge_joins(spark):
    assert "BroadcastHashJoin" in plan(spark, "join_broadcast")
    assert "SortMergeJoin" in plan(spark, "join_shuffle")


PYTHON = {"udf_scalar", "udf_pandas", "udtf_flatmap", "udaf_custom", "map_batches"}
BATCH = ["case_banding", "trip_features", "anomaly_rules", "cleaning_audit", "outliers_iqr", "etl_transform",
         "merge_group_stats", "split_stratified", "word_count", "impute_mean", "corr_matrix"]


@pytest.mark.parametrize("name", BATCH)
def test_no_python_in_built_in_operators(spark, name):
    text = plan(spark, name)
    assert "Python" not in text and "InPandas" not in text and "CartesianProduct" not in text


@pytest.mark.parametrize("name", sorted(PYTHON))
def test_python_hooks_use_arrow(spark, name):
    text = plan(spark, name)
    assert "ArrowEvalPython" in text or "MapInPandas" in text
