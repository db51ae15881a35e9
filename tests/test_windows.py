"""Chunked windows give what plain windows give, on skewed data with ties and nulls."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from tidewater.operators import windows as W

SPECS = {
    "rn": W.row_number(), "rk": W.rank(), "dr": W.dense_rank(), "pr": W.percent_rank(), "q4": W.ntile(4),
    "q7": W.ntile(7), "n": W.group_size(), "s": W.running_sum("x"), "m": W.running_max("x"),
    "prev": W.previous("x"), "next": W.following("x"), "fill": W.last_known("x"),
}


def skewed(spark, n=400):
    """Key 1 holds three quarters of the rows; one value of it holds half of those."""
    ids = spark.range(n, numPartitions=5)
    return ids.select(
        "id",
        F.when(F.col("id") % 4 != 0, 1).when(F.col("id") % 8 == 0, 2).otherwise(F.lit(None)).alias("k"),
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 5 == 0, F.lit(None)).otherwise(F.col("id") * 37 % 23)
        .alias("v"),
        F.when(F.col("id") % 6 != 0, F.col("id") * 11 % 101).alias("x"))


@pytest.mark.parametrize("order", [["v"], [("v", "desc")]])
@pytest.mark.parametrize("rows_per_chunk", [17, 150])
def test_chunked_equals_plain(spark, order, rows_per_chunk):
    df = skewed(spark)
    plain = W.with_windows(df, ["k"], order, SPECS, ["id"])
    chunked = W.with_windows(df, ["k"], order, SPECS, ["id"], max_group_rows=10, rows_per_chunk=rows_per_chunk)
    assert rows(chunked) == rows(plain)


def test_whole_table_as_one_group(spark):
    df = skewed(spark)
    w = Window.partitionBy(F.lit(0)).orderBy("v", "id")
    expected = df.withColumns({
        "rn": F.row_number().over(w).cast("bigint"),
        "s": F.sum("x").over(w.rowsBetween(Window.unboundedPreceding, 0))})
    got = W.with_windows(df, [], ["v"], {"rn": W.row_number(), "s": W.running_sum("x")}, ["id"], rows_per_chunk=20)
    assert rows(got) == rows(expected)


def test_string_order_and_two_keys(spark):
    df = skewed(spark).withColumn("t", F.md5(F.col("id").cast("string"))).withColumn("j", F.lit("a"))
    plain = W.with_windows(df, ["k", "j"], ["t"], SPECS)
    chunked = W.with_windows(df, ["k", "j"], ["t"], SPECS, max_group_rows=10, rows_per_chunk=25)
    assert rows(chunked) == rows(plain)


def test_all_rows_tied(spark):
    df = spark.range(100, numPartitions=4).select("id", F.lit(1).alias("k"), F.lit(5).alias("v"), F.col("id").alias("x"))
    plain = W.with_windows(df, ["k"], ["v"], SPECS, ["id"])
    chunked = W.with_windows(df, ["k"], ["v"], SPECS, ["id"], max_group_rows=1, rows_per_chunk=9)
    assert rows(chunked) == rows(plain)


def test_extent_counts_the_largest_group(spark):
    assert W.group_extent(skewed(spark), ["k"]) == (400, 300)
    assert W.group_extent(skewed(spark).filter("id < 0"), ["k"]) == (0, 0)


def test_user_columns_named_like_helpers(spark):
    df = skewed(spark).withColumnsRenamed({"x": "_n", "v": "_rank"})
    got = W.with_windows(df, ["k"], ["_rank"], {"s": W.running_sum("_n")}, ["id"], max_group_rows=1, rows_per_chunk=50)
    plain = W.with_windows(df, ["k"], ["_rank"], {"s": W.running_sum("_n")}, ["id"])
    assert rows(got) == rows(plain)


def test_top_per_group_limits_before_the_shuffle(spark):
    df = skewed(spark)
    top = W.top_per_group(df, ["k"], [("v", "desc")], 3)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    expected = df.withColumn("rank", F.rank().over(Window.partitionBy("k").orderBy(F.desc("v"))).cast("bigint"))
    assert rows(top) == rows(expected.filter("rank <= 3"))


@pytest.mark.parametrize("ties", [True, False])
def test_long_top_lists_use_chunks(spark, monkeypatch, ties):
    df = skewed(spark)
    order = [("v", "desc"), "id"]
    short = W.top_per_group(df, ["k"], order, 50, ties=ties)
    monkeypatch.setattr(W, "GROUP_LIMIT", 10)
    long = W.top_per_group(df, ["k"], order, 50, ties=ties, max_group_rows=20, rows_per_chunk=60)
    assert rows(long) == rows(short)


def test_threshold_and_nth(spark):
    values = spark.createDataFrame([(1, 100), (2, 200), (3, 250), (4, 300), (5, 150)], "pos int, x int")
    running = W.with_windows(values, [], ["pos"], {"total": W.running_sum("x")}, rows_per_chunk=2)
    assert [r["total"] for r in running.filter("total >= 500").orderBy("pos").collect()] == [550, 850, 1000]
    names = ["Alice", "Bob", "Alice", "Alice", "Bob", "Charlie", "Bob", "Bob"]
    visits = spark.createDataFrame(list(enumerate(names)), "pos int, name string")
    assert rows(W.nth_row(visits, ["name"], ["pos"], 3)) == [("Alice", 3), ("Bob", 6)]
