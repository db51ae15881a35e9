"""Join operators against Spark's own joins, with a key that holds most rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidewater.operators import joins as J


@pytest.fixture(scope="module")
def sides(spark):
    left = spark.range(600).select(F.when(F.col("id") % 3 != 0, 1).when(F.col("id") % 50 == 0, None).otherwise(
        F.col("id") % 40).cast("bigint").alias("k"), F.col("id").alias("a"))
    right = spark.range(1, 60).select(F.col("id").alias("k"), (F.col("id") * 10).alias("b")).union(
        spark.createDataFrame([(1, 11), (None, 12)], "k bigint, b bigint"))
    return left, right


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join(sides, how):
    left, right = sides
    assert rows(J.salted_join(left, right, ["k"], how, salts=4)) == rows(left.join(right, "k", how))


def test_salted_join_spreads_the_hot_key(sides):
    left, right = sides
    salted = J.salted_join(left, right, ["k"], salts=4)
    assert "_salt" in salted._jdf.queryExecution().analyzed().toString()
    assert salted.columns == ["k", "a", "b"]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_with_a_hot_null_key(spark, how):
    left = spark.range(200).select(F.when(F.col("id") % 2 == 0, F.col("id") % 3).alias("k"), F.col("id").alias("a"))
    right = spark.createDataFrame([(0, "x"), (1, "y"), (1, "z"), (None, "n")], "k bigint, b string")
    salted = J.salted_join(left, right, ["k"], how, salts=8, fraction=0.3)
    assert rows(salted) == rows(left.join(right, "k", how))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_spreads_equal_rows(spark, how):
    left = spark.range(5000).select(F.when(F.col("id") % 10 > 0, 1).otherwise(F.col("id")).alias("k"), F.lit("x").alias("a"))
    right = spark.createDataFrame([(1, "b"), (1, "c"), (20, "d")], "k bigint, b string")
    salted = J.salted_join(left, right, ["k"], how, salts=8, run=100)
    assert rows(salted) == rows(left.join(right, "k", how))
    plan = salted._jdf.queryExecution().analyzed().toString()
    assert "_run" in plan and "_copies" in plan


def test_salted_join_runs_get_different_salts(spark):
    copies = spark.range(50).select(F.lit(1).alias("k"), F.col("id").alias("_run"))
    assert copies.select(J.salt_of([F.col("k"), F.col("_run")], 8).alias("s")).distinct().count() == 8


def test_right_and_full_join(sides):
    left, right = sides
    assert rows(J.right_join(left, right, ["k"])) == rows(left.join(right, "k", "right"))
    assert rows(J.full_join(left, right, ["k"])) == rows(left.join(right, "k", "full"))


def test_lookup_join_broadcasts_only_measured_small_sides(sides):
    left, right = sides
    small = J.lookup_join(left, right, ["k"])
    large = J.lookup_join(left, right, ["k"], max_rows=10)
    assert "_salt" in large._jdf.queryExecution().analyzed().toString()
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    assert rows(small) == rows(large) == rows(left.join(right, "k"))


def test_hot_keys_are_bounded(sides):
    left, _ = sides
    assert rows(J.hot_keys(left, ["k"], 0.25)) == [(1,)]


def test_group_statistics_keep_null_groups(sides):
    left, _ = sides
    out = J.with_group_statistics(left, ["k"], [F.count(F.lit(1)).alias("n")])
    assert out.count() == left.count()
    assert out.filter("k IS NULL").select("n").distinct().count() == 1


def test_salts_follow_the_size_of_the_key(spark):
    left = spark.range(3000).select(F.when(F.col("id") < 1000, 1).when(F.col("id") < 1600, 2).otherwise(
        F.col("id")).alias("k"), F.col("id").alias("a"))
    right = spark.createDataFrame([(1, "b"), (2, "c"), (2, "d"), (1700, "e")], "k bigint, b string")
    salted = J.salted_join(left, right, ["k"], "left", rows_per_salt=100)
    assert rows(salted) == rows(left.join(right, "k", "left"))
    found = {r["k"]: r["_rows"] for r in J.hot_key_counts(left, ["k"], 0.01).collect()}
    assert found == {1: 1000, 2: 600}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_of_rows_with_maps(spark, how):
    left = spark.range(400).select(F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id")).alias("k"),
                                   F.create_map(F.lit("x"), F.col("id") % 5).alias("m"))
    right = spark.createDataFrame([(1, "b"), (3, "c")], "k bigint, b string")
    as_text = lambda df: rows(df.withColumn("m", F.to_json("m")))
    salted = J.salted_join(left, right, ["k"], how, salts=4, run=10)
    assert as_text(salted) == as_text(left.join(right, "k", how))
    nested = left.withColumn("m", F.array("m"))
    with pytest.raises(TypeError, match="m: array<map"):
        J.salted_join(nested, right, ["k"], how)


@pytest.mark.parametrize("how", ["right", "full"])
def test_outer_joins_spread_the_hot_key(sides, how):
    left, right = sides
    found = {"right": J.right_join, "full": J.full_join}[how](left, right, ["k"])
    assert rows(found) == rows(left.join(right, "k", how))
    assert "_salt" in found._jdf.queryExecution().analyzed().toString()
