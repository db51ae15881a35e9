"""Samples and splits do not depend on partitioning; parts are disjoint and cover the table."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import rows
from tidewater.operators import sampling as S


def test_sample_is_stable(spark):
    df = spark.range(5000)
    one = S.sample_rows(df, "id", 0.2)
    assert rows(one) == rows(S.sample_rows(df.repartition(7), "id", 0.2))
    assert 800 < one.count() < 1200
    assert rows(one) != rows(S.sample_rows(df, "id", 0.2, seed=1))


def test_split_covers(spark):
    df = spark.range(2000)
    train, test = S.split_two(df, "id")
    assert train.intersect(test).isEmpty()
    assert train.count() + test.count() == 2000
    assert 1500 < train.count() < 1700


def test_three_way_split(spark):
    parts = spark.range(3000).groupBy(S.split_column("id", {"a": 0.5, "b": 0.3, "c": 0.2}).alias("p")).count()
    counts = {r["p"]: r["count"] for r in parts.collect()}
    assert sum(counts.values()) == 3000
    assert counts["a"] > counts["b"] > counts["c"] > 400


def test_stratified_split_is_exact_also_in_chunks(spark):
    df = spark.range(1000).withColumn("y", (F.col("id") % 10 == 0).cast("int"))
    plain = S.stratified_split(df, "y", ["id"])
    chunked = S.stratified_split(df, "y", ["id"], max_group_rows=50, rows_per_chunk=70)
    assert rows(plain) == rows(chunked)
    assert rows(plain.filter("split = 'train'").groupBy("y").count()) == [(720, 0), (80, 1)]
