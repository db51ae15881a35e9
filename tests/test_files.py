"""Reading files whose schemas drifted apart, and buckets at exact quantiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import rows
from tidewater.ml.features import quantile_buckets
from tidewater.plans.tables import trips_of
from tidewater.sources import lake
from tidewater.sources.files import read_drifted


def test_drifted_files_of_one_schema_share_a_scan(spark, tmp_path):
    frames = [spark.createDataFrame([(i, float(i))], "a int, b double") for i in range(3)]
    frames += [spark.createDataFrame([(9, "x")], "a bigint, c string")]
    paths = [f"{tmp_path}/part{i}" for i in range(4)]
    for frame, path in zip(frames, paths):
        frame.write.parquet(path)
    found = read_drifted(spark, paths, {"a": "bigint"})
    assert rows(found.select("a", "b", "c")) == rows(spark.createDataFrame(
        [(0, 0.0, None), (1, 1.0, None), (2, 2.0, None), (9, None, "x")], "a bigint, b double, c string"))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("parquet") == 2


def test_quantile_buckets(spark):
    frame = spark.createDataFrame([(float(x),) for x in (1, 1, 1, 1, 2, 3, 4, 5)], "x double")
    sizes = quantile_buckets(frame, "x", 4, "b").groupBy("b").agg(F.count(F.lit(1)).alias("n"))
    # The quartiles are 1, 1 and 3, so the middle bucket holds 1 and 2.
    assert rows(sizes.select("b", "n")) == [(1.0, 5), (2.0, 3)]
    nothing = quantile_buckets(frame.select(F.lit(None).cast("double").alias("x")), "x", 4, "b")
    assert {r["b"] for r in nothing.collect()} == {None}


def test_silver_is_written_from_one_shuffle(spark, tables, tmp_path):
    lake.bronze_ingest(trips_of(tables.lineitem), f"{tmp_path}/bronze", "pickup_ts")
    bronze = spark.read.parquet(f"{tmp_path}/bronze")
    bronze = bronze.unionByName(bronze)
    dealt = bronze.withColumn("_slice", F.lit(0)).repartition("_year", "_month", "_slice")
    plan = lake.silver_trips(dealt, ["_year", "_month", "_slice"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    lake.write_silver(bronze, f"{tmp_path}/silver", rows_per_slice=20)
    silver, usual = spark.read.parquet(f"{tmp_path}/silver"), lake.silver_trips(bronze)
    assert sorted(silver.columns) == sorted(usual.columns) and silver.count() == usual.count() > 0
    assert silver.select(usual.columns).exceptAll(usual).count() == 0
