"""Small inputs with known results."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidewater.functions import expressions as X
from tidewater.ml import features as M
from tidewater.ml import models as L
from tidewater.operators import aggregates as A
from tidewater.operators import cleaning as C
from tidewater.operators import pythonic as P
from tidewater.operators import quality as Q
from tidewater.sources import lake, logs
from tidewater.streaming.aggregates import window_agg


def pairs(spark, data, types="k string, v int"):
    return spark.createDataFrame(data, types)


CRATES = [("pear", 7), ("fig", 5), ("pear", 1), ("fig", 9)]


def test_group_by_key(spark):
    lists = A.grouped_lists(pairs(spark, CRATES), ["k"], "v", [])
    assert [(r["k"], r["part"], r["values"]) for r in lists.orderBy("k").collect()] == [
        ("fig", 0, [5, 9]), ("pear", 0, [1, 7])]


def test_group_by_key_splits_long_lists_and_loses_nothing(spark):
    df = spark.range(1000).select(F.lit("hot").alias("k"), F.col("id").alias("v"))
    lists = A.grouped_lists(df, ["k"], "v", [], max_values=64, max_group_rows=100, rows_per_chunk=130).collect()
    assert max(len(r["values"]) for r in lists) == 64
    assert [v for r in sorted(lists, key=lambda r: r["part"]) for v in r["values"]] == list(range(1000))


@pytest.mark.parametrize("data, expected", [
    (CRATES, [("fig", 14), ("pear", 8)]),
    ([("north", 11), ("south", -4), ("north", 0), ("south", 4), ("west", 3)],
     [("north", 11), ("south", 0), ("west", 3)]),
    ([("only", 13)], [("only", 13)]),
])
def test_combine_per_key(spark, data, expected):
    plain = pairs(spark, data).groupBy("k").agg(F.sum("v").alias("v"))
    salted = A.salted_aggregate(pairs(spark, data), ["k"], [F.sum("v").alias("v")], [F.sum("v").alias("v")], ["k", "v"])
    assert rows(plain) == rows(salted) == expected


def test_odd_even_sum(spark):
    parity = F.when(F.col("id") % 2 == 1, "odd").otherwise("even")
    assert rows(spark.range(1, 6).groupBy(parity.alias("k")).agg(F.sum("id").alias("v"))) == [("even", 6), ("odd", 9)]


def test_combine_globally(spark):
    df = spark.createDataFrame([(100,), (200,), (300,), (400,)], "v int").repartition(3)
    out = P.combine(df, [], lambda b: {"s": int(b["v"].sum()), "n": len(b)}, "s bigint, n bigint",
                    [F.sum("s").alias("s"), F.sum("n").alias("n")], [(F.col("s") / F.col("n")).alias("mean")])
    assert out.first()["mean"] == 250.0


def test_word_count(spark):
    lines = ["The tide turns at noon", "the harbour waits", "At noon the bell", "  "]
    counts = {r["word"]: r["n"] for r in A.word_counts(pairs(spark, [(x,) for x in lines], "text string"), "text").collect()}
    assert counts == {"the": 3, "tide": 1, "turns": 1, "at": 2, "noon": 2, "harbour": 1, "waits": 1, "bell": 1}


def test_flat_map_filter(spark):
    df = pairs(spark, [("anchor", 640), ("buoy", 90), ("chain", 101)])
    out = P.flat_map(df, lambda k, v: [(k,)] if v > 100 else [], ["k", "v"], "k string")
    assert rows(out) == [("anchor",), ("chain",)]


def test_fixed_windows(spark):
    # The published example and its totals.
    sales = [("09:00", 100), ("09:01", 200), ("09:03", 150), ("09:05", 300), ("09:06", 250), ("09:09", 100)]
    df = spark.createDataFrame([(datetime.fromisoformat(f"2024-01-01 {t}"), v) for t, v in sales], "ts timestamp, v int")
    out = window_agg(df, "ts", "5 minutes", [], [F.sum("v").alias("v")]).orderBy("window_start")
    assert [r["v"] for r in out.collect()] == [450, 650]


def test_consumer_lag(spark):
    types = "topic string, partition int, {} bigint"
    high = pairs(spark, [("t", 0, 5_280_000), ("t", 1, 1_240_000), ("t", 2, 10)], types.format("high_watermark"))
    done = pairs(spark, [("t", 0, 5_210_000), ("t", 1, 1_180_000)], types.format("committed"))
    out = {r["partition"]: (r["lag"], r["safe_offset"]) for r in logs.consumer_lag(high, done).collect()}
    assert out == {0: (70_000, 5_280_000), 1: (60_000, 1_240_000), 2: (10, 10)}


def test_impute_mean(spark):
    ages = [(20.0,), (None,), (30.0,), (40.0,), (None,), (41.0,), (45.0,), (46.0,)]
    out = C.fill_with_mean(pairs(spark, ages, "age double"), ["age"])
    assert [r["age"] for r in out.collect()].count(37.0) == 2


def test_mode_ties_and_blanks(spark):
    df = pairs(spark, [("b", None), ("a", 1), (" ", 2), ("b", 3), ("a", 4)], "c string, x int")
    fills = C.learn_fill_values(df, ["x"], ["c"])
    assert fills == {"x": 2.0, "c": "a"}
    assert C.learn_fill_values(df.filter("c = ' '"), [], ["c"]) == {"c": "unknown"}


TRIP = ("order_key bigint, vendor_id bigint, pu_zone bigint, do_zone bigint, pickup_ts timestamp_ntz, "
        "dropoff_ts timestamp_ntz, passengers double, distance double, rate_code bigint, payment_type bigint, "
        "fare double, tip double, airport_fee double, congestion_fee double, flag string")


def trip(fare=15.0, pickup=datetime(2023, 1, 1, 10), dropoff=datetime(2023, 1, 1, 10, 20)):
    return (1, 1, 2, 3, pickup, dropoff, None, 5.0, 1, 1, fare, 2.0, None, None, "n")


def test_valid_trip(spark):
    out = C.clean_trips(spark.createDataFrame([trip(), trip()], TRIP)).collect()
    assert [(r["fare_band"], r["duration_min"], r["passengers"]) for r in out] == [("medium", 20.0, 1.0)]


@pytest.mark.parametrize("bad", [trip(fare=-5.0), trip(pickup=None), trip(dropoff=datetime(2023, 1, 1, 9))])
def test_invalid_trip_is_dropped(spark, bad):
    assert C.clean_trips(spark.createDataFrame([bad], TRIP)).isEmpty()


def test_quality_report_flags_bad_rows(spark):
    df = spark.createDataFrame([trip(fare=-5.0), trip(dropoff=datetime(2023, 1, 1, 9))], TRIP)
    status = [r["status"] for r in Q.quality_report(df, Q.trip_checks()).collect()]
    assert status.count("FAIL") >= 2
    assert Q.quality_report(df.limit(0), Q.trip_checks()).isEmpty()


def test_quality_report_nulls(spark):
    df = pairs(spark, [(1,), (None,)], "x int")
    check = [Q.Check("positive", F.col("x") > 0, "")]
    assert Q.quality_report(df, check).first()["failed_rows"] == 0
    assert Q.quality_report(df, check, nulls_fail=True).first()["failed_rows"] == 1


def test_missing_column_is_named(spark):
    with pytest.raises(ValueError, match="nope"):
        Q.require_columns(spark.range(1), ["id", "nope"])


def test_grid_minimum():
    best = min(L.combinations({"lr": [0.001, 0.01, 0.1]}), key=lambda p: (p["lr"] - 0.01) ** 2)
    assert best == {"lr": 0.01}


def test_incremental_second_run_is_empty(spark, tmp_path):
    df = spark.createDataFrame([(datetime(2024, 1, d), d) for d in (1, 2, 3)], "ts timestamp_ntz, x int")
    args = ("ts", f"{tmp_path}/state", f"{tmp_path}/out")
    assert lake.incremental_load(df.filter("x < 3"), *args) == 2
    assert lake.incremental_load(df, *args) == 1
    assert lake.incremental_load(df, *args) == 0
    assert spark.read.parquet(f"{tmp_path}/out").count() == 3


def test_incremental_load_counts_its_own_files(spark, tmp_path):
    df = spark.createDataFrame([(datetime(2024, 1, d), d) for d in (1, 2, 3)], "ts timestamp_ntz, x int")
    args = ("ts", f"{tmp_path}/state", f"{tmp_path}/out")
    # A run that crashed before it wrote its state left three days; the source has two of them now.
    lake.overwrite_partitions(df.withColumn("load_date", F.to_date("ts")), f"{tmp_path}/out", ["load_date"])
    assert lake.incremental_load(df.filter("x < 3"), *args) == 2
    assert lake.last_loaded(spark, f"{tmp_path}/state") == "2024-01-02"


def test_classifiers_predict_after_an_incremental_load(spark, tmp_path):
    loads = spark.createDataFrame([(datetime(2024, 1, 1), 1)], "ts timestamp_ntz, x int")
    assert lake.incremental_load(loads, "ts", f"{tmp_path}/state", f"{tmp_path}/out") == 1
    data = M.assemble(spark.range(40).select((F.col("id") % 7).cast("double").alias("a"),
                                             (F.col("id") % 2).cast("double").alias("label")), ["a"])
    assert len(L.fit_score(data, data, "logistic_regression").select("prediction").collect()) == 40


def test_expressions(spark):
    df = spark.createDataFrame([("2024-01-06 10:00:00", 0.0), ("NOT_A_TIMESTAMP", 4.0)], "t string, d double")
    ts = X.parse_event_time(F.col("t"))
    out = df.select(ts.alias("ts"), X.weekend_flag(ts).alias("w"), X.safe_ratio(F.lit(2.0), F.col("d")).alias("r"),
                    X.banded(F.col("d"), [(1, "low")], "high").alias("b")).collect()
    assert [(r["w"], r["r"], r["b"]) for r in out] == [(1, None, "low"), (None, 0.5, "high")]
    assert out[1]["ts"] is None


def test_steady_rounding_takes_halves_away_from_zero(spark):
    df = spark.createDataFrame([(64.835,), (0.125,), (-0.125,), (1.0,)], "x double")
    assert [r[0] for r in df.select(X.steady(F.col("x"), 2)).collect()] == [64.84, 0.13, -0.13, 1.0]


def test_steady_rounding_leaves_large_values_alone(spark):
    df = spark.createDataFrame([(60000000.0,), (2500000000000.0,), (-2500000000000.25,)], "x double")
    assert [r[0] for r in df.select(X.steady(F.col("x"), 4)).collect()] == [60000000.0, 2500000000000.0, -2500000000000.25]
    means = df.filter("x > 0").groupBy("x").agg(X.steady(F.avg("x"), 4).alias("m")).collect()
    assert all(r["m"] == r["x"] for r in means)


def test_steady_rounding_does_not_depend_on_the_order_of_sums(spark):
    up, down = (0.1 + 0.2 + 0.075) / 3, (0.075 + 0.2 + 0.1) / 3
    df = spark.createDataFrame([(up,), (down,)], "x double")
    assert [r[0] for r in df.select(X.steady(F.col("x"), 2)).collect()] == [0.13, 0.13]
