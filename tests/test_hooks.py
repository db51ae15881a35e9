"""Table functions, batch prediction, trials at the same time, footers and quantile brackets."""

from __future__ import annotations

import threading
import time

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from conftest import rows
from tidewater.ml import features as M
from tidewater.ml import models as L
from tidewater.operators import pythonic as P
from tidewater.operators import quantiles as Q
from tidewater.sources import files


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_table_function_runs_on_arrow(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None), (3, "c")], "id int, words string")
    out = P.flat_map(df, lambda w: [(x,) for x in (w or "").split()], ["words"], "word string", keep=["id"])
    assert rows(out) == [(1, "a"), (1, "b"), (3, "c")]
    assert "ArrowEvalPythonUDTF" in plan_of(out)


def test_group_rows_are_fresh_and_in_order(spark):
    class Sums:
        def __init__(self):
            self.seen = []

        def eval(self, row):
            self.seen.append(row["x"])

        def terminate(self):
            yield str(self.seen), len(self.seen)

    df = spark.createDataFrame([(k, x) for x in (3, 1, 2) for k in ("a", "b", None)] + [("b", 0)], "k string, x int")
    out = P.group_rows(df.repartition(3), Sums, ["k"], ["x"], "seen string, n int")
    assert rows(out) == sorted([(3, "[1, 2, 3]"), (4, "[0, 1, 2, 3]"), (3, "[1, 2, 3]")], key=repr)


def test_model_is_loaded_once_per_worker(spark, tmp_path):
    df = M.assemble(spark.range(4000).select(
        "id", F.rand(1).alias("a"), F.rand(2).alias("b")).withColumn("label", (F.col("a") > F.col("b")).cast("double")), ["a", "b"])
    model = L.fit(L.estimator("logistic_regression"), df)
    path = f"{tmp_path}/weights/model.json"
    L.save_weights(model, path)
    load, marks = L.linear_loader(path), str(tmp_path / "loads")

    def counted():
        import os

        os.makedirs(marks, exist_ok=True)
        open(f"{marks}/{os.getpid()}-{time.time_ns()}", "w").close()
        return load()

    scored = L.score_in_batches(df.repartition(16), counted, vector_to_array("features"), 2, "mine", batch_size=50)
    assert model.transform(scored).filter("mine != prediction").count() == 0
    import os

    loads = [name.split("-")[0] for name in os.listdir(marks)]
    assert len(loads) <= 8 < 16 and len(loads) == len(set(loads))  # fewer than tasks, one per process


def test_trials_overlap_and_share_nothing(spark):
    running, most, lock = [0], [0], threading.Lock()

    def trial(i):
        def run():
            with lock:
                running[0] += 1
                most[0] = max(most[0], running[0])
            n = spark.range(1000).repartition(2).count()
            time.sleep(0.3)
            with lock:
                running[0] -= 1
            return float(n + i)
        return run

    assert L.in_parallel(spark, [trial(i) for i in range(6)], 3) == [1000.0 + i for i in range(6)]
    assert 2 <= most[0] <= 3
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


def test_a_failed_trial_cancels_the_others(spark):
    def fails():
        time.sleep(1)
        raise ArithmeticError("no result")

    def endless():
        slow = F.udf(lambda x: time.sleep(0.5) or x, "long")
        return float(spark.range(4000).repartition(4).select(slow("id").alias("y")).agg(F.sum("y")).first()[0])

    began = time.time()
    with pytest.raises(ArithmeticError):
        L.in_parallel(spark, [endless, fails, endless], 3)
    assert time.time() - began < 60
    assert not spark.sparkContext.statusTracker().getActiveJobsIds()


def test_validation_is_the_same_however_many_run(spark):
    df = M.assemble(spark.range(500).select("id", F.rand(3).alias("a")).withColumn(
        "label", 2 * F.col("a") + F.rand(4)), ["a"])
    est = L.estimator("linear_regression")
    maps = L.grid(est, {"regParam": [0.01, 0.1, 1.0, 10.0]})
    one, many = [L.validated(df, est, maps, RegressionEvaluator(), "id", parallelism=p) for p in (1, 4)]
    assert np.allclose(one.metrics, many.metrics) and one.best_map == many.best_map


def test_footers_are_read_in_tasks(spark, tmp_path):
    shapes = ["id bigint, x int", "id bigint, x double", "id int, y string, z timestamp_ntz"]
    import pyarrow as pa
    import pyarrow.parquet as pq

    paths = []
    for i in range(300):
        path = f"{tmp_path}/f{i}.parquet"
        values = ({"id": pa.array([i]), "x": pa.array([1], pa.int32())}, {"id": pa.array([i]), "x": pa.array([1.5])},
                  {"id": pa.array([i], pa.int32()), "y": pa.array(["s"]), "z": pa.array([0], pa.timestamp("us"))})[i % 3]
        pq.write_table(pa.table(values), path)
        paths.append(path)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("footers", "footers")
    try:
        out = files.read_drifted(spark, paths, {"id": "bigint", "x": "double"})
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(tracker.getJobIdsForGroup("footers")) <= 8
    assert sorted(out.columns) == ["id", "x", "y", "z"] and out.count() == 300
    assert out.agg(F.sum("id"), F.sum("x"), F.count("y")).first()[:] == (44850, 250.0, 100)
    found = files.footer_schemas(spark, paths)
    assert sorted(map(len, found.values())) == [100, 100, 100] and len(shapes) == len(found)
    # A folder that Spark wrote keeps Spark's own types.
    spark.range(3).select("id", F.current_timestamp().alias("t")).write.parquet(f"{tmp_path}/folder")
    assert files.read_drifted(spark, [f"{tmp_path}/folder"], {}).dtypes == [("id", "bigint"), ("t", "timestamp")]


def test_brackets_hold_a_ten_thousandth_of_the_rows(spark, monkeypatch):
    n = 400_000
    df = spark.range(n).select(F.pmod(F.xxhash64("id"), F.lit(10**12)).cast("double").alias("x"))
    seen = []
    refine = Q._refine

    def counted(frame, targets, options):
        for _, _, _, low, high in targets:
            seen.append(frame.filter(F.col("x").between(low, high)).count())
        return refine(frame, targets, options)

    monkeypatch.setattr(Q, "_refine", counted)
    found = Q.exact_quantiles(df, {"x": [0.25, 0.5, 0.99]})["x"]
    values = np.sort(df.toPandas()["x"].to_numpy())
    assert found == [values[int(np.ceil(p * n)) - 1] for p in (0.25, 0.5, 0.99)]
    assert all(s <= 3e-4 * n for s in seen[:3])


def test_table_function_rows_are_spread(spark, monkeypatch):
    monkeypatch.setattr(P, "SPREAD_ROWS", 10)
    df = spark.range(30).select("id", F.lit("a b").alias("words")).coalesce(1)
    out = P.flat_map(df, lambda w: [(x,) for x in w.split()], ["words"], "word string", keep=["id"])
    assert out.select(F.spark_partition_id().alias("p"), "id").distinct().groupBy("p").count().count() == 4
    assert out.count() == 60


def test_training_rows_keep_places_and_drop_what_a_fit_does_not_read(spark):
    df = M.assemble(spark.range(500).select("id", F.col("id").cast("double").alias("label")), ["id"])
    with L.training_rows(df, ["features", "label"]) as kept:
        assert kept.columns == ["features", "label"]
        places = rows(kept.select("label", F.spark_partition_id().alias("p")))
    usual = df.repartition(L.TRAIN_PARTITIONS, *df.columns)
    assert places == rows(usual.select("label", F.spark_partition_id().alias("p")))
