"""Feature preparation, model quality bounds, tuning and run records."""

from __future__ import annotations

import math

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from conftest import rows
from tidewater.ml import evaluation as E
from tidewater.ml import features as M
from tidewater.ml import models as L
from tidewater.ml import statistics as ST
from tidewater.operators.sampling import split_two


@pytest.fixture(scope="module")
def line(spark):
    """y = 3 a - 2 b + 1 with a class at y > 0."""
    a, b = (F.col("id") * 37 % 100) / 50 - 1, (F.col("id") * 61 % 100) / 50 - 1
    df = spark.range(600).select("id", a.alias("a"), b.alias("b"), (3 * a - 2 * b + 1).alias("y"))
    return M.assemble(df, ["a", "b"]).withColumn("c", (F.col("y") > 0).cast("double"))


def test_string_index_ties_are_alphabetical(spark):
    df = spark.createDataFrame([("Prepaid",), ("Postpaid",)] * 4, "t string")
    assert rows(M.index_strings(df, ["t"]).distinct()) == [("Postpaid", 0.0), ("Prepaid", 1.0)]


def test_unseen_category_is_kept(spark):
    fitted = M.string_indexer(["t"]).fit(spark.createDataFrame([("x",), ("x",), ("y",)], "t string"))
    assert fitted.transform(spark.createDataFrame([("z",)], "t string")).first()["t_idx"] == 2.0


def test_tabular_features_learn_on_train_only(spark):
    train = spark.createDataFrame([(1.0, "a"), (3.0, "a"), (None, "b")], "x double, c string")
    test = spark.createDataFrame([(None, " "), (100.0, "zz")], "x double, c string")
    prepared = M.TabularFeatures(["x"], ["c"]).fit(train)
    assert prepared.fills == {"x": 1.0, "c": "a"}
    out = prepared.transform(test).select(vector_to_array("features").alias("f"), "c").collect()
    assert out[0]["c"] == "a"
    assert out[0]["f"][1] == 0.0 and out[1]["f"][1] == 2.0


def test_assemble_rejects_nulls(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "x double")
    with pytest.raises(Exception, match="null|Null"):
        M.assemble(df, ["x"]).collect()
    assert M.assemble(df, ["x"], invalid="skip").count() == 1


def test_polynomial_width(spark):
    names = [f"p{i}" for i in range(9)]
    df = spark.createDataFrame([(1.0, 2.0, 3.0)], "a double, b double, c double")
    assert M.polynomial(df, ["a", "b", "c"], 2, names).select(names).first()[8] == 9.0


def test_components_are_ordered_and_signed(line):
    out = M.principal_components(line, "features", 2)
    spread = out.agg(F.variance("pc1"), F.variance("pc2")).first()
    assert spread[0] >= spread[1] > 0


def test_regression(line):
    train, test = split_two(line.withColumn("label", F.col("y")), "id")
    scored = L.fit_score(train, test, "linear_regression", regParam=0.0)
    report = E.regression_metrics(scored).first()
    assert report["r2"] > 0.999 and report["rmse"] < 0.01
    assert E.regression_metrics(L.fit_score(train, test, "random_forest_regressor")).first()["r2"] > 0.9


@pytest.mark.parametrize("kind", ["logistic_regression", "decision_tree", "random_forest", "gbt"])
def test_classifiers(line, kind):
    train, test = split_two(line.withColumn("label", F.col("c")), "id")
    params = {"maxIter": 5} if kind == "gbt" else {}
    assert E.binary_metrics(L.fit_score(train, test, kind, **params)).first()["accuracy"] > 0.9


def test_kmeans_finds_separated_groups(spark):
    df = spark.range(300).select((F.col("id") % 3 * 100 + F.col("id") % 7).cast("double").alias("x"))
    out = L.estimator("kmeans").fit(M.assemble(df, ["x"])).transform(M.assemble(df, ["x"]))
    assert [r["count"] for r in out.groupBy("prediction").count().collect()] == [100, 100, 100]


def test_cross_validation_folds_ignore_partitioning(line):
    data = line.withColumn("label", F.col("y"))
    est = L.estimator("linear_regression")
    maps = L.grid(est, {"regParam": [0.0, 1.0]})
    first, second = [
        L.cross_validated(df, est, maps, RegressionEvaluator(metricName="rmse"), "id").avgMetrics
        for df in (data, data.repartition(7))]
    assert all(math.isclose(a, b, rel_tol=1e-6, abs_tol=1e-6) for a, b in zip(first, second))
    assert first[0] < first[1]


def test_validation_split_ignores_partitioning(line):
    data = line.withColumn("label", F.col("y"))
    est = L.estimator("linear_regression")
    maps = L.grid(est, {"regParam": [0.0, 1.0]})
    first, second = [L.validated(df, est, maps, RegressionEvaluator(metricName="rmse"), "id")
                     for df in (data, data.repartition(7))]
    assert all(math.isclose(a, b, rel_tol=1e-6, abs_tol=1e-6) for a, b in zip(first.metrics, second.metrics))
    assert first.best_map == maps[0]


def test_area_under_curve_counts_ties_half(spark):
    data = [(1.0, 3), (0.0, 3), (1.0, 5), (0.0, 1), (0.0, 4), (None, 9), (1.0, None)]
    df = spark.createDataFrame(data, "label double, score int")
    # Pairs won by a 1: 3 beats 1 and ties 3; 5 beats all three.
    assert E.area_under_curve(df, rows_per_chunk=2).first()["auc"] == round(4.5 / 6, 6)
    assert E.area_under_curve(df.filter("label = 1")).first()["auc"] is None


def test_random_grid_is_seeded():
    est = L.estimator
    options = {"regParam": [0.1, 0.2, 0.3], "maxIter": [5, 10]}

    def draw(spark_estimator):
        return [sorted((p.name, v) for p, v in m.items()) for m in L.random_grid(spark_estimator, options, 5)]

    one = est("linear_regression")
    assert draw(one) == draw(one)


def test_reports_agree_with_counts(spark):
    cells = [(1.0, 1.0)] * 3 + [(1.0, 0.0)] + [(0.0, 1.0)] * 2 + [(0.0, 0.0)] * 4
    df = spark.createDataFrame(cells, "label double, prediction double")
    m = E.binary_metrics(df).first()
    assert (m["accuracy"], m["precision"], m["recall"], m["f1"]) == (0.7, 0.6, 0.75, round(2 * 0.6 * 0.75 / 1.35, 6))
    by_class = {r["class"]: r["support"] for r in E.class_report(df).collect()}
    assert by_class == {0.0: 6, 1.0: 4}


def test_empty_predictions_do_not_raise(spark):
    empty = spark.createDataFrame([], "label double, prediction double")
    assert E.binary_metrics(empty).first()["n"] == 0
    assert E.regression_metrics(empty).first()["rmse"] is None


def test_spearman_handles_ties_in_chunks(spark):
    df = spark.createDataFrame([(i % 5, (i % 5) ** 3) for i in range(50)] + [(None, 1)], "a int, b int")
    assert ST.spearman(df, "a", "b", rows_per_chunk=2).first()["rho"] == 1.0


def test_leaderboard_orders_runs(spark, tmp_path):
    for run, score in (("r1", 0.5), ("r2", 0.9)):
        E.log_run(spark, f"{tmp_path}/runs", run, "e", {"lr": 0.1, "depth": 3}, {"f1": score})
    board = E.leaderboard(spark.read.parquet(f"{tmp_path}/runs"), "f1").collect()
    assert [(r["run_id"], r["params"]) for r in board] == [("r2", "depth=3, lr=0.1"), ("r1", "depth=3, lr=0.1")]


def test_save_and_reload(line, tmp_path):
    data = line.withColumn("label", F.col("c")).select("a", "b", "label")
    from pyspark.ml.feature import VectorAssembler

    model = L.chain(VectorAssembler(inputCols=["a", "b"], outputCol="features"), L.estimator("logistic_regression")).fit(data)
    again = L.save_and_reload(model, f"{tmp_path}/model")
    assert rows(model.transform(data).select("prediction")) == rows(again.transform(data).select("prediction"))
