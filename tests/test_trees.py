"""Trees grown from histograms against Spark's own, and what their passes read."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor
from pyspark.sql import functions as F

from tidewater.ml import features as M
from tidewater.ml import models as L
from tidewater.ml import trees as R

SPARKS = {"decision_tree_regressor": DecisionTreeRegressor, "gbt_regressor": GBTRegressor, "gbt": GBTClassifier}


@pytest.fixture(scope="module")
def table(spark):
    """More rows than thresholds are sampled from: one feature of few values, one with zeros, two with many values."""
    def noise(seed):
        return F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(100_003)) / 100_003

    df = spark.range(15_000).select(
        "id", F.pmod("id", F.lit(7)).cast("double").alias("a"), F.greatest(noise(1) - 0.4, F.lit(0.0)).alias("b"),
        (noise(2) * 1000).alias("c"), (-F.log(noise(3) + 1e-6)).alias("d"), noise(4).alias("e"))
    y = F.col("a") * F.col("b") - F.sqrt("c") + F.col("d") * F.col("a") + F.col("e")
    return M.assemble(df, ["a", "b", "c", "d"]).select(
        "features", y.alias("value"), (y > F.lit(-14.0)).cast("double").alias("class"))


def compared(rows, kind, **params):
    """Number of rows and largest differences of predictions to Spark's own model, after the number of different predictions."""
    if kind.startswith("gbt"):
        params = {"maxIter": 4, **params}
    data = rows.withColumn("label", F.col("class" if kind == "gbt" else "value"))
    with L.training_rows(data, ["features", "label"]) as kept:
        was = SPARKS[kind](seed=L.SEED, **params).fit(kept).transform(kept)
        now = L.estimator(kind, **params).fit(kept)
        score = vector_to_array("rawPrediction")[1] if kind == "gbt" else F.col("prediction")
        olds = was.select("features", F.col("prediction").alias("old"), score.alias("old_score"))
        both = now.transform(olds).withColumn("gap", F.abs(score - F.col("old_score")))
        return tuple(both.agg(F.count_distinct("old_score") > 8, F.count("gap"), F.max("gap") < 1e-9,
                              F.max(F.abs(F.col("old") - F.col("prediction"))) < 1e-9).first())


@pytest.mark.parametrize("kind", SPARKS)
def test_models_are_those_of_spark(table, kind):
    assert compared(table, kind) == (True, 15_000, True, True)


@pytest.mark.parametrize("kind", SPARKS)
def test_limits_of_a_tree_are_kept(table, kind):
    # Few rows: all values are seen, and there are fewer bins than rows.
    params = {"maxDepth": 3, "minInstancesPerNode": 40, "minInfoGain": 0.001, "maxBins": 12}
    assert compared(table.limit(900), kind, **params)[1:] == (900, True, True)


def test_boosted_passes_read_sums_not_rows(spark, table, monkeypatch):
    rows = table.select(vector_to_array("features").alias("features"), F.col("value").alias("label"))
    thresholds = R.find_thresholds(rows, 15_000, 4, 42)
    sizes = [len(t) + 1 for t in thresholds]
    blocks = R.to_blocks(rows, thresholds, False).collect()
    assert sum(b.n.sum() for b in blocks) == 15_000
    assert sum(len(b.n) for b in blocks) <= np.prod(sizes) < 1000
    found = R.boost(R.to_blocks(rows, thresholds, False), R.squared, sizes, 3, 0.1, depth=3, least=1, min_gain=0.0)
    # With more combinations than are summed, the blocks hold rows; the trees stay the same.
    monkeypatch.setattr(R, "MAX_CELLS", 1)
    monkeypatch.setattr(R, "BLOCK_ROWS", 1000)
    assert sum(b.bins.shape[1] for b in R.to_blocks(rows, thresholds, False).collect()) == 15_000
    plain = R.boost(R.to_blocks(rows, thresholds, False), R.squared, sizes, 3, 0.1, depth=3, least=1, min_gain=0.0)
    for (weight, tree), (other, same) in zip(found, plain, strict=True):
        assert weight == other and list(tree.feature) == list(same.feature) and list(tree.cut) == list(same.cut)
        assert abs(tree.value - same.value).max() < 1e-9


def test_sums_of_many_tasks_are_added_up_by_tasks(spark, table, monkeypatch):
    rows = table.select(vector_to_array("features").alias("features"), F.col("class").alias("label")).repartition(9)
    thresholds = R.find_thresholds(rows, 15_000, 8, 42)
    blocks, width = R.to_blocks(rows, thresholds, True), max(len(t) for t in thresholds) + 1
    once = R.level_sums(blocks, R.Tree.empty(2), 0, R.logistic, 4, width)
    monkeypatch.setattr(R, "REDUCE_PARTITIONS", 1)
    again = R.level_sums(blocks, R.Tree.empty(2), 0, R.logistic, 4, width)
    assert all((a == b).all() for a, b in zip(once, again))
    assert R.to_blocks(rows, thresholds, True, 2).getNumPartitions() == 2 < blocks.getNumPartitions()
    assert once[0].sum() == 4 * 15_000 and once[2] == [15_000]


def test_other_options_are_left_to_spark(table):
    data = table.limit(300).withColumn("label", F.col("class"))
    assert isinstance(L.estimator("gbt", maxIter=2, subsamplingRate=0.5).fit(data), GBTClassificationModel)
    assert isinstance(L.estimator("gbt", maxIter=2).fit(data), R.TreeSum)


@pytest.mark.parametrize("kind, label", [("gbt", 2.0), ("gbt", None), ("gbt_regressor", None), ("decision_tree_regressor", float("nan"))])
def test_wrong_labels_are_an_error(spark, kind, label):
    df = M.assemble(spark.createDataFrame([(1.0, 0.0), (2.0, 1.0), (3.0, label)], "x double, label double"), ["x"])
    with pytest.raises(Exception, match="labels must"):
        L.estimator(kind).fit(df)


def test_no_rows_are_an_error_and_constant_features_give_the_mean(spark):
    df = M.assemble(spark.createDataFrame([(1.0, 2.0), (1.0, 4.0)], "x double, label double"), ["x"])
    with pytest.raises(ValueError, match="no rows"):
        L.estimator("gbt_regressor").fit(df.limit(0))
    assert {r["prediction"] for r in L.estimator("decision_tree_regressor").fit(df).transform(df).collect()} == {3.0}


def test_boosted_model_is_saved_and_reloaded(table, tmp_path):
    data = table.limit(300).withColumn("label", F.col("class"))
    model = L.chain(L.estimator("gbt", maxIter=2)).fit(data)
    again = L.save_and_reload(model, f"{tmp_path}/model")
    assert [r["probability"] for r in model.transform(data).collect()] == [r["probability"] for r in again.transform(data).collect()]
