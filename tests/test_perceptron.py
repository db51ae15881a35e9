"""The perceptron with dropout: gradients, masks, partitioning and held-out accuracy."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tidewater.ml import models as L
from tidewater.ml import perceptron as N


def test_gradient_equals_finite_differences():
    draw = np.random.default_rng(1)
    weights = N.Weights.drawn(5, 7, 3, 2)
    rows, labels = draw.normal(size=(11, 5)), draw.integers(0, 3, 11)
    kept = N.kept_units(np.arange(11), 4, 7, 0.3)
    _, gradient = N.loss_and_gradient(weights, rows, labels, kept)
    flat = weights.flat()
    for i in range(len(flat)):
        ahead, behind = flat.copy(), flat.copy()
        ahead[i] += 1e-6
        behind[i] -= 1e-6
        slope = (N.loss_and_gradient(weights.like(ahead), rows, labels, kept)[0]
                 - N.loss_and_gradient(weights.like(behind), rows, labels, kept)[0]) / 2e-6
        assert abs(slope - gradient[i]) < 1e-4


def test_masks_depend_on_row_and_epoch_only():
    keys = np.array([5, -3, 2**40])
    one = N.kept_units(keys, 2, 64, 0.25)
    assert (N.kept_units(keys[::-1], 2, 64, 0.25) == one[::-1]).all()
    assert (N.kept_units(keys, 3, 64, 0.25) != one).any()
    many = N.kept_units(np.arange(4000), 0, 64, 0.25)
    assert set(np.unique(many)) == {0.0, 1 / 0.75} and abs((many == 0).mean() - 0.25) < 0.005
    assert (N.kept_units(keys, 1, 8, 0.0) == 1).all()


@pytest.fixture(scope="module")
def points(spark):
    draw = np.random.default_rng(7)
    centres = draw.normal(0, 1.0, (3, 8))
    labels = draw.integers(0, 3, 900)
    values = centres[labels] + draw.normal(0, 0.8, (900, 8))
    return spark.createDataFrame([(i, v.tolist(), float(c)) for i, (v, c) in enumerate(zip(values, labels))],
                                 "id bigint, x array<double>, label double").cache()


def test_partitioning_does_not_matter(spark, points):
    one, many = [N.train(points.repartition(n), "id", F.col("x"), "label", 3, hidden=8, epochs=2, batches=2).flat()
                 for n in (1, 7)]
    assert np.allclose(one, many, atol=1e-9)


def test_as_accurate_as_the_model_without_dropout(spark, points):
    train, test = points.filter("id % 5 != 0"), points.filter("id % 5 = 0")
    weights = N.train(train, "id", F.col("x"), "label", 3, hidden=32, epochs=12)
    own = N.with_classes(test, weights, F.col("x")).filter("label = prediction").count()

    def vectors(df):
        return df.withColumn("features", array_to_vector("x")).select("id", "features", "label")

    other = L.fit_score(vectors(train), vectors(test), "mlp", layers=[8, 32, 3]).filter("label = prediction").count()
    assert own >= other - 0.03 * test.count() and own > 0.75 * test.count()


def test_odd_rows(spark):
    schema = "id bigint, x array<double>, label double"
    with pytest.raises(ValueError, match="no rows"):
        N.train(spark.createDataFrame([], schema), "id", F.col("x"), "label", 2)
    some = spark.createDataFrame([(1, [1.0], 0.0), (2, [-1.0], 1.0), (None, [3.0], 0.0), (4, None, 1.0), (5, [2.0], None)], schema)
    weights = N.train(some, "id", F.col("x"), "label", 2, hidden=4, epochs=1, dropout=0.0)
    assert [r["prediction"] is None for r in N.with_classes(some, weights, F.col("x")).orderBy(F.asc_nulls_first("id")).collect()] == [
        False, False, False, True, False]
