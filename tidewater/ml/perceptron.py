"""A perceptron with one hidden layer and dropout, trained by distributed mini-batch gradients.

Rows are staged once, in a folder per mini-batch chosen by a hash of the row key, so a step reads
its own rows only. Each task sums the gradient over its rows; the sums are added by position in a
shuffle with map-side combining, and the driver, which holds the weights only, takes the step.
Which hidden units a row drops depends on its key and the epoch, so neither the partitioning nor
a retried task changes the result beyond rounding.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.session import scratch_path


def mixed(x: np.ndarray) -> np.ndarray:
    """Splitmix64: a well-mixed 64-bit hash of whole numbers."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def kept_units(keys: np.ndarray, epoch: int, units: int, dropout: float) -> np.ndarray:
    """Per row and hidden unit 0 where it is dropped, else 1 / (1 - dropout)."""
    rows = mixed(keys.astype(np.int64).view(np.uint64) ^ mixed(np.array([epoch], np.uint64)))
    drawn = mixed(rows[:, None] ^ mixed(np.arange(units, dtype=np.uint64))[None, :])
    uniform = (drawn >> np.uint64(11)).astype(np.float64) * 2.0**-53
    return (uniform >= dropout) / (1.0 - dropout)


@dataclass
class Weights:
    inner: np.ndarray
    inner_bias: np.ndarray
    outer: np.ndarray
    outer_bias: np.ndarray

    @classmethod
    def drawn(cls, inputs: int, hidden: int, classes: int, seed: int) -> Weights:
        draw = np.random.default_rng(seed)
        return cls(draw.normal(0, np.sqrt(2 / inputs), (inputs, hidden)), np.zeros(hidden),
                   draw.normal(0, np.sqrt(1 / hidden), (hidden, classes)), np.zeros(classes))

    def flat(self) -> np.ndarray:
        return np.concatenate([w.ravel() for w in (self.inner, self.inner_bias, self.outer, self.outer_bias)])

    def like(self, flat: np.ndarray) -> Weights:
        parts, at = [], 0
        for w in (self.inner, self.inner_bias, self.outer, self.outer_bias):
            parts.append(flat[at:at + w.size].reshape(w.shape))
            at += w.size
        return Weights(*parts)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return np.maximum(rows @ self.inner + self.inner_bias, 0) @ self.outer + self.outer_bias


def loss_and_gradient(weights: Weights, rows: np.ndarray, labels: np.ndarray, kept: np.ndarray) -> tuple[float, np.ndarray]:
    """Cross-entropy summed over the rows and its gradient, under the given dropout."""
    before = rows @ weights.inner + weights.inner_bias
    hidden = np.maximum(before, 0) * kept
    scores = hidden @ weights.outer + weights.outer_bias
    scores -= scores.max(axis=1, keepdims=True)
    chances = np.exp(scores)
    chances /= chances.sum(axis=1, keepdims=True)
    at = np.arange(len(rows))
    loss = -np.log(np.maximum(chances[at, labels], 1e-300)).sum()
    chances[at, labels] -= 1
    back = (chances @ weights.outer.T) * kept * (before > 0)
    gradient = Weights(rows.T @ back, back.sum(axis=0), hidden.T @ chances, chances.sum(axis=0))
    return float(loss), gradient.flat()


def summed_gradient(batch: DataFrame, weights: Weights, epoch: int, dropout: float) -> tuple[int, np.ndarray]:
    """Number of rows and mean gradient of one mini-batch."""
    units = len(weights.inner_bias)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros(weights.flat().size), 0
        for part in batches:
            if not part.num_rows:
                continue
            keys = part.column(0).to_numpy()
            rows = part.column(1).flatten().to_numpy().reshape(part.num_rows, -1).astype(np.float64)
            total += loss_and_gradient(weights, rows, part.column(2).to_numpy(), kept_units(keys, epoch, units, dropout))[1]
            count += part.num_rows
        if count:
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(-1, total.size, dtype=np.int32)), pa.array(np.append(float(count), total))], ["at", "value"])

    sums = batch.select("key", "features", "label").mapInArrow(run, "at int, value double").groupBy("at").agg(
        F.sum("value").alias("value")).toPandas().sort_values("at")
    if not len(sums):
        return 0, np.zeros(0)
    values = sums["value"].to_numpy()
    return int(values[0]), values[1:] / values[0]


def train(rows: DataFrame, key: str, features: Column, label: str, classes: int, hidden: int = 64, dropout: float = 0.2,
          epochs: int = 15, batches: int = 4, rate: float = 0.01, seed: int = 42) -> Weights:
    """Weights fitted by Adam steps over ``batches`` mini-batches per epoch.

    ``key`` is a whole number that names a row, ``features`` an array of numbers of one length,
    ``label`` a class from 0. Rows without one of these are left out; an empty table is an error.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, "perceptron")
    ready = rows.select(F.col(key).cast("bigint").alias("key"), features.cast("array<float>").alias("features"),
                        F.col(label).cast("int").alias("label")).dropna()
    ready.withColumn("batch", F.pmod(F.xxhash64("key"), F.lit(batches)).cast("int")).write.partitionBy("batch").parquet(path)
    staged = spark.read.schema("key bigint, features array<float>, label int, batch int").parquet(path)
    first = staged.select(F.size("features").alias("n")).first()
    if first is None:
        raise ValueError("no rows to learn from")
    weights = Weights.drawn(first["n"], hidden, classes, seed)
    speed, spread, step = 0.0, 0.0, 0
    for epoch in range(epochs):
        for number in np.random.default_rng((seed, epoch)).permutation(batches):
            count, gradient = summed_gradient(staged.filter(F.col("batch") == int(number)), weights, epoch, dropout)
            if not count:
                continue
            step += 1
            speed, spread = 0.9 * speed + 0.1 * gradient, 0.999 * spread + 0.001 * gradient**2
            move = speed / (1 - 0.9**step) / (np.sqrt(spread / (1 - 0.999**step)) + 1e-8)
            weights = weights.like(weights.flat() - rate * move)
    return weights


def with_classes(rows: DataFrame, weights: Weights, features: Column, output: str = "prediction") -> DataFrame:
    """The likeliest class of each row, as a double; null features give null."""
    @F.pandas_udf("double")
    def classes(vectors: pd.Series) -> pd.Series:
        known = vectors.notna()
        found = pd.Series(np.nan, index=vectors.index)
        if known.any():
            found[known] = weights.scores(np.stack(vectors[known].to_list()).astype(np.float64)).argmax(axis=1)
        return found

    return rows.withColumn(output, classes(features.cast("array<float>")))
