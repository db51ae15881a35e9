"""Model fitting, tuning and batch scoring with Spark ML estimators."""

from __future__ import annotations

import json
import random
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from contextlib import contextmanager
from itertools import product
from typing import NamedTuple

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.functions import predict_batch_udf
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tidewater.functions.expressions import hash_percent
from tidewater.ml.trees import HistogramGBTClassifier, HistogramGBTRegressor, HistogramTreeRegressor
from tidewater.operators.layout import persisted
from tidewater.sources.stores import open_store

SEED = 42
# Training rows are dealt to this many partitions, or to more when a partition would hold over so many rows.
TRAIN_PARTITIONS, TRAIN_ROWS = 16, 1_000_000

# Default hyper-parameters.
ESTIMATORS = {
    "linear_regression": lambda **p: LinearRegression(**{"maxIter": 20, "regParam": 0.1, **p}),
    "logistic_regression": lambda **p: LogisticRegression(**{"maxIter": 20, "regParam": 0.01, **p}),
    "decision_tree": lambda **p: DecisionTreeClassifier(**{"seed": SEED, **p}),
    "random_forest": lambda **p: RandomForestClassifier(**{"numTrees": 20, "seed": SEED, **p}),
    "gbt": lambda **p: HistogramGBTClassifier(**{"maxIter": 20, "seed": SEED, **p}),
    "mlp": lambda **p: MultilayerPerceptronClassifier(**{"maxIter": 50, "seed": SEED, **p}),
    "decision_tree_regressor": lambda **p: HistogramTreeRegressor(**{"seed": SEED, **p}),
    "random_forest_regressor": lambda **p: RandomForestRegressor(**{"numTrees": 20, "seed": SEED, **p}),
    "gbt_regressor": lambda **p: HistogramGBTRegressor(**{"maxIter": 20, "seed": SEED, **p}),
    "kmeans": lambda **p: KMeans(**{"k": 3, "seed": SEED, **p}),
}


def estimator(kind: str, **params) -> Estimator:
    return ESTIMATORS[kind](**params)


@contextmanager
def training_rows(train: DataFrame, columns: Sequence[str] | None = None) -> Iterator[DataFrame]:
    """Training rows computed once and kept while models are fitted on them.

    Fitting samples and sums by partition, so rows are dealt by their own hash to a number of
    partitions that follows from their count, and ordered by it: a fitted model depends neither on
    the cluster nor on how the table is cut into files. ``columns`` are those that the fit reads:
    the whole row decides its place, but only they move and are kept.
    """
    n = max(TRAIN_PARTITIONS, -(-train.count() // TRAIN_ROWS))
    names = train.columns if columns is None else list(columns)
    # The partition that repartition(n, *train.columns) would choose.
    placed = train.select(*names, F.pmod(F.hash(*train.columns), F.lit(n)).alias("_place"),
                          F.xxhash64(*train.columns).alias("_order"))
    dealt = placed.repartitionById(n, F.col("_place")).sortWithinPartitions("_order")
    with persisted(dealt.select(*names)) as kept:
        yield kept


def fit(est: Estimator, train: DataFrame, columns: Sequence[str] | None = None):
    with training_rows(train, columns) as rows:
        return est.fit(rows)


def fit_score(train: DataFrame, test: DataFrame, kind: str, **params) -> DataFrame:
    """Fit on ``train`` and add predictions to ``test``."""
    return fit(estimator(kind, **params), train).transform(test)


def save_weights(model: Model, path: str) -> None:
    """Coefficients, intercept and threshold of a binary linear classifier as one JSON file."""
    store, inner = open_store(path)
    store.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    saved = {"coefficients": model.coefficients.toArray().tolist(), "intercept": float(model.intercept),
             "threshold": float(model.getThreshold())}
    with store.open_output_stream(inner) as sink:
        sink.write(json.dumps(saved).encode())


def linear_loader(path: str) -> Callable[[], Callable[[np.ndarray], np.ndarray]]:
    """A loader of saved weights: it reads the file and returns the function that scores a chunk of rows."""
    def load():
        store, inner = open_store(path)
        with store.open_input_stream(inner) as source:
            saved = json.loads(source.read())
        weights, threshold = np.array(saved["coefficients"]), saved["threshold"]

        def predict(rows: np.ndarray) -> np.ndarray:
            probability = 1 / (1 + np.exp(-(rows @ weights + saved["intercept"])))
            return (probability > threshold).astype(np.float64)

        return predict

    return load


def score_in_batches(df: DataFrame, load: Callable[[], Callable], features: Column, size: int,
                     output: str = "prediction", batch_size: int = 4096) -> DataFrame:
    """Predictions of ``features`` (an array column of length ``size``), in chunks of ``batch_size`` rows.

    ``load`` runs once per Python worker, which keeps what it returns for all its tasks; rows stay
    in their partitions.
    """
    predict = predict_batch_udf(load, return_type=DoubleType(), batch_size=batch_size, input_tensor_shapes=[[size]])
    return df.withColumn(output, predict(features))


def grid(est: Estimator, values: dict[str, Sequence]) -> list[dict]:
    """All combinations of the given parameter values."""
    builder = ParamGridBuilder()
    for name, options in values.items():
        builder = builder.addGrid(est.getParam(name), list(options))
    return builder.build()


def combinations(values: dict[str, Sequence]) -> list[dict]:
    """All combinations of the given values as plain dictionaries."""
    return [dict(zip(values, combo)) for combo in product(*values.values())]


def random_combinations(values: dict[str, Sequence], trials: int, seed: int = SEED) -> list[dict]:
    """``trials`` different combinations drawn with a seed, or all of them if there are fewer."""
    every = combinations(values)
    return random.Random(seed).sample(every, min(trials, len(every)))


def random_grid(est: Estimator, ranges: dict[str, Sequence], trials: int, seed: int = SEED) -> list[dict]:
    """``trials`` parameter maps drawn with a seed from the given options."""
    draw = random.Random(seed)
    return [{est.getParam(k): draw.choice(list(v)) for k, v in ranges.items()} for _ in range(trials)]


def cross_validated(df: DataFrame, est: Estimator, maps: list[dict], evaluator: Evaluator, key: str,
                    folds: int = 3, parallelism: int = 4):
    """Cross-validation over folds given by a hash of the row key, refit on all rows.

    The folds do not change when the table is partitioned differently.
    """
    folded = df.withColumn("_fold", (hash_percent(F.col(key), 9_999) % folds).cast("int"))
    search = CrossValidator(estimator=est, estimatorParamMaps=maps, evaluator=evaluator,
                            numFolds=folds, foldCol="_fold", parallelism=parallelism, seed=SEED)
    return fit(search, folded)


class Validated(NamedTuple):
    """The metric of each tried parameter map, the best map and the model refit with it on all rows."""

    metrics: list[float]
    best_map: dict
    best_model: Model


def in_parallel(spark: SparkSession, trials: Sequence[Callable[[], float]], parallelism: int = 4) -> list[float]:
    """Results of trials that run at the same time, at most ``parallelism`` of them.

    Every trial's jobs form a job group in a scheduler pool of its own, so with the FAIR scheduler
    trials share the executors evenly. When one fails, the others are cancelled and the error is raised.
    """
    context = spark.sparkContext
    name = f"trials-{uuid.uuid4().hex}"

    def run(number: int, trial: Callable[[], float]) -> float:
        context.setJobGroup(f"{name}-{number}", f"trial {number}", interruptOnCancel=True)
        context.setLocalProperty("spark.scheduler.pool", f"{name}-{number}")
        try:
            return trial()
        finally:
            context.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(run), i, trial) for i, trial in enumerate(trials)]
        done, _ = wait(running, return_when=FIRST_EXCEPTION)
        failed = next((f for f in running if f in done and f.exception()), None)
        if failed is not None:
            for i, other in enumerate(running):
                other.cancel()
                context.cancelJobGroup(f"{name}-{i}")
            raise failed.exception()
        return [f.result() for f in running]


def validated(df: DataFrame, est: Estimator, maps: list[dict], evaluator: Evaluator, key: str,
              ratio: float = 0.8, parallelism: int = 4, columns: Sequence[str] | None = None) -> Validated:
    """Best parameters on one train/validation split, refit on all rows; trials run at the same time.

    The split hashes the row key, so it does not change when the table is partitioned differently.
    ``columns`` are those that the estimator and the evaluator read; all, unless given.
    """
    names = df.columns if columns is None else list(columns)
    held_out = hash_percent(F.col(key), 9_999) >= int(ratio * 9_999)
    with (training_rows(df.filter(~held_out), columns) as train,
          persisted(df.filter(held_out).select(*names)) as validation):
        def trial(m: dict) -> Callable[[], float]:
            return lambda: float(evaluator.evaluate(est.fit(train, m).transform(validation)))

        metrics = in_parallel(df.sparkSession, [trial(m) for m in maps], parallelism)
    best = (max if evaluator.isLargerBetter() else min)(range(len(maps)), key=metrics.__getitem__)
    return Validated(metrics, maps[best], fit(est.copy(maps[best]), df, columns))


def tuning_table(spark, maps: list[dict], metrics: Sequence[float], metric: str, digits: int = 6) -> DataFrame:
    """One row per tried parameter map with its rounded metric."""
    rows = [(i, ", ".join(f"{p.name}={v}" for p, v in sorted(m.items(), key=lambda kv: kv[0].name)),
             round(float(value), digits)) for i, (m, value) in enumerate(zip(maps, metrics))]
    return spark.createDataFrame(rows, f"trial bigint, params string, {metric} double")


def save_and_reload(model: PipelineModel, path: str) -> PipelineModel:
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


def chain(*stages) -> Pipeline:
    return Pipeline(stages=list(stages))
