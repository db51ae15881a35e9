"""Regression trees and boosting, grown level by level from histograms that tasks sum over binned rows.

A fit reads its rows once: they become blocks of bin numbers, a byte per feature, and the label. With few
features the blocks hold one entry per combination of bins instead, as a tree and the residuals of squared
error depend on the rows of a combination only by their number, sum and sum of squares. Each level of a tree
is one pass: tasks place their rows in the tree so far and count rows and residuals per node, feature and bin;
the driver gets the sums, whose size does not depend on the rows, and chooses the splits. The score of a row,
by the trees before, stands in its block.

Thresholds, splits and steps are those of Spark's own estimators, which are subclassed here, so models are the
same beyond rounding. What these do by options not known here is left to them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

# Rows of a block, and the number of combinations of bins up to which rows are summed per combination.
BLOCK_ROWS, MAX_CELLS = 1 << 16, 1 << 21
# A task of a pass gets about so many rows at least, as starting it costs more than fewer.
TASK_ROWS = 1 << 17
# Thresholds come from a sample of so many rows, or of the square of the bins, as in Spark.
SAMPLE_ROWS = 10_000
# Up to this depth and number of bins, histograms are used. A bin is a byte, and a sample that came out larger
# than expected gives some bins more than asked for.
MAX_DEPTH, MAX_BINS, LAST_BIN = 8, 128, 255
# Two features are counted in one table up to this number of bins.
PAIR_BINS = 64
# The sums of up to so many tasks go to the driver as they are; of more, they are added up by other tasks before.
REDUCE_PARTITIONS = 256

_KNOWN = {"featuresCol", "labelCol", "predictionCol", "rawPredictionCol", "probabilityCol", "maxDepth", "maxBins", "maxIter",
          "stepSize", "minInstancesPerNode", "minInfoGain", "seed", "maxMemoryInMB", "cacheNodeIds", "checkpointInterval"}
_BLOCK = "bins binary, n binary, y binary, yy binary"


@dataclass
class Tree:
    """Nodes in heap order from 1: a row goes right where its bin of ``feature`` is over ``cut``.

    The tree is complete: below a leaf all rows go left, and its value goes along.
    """

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        nodes = 1 << (depth + 1)
        return cls(np.zeros(nodes, np.int64), np.full(nodes, LAST_BIN, np.int64), np.zeros(nodes))

    @property
    def depth(self) -> int:
        return len(self.feature).bit_length() - 2

    def places(self, bins: np.ndarray, level: int) -> np.ndarray:
        """The number of the node of ``level``, from 0, that each row gets to; ``bins`` has a line per feature."""
        turns: list[np.ndarray] = []
        for step in range(level):
            first = 1 << step
            right = [bins[self.feature[k]] > self.cut[k] for k in range(first, 2 * first)]
            for turn in reversed(turns):  # of both halves below a node, the one that the row turned to
                right = [a ^ (turn & (a ^ b)) for a, b in zip(right[::2], right[1::2])]
            turns.append(right[0])
        at = np.zeros(bins.shape[1], np.int64)
        for turn in turns:
            at = 2 * at + turn
        return at

    def values(self, bins: np.ndarray) -> np.ndarray:
        return self.value[1 << self.depth:][self.places(bins, self.depth)]


@dataclass
class Block:
    """Rows of training data, or combinations of bins with the number and sums of their rows; rows have no ``n``.

    ``bins`` has a line per feature. Class labels are the bytes -1 and 1.
    """

    bins: np.ndarray
    n: np.ndarray | None
    y: np.ndarray
    yy: np.ndarray | None
    score: np.ndarray | None = None

    @property
    def squares(self) -> np.ndarray:
        return self.y * self.y if self.yy is None else self.yy


#: Sum and sum of squares of what the next tree of a boosted sum is fitted on.
Residuals = Callable[[Block], tuple[np.ndarray, np.ndarray]]


def squared(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Twice the label less the score."""
    if block.score is None:
        return block.y, block.squares
    n, score = 1.0 if block.n is None else block.n, block.score
    return 2 * (block.y - n * score), 4 * (block.squares - 2 * score * block.y + n * score * score)


def logistic(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """4 y / (1 + exp(2 y score)) for a label y of -1 or 1."""
    y = block.y.astype(np.float64)
    if block.score is None:
        return y, y * y
    with np.errstate(over="ignore"):
        one = 4 * y / (1 + np.exp(2 * y * block.score))
    return one, one * one


def _written(bins: np.ndarray, *columns: np.ndarray | None) -> pa.RecordBatch:
    """A block as one row."""
    values = [pa.array([None if v is None else v.tobytes()], pa.binary()) for v in (bins, *columns)]
    return pa.RecordBatch.from_arrays(values, ["bins", "n", "y", "yy"])


def _block(row: Row, features: int) -> Block:
    """The block of such a row; labels of a byte each are classes."""
    n, yy = (None if v is None else np.frombuffer(v, np.float64) for v in (row["n"], row["yy"]))
    bins = np.frombuffer(row["bins"], np.uint8).reshape(features, -1)
    return Block(bins, n, np.frombuffer(row["y"], np.int8 if len(row["y"]) == bins.shape[1] else np.float64), yy)


# Bins


def _thresholds(values: np.ndarray, expected: float, splits: int) -> np.ndarray:
    """Spark's thresholds from sampled values: all middles if few, else those nearest to equal shares.

    ``expected`` is the expected size of the sample. What the drawn rows lack of it counts as zeros,
    since Spark leaves zeros out of the sample.
    """
    found, counts = np.unique(values[values != 0], return_counts=True)
    if not len(found):
        return np.zeros(0)
    counts = counts.astype(np.float64)
    missing = expected - counts.sum()
    if missing > np.finfo(float).eps * counts.sum() * 100:
        at = int(np.searchsorted(found, 0.0))
        found, counts = np.insert(found, at, 0.0), np.insert(counts, at, missing)
    middles = (found[:-1] + found[1:]) / 2
    if len(middles) <= splits:
        return middles
    stride = target = expected / (splits + 1)
    upto, chosen = np.cumsum(counts), []
    for i in range(len(middles)):
        if abs(upto[i] - target) < abs(upto[i + 1] - target):
            chosen.append(middles[i])
            target += stride
    return np.array(chosen)


def _sampled(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    """The rows that ``RDD.sample`` of the JVM draws, as Spark's trees do."""
    spark = df.sparkSession
    drawn = df._jdf.javaRDD().sample(False, fraction, spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt())
    return DataFrame(spark._jsparkSession.createDataFrame(drawn, df._jdf.schema()), spark)


def find_thresholds(rows: DataFrame, count: int, bins: int, seed: int) -> list[np.ndarray]:
    """Thresholds between the bins of every feature of the ``count`` rows (features array<double>)."""
    fraction = min(1.0, max(bins * bins, SAMPLE_ROWS) / count)
    features = rows.select("features")
    drawn = (_sampled(features, fraction, seed) if fraction < 1 else features).toPandas()["features"]
    sample = np.stack(drawn.to_list()) if len(drawn) else np.zeros((0, len(features.first()["features"])))
    return [_thresholds(column, fraction * count, min(bins, count) - 1) for column in sample.T]


def _in_bins(batch: pa.RecordBatch, thresholds: list[np.ndarray]) -> np.ndarray:
    """Bin numbers of the first column, a line per feature."""
    values = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
    if not np.isfinite(values).all():
        raise ValueError("features must not be null, NaN or infinite")
    return np.stack([np.searchsorted(t, values[:, k]).astype(np.uint8) for k, t in enumerate(thresholds)])


def _labels(batch: pa.RecordBatch, classes: bool) -> np.ndarray:
    labels = batch.column(1).to_numpy(zero_copy_only=False).astype(np.float64)
    if not np.isfinite(labels).all() or classes and not np.isin(labels, (0.0, 1.0)).all():
        raise ValueError("labels must be 0 or 1" if classes else "labels must not be null, NaN or infinite")
    return (2 * labels - 1).astype(np.int8) if classes else labels


def _row_blocks(batches: Iterator[pa.RecordBatch], thresholds: list[np.ndarray], classes: bool) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def block() -> pa.RecordBatch:
        bins, y = np.concatenate([b for b, _ in held], axis=1), np.concatenate([y for _, y in held])
        held.clear()
        return _written(bins, None, y, None)

    for batch in batches:
        if batch.num_rows:
            held.append((_in_bins(batch, thresholds), _labels(batch, classes)))
        if sum(len(y) for _, y in held) >= BLOCK_ROWS:
            yield block()
    if held:
        yield block()


def _cell_sums(batches: Iterator[pa.RecordBatch], thresholds: list[np.ndarray], sizes: list[int]) -> Iterator[pa.RecordBatch]:
    """Number, sum and sum of squares of the labels per combination of bins, over the rows of a task."""
    total = np.zeros((3, int(np.prod(sizes))))
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def add() -> None:
        cells, y = np.concatenate([c for c, _ in held]), np.concatenate([y for _, y in held])
        held.clear()
        for line, weights in zip(total, (None, y, y * y)):
            line += np.bincount(cells, weights, total.shape[1])

    for batch in batches:
        if batch.num_rows:
            held.append((np.ravel_multi_index(tuple(_in_bins(batch, thresholds)), sizes), _labels(batch, False)))
        if sum(len(y) for _, y in held) >= max(BLOCK_ROWS, total.shape[1]):
            add()
    if held:
        add()
    cells = np.flatnonzero(total[0])
    if len(cells):
        yield pa.RecordBatch.from_arrays([pa.array(cells), *[pa.array(line[cells]) for line in total]], ["cell", "n", "y", "yy"])


def _cell_blocks(batches: Iterator[pa.RecordBatch], sizes: list[int]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            cell, n, y, yy = (batch.column(k).to_numpy() for k in range(4))
            bins = np.stack(np.unravel_index(cell, sizes)).astype(np.uint8)
            yield _written(bins, n, y, yy)


def to_blocks(rows: DataFrame, thresholds: list[np.ndarray], classes: bool, tasks: int = 1 << 30) -> RDD:
    """Blocks of the rows (features array<double>, label), summed per combination of bins if those are few.

    Class labels become -1 and 1; rows of classes are not summed. There are at most ``tasks`` partitions.
    """
    sizes = [len(t) + 1 for t in thresholds]
    if classes or np.prod(sizes, dtype=np.float64) > MAX_CELLS:
        blocks = rows.mapInArrow(partial(_row_blocks, thresholds=thresholds, classes=classes), _BLOCK)
    else:
        in_task = partial(_cell_sums, thresholds=thresholds, sizes=sizes)
        sums = rows.mapInArrow(in_task, "cell bigint, n double, y double, yy double")
        cells = sums.groupBy("cell").agg(*[F.sum(c).alias(c) for c in ("n", "y", "yy")])
        blocks = cells.mapInArrow(partial(_cell_blocks, sizes=sizes), _BLOCK)
    return blocks.rdd.coalesce(tasks).map(partial(_block, features=len(sizes)))


# Growth


def _level_sums(blocks: Iterator[Block], tree: Tree, level: int, residuals: Residuals, features: int, width: int
                ) -> Iterator[np.ndarray]:
    nodes, step = 1 << level, 2 if width <= PAIR_BINS else 1
    groups = [list(range(k, min(k + step, features))) for k in range(0, features, step)]
    tables = [np.zeros((2, nodes, *[width] * len(g))) for g in groups]
    squares = np.zeros(nodes)
    for block in blocks:
        at = tree.places(block.bins, level)
        sums, of_squares = residuals(block)
        squares += np.bincount(at, of_squares, nodes)
        for group, table in zip(groups, tables):
            code = at
            for k in group:
                code = code * width + block.bins[k]
            for part, weights in zip(table, (block.n, sums)):
                part += np.bincount(code, weights, part.size).reshape(part.shape)
    lines = []
    for group, table in zip(groups, tables):
        lines += [table] if len(group) == 1 else [table.sum(axis=3), table.sum(axis=2)]
    yield np.concatenate([np.stack(lines, axis=2).ravel(), squares])


def level_sums(blocks: RDD, tree: Tree, level: int, residuals: Residuals, features: int, width: int
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows and residuals per node of ``level``, feature and bin, and squared residuals per node."""
    of_task = partial(_level_sums, tree=tree, level=level, residuals=residuals, features=features, width=width)
    depth = 1 if blocks.getNumPartitions() <= REDUCE_PARTITIONS else 2
    flat, nodes = blocks.mapPartitions(of_task).treeReduce(np.add, depth), 1 << level
    rows, values = flat[:-nodes].reshape(2, nodes, features, width)
    return rows, values, flat[-nodes:]


def gains(rows: np.ndarray, values: np.ndarray, least: int, min_gain: float) -> np.ndarray:
    """Fall of the variance by each split of a node (feature, after which bin), -inf where it is not allowed."""
    n, s = rows.sum(axis=1, keepdims=True), values.sum(axis=1, keepdims=True)
    left, left_sum = rows.cumsum(axis=1)[:, :-1], values.cumsum(axis=1)[:, :-1]
    right, right_sum = n - left, s - left_sum
    allowed = (left >= max(least, 1)) & (right >= max(least, 1))
    with np.errstate(divide="ignore", invalid="ignore"):
        fall = (left_sum**2 / left + right_sum**2 / right - s**2 / n) / n
    return np.where(allowed & (fall >= min_gain), fall, -np.inf)


def grow(blocks: RDD, residuals: Residuals, sizes: list[int], depth: int, least: int, min_gain: float) -> Tree:
    """One tree on the residuals, a pass over the blocks per level."""
    tree, width = Tree.empty(depth), max(sizes)
    active = {1}
    for level in range(depth):
        rows, values, squares = level_sums(blocks, tree, level, residuals, len(sizes), width)
        below = set()
        for k in range(1 << level, 2 << level):
            n, s = rows[k - (1 << level)], values[k - (1 << level)]
            total, mean = n[0].sum(), s[0].sum() / max(n[0].sum(), 1)
            if k == 1:
                tree.value[1] = mean
            tree.value[2 * k] = tree.value[k]
            pure = level and abs(squares[k - (1 << level)] / max(total, 1) - mean * mean) < np.finfo(float).eps
            if k not in active or pure or width == 1:
                continue
            fall = gains(n, s, least, min_gain)
            feature, cut = np.unravel_index(fall.argmax(), fall.shape)
            if not fall[feature, cut] > 0:
                continue
            tree.feature[k], tree.cut[k] = feature, cut
            left, left_sum = n[feature, :cut + 1].sum(), s[feature, :cut + 1].sum()
            tree.value[2 * k] = left_sum / left
            tree.value[2 * k + 1] = (s[feature].sum() - left_sum) / (n[feature].sum() - left)
            below |= {2 * k, 2 * k + 1}
        active = below
        if not active:  # the values of the leaves go down all the way
            for k in range(2 << level, 1 << depth):
                tree.value[2 * k] = tree.value[k]
            break
    return tree


def _scored(block: Block, tree: Tree, weight: float) -> Block:
    more = weight * tree.values(block.bins)
    return replace(block, score=more if block.score is None else block.score + more)


def boost(blocks: RDD, residuals: Residuals, sizes: list[int], trees: int, rate: float, **limits) -> list[tuple[float, Tree]]:
    """Trees with their weights: the first on the labels, each later one on what the trees before it leave."""
    out: list[tuple[float, Tree]] = []
    kept = [blocks.persist(StorageLevel.MEMORY_AND_DISK)]
    try:
        for k in range(trees):
            if k:
                scored = kept[-1].map(partial(_scored, tree=out[-1][1], weight=out[-1][0]))
                kept.append(scored.persist(StorageLevel.MEMORY_AND_DISK))
            out.append((rate if k else 1.0, grow(kept[-1], residuals, sizes, **limits)))
            while len(kept) > 1:  # the passes over the newest scores have filled it from those before
                kept.pop(0).unpersist()
    finally:
        for rdd in kept:
            rdd.unpersist()
    return out


# Estimators


def _margins(vectors: pa.Array, trees: list[tuple[float, Tree]], thresholds: list[np.ndarray]) -> pa.Array:
    if not len(vectors):
        return pa.array([], pa.float64())
    bins = _in_bins(pa.RecordBatch.from_arrays([vectors], ["features"]), thresholds)
    return pa.array(sum(weight * tree.values(bins) for weight, tree in trees))


class TreeSum(Model, MLWritable, MLReadable):
    """A weighted sum of trees on binned features; of a classifier, its sign is the class."""

    def __init__(self, trees: list[tuple[float, Tree]], thresholds: list[np.ndarray], features: str, outputs: dict[str, str]):
        super().__init__()
        self.trees, self.thresholds, self.features, self.outputs = trees, thresholds, features, outputs

    def write(self) -> MLWriter:
        return _TreeWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TreeReader()

    def _margin(self) -> Column:
        trees, thresholds = self.trees, self.thresholds

        @F.arrow_udf("double")
        def margin(vectors: pa.Array) -> pa.Array:
            return _margins(vectors, trees, thresholds)

        return margin(vector_to_array(F.col(self.features)))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        if "rawPredictionCol" not in self.outputs:
            return dataset.withColumn(self.outputs["predictionCol"], self._margin())
        margin = F.col("_margin")
        chance = 1 / (1 + F.exp(-2 * margin))
        columns = {"rawPredictionCol": array_to_vector(F.array(-margin, margin)),
                   "probabilityCol": array_to_vector(F.array(1 - chance, chance)),
                   "predictionCol": (margin > 0).cast("double")}
        return dataset.withColumn("_margin", self._margin()).withColumns(
            {self.outputs[k]: v for k, v in columns.items() if self.outputs[k]}).drop("_margin")


class _TreeWriter(MLWriter):
    def __init__(self, model: TreeSum):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m = self.model
        trees = [[weight, *(part.tolist() for part in (tree.feature, tree.cut, tree.value))] for weight, tree in m.trees]
        saved = {"trees": trees, "thresholds": [t.tolist() for t in m.thresholds], "features": m.features, "outputs": m.outputs}
        DefaultParamsWriter.saveMetadata(m, path, self.sparkSession, extraMetadata=saved)


class _TreeReader(MLReader):
    def load(self, path: str) -> TreeSum:
        saved = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        trees = [(weight, Tree(*map(np.array, parts))) for weight, *parts in saved["trees"]]
        model = TreeSum(trees, [np.array(t, np.float64) for t in saved["thresholds"]], saved["features"], saved["outputs"])
        return model._resetUid(saved["uid"])


def _plain(est, dataset: DataFrame) -> bool:
    """Whether histograms do all that the estimator is asked for."""
    kinds = dataset.schema[est.getFeaturesCol()].metadata.get("ml_attr", {}).get("attrs", {})
    return (all(p.name in _KNOWN for p in est.params if est.isSet(p)) and not {"nominal", "binary"} & set(kinds)
            and 0 < est.getMaxDepth() <= MAX_DEPTH and est.getMaxBins() <= MAX_BINS)


def _fitted(est, dataset: DataFrame, residuals: Residuals, trees: int = 1, rate: float = 1.0) -> TreeSum:
    classes = residuals is logistic
    rows = dataset.select(vector_to_array(F.col(est.getFeaturesCol())).alias("features"),
                          F.col(est.getLabelCol()).cast("double").alias("label"))
    count = rows.count()
    if not count:
        raise ValueError("no rows to learn from")
    thresholds = find_thresholds(rows, count, est.getMaxBins(), est.getSeed())
    blocks = to_blocks(rows, thresholds, classes, -(-count // TASK_ROWS))
    grown = boost(blocks, residuals, [len(t) + 1 for t in thresholds], trees, rate, depth=est.getMaxDepth(),
                  least=est.getMinInstancesPerNode(), min_gain=est.getMinInfoGain())
    names = ["predictionCol", *["rawPredictionCol", "probabilityCol"] * classes]
    return TreeSum(grown, thresholds, est.getFeaturesCol(), {k: est.getOrDefault(k) for k in names})


class HistogramTreeRegressor(DecisionTreeRegressor):
    """Spark's decision tree regressor, fitted from histograms."""

    def _fit(self, dataset: DataFrame) -> Model:
        return _fitted(self, dataset, squared) if _plain(self, dataset) else super()._fit(dataset)


class HistogramGBTRegressor(GBTRegressor):
    """Spark's boosted trees for squared error, fitted from histograms."""

    def _fit(self, dataset: DataFrame) -> Model:
        if not _plain(self, dataset):
            return super()._fit(dataset)
        return _fitted(self, dataset, squared, self.getMaxIter(), self.getStepSize())


class HistogramGBTClassifier(GBTClassifier):
    """Spark's boosted trees for two classes, fitted from histograms."""

    def _fit(self, dataset: DataFrame) -> Model:
        if not _plain(self, dataset):
            return super()._fit(dataset)
        return _fitted(self, dataset, logistic, self.getMaxIter(), self.getStepSize())
