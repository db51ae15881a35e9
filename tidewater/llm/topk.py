"""Exact top-k search by inner product with an impact-ordered, score-at-a-time index.

A block of vectors is indexed per dimension: its posting segments hold the vectors whose component
falls into one quantised impact level. A query takes the segments of all dimensions in descending
order of what they add to a score and adds the lower end of each level to the score of its vectors.
The missing rest is bounded at any time: per dimension by the next segment still to come, or by the
width of the levels already taken. When the vectors that may still reach the k-th best lower bound
are few, the search stops, and those are scored exactly; no other vector can be a result.

Blocks of vectors and chunks of queries are paired as tiles; each tile returns its k best per query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.text import offsets_of, ranges

LEVELS = 64
BLOCK = 16_384
QUERIES = 128
ROUNDS = 16


class ImpactIndex:
    """Posting segments of one block; ``vectors`` is an int64 matrix."""

    def __init__(self, vectors: np.ndarray, levels: int = LEVELS):
        self.vectors = vectors
        n, dims = vectors.shape
        low, high = vectors.min(axis=0), vectors.max(axis=0)
        width = np.maximum(1, -(-(high - low + 1) // levels))
        level = (vectors - low) // width
        order = np.argsort(level, axis=0, kind="stable")
        self.postings = order.T.ravel().astype(np.int32)
        sorted_level = np.take_along_axis(level, order, axis=0).T
        new = np.ones((dims, n), bool)
        new[:, 1:] = sorted_level[:, 1:] != sorted_level[:, :-1]
        first = np.flatnonzero(new.ravel())
        self.starts, self.lengths = first, np.diff(np.append(first, n * dims))
        self.dim = first // n
        quantised = sorted_level.ravel()[first]
        self.least = low[self.dim] + quantised * width[self.dim]
        self.most = np.minimum(self.least + width[self.dim] - 1, high[self.dim])

    def search(self, query: np.ndarray, k: int, barred: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows that may be among the k best, and their exact scores; ``barred`` rows take no part."""
        n, dims = self.vectors.shape
        factor = query[self.dim]
        lower = np.where(factor >= 0, factor * self.least, factor * self.most)
        upper = np.where(factor >= 0, factor * self.most, factor * self.least)
        worst = np.full(dims, np.iinfo(np.int64).max)
        np.minimum.at(worst, self.dim, lower)
        gain, reach = lower - worst[self.dim], upper - worst[self.dim]
        order = np.argsort(-gain, kind="stable")
        width = np.zeros(dims, np.int64)
        np.maximum.at(width, self.dim, upper - lower)
        sums = np.zeros(n)
        alive = n - len(barred)
        k = min(k, alive)
        few = max(8 * k, n // 64)
        cuts = np.linspace(0, len(order), ROUNDS + 1).astype(int)
        for a, b in zip(cuts[:-1], cuts[1:]):
            segments = order[a:b]
            lengths = self.lengths[segments]
            at = self.postings[ranges(self.starts[segments], lengths)]
            sums += np.bincount(at, np.repeat(gain[segments], lengths), minlength=n)
            sums[barred] = -np.inf
            ahead = np.zeros(dims, np.int64)
            np.maximum.at(ahead, self.dim[order[b:]], reach[order[b:]])
            missing = np.maximum(ahead, width).sum()
            threshold = np.partition(sums, n - k)[n - k] if k else np.inf
            possible = np.flatnonzero((sums + missing >= threshold) & (sums > -np.inf))
            if len(possible) <= few:
                break
        return possible, self.vectors[possible] @ query


def quantised(vector: Column, scale: int = 1024) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")))


def bounded(vector: Column, scale: int = 1024) -> Column:
    """``quantised``, or an error if scores of such vectors could pass 2^52."""
    most = F.sqrt(F.lit(2.0 ** 52) / F.size(vector)) / scale
    large = F.exists(vector, lambda x: F.abs(x.cast("double")) >= most)
    return F.when(large, F.raise_error(F.lit("a vector component is too large for exact scores"))).otherwise(
        quantised(vector, scale))


def usable(vector: Column) -> Column:
    """Not null, not empty, and without null or non-finite components."""
    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def top_k(candidates: DataFrame, queries: DataFrame, k: int, block: int = BLOCK, chunk: int = QUERIES) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the k best candidates of each query.

    Both frames have ``vec_id`` (long, not null) and ``v`` (array<long>). Candidates with the
    query's own id are left out; vectors meet only vectors of the same length. Ties take the
    smaller vec_id. Repeated candidate rows are results each; a query id with several different
    vectors gets one list per vector.
    """
    sizes = candidates.groupBy(F.size("v").alias("dims")).count().collect()
    asked = queries.count()
    chunks = max(1, -(-asked // chunk))
    # One row per vector length, which is a property of the model that made the vectors.
    blocks = F.lit(1)
    for row in sizes:
        blocks = F.when(F.col("dims") == row["dims"], max(1, -(-row["count"] // block))).otherwise(blocks)
    left = candidates.select("vec_id", "v", F.size("v").alias("dims")).withColumn(
        "block", F.pmod(F.xxhash64("vec_id", "v"), blocks).cast("int")).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    right = queries.select(F.col("vec_id").alias("query_id"), "v", F.size("v").alias("dims")).withColumn(
        "chunk", F.pmod(F.xxhash64("query_id"), F.lit(chunks)).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int"))))
    schema = "query_id bigint, query_key bigint, vec_id bigint, score bigint"

    def tile(vectors: pa.Table, asked: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, ...]] = []
        if vectors.num_rows and asked.num_rows:
            dims = vectors["dims"][0].as_py()
            ids = vectors["vec_id"].to_numpy()
            index = ImpactIndex(flat(vectors["v"], dims))
            wanted = flat(asked["v"], dims)
            for query, query_id, key in zip(wanted, asked["query_id"].to_pylist(), asked["query_key"].to_pylist()):
                rows, scores = index.search(query, k, np.flatnonzero(ids == query_id))
                best = np.lexsort((ids[rows], -scores))[:k]
                found.append((np.full(len(best), query_id), np.full(len(best), key), ids[rows][best], scores[best]))
        parts = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64)] * 4
        return pa.table(dict(zip(("query_id", "query_key", "vec_id", "score"), parts)))

    keys = ["dims", "block", "chunk"]
    tiles = left.groupBy(*keys).cogroup(right.withColumn("query_key", F.xxhash64("v")).groupBy(*keys)).applyInArrow(
        tile, schema)
    best = Window.partitionBy("query_id", "query_key").orderBy(F.col("score").desc(), "vec_id")
    return tiles.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def flat(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    return np.concatenate([c.flatten().to_numpy() for c in column.chunks]).reshape(-1, dims)


def search_embeddings(embeddings: DataFrame, k: int = 10, every: int = 100) -> DataFrame:
    """Top k for the rows whose vec_id is divisible by ``every``, against all rows.

    Rows without id, and vectors that are null, empty or hold null or non-finite components, take
    no part. Components so large that partial sums of scores would leave the whole numbers that
    doubles hold (8192 and more at 64 dimensions) are an error. An empty table gives no rows; other
    columns are ignored.
    """
    vectors = embeddings.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), bounded(F.col("embedding")).alias("v"))
    return top_k(vectors, vectors.filter(F.col("vec_id") % every == 0), k)


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 10
"""
