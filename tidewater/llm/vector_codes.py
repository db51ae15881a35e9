"""Vector codes: product quantisation whose nearest entries are found by Orchard's search.

A vector is cut into equal parts, and each part is named by the nearest entry of that part's
codebook. For every entry of a codebook a list names all entries by their distance from it. A
search starts at some entry and walks along its list; a nearer entry found there is jumped to, and
its list is walked instead. Entries seen once are marked and not measured again. The walk ends at
an entry more than twice as far from the present one as the query is: by the triangle inequality
no later entry can be nearer. All is whole numbers, so the end is exact and ties are too.

Codebooks are refined by rounds over the whole table: each task adds up the parts per entry, the
sums are added by shuffle, and the driver holds one codebook set per vector length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.frames import staged
from tidewater.llm.topk import usable
from tidewater.operators.joins import with_group_statistics

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
#: Quantised components lie within this bound, so that no sum of squares leaves 64 bits.
LARGEST = 1 << 26
CHUNK = 1 << 16


class Orchard:
    """Nearest entries of one codebook (int64 matrix, one row per entry)."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        gaps = entries[:, None, :] - entries[None, :, :]
        between = np.einsum("ijk,ijk->ij", gaps, gaps)
        # The entry itself comes first; entries at the same distance are in the order of their index.
        own = np.where(np.eye(len(entries), dtype=bool), -1, between)
        self.lists = np.argsort(own, axis=1, kind="stable")
        self.reach = np.take_along_axis(between, self.lists, axis=1)

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of each query's nearest entry (the lowest among equals) and its squared distance.

        All queries walk in step: each round moves every open search one place along its list.
        """
        size = len(self.entries)
        current = np.zeros(len(queries), np.int64)
        gap = queries - self.entries[0]
        best = np.einsum("ij,ij->i", gap, gap)
        seen = np.zeros((len(queries), size), bool)
        seen[:, 0] = True
        place = np.ones(len(queries), np.int64)
        walking = np.arange(len(queries)) if size > 1 else np.zeros(0, np.int64)
        while len(walking):
            at, here = current[walking], place[walking]
            # Squares: twice as far is four times the square.
            going = self.reach[at, here] <= 4 * best[walking]
            walking, at, here = walking[going], at[going], here[going]
            other = self.lists[at, here]
            place[walking] += 1
            fresh = ~seen[walking, other]
            rows, other = walking[fresh], other[fresh]
            seen[rows, other] = True
            gap = queries[rows] - self.entries[other]
            far = np.einsum("ij,ij->i", gap, gap)
            better = (far < best[rows]) | ((far == best[rows]) & (other < current[rows]))
            rows = rows[better]
            best[rows], current[rows], place[rows] = far[better], other[better], 1
            walking = walking[place[walking] < size]
        return current, best


def vector_rows(vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of each vector length in a batch and their quantised components as a matrix."""
    lengths = vectors.value_lengths().to_numpy()
    for length in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == length)
        values = vectors.take(pa.array(rows)).flatten().to_numpy().astype(np.float64)
        whole = np.floor(SCALE * values)
        if (np.abs(whole) > LARGEST).any():
            raise ValueError(f"a component lies beyond {LARGEST // SCALE}, so distances would leave 64 bits")
        yield rows, whole.astype(np.int64).reshape(len(rows), length)


def assigned(matrix: np.ndarray, books: list[Orchard]) -> tuple[np.ndarray, np.ndarray]:
    """Codes (one row per vector) and the squared distance of each part."""
    width = matrix.shape[1] // len(books)
    codes, errors = np.empty((len(matrix), len(books)), np.int64), np.empty((len(matrix), len(books)), np.int64)
    for first in range(0, len(matrix), CHUNK):
        chunk = matrix[first:first + CHUNK]
        for p, book in enumerate(books):
            found = book.nearest(chunk[:, p * width:(p + 1) * width])
            codes[first:first + CHUNK, p], errors[first:first + CHUNK, p] = found
    return codes, errors


class Codebooks:
    """One codebook per part of the vectors of each length."""

    def __init__(self, entries: dict[int, np.ndarray]):
        """``entries``: per vector length an array (part, entry, component)."""
        self.entries = entries

    def books(self) -> dict[int, list[Orchard]]:
        return {length: [Orchard(part) for part in parts] for length, parts in self.entries.items()}

    def digest(self, length: int) -> str:
        return hashlib.sha256(",".join(map(str, self.entries[length].ravel().tolist())).encode()).hexdigest()


def kept_vectors(embeddings: DataFrame, parts: int, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    vector = F.col(vector_col)
    return embeddings.filter(usable(vector) & (F.size(vector) % parts == 0)).select(
        F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).alias("label"), vector.alias("v"))


def first_codebooks(kept: DataFrame, parts: int, entries: int) -> Codebooks:
    """The parts of the ``entries`` rows with the smallest ids, per vector length."""
    order = Window.partitionBy("length").orderBy(F.col("vec_id").asc_nulls_last(), "v")
    rows = kept.select("vec_id", "v", F.size("v").alias("length")).withColumn(
        "rank", F.row_number().over(order)).filter(F.col("rank") <= entries).collect()
    found: dict[int, list] = {}
    for row in sorted(rows, key=lambda r: (r["length"], r["rank"])):
        found.setdefault(row["length"], []).append(row["v"])
    books = {}
    for length, vectors in found.items():
        _, matrix = next(vector_rows(pa.array(vectors, pa.list_(pa.float64()))))
        books[length] = matrix.reshape(len(vectors), parts, length // parts).transpose(1, 0, 2).copy()
    return Codebooks(books)


def refined(kept: DataFrame, codebooks: Codebooks) -> Codebooks:
    """Each entry replaced by the floored mean of the parts that are nearest to it; unused ones stay."""
    columns = ["length", "part", "entry", "at", "n", "total"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = codebooks.books()
        counts = {n: np.zeros(e.shape[:2], np.int64) for n, e in codebooks.entries.items()}
        totals = {n: np.zeros_like(e) for n, e in codebooks.entries.items()}
        for batch in batches:
            for _, matrix in vector_rows(batch.column(0)):
                length = matrix.shape[1]
                parts, size, width = codebooks.entries[length].shape
                codes, _ = assigned(matrix, books[length])
                slot = (codes + np.arange(parts) * size).ravel()
                order = np.argsort(slot, kind="stable")
                used, starts = np.unique(slot[order], return_index=True)
                sums = np.add.reduceat(matrix.reshape(-1, width)[order], starts, axis=0)
                totals[length].reshape(-1, width)[used] += sums
                counts[length].reshape(-1)[used] += np.diff(np.append(starts, len(slot)))
        for length, total in totals.items():
            part, entry, at = (x.ravel() for x in np.indices(total.shape))
            n = np.repeat(counts[length].ravel(), total.shape[2])
            used = n > 0
            values = [np.full(int(used.sum()), length), part[used], entry[used], at[used], n[used],
                      total.ravel()[used]]
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in values], columns)

    sums = kept.select("v").mapInArrow(run, ", ".join(f"{c} bigint" for c in columns)).groupBy(*columns[:4]).agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"))
    entries = {length: e.copy() for length, e in codebooks.entries.items()}
    for row in sums.collect():
        entries[row["length"]][row["part"], row["entry"], row["at"]] = row["total"] // row["n"]
    return Codebooks(entries)


def encoded(kept: DataFrame, codebooks: Codebooks) -> DataFrame:
    """``vec_id``, ``label``, ``codes`` (array<int>), ``error``, ``length`` of every vector."""
    label = kept.schema["label"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = codebooks.books()
        for batch in batches:
            for rows, matrix in vector_rows(batch.column(2)):
                codes, errors = assigned(matrix, books[matrix.shape[1]])
                ends = np.arange(len(rows) + 1, dtype=np.int32) * codes.shape[1]
                taken = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(taken), batch.column(1).take(taken),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(codes.ravel(), pa.int32())),
                     pa.array(errors.sum(axis=1)), pa.array(np.full(len(rows), matrix.shape[1]), pa.int32())],
                    ["vec_id", "label", "codes", "error", "length"])

    return kept.mapInArrow(run, f"vec_id bigint, label {label}, codes array<int>, error bigint, length int")


def compress(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
             id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
             ) -> tuple[DataFrame, Codebooks]:
    """Codes of all vectors, and the codebooks that turn them back into vectors.

    Rows: ``vec_id``, ``label``, ``codes`` (one index per part), ``error`` (squared distances, in
    units of 1/SCALE, summed over the parts) and ``length``. Vectors that are null, empty or hold
    null or non-finite components take no part, nor do those whose length is no multiple of
    ``parts``. Vectors of one length share codebooks. A component beyond LARGEST / SCALE in size
    is an error. A null id comes last in the order of ids; rows that share an id are ordered by
    their vectors and each keep a row. An empty table gives no rows; other columns are ignored.
    """
    kept = kept_vectors(embeddings, parts, id_col, vector_col, label_col)
    codebooks = first_codebooks(kept, parts, entries)
    for _ in range(rounds):
        codebooks = refined(kept, codebooks)
    return staged(encoded(kept, codebooks), "vector-codes"), codebooks


def code_digests(embeddings: DataFrame) -> DataFrame:
    """The codes as hex digits, with the error of each label and the checksum of the codebooks."""
    codes, codebooks = compress(embeddings)
    digest = F.lit(None).cast("string")
    for length in codebooks.entries:
        digest = F.when(F.col("length") == length, codebooks.digest(length)).otherwise(digest)
    digits = F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0")))
    return with_group_statistics(codes, ["label"], [F.sum("error").alias("label_error")]).select(
        "vec_id", F.array_join(digits, "").alias("code"), "error", "label_error", digest.alias("codebooks_sha256"))


def _round_sql(n: int) -> str:
    """CTEs: ``near{n}`` (nearest entry of every part) from ``book{n}``."""
    return f"""
near{n} AS (
  SELECT p.seq, p.part, min(list_inner_product(p.c, p.c) - 2 * list_inner_product(p.c, b.e)
         + list_inner_product(b.e, b.e)) AS error,
         arg_min(b.entry, (list_inner_product(p.c, p.c) - 2 * list_inner_product(p.c, b.e)
         + list_inner_product(b.e, b.e)) * {ENTRIES} + b.entry) AS entry
  FROM parts p JOIN book{n} b ON p.part = b.part GROUP BY p.seq, p.part
)"""


def _mean_sql(n: int) -> str:
    return f"""
means{n} AS (
  SELECT part, entry, list(m ORDER BY i) AS e FROM (
    SELECT x.part, near.entry, x.i, floor(sum(x.c) / count(*)) AS m
    FROM (SELECT seq, part, unnest(c) AS c, unnest(range(len(c))) AS i FROM parts) x
    JOIN near{n} near ON near.seq = x.seq AND near.part = x.part GROUP BY x.part, near.entry, x.i
  ) GROUP BY part, entry
), book{n + 1} AS (
  SELECT b.part, b.entry, coalesce(m.e, b.e) AS e
  FROM book{n} b LEFT JOIN means{n} m ON m.part = b.part AND m.entry = b.entry
)"""


ORACLE = f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) - 1 AS seq, vec_id, label,
         list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v
  FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (
  SELECT seq, p AS part, v[p * w + 1 : (p + 1) * w] AS c
  FROM (SELECT seq, v, len(v) // {PARTS} AS w, unnest(range({PARTS})) AS p FROM kept)
), book0 AS (SELECT part, seq AS entry, c AS e FROM parts WHERE seq < {ENTRIES}),
{_round_sql(0)}, {_mean_sql(0)}, {_round_sql(1)}, {_mean_sql(1)}, {_round_sql(2)},
codes AS (
  SELECT seq, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(error)::BIGINT AS error
  FROM near2 GROUP BY seq
), books AS (
  SELECT sha256(string_agg(array_to_string(list_transform(e, lambda x: x::BIGINT), ','), ',' ORDER BY part, entry)) AS s
  FROM book2
)
SELECT k.vec_id, c.code, c.error, sum(c.error) OVER (PARTITION BY k.label)::BIGINT AS label_error,
       (SELECT s FROM books) AS codebooks_sha256
FROM kept k JOIN codes c ON c.seq = k.seq
"""
