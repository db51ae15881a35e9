"""Shards of near-equal bytes by a k-d tree over metadata.

The tree starts with one node that holds all rows. A node of k shards is cut in two, of k // 2 and
the rest, along the dimension whose values reach widest in it (relative to the whole table), at
the weighted median: the place where the bytes before it come closest to its share. Rows with the
same value are ordered by the other dimensions, then by a hash of the text and last by a row
number, so every cut is exact however many rows share a value.

Medians are found without moving rows. All nodes of a level search at once: a pass adds up bytes
per node and bin of the current bracket (map-side sums, at most BINS bins per node), the driver
picks each node's bin, and the next pass looks into it. Only a narrow table (sizes, coordinates,
hash, row number) is read again. What the driver holds follows the number of shards.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.frames import staged
from tidewater.session import scratch_path

ROW_BYTES = 16
BINS = 1024
#: Equal texts with equal metadata are cut only if they hold more than this part of a shard's bytes.
GROUP_SHARE = 0.01
LEAST, MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


@dataclass
class Node:
    """A node of ``leaves`` shards from number ``first`` on. Rows whose key is at most ``cut`` go left."""
    first: int
    leaves: int
    order: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    left: Node | None = None
    right: Node | None = None


class Search:
    """The search for one node's cut: key parts before ``part`` are decided, the rest lies in [low, high]."""

    def __init__(self, node: Node, order: list[int], low: int, high: int, aim: float):
        self.node, self.order, self.low, self.high, self.aim = node, order, low, high, aim
        self.decided: list[int] = []
        self.before = 0.0

    def bins(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of ``key`` inside the bracket, and their bins."""
        inside = np.ones(key.shape[1], bool)
        for part, value in zip(self.order, self.decided):
            inside &= key[part] == value
        at = key[self.order[len(self.decided)]]
        inside &= (at >= self.low) & (at <= self.high)
        rows = np.flatnonzero(inside)
        width = (self.high - self.low) // BINS + 1
        return rows, (at[rows] - self.low) // width

    def narrow(self, found: list[tuple], smallest: float, tie_part: int) -> bool:
        """Take the bin that holds the aim; ``found`` is in order of the bins. Whether the cut is known."""
        for i, (_, size, low, high, next_low, next_high) in enumerate(found):
            if self.before + size >= self.aim or i == len(found) - 1:
                break
            self.before += size
        if low != high:
            self.low, self.high = low, high
            return False
        self.decided.append(low)
        part = self.order[len(self.decided) - 1]
        last = len(self.decided) == len(self.order)
        if last or (part == tie_part and size <= smallest):
            # One row, or equal texts that stay together: on the side that comes closer to the aim.
            take = self.before + size - self.aim <= self.aim - self.before
            rest = len(self.order) - len(self.decided)
            self.node.order = self.order
            self.node.cut = self.decided + [MOST if take else LEAST] * rest
            if last and not take:
                self.node.cut[-1] -= 1
            return True
        self.low, self.high = next_low, next_high
        return False


def goes_left(node: Node, key: np.ndarray) -> np.ndarray:
    left = np.ones(key.shape[1], bool)
    for part, value in reversed(list(zip(node.order, node.cut))):
        left = (key[part] < value) | ((key[part] == value) & left)
    return left


def descend(root: Node, key: np.ndarray) -> Iterator[tuple[Node, np.ndarray]]:
    """The undivided nodes and the rows of ``key`` in each."""
    todo = [(root, np.arange(key.shape[1]))]
    while todo:
        node, rows = todo.pop()
        if node.left is None:
            yield node, rows
            continue
        left = goes_left(node, key[:, rows])
        todo += [(node.left, rows[left]), (node.right, rows[~left])]


def key_matrix(batch: pa.RecordBatch, parts: int) -> np.ndarray:
    return np.stack([batch.column(i).to_numpy() for i in range(parts)])


def node_ranges(base: DataFrame, root: Node, parts: int) -> dict[int, tuple]:
    """Per undivided node: bytes, and the least and largest value of each key part."""
    names = [f"k{i}" for i in range(parts)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list] = {}
        for batch in batches:
            key, size = key_matrix(batch, parts), batch.column(parts).to_numpy()
            for node, rows in descend(root, key):
                if not len(rows):
                    continue
                new = [int(size[rows].sum()), *key[:, rows].min(axis=1).tolist(), *key[:, rows].max(axis=1).tolist()]
                old = totals.get(node.first)
                totals[node.first] = new if old is None else [
                    old[0] + new[0], *map(min, old[1:1 + parts], new[1:1 + parts]),
                    *map(max, old[1 + parts:], new[1 + parts:])]
        rows = [[first, *values] for first, values in totals.items()]
        columns = list(zip(*rows)) if rows else [[] for _ in range(2 + 2 * parts)]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns],
                                         ["node", "bytes", *[f"a{i}" for i in range(parts)],
                                          *[f"z{i}" for i in range(parts)]])

    schema = ", ".join(f"{c} bigint" for c in ("node", "bytes", *[f"a{i}" for i in range(parts)],
                                               *[f"z{i}" for i in range(parts)]))
    found = base.select(*names, "size").mapInArrow(run, schema).groupBy("node").agg(
        F.sum("bytes"), *[F.min(f"a{i}") for i in range(parts)], *[F.max(f"z{i}") for i in range(parts)]).collect()
    return {row[0]: tuple(row[1:]) for row in found}


def histogram(base: DataFrame, root: Node, searches: dict[int, Search], parts: int) -> dict[int, list[tuple]]:
    """Per searching node its bins in order: (bin, bytes, least, most, least and most of the next key part)."""
    names = [f"k{i}" for i in range(parts)]
    columns = ["node", "bin", "bytes", "low", "high", "next_low", "next_high"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, size = key_matrix(batch, parts), batch.column(parts).to_numpy()
            for node, rows in descend(root, key):
                search = searches.get(node.first)
                if search is None or not len(rows):
                    continue
                inner = key[:, rows]
                inside, at = search.bins(inner)
                if not len(inside):
                    continue
                level = len(search.decided)
                now = inner[search.order[level]][inside]
                then = inner[search.order[min(level + 1, parts - 1)]][inside]
                order = np.argsort(at, kind="stable")
                bins, starts = np.unique(at[order], return_index=True)
                values = [np.full(len(bins), node.first), bins,
                          np.add.reduceat(size[rows][inside][order], starts),
                          np.minimum.reduceat(now[order], starts), np.maximum.reduceat(now[order], starts),
                          np.minimum.reduceat(then[order], starts), np.maximum.reduceat(then[order], starts)]
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in values], columns)

    found = base.select(*names, "size").mapInArrow(run, ", ".join(f"{c} bigint" for c in columns)).groupBy(
        "node", "bin").agg(F.sum("bytes"), F.min("low"), F.max("high"), F.min("next_low"), F.max("next_high")).collect()
    bins: dict[int, list[tuple]] = {}
    for row in sorted(tuple(r) for r in found):
        bins.setdefault(row[0], []).append(row[1:])
    return bins


def build_tree(base: DataFrame, shards: int, dims: int, group_share: float = GROUP_SHARE) -> Node:
    """The k-d tree of ``base``: columns k0.. (the dimensions, then text hash and row number) and ``size``."""
    parts = dims + 2
    root = Node(0, shards)
    whole: tuple | None = None
    while True:
        open_nodes = [n for n in undivided(root) if n.leaves > 1]
        if not open_nodes:
            return root
        stats = node_ranges(base, root, parts)
        whole = whole or stats.get(0)
        searches = {}
        for node in open_nodes:
            if node.first not in stats:
                continue
            size, low, high = stats[node.first][0], stats[node.first][1:1 + parts], stats[node.first][1 + parts:]
            reach = [(high[d] - low[d]) / max(1, whole[1 + parts + d] - whole[1 + d]) for d in range(dims)]
            widest = max(range(dims), key=lambda d: reach[d], default=0)
            order = [widest, *[d for d in range(dims) if d != widest], dims, dims + 1] if dims else [0, 1]
            searches[node.first] = Search(node, order, low[order[0]], high[order[0]],
                                          size * (node.leaves // 2) / node.leaves)
        smallest = group_share * whole[0] / shards if whole else 0
        pending = dict(searches)
        while pending:
            bins = histogram(base, root, pending, parts)
            pending = {k: s for k, s in pending.items() if not s.narrow(bins[k], smallest, dims)}
        for node in open_nodes:
            half = node.leaves // 2
            if not node.order:  # a node without rows
                node.order, node.cut = [0], [MOST]
            node.left, node.right = Node(node.first, half), Node(node.first + half, node.leaves - half)


def undivided(node: Node) -> Iterator[Node]:
    if node.left is None:
        yield node
    else:
        yield from undivided(node.left)
        yield from undivided(node.right)


def coordinate(docs: DataFrame, name: str) -> Column:
    """A column as whole numbers in order; null comes first.

    Numbers are rounded down. Other values count by their first seven bytes as text, which keeps
    their order; values that agree in those are ordered by the tree's other keys.
    """
    kind = dict(docs.dtypes)[name]
    if kind in ("tinyint", "smallint", "int", "bigint"):
        number = F.greatest(F.lit(-(1 << 61)), F.least(F.lit(1 << 61), F.col(name).cast("bigint")))
    elif kind in ("float", "double") or kind.startswith("decimal"):
        value = F.col(name).cast("double")
        bounded = F.greatest(F.lit(-1e18), F.least(F.lit(1e18), value))
        number = F.when(F.isnan(value), F.lit(10**18 + 1)).otherwise(F.floor(bounded)).cast("bigint")
    else:
        head = F.rpad(F.hex(F.substring(F.encode(F.col(name).cast("string"), "UTF-8"), 1, 7)), 14, "0")
        number = F.conv(head, 16, 10).cast("bigint")
    return F.coalesce(number, F.lit(-(1 << 62)))


def narrow_rows(docs: DataFrame, dims: Sequence[str], id_col: str, text_col: str, with_text: bool) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keys = [coordinate(docs, d).alias(f"k{i}") for i, d in enumerate(dims)]
    return docs.select(
        *keys, F.shiftright(F.xxhash64(text), 1).alias(f"k{len(dims)}"),
        F.monotonically_increasing_id().alias(f"k{len(dims) + 1}"),
        (F.octet_length(text) + ROW_BYTES).cast("bigint").alias("size"),
        F.col(id_col).cast("bigint").alias("doc_id"), F.crc32(text.cast("binary")).alias("text_crc32"),
        *([text.alias("text")] if with_text else []))


def place(base: DataFrame, root: Node, dims: int) -> DataFrame:
    """``base`` rows with ``shard``: ``doc_id``, ``size``, ``text_crc32``, ``row`` (number), ``shard``."""
    parts = dims + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = key_matrix(batch, parts)
            shard = np.zeros(batch.num_rows, np.int32)
            for node, rows in descend(root, key):
                shard[rows] = node.first
            yield pa.RecordBatch.from_arrays(
                [batch.column(parts + 1), batch.column(parts), batch.column(parts + 2), batch.column(parts - 1),
                 pa.array(shard)], ["doc_id", "size", "text_crc32", "row", "shard"])

    return base.select(*[f"k{i}" for i in range(parts)], "size", "doc_id", "text_crc32").mapInArrow(
        run, "doc_id bigint, size bigint, text_crc32 bigint, row bigint, shard int")


def with_slots(placed: DataFrame) -> DataFrame:
    """``slot``: the place in the shard, from 0 without gaps, in the order of the row numbers.

    A row number starts with the number of the task that wrote it. Rows are numbered per task and
    shard, and a task's numbers follow those of the tasks before it, so no shard is gathered.
    """
    keyed = placed.withColumn("task", F.shiftright("row", 33))
    earlier = Window.partitionBy("shard").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    counts = keyed.groupBy("shard", "task").count().select(
        "shard", "task", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    own = Window.partitionBy("shard", "task").orderBy("row")
    return keyed.withColumn("at", F.row_number().over(own)).join(counts, ["shard", "task"]).select(
        "doc_id", "size", "text_crc32", "row", "shard", (F.col("before") + F.col("at") - 1).alias("slot"))


def _sharded(docs: DataFrame, dims: Sequence[str], shards: int | None, target_bytes: int | None, group_share: float,
             id_col: str, text_col: str, with_text: bool) -> tuple[DataFrame, DataFrame]:
    base = staged(narrow_rows(docs, dims, id_col, text_col, with_text), "shard-rows")
    if shards is None:
        total = base.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
        shards = max(1, -(-total // target_bytes))
    root = build_tree(base, shards, len(dims), group_share)
    return base, with_slots(staged(place(base, root, len(dims)), "shard-places"))


def kd_shards(docs: DataFrame, dims: Sequence[str] = ("lang", "n_chars"), shards: int | None = None,
              target_bytes: int | None = None, group_share: float = GROUP_SHARE, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``size``, ``text_crc32``, ``shard`` and ``slot``.

    Give either the number of shards or the bytes each should reach. ``size`` is the text's UTF-8
    bytes plus 16; a null text counts as empty. Shards have near-equal bytes: each cut is off by at
    most half a row, or half a group of equal texts that holds at most ``group_share`` of a shard.
    Such a group stays in one shard if its metadata are equal too; larger groups are cut between
    their rows. Nulls are the least value of a dimension. Repeated rows, and rows with a null or
    repeated id, are rows of their own. With fewer rows than shards some shards stay empty; an empty
    table gives no rows. Very long texts count whole. Other columns are ignored.
    """
    if (shards is None) == (target_bytes is None):
        raise ValueError("give either shards or target_bytes")
    return _sharded(docs, dims, shards, target_bytes, group_share, id_col, text_col, False)[1].drop("row")


def write_shards(docs: DataFrame, dims: Sequence[str] = ("lang", "n_chars"), shards: int | None = None,
                 target_bytes: int | None = None, path: str | None = None, file_rows: int = 100_000,
                 group_share: float = GROUP_SHARE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the texts as Parquet, a folder per shard, and return what was written, read from it.

    Rows are ``doc_id``, ``text``, ``size``, ``slot`` and ``shard``; a file has at most ``file_rows`` rows.
    """
    if (shards is None) == (target_bytes is None):
        raise ValueError("give either shards or target_bytes")
    base, places = _sharded(docs, dims, shards, target_bytes, group_share, id_col, text_col, True)
    texts = base.select(F.col(f"k{len(dims) + 1}").alias("row"), "text")
    root = path or scratch_path(docs.sparkSession, "shards")
    out = places.join(texts, "row").select("doc_id", "text", "size", "slot", "shard")
    out.withColumn("_file", F.floor(F.col("slot") / file_rows)).repartition("shard", "_file").drop("_file").write.option(
        "maxRecordsPerFile", file_rows).partitionBy("shard").parquet(root)
    return docs.sparkSession.read.schema(out.schema).parquet(root)
