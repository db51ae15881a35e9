"""N-gram Jaccard join: MinHash bands find candidates, full n-gram sets decide.

1. Every text becomes its set of word n-grams (64-bit hashes) and a MinHash signature; only the
   band hashes and a 128-bit key of the set are staged. A node is a distinct set; all documents with
   that set are its members, whatever their ids are.
2. Nodes shuffle on their band hashes. A bucket is linked as a star to its smallest node, so a
   bucket costs as many rows as it has members, however large it is.
3. The components of these stars hold every candidate pair. Only their texts are read again.
4. Each component is cut into blocks by set size and hash, bounded in sets and in n-grams; pairs of
   blocks whose sizes can reach the threshold are cells. A cell verifies all its pairs on the full sets at once and returns one
   row per node: how many it is linked to, and the smallest node it is connected with.
5. The components of the verified links are the classes.

Links are counted for all pairs of a component, also for those that share no band.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.components import connected_components
from tidewater.llm.frames import slices, staged
from tidewater.llm.text import list_offsets, offsets_of

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.9995
MAX_HASHES = 128
BLOCK = 512
CELL_ROWS = 2000
# 8 bytes each: a block of long texts holds fewer of them, at least one.
BLOCK_GRAMS = 4 << 20
SLICE = 8 << 20
NO_ID = -(1 << 63)
PRIME = np.uint64(0x9E3779B97F4A7C15)


def choose_bands(threshold: float, recall: float = RECALL, most: int = MAX_HASHES) -> tuple[int, int]:
    """Bands and rows per band: the most rows for which pairs at the threshold still meet in some
    band with probability ``recall``, within ``most`` hashes."""
    best = (math.ceil(math.log(1 - recall) / math.log(1 - threshold)) if threshold < 1 else 1, 1)
    for rows in range(1, most + 1):
        meet = threshold ** rows
        bands = 1 if meet >= 1 else math.ceil(math.log(1 - recall) / math.log(1 - meet))
        if bands * rows > most:
            break
        best = (bands, rows)
    return best


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def shingles(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-gram hashes of all texts end to end, and each text's offset.

    Words are runs without ASCII white space, A-Z lower-cased. A text with fewer than n words has
    one n-gram, all its words; a text without words has none.
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    ends = list_offsets(lists)
    coded = lists.flatten().dictionary_encode()
    distinct = np.array([xxhash.xxh3_64_intdigest(w) if w else 0 for w in coded.dictionary.to_pylist()], np.uint64)
    word = distinct[coded.indices.to_numpy()] if len(coded) else np.zeros(0, np.uint64)
    row = np.repeat(np.arange(len(texts)), np.diff(ends))
    real = word != 0  # white space at the ends of a text leaves empty words
    word, row = word[real], row[real]
    counts = np.bincount(row, minlength=len(texts))
    ends = offsets_of(counts)
    gram = np.zeros(len(word), np.uint64)
    inside = np.arange(len(word)) - ends[row]
    for step in range(n):
        # Position i takes the words i .. i+n-1 of its text; a short text takes what it has.
        at = np.minimum(np.arange(len(word)) + step, len(word) - 1)
        use = inside + step < counts[row]
        gram = np.where(use, mixed(gram * PRIME + word[at]) if len(word) else gram, gram)
    keep = (inside + n <= counts[row]) | ((inside == 0) & (counts[row] < n))
    gram, row = mixed(gram[keep]), row[keep]
    order = np.lexsort((gram, row))
    gram, row = gram[order], row[order]
    fresh = np.ones(len(gram), bool)
    fresh[1:] = (gram[1:] != gram[:-1]) | (row[1:] != row[:-1])
    return gram[fresh], offsets_of(np.bincount(row[fresh], minlength=len(texts)))


@functools.lru_cache(maxsize=4)
def multipliers(count: int) -> np.ndarray:
    rng = np.random.default_rng(20)
    return rng.integers(1, 1 << 63, (2, count), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def band_hashes(grams: np.ndarray, ends: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit hash per band and text; texts without n-grams get zeros."""
    out = np.zeros((len(ends) - 1, bands), np.uint64)
    some = np.flatnonzero(np.diff(ends))
    if len(some):
        times, plus = multipliers(bands * rows)
        for i in range(bands * rows):
            smallest = np.minimum.reduceat(mixed(grams * times[i] + plus[i]), ends[:-1][some])
            out[some, i // rows] = mixed(out[some, i // rows] * PRIME + smallest)
    return out


def set_keys(grams: np.ndarray, ends: np.ndarray) -> list[bytes]:
    return [xxhash.xxh3_128_digest(grams[a:b]) for a, b in zip(ends[:-1], ends[1:])]


def cell_links(sets: list[np.ndarray], weight: np.ndarray, left: np.ndarray, right: np.ndarray, same: bool,
               threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per set: weight of the sets it is linked to, their number, and its smallest connected index.

    Compares all sets of ``left`` with all of ``right`` (``same``: all pairs of one block).
    """
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, code, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[code] > 1
    owner, code = owner[shared], code[shared]
    _, code = np.unique(code, return_inverse=True)
    columns = int(code.max()) + 1 if len(code) else 0
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    both = np.zeros((len(left), len(right)), np.float32)
    width = max(1, (4 << 20) // len(sets))
    for first in range(0, columns, width):
        a, b = np.searchsorted(code, [first, first + width])
        part = np.zeros((len(sets), min(width, columns - first)), np.float32)
        part[owner[a:b], code[a:b] - first] = 1
        both += part[left] @ part[right].T
    linked = both >= threshold * (sizes[left][:, None] + sizes[right][None, :] - both) - 1e-6
    if same:
        np.fill_diagonal(linked, False)
    links, partners = np.zeros(len(sets), np.int64), np.zeros(len(sets), np.int64)
    links[left] = linked @ weight[right]
    partners[left] = linked.sum(axis=1)
    if not same:
        links[right] += weight[left] @ linked
        partners[right] += linked.sum(axis=0)
    root = np.arange(len(sets))
    while True:
        before = root.copy()
        lowest = np.where(linked, root[right][None, :], len(sets)).min(axis=1, initial=len(sets))
        root[left] = np.minimum(root[left], lowest)
        lowest = np.where(linked, root[left][:, None], len(sets)).min(axis=0, initial=len(sets))
        root[right] = np.minimum(root[right], lowest)
        if (root == before).all():
            return links, partners, root


def text_hashes(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, n: int = WORDS, id_col: str = "doc_id",
                    text_col: str = "text", block: int = BLOCK, block_grams: int = BLOCK_GRAMS) -> DataFrame:
    """Per row: ``doc_id``, ``class_id``, ``links``, ``set_links``.

    Two documents are linked when the Jaccard similarity of their n-gram sets is at least
    ``threshold``. ``class_id`` is the smallest id that a document is connected with by links,
    ``links`` the number of other documents it is linked to, ``set_links`` how many different
    n-gram sets these have besides its own. Texts without words are linked to nothing. Rows with
    the same id and text are one document, rows with the same id and different texts are several;
    so are rows with a null id, which is smaller than all others. An empty table gives no rows. Very
    long texts take part whole: a task holds two blocks of ``block_grams`` n-grams, or two texts that
    have more.
    """
    return near_classes(docs, threshold, n, id_col, text_col, block, block_grams).select("doc_id", "class_id", "links", "set_links")


def near_classes(docs: DataFrame, threshold: float = THRESHOLD, n: int = WORDS, id_col: str = "doc_id",
                 text_col: str = "text", block: int = BLOCK, block_grams: int = BLOCK_GRAMS) -> DataFrame:
    """The columns of ``near_duplicates`` with ``text_hash`` (``text_hashes``) and ``first``: whether the row
    is the document of its class with the smallest id, and of its texts that with the smallest hash."""
    bands, rows = choose_bands(threshold)
    source = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)).alias("owner"),
                         F.coalesce(F.col(text_col), F.lit("")).alias("text"), text_hashes(F.col(text_col)).alias("hash"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=SLICE):
            grams, ends = shingles(batch.column(1), n)
            hashes = band_hashes(grams, ends, bands, rows).view(np.int64)
            offsets = pa.array(np.arange(len(hashes) + 1, dtype=np.int32) * bands)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(set_keys(grams, ends), pa.binary()), pa.array(np.diff(ends)),
                 pa.ListArray.from_arrays(offsets, pa.array(hashes.ravel()))], ["owner", "hash", "key", "size", "bands"])

    signed = staged(source.mapInArrow(sign, "owner bigint, hash bigint, key binary, size bigint, bands array<bigint>"),
                    "signed")
    # Texts without words have no node: they stay alone.
    texts = signed.filter("size > 0").groupBy("owner", "hash", "key").agg(F.first("bands").alias("bands"))
    sets = staged(texts.groupBy("key").agg(
        F.min(F.struct("owner", "hash")).alias("head"), F.count(F.lit(1)).alias("weight"), F.first("bands").alias("bands"))
        .withColumn("node", F.monotonically_increasing_id()), "sets")
    reps = sets.select("node", "key", "weight", "head.owner", "head.hash")

    buckets = sets.select("node", F.posexplode("bands").alias("band", "hash"))
    first = staged(buckets.groupBy("band", "hash").agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("held"))
                   .filter("held > 1").select("band", "hash", "first"), "buckets")
    stars = buckets.join(first, ["band", "hash"]).filter("node <> first").select(
        F.col("node").alias("a"), F.col("first").alias("b")).distinct()
    candidates = connected_components(stars).withColumnRenamed("label", "comp")

    members = staged(candidates.join(reps, "node"), "members")
    # The texts move once, at every size; a broadcast of the candidates would not last.
    wanted = source.join(members.hint("merge"), ["owner", "hash"])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=SLICE):
            at = {name: i for i, name in enumerate(batch.schema.names)}
            grams, ends = shingles(batch.column(at["text"]), n)
            right = np.array([k == key for k, key in zip(set_keys(grams, ends), batch.column(at["key"]).to_pylist())])
            rows = np.flatnonzero(right)
            take = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(at[c]).take(take) for c in ("node", "comp", "weight")]
                + [pa.array(np.diff(ends)[rows]),
                   pa.array([grams[ends[i]:ends[i + 1]].tobytes() for i in rows.tolist()], pa.binary())],
                ["node", "comp", "weight", "size", "grams"])

    # Sizes that differ by more than one step of this scale cannot reach the threshold.
    step = math.log(1 / threshold) if threshold < 1 else math.log(2)
    full = staged(wanted.mapInArrow(fetch, "node bigint, comp bigint, weight bigint, size bigint, grams binary")
                  .withColumn("band", F.floor(F.log("size") / step).cast("int"))
                  .dropDuplicates(["node"]), "full")
    blocks = staged(full.groupBy("comp", "band").agg(
        F.count(F.lit(1)).alias("held"), F.sum("size").alias("n_grams")).withColumn(
        "blocks", F.greatest(F.ceil(F.col("held") / block), F.ceil(F.col("n_grams") / block_grams)).cast("int")), "blocks")
    small = staged(blocks.groupBy("comp").agg(F.sum("held").alias("held"), F.sum("n_grams").alias("n_grams")).filter(
        (F.col("held") <= block) & (F.col("n_grams") <= block_grams)), "small")
    counted = full.join(blocks.select("comp", "band", "blocks"), ["comp", "band"])
    for side, shift in (("lower", -1), ("upper", 1)):
        beside = blocks.select("comp", (F.col("band") - shift).alias("band"), F.col("blocks").alias(side))
        counted = counted.join(beside, ["comp", "band"], "left")
    counted = counted.join(small.select("comp", F.lit(True).alias("small")), "comp", "left")
    held, n_grams = small.agg(F.coalesce(F.sum("held"), F.lit(0)), F.coalesce(F.sum("n_grams"), F.lit(0))).first()
    groups = max(1, -(-held // CELL_ROWS), -(-n_grams // block_grams))
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")

    def cells(count: str, build) -> F.Column:
        """Cells with each of ``count`` blocks."""
        return F.transform(F.when(F.col(count) > 0, F.sequence(F.lit(0), F.col(count) - 1)).otherwise(
            F.array().cast("array<int>")), build)

    def cell(comp, band, low, high_band, high):
        return F.struct(comp.cast("bigint").alias("comp"), band.cast("int").alias("band"), low.cast("int").alias("low"),
                        high_band.cast("int").alias("high_band"), high.cast("int").alias("high"))

    comp, band = F.col("comp"), F.col("band")
    own = cells("blocks", lambda i: cell(comp, band, F.least(i, F.col("mine")), band, F.greatest(i, F.col("mine"))))
    up = cells("upper", lambda i: cell(comp, band, F.col("mine"), band + 1, i))
    down = cells("lower", lambda i: cell(comp, band - 1, i, band, F.col("mine")))
    batch_cell = F.array(cell(F.pmod(F.xxhash64("comp"), F.lit(groups)), F.lit(-1), F.lit(0), F.lit(-1), F.lit(0)))
    dealt = counted.withColumn("mine", mine).withColumn(
        "cell", F.explode(F.when(F.col("small"), batch_cell).otherwise(F.concat(own, up, down)))).select(
        "node", "comp", "weight", "grams", F.col("band").alias("own_band"), "mine", "cell.*"
    ).toDF("node", "comp", "weight", "grams", "own_band", "mine", "c_comp", "c_band", "c_low", "c_high_band", "c_high")

    def verify(table: pa.Table) -> pa.Table:
        table = table.sort_by([("comp", "ascending"), ("node", "ascending")])
        node, weight, comp = (table[c].to_numpy() for c in ("node", "weight", "comp"))
        grams = [np.frombuffer(g, np.uint64) for g in table["grams"].to_pylist()]
        c = {name: table[name][0].as_py() for name in ("c_band", "c_low", "c_high_band", "c_high")}
        links, partners = np.zeros(len(node), np.int64), np.zeros(len(node), np.int64)
        root = node.copy()
        cuts = np.flatnonzero(np.diff(comp, prepend=comp[0] - 1, append=comp[-1] + 1))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            everyone = np.arange(b - a)
            same = c["c_band"] == -1 or (c["c_band"], c["c_low"]) == (c["c_high_band"], c["c_high"])
            left = right = everyone
            if not same:
                own_band, own_block = table["own_band"].to_numpy()[a:b], table["mine"].to_numpy()[a:b]
                is_left = (own_band == c["c_band"]) & (own_block == c["c_low"])
                left, right = everyone[is_left], everyone[~is_left]
            if len(left) and len(right):
                links[a:b], partners[a:b], at = cell_links(grams[a:b], weight[a:b], left, right, same, threshold)
                root[a:b] = node[a:b][at]
        return pa.table({"node": node, "root": root, "links": links, "partners": partners})

    verified = staged(dealt.groupBy("c_comp", "c_band", "c_low", "c_high_band", "c_high").applyInArrow(
        verify, "node bigint, root bigint, links bigint, partners bigint"), "verified")
    classes = connected_components(verified.filter("node <> root").select(
        F.col("node").alias("a"), F.col("root").alias("b")))
    totals = verified.groupBy("node").agg(F.sum("links").alias("links"), F.sum("partners").alias("partners")).join(
        classes, "node", "left")
    found = staged(sets.join(totals, "node", "left").select(
        "key", "head", F.coalesce("label", "node").alias("label"),
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links"),
        F.coalesce("partners", F.lit(0)).alias("set_links")), "found")
    heads = staged(found.groupBy("label").agg(F.min("head").alias("class_head")), "heads")
    known = staged(found.join(heads, "label").select("key", "class_head", "links", "set_links"), "classes")
    own = F.struct("owner", "hash")
    alone = F.col("class_head").isNull()
    return signed.select("owner", "hash", "key").join(known, "key", "left").select(
        F.nullif("owner", F.lit(NO_ID)).alias("doc_id"),
        F.nullif(F.when(alone, F.col("owner")).otherwise(F.col("class_head.owner")), F.lit(NO_ID)).alias("class_id"),
        F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("set_links", F.lit(0)).alias("set_links"),
        F.col("hash").alias("text_hash"), (alone | (own == F.col("class_head"))).alias("first"))
