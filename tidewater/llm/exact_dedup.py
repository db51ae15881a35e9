"""Exact dedup with an extendible-hash index on shared files.

1. Each task collapses the equal texts of a slice (its own rows, bounded by bytes) into one local
   group: digest, compressed text, members. However often a text repeats, its bytes travel once
   per slice; the ids of its rows stay behind.
2. Owner tasks hold ranges of the key space and insert its texts in the order of their digests: a
   text is compared byte by byte with the chain of texts under its digest, and only a new text
   becomes an entry. Entries go to the bucket of their hash prefix. A bucket with more bytes than
   its capacity is split by one more bit; the directory doubles when that bucket was already as
   deep as the directory. A bucket that is complete becomes a record batch of the owner's file in
   the shared folder, so an owner holds one bucket's worth of texts at a time.
3. The stored directory has a row per bucket: its prefix and depth, its file and batch. Membership
   is read back from there: a bucket's entries name the local groups that hold their text.
4. Sizes and survivors are aggregated per entry and joined to the local groups and their members.
   A local group has a slice's rows at most, so no join has a hot key.

Local groups, directory and entries are staged as tables, so a lost executor repeats one step.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.frames import slices, staged, text_bytes, texts_of
from tidewater.llm.token_files import filesystem
from tidewater.session import scratch_path

BLANKS = b" \t\n\x0b\x0c\r"
SLICE = 4 << 20  # bytes of text collapsed at once, which bounds what a task holds beside a batch
BUCKET_BYTES = 8 << 20
KEY_BITS = 32

LOCAL = ("grp bigint, digest binary, prefix bigint, body binary, size bigint, n bigint, best_chars bigint, "
         "best_id bigint, best_pos int, ids array<bigint>, chars array<bigint>")
DIRECTORY = "prefix bigint, depth int, file string, batch int, entries bigint, bytes bigint"
ENTRIES = "digest binary, chain int, grp bigint"
INDEX = pa.schema([("digest", pa.binary()), ("chain", pa.int32()), ("body", pa.binary()),
                   ("groups", pa.list_(pa.int64()))])


def local_groups(docs: DataFrame) -> DataFrame:
    """One row per distinct normalised text and slice, with the ids and code points of its rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        number = TaskContext.get().partitionId() << 40
        for batch in slices(batches, limit=SLICE):
            raw, ends = text_bytes(batch.column(1))
            raw = raw.tobytes()
            chars = batch.column(2).to_pylist()
            ids = batch.column(0).to_pylist()
            groups: dict[bytes, list[int]] = {}
            for i, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist())):
                groups.setdefault(raw[a:b].translate(None, BLANKS), []).append(i)
            digests = [hashlib.sha256(text).digest() for text in groups]
            bodies = [pack(text) for text in groups]
            best = [min(range(len(rows)), key=lambda p: (-chars[rows[p]], ids[rows[p]] is not None, ids[rows[p]] or 0))
                    for rows in groups.values()]
            first = [rows[p] for rows, p in zip(groups.values(), best)]
            yield pa.RecordBatch.from_arrays([
                pa.array(range(number, number + len(groups)), pa.int64()),
                pa.array(digests, pa.binary()),
                pa.array([int.from_bytes(d[:4], "big") for d in digests], pa.int64()),
                pa.array(bodies, pa.binary()),
                pa.array([len(b) for b in bodies], pa.int64()),
                pa.array([len(rows) for rows in groups.values()], pa.int64()),
                pa.array([chars[i] for i in first], pa.int64()),
                pa.array([ids[i] for i in first], pa.int64()),
                pa.array(best, pa.int32()),
                pa.array([[ids[i] for i in rows] for rows in groups.values()], pa.list_(pa.int64())),
                pa.array([[chars[i] for i in rows] for rows in groups.values()], pa.list_(pa.int64()))],
                [c.split(" ")[0] for c in LOCAL.split(", ")])
            number += len(groups)
        pa.default_memory_pool().release_unused()

    source = texts_of(docs).withColumn("chars", F.length("text").cast("bigint"))
    return source.mapInArrow(run, LOCAL)


class Entry(NamedTuple):
    """A distinct text of the index: the first bits of its digest, its place in the chain, its local groups."""
    key: int
    digest: bytes
    chain: int
    body: bytes
    groups: list[int]


class Buckets:
    """The buckets of one owner, filled in the order of their keys; complete ones go to ``write``.

    ``first_depth`` is the depth with which the directory began, ``depth`` the one it has grown to.
    """

    def __init__(self, capacity: int, first_depth: int, write: Callable[[int, int, list[Entry]], None]):
        self.capacity, self.first_depth, self.write = capacity, first_depth, write
        self.depth = first_depth
        self.bucket = (-1, first_depth)  # prefix and depth of the one being filled
        self.open: list[Entry] = []
        self.bytes = 0
        self.done = -1  # the last key that the buckets written so far cover

    def insert(self, entry: Entry) -> None:
        prefix, depth = self.bucket
        if prefix != entry.key >> (KEY_BITS - depth):
            self.close()
            self.bucket = self._next(entry.key)
        self.open.append(entry)
        self.bytes += len(entry.body)
        while self.bytes > self.capacity and self.open[0].key != self.open[-1].key:
            self._split()

    def _next(self, key: int) -> tuple[int, int]:
        """The shallowest bucket of a key that does not reach back over buckets already written."""
        depth = self.first_depth
        while self.done >= key >> (KEY_BITS - depth) << (KEY_BITS - depth):
            depth += 1
        return key >> (KEY_BITS - depth), depth

    def _split(self) -> None:
        prefix, depth = self.bucket
        if depth == self.depth:
            self.depth += 1  # the directory doubles
        bit = KEY_BITS - depth - 1
        low = [e for e in self.open if not e.key >> bit & 1]
        high = self.open[len(low):]
        if not high:
            self.bucket = prefix * 2, depth + 1
            return
        if low:
            self._write(prefix * 2, depth + 1, low)
        self.bucket, self.open = (prefix * 2 + 1, depth + 1), high
        self.bytes = sum(len(e.body) for e in high)

    def _write(self, prefix: int, depth: int, entries: list[Entry]) -> None:
        self.write(prefix, depth, entries)
        self.done = ((prefix + 1) << (KEY_BITS - depth)) - 1

    def close(self) -> None:
        if self.open:
            self._write(*self.bucket, self.open)
        self.open, self.bytes = [], 0


def build_index(local: DataFrame, root: str, capacity: int = BUCKET_BYTES) -> DataFrame:
    """The directory of an index over the texts of ``local``, whose bucket files are under ``root``.

    The directory begins with as many slots as the bytes fill buckets; an owner has whole slots.
    """
    total = local.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    depth = min(KEY_BITS - 1, (total // capacity).bit_length())

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        name = f"{root}/owner-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.arrow"
        found: list[tuple] = []
        writer = sink = None

        def write(prefix: int, at_depth: int, entries: list[Entry]) -> None:
            nonlocal writer, sink
            if writer is None:
                store, inner = filesystem(name)
                store.create_dir(inner.rsplit("/", 1)[0], recursive=True)
                sink = store.open_output_stream(inner)
                writer = pa.ipc.new_file(sink, INDEX)
            columns = ([e.digest for e in entries], [e.chain for e in entries], [e.body for e in entries],
                       [e.groups for e in entries])
            writer.write_batch(pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, INDEX)], schema=INDEX))
            found.append((prefix, at_depth, name, len(found), len(entries), sum(len(e.body) for e in entries)))

        buckets = Buckets(capacity, depth, write)
        current, chain = None, []
        for batch in batches:
            for grp, digest, key, body in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if digest != current:
                    current, chain = digest, []
                text = unpack(body)
                entry = next((e for other, e in chain if other == text), None)
                if entry is None:
                    entry = Entry(key, digest, len(chain), body, [])
                    chain.append((text, entry))
                    buckets.insert(entry)
                entry.groups.append(grp)
        buckets.close()
        if writer is not None:
            writer.close()
            sink.close()
        pa.default_memory_pool().release_unused()
        kinds = (pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.int64())
        columns = zip(*found) if found else [[]] * len(kinds)
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)],
                                         ["prefix", "depth", "file", "batch", "entries", "bytes"])

    slot = F.shiftright("prefix", KEY_BITS - depth)
    dealt = local.select("grp", "digest", "prefix", "body", slot.alias("slot")).repartitionByRange("slot")
    return staged(dealt.sortWithinPartitions("digest").drop("slot").mapInArrow(own, DIRECTORY), "dedup-directory")


def index_entries(directory: DataFrame) -> DataFrame:
    """What the bucket files hold, read back: each local group and the entry of its text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, source, reader = None, None, None
        for batch in batches:
            for file, number in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if file != name:
                    if source is not None:
                        source.close()
                    store, inner = filesystem(file)
                    name, source = file, store.open_input_file(inner)
                    reader = pa.ipc.open_file(source)
                bucket = reader.get_batch(number)
                groups = bucket.column(3)
                entry = pc.list_parent_indices(groups)
                yield pa.RecordBatch.from_arrays(
                    [bucket.column(0).take(entry), bucket.column(1).take(entry), groups.flatten()], ["digest", "chain", "grp"])
        if source is not None:
            source.close()

    return directory.select("file", "batch").repartition("file").sortWithinPartitions("file", "batch").mapInArrow(run, ENTRIES)


def exact_groups(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, the text's ``text_sha256`` and ``chars``.

    Texts are equal when they have the same bytes without ASCII white space; null counts as empty,
    and empty texts are equal to each other. Of equal texts exactly one row stays: the longest
    original (``chars`` code points), then the smallest id (a null id before all others), then any
    one of the rows that share both. Very long texts are compared whole. An empty table gives no
    rows; other columns are ignored.
    """
    spark = docs.sparkSession
    local = staged(local_groups(texts_of(docs, id_col, text_col)), "dedup-local")
    directory = build_index(local, scratch_path(spark, "dedup-index"), bucket_bytes)
    entries = staged(index_entries(directory), "dedup-entries")
    best = F.struct(F.col("best_chars"), F.col("best_id").isNull().cast("int").alias("no_id"),
                    (-F.col("best_id")).alias("rank"), (-F.col("grp")).alias("grp"), F.col("best_pos"))
    texts = entries.join(local.select("grp", "n", "best_chars", "best_id", "best_pos"), "grp").groupBy(
        "digest", "chain").agg(F.sum("n").alias("group_size"), F.max(best).alias("best"))
    # One row per local group, however many rows of the table it stands for.
    of_group = staged(entries.join(texts, ["digest", "chain"]), "dedup-groups")
    members = local.select("grp", F.posexplode(F.arrays_zip("ids", "chars")).alias("pos", "row"))
    return members.join(of_group, "grp").select(
        F.col("row.ids").alias("doc_id"), (-F.col("best.rank")).alias("keep_id"), "group_size",
        ((F.col("grp") == -F.col("best.grp")) & (F.col("pos") == F.col("best.best_pos"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), F.col("row.chars").alias("chars"))


ORACLE = """
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS norm
  FROM documents
), ranked AS (
  SELECT *, row_number() OVER same AS rn, first(doc_id) OVER same AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size
  FROM t WINDOW same AS (PARTITION BY norm ORDER BY length(text) DESC, doc_id NULLS FIRST)
)
SELECT doc_id, keep_id, group_size, rn = 1 AS kept, sha256(norm) AS text_sha256, length(text) AS chars
FROM ranked
"""
