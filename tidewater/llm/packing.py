"""Sum-of-squares packing of documents into sequences of a fixed capacity.

A document that is longer than a sequence is cut into full pieces and a rest; everything else is
placed whole. Pieces are dealt by hash into groups of a bounded number of pieces, and each group is
packed on its own: the longest piece first, each into the open sequence (or a new one) that makes
the sum of squares of the number of open sequences per gap smallest. So all gaps stay in supply,
and nearly every sequence gets filled; a group wastes a few sequences out of thousands.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.frames import slices, staged, texts_of
from tidewater.llm.text import word_encoder

CAPACITY = 4096
GROUP_PIECES = 8192
SLICE = 4 << 20  # bytes of text encoded at once, which bounds what a task holds beside a batch


def sum_of_squares(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece; pieces come in the order of placement.

    For a piece of length s, an open sequence with gap h becomes one with gap h - s. With n[g] open
    sequences per gap the sum of squares changes by 2 (n[h - s] - n[h] + 1), where n[0] does not
    count; a new sequence changes it by 2 n[capacity - s] + 1. Ties take the tightest gap, an open
    sequence before a new one.
    """
    count = np.zeros(capacity + 1, np.int64)
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    gap_of: list[int] = []
    sequence = np.empty(len(lengths), np.int64)
    offset = np.empty(len(lengths), np.int64)
    never = np.iinfo(np.int64).max
    for i, s in enumerate(lengths.tolist()):
        fresh = 2 * count[capacity - s] + 1 if s < capacity else 0
        there = count[s:capacity]
        change = np.where(there > 0, 2 * (count[:capacity - s] - there + 1), never)
        if len(change) and there[0] > 0:
            change[0] = 1 - 2 * there[0]
        best = int(change.argmin()) if len(change) else 0
        if len(change) and change[best] != never and change[best] <= fresh:
            gap = s + best
            place = by_gap[gap].pop()
            count[gap] -= 1
        else:
            gap, place = capacity, len(gap_of)
            gap_of.append(capacity)
        sequence[i], offset[i] = place, capacity - gap
        gap_of[place] = gap - s
        if 0 < gap - s < capacity:
            by_gap[gap - s].append(place)
            count[gap - s] += 1
    return sequence, offset


def document_pieces(docs: DataFrame, vocabulary: str, end_id: int | None, capacity: int = CAPACITY,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per piece ``doc_id``, ``piece``, ``start``, ``length`` and the checksum of its ids.

    A document has its text's ids and then ``end_id``, if any. A null text counts as empty; a
    document without ids has no piece.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(vocabulary)
        for batch in slices(batches, limit=SLICE):
            ids, ends = encoder(batch.column(1))
            if end_id is not None:
                ids, ends = np.insert(ids, ends[1:], end_id), ends + np.arange(len(ends))
            ids = ids.astype("<u4")
            counts = -(-np.diff(ends) // capacity)
            row = np.repeat(np.arange(len(counts)), counts)
            piece = np.arange(len(row)) - (np.cumsum(counts) - counts)[row]
            start = piece * capacity
            length = np.minimum(capacity, np.diff(ends)[row] - start)
            first = ends[:-1][row] + start
            crcs = [zlib.crc32(ids[a:a + n]) for a, n in zip(first.tolist(), length.tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start),
                 pa.array(length), pa.array(crcs, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    return texts_of(docs, id_col, text_col).mapInArrow(
        run, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` with the sequence and the offset of each one; lengths are 1 to ``capacity``.

    Full pieces fill a sequence each and need no packing: they get negative numbers where they are,
    without a shuffle. The others go to groups of about ``group_pieces``. A row number is part of
    the group's hash, so equal pieces spread over the groups too.
    """
    total = pieces.filter(F.col("length") < capacity).count()
    groups = max(1, -(-total // group_pieces))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    row = F.monotonically_increasing_id()
    full = pieces.withColumn("_row", row).filter(F.col("length") == capacity).select(
        *columns, (-1 - F.col("_row")).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    dealt = pieces.withColumn("_row", row).filter(F.col("length") < capacity).select(
        *columns, F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "_row"), F.lit(groups)).alias("grp"))
    schema = ("doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, "
              "sequence_id bigint, offset bigint")

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        sequence, offset = sum_of_squares(group["length"].to_numpy(), capacity)
        base = group["grp"][0].as_py() << 32
        return group.select(columns).append_column("sequence_id", pa.array(sequence + base)).append_column(
            "offset", pa.array(offset))

    return dealt.groupBy("grp").applyInArrow(run, schema).unionByName(full)


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int | None = 1, capacity: int = CAPACITY,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every piece of every document with its sequence and its offset there.

    Each row of ``docs`` is a document of its own, repeated rows too, whatever its id; other columns
    are ignored. Null and empty texts have only ``end_id``. An empty table gives no rows. The pieces,
    five numbers each, are staged, so packing and counting do not encode the texts again.
    """
    return pack(staged(document_pieces(docs, vocabulary, end_id, capacity, id_col, text_col), "pieces"), capacity)
