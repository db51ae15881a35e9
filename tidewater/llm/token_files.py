"""Token ids in Arrow files of equal-length sequences, with random access.

A file is an Arrow IPC file whose record batches hold two fixed-size-list columns: ``ids`` and
``mask``. The ids of its documents follow each other without gaps; only the last sequence of a
file is padded, with mask 0. Every batch but the last has the same number of sequences, so token t
of a file is in sequence t // length, and that sequence is in batch (t // length) // rows: a reader
maps the file and touches nothing else. An index file beside it says where each document begins.

Documents are range-partitioned by id, so files in order of their number hold the documents in
order of their id, and no task sees more than its own range.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.frames import slices, staged, texts_of
from tidewater.llm.text import word_encoder
from tidewater.session import scratch_path

SEQUENCE_LENGTH = 2048
ROWS_PER_BATCH = 256

MANIFEST = "part int, tokens string, docs string, n_docs bigint, n_tokens bigint"
SPANS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI and the path in it, for local and cluster stores alike."""
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1))
    return fs.LocalFileSystem(), path


class SequenceWriter:
    """Appends ids to one file; holds at most one batch of sequences."""

    def __init__(self, sink: pa.NativeFile, id_type: pa.DataType, length: int, rows: int):
        self.schema = pa.schema([("ids", pa.list_(id_type, length)), ("mask", pa.list_(pa.bool_(), length))],
                                metadata={"length": str(length), "rows": str(rows)})
        self.writer = pa.ipc.new_file(sink, self.schema)
        self.id_type, self.length, self.rows = id_type, length, rows
        self.buffer = np.zeros(length * rows, id_type.to_pandas_dtype())
        self.filled = 0
        self.total = 0

    def append(self, ids: np.ndarray) -> None:
        self.total += len(ids)
        while len(ids):
            take = min(len(ids), len(self.buffer) - self.filled)
            self.buffer[self.filled:self.filled + take] = ids[:take]
            self.filled += take
            ids = ids[take:]
            if self.filled == len(self.buffer):
                self._write()

    def _write(self) -> None:
        sequences = -(-self.filled // self.length)
        mask = np.arange(sequences * self.length) < self.filled
        self.buffer[self.filled:] = 0
        ids = pa.array(self.buffer[:sequences * self.length], self.id_type)
        self.writer.write_batch(pa.RecordBatch.from_arrays([
            pa.FixedSizeListArray.from_arrays(ids, self.length),
            pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length)], schema=self.schema))
        self.filled = 0

    def close(self) -> None:
        if self.filled:
            self._write()
        self.writer.close()


class SequenceFile:
    """Random access to the ids of one file. Ids within one batch are views of the mapped file."""

    def __init__(self, path: str):
        store, inner = filesystem(path)
        local = isinstance(store, fs.LocalFileSystem)
        self.source = pa.memory_map(inner) if local else store.open_input_file(inner)
        self.reader = pa.ipc.open_file(self.source)
        metadata = self.reader.schema.metadata
        self.length, self.rows = int(metadata[b"length"]), int(metadata[b"rows"])
        self._batch = (-1, np.zeros(0))

    def sequence(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of one sequence."""
        batch = self.reader.get_batch(number // self.rows)
        at = number % self.rows
        return (batch.column(0).slice(at, 1).flatten().to_numpy(),
                batch.column(1).slice(at, 1).flatten().to_numpy(zero_copy_only=False))

    def _ids(self, batch: int) -> np.ndarray:
        if self._batch[0] != batch:
            self._batch = batch, self.reader.get_batch(batch).column(0).flatten().to_numpy()
        return self._batch[1]

    def ids(self, start: int, count: int) -> np.ndarray:
        """``count`` ids from position ``start`` of the file."""
        size = self.length * self.rows
        parts = []
        while count:
            batch, at = divmod(start, size)
            part = self._ids(batch)[at:at + count]
            parts.append(part)
            start, count = start + len(part), count - len(part)
        return parts[0] if len(parts) == 1 else np.concatenate(parts or [np.zeros(0, np.uint16)])


def write_token_files(docs: DataFrame, vocabulary: str, end_id: int | None = None, path: str | None = None,
                      length: int = SEQUENCE_LENGTH, rows: int = ROWS_PER_BATCH, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """Encode all documents in ascending id order into files under ``path``; return their manifest.

    The manifest has a row per file: part number, paths of its ids and of its document index,
    documents and tokens in it. Ids take 16 bits when the vocabulary allows, else 32. Null texts
    count as empty and give only ``end_id`` (or nothing without one). Rows with equal ids follow
    each other in the order of their text's hash; rows with a null id come first. An empty table
    gives an empty manifest. A task writes under a name of its own, so a repeated attempt leaves
    an unused file behind, never a torn one.
    """
    spark = docs.sparkSession
    root = path or scratch_path(spark, "token-files")
    # The hash and a row number let a range split rows that share an id, equal ones too.
    ordered = texts_of(docs, id_col, text_col).withColumns(
        {"_hash": F.xxhash64("text"), "_row": F.monotonically_increasing_id()}).repartitionByRange(
        "doc_id", "_hash", "_row").sortWithinPartitions("doc_id", "_hash").select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(vocabulary)
        id_type = pa.uint16() if encoder.vocabulary_size() <= 1 << 16 else pa.uint32()
        part = TaskContext.get().partitionId()
        name = f"{root}/part-{part:06d}-{uuid.uuid4().hex}"
        writer, spans = None, None
        for batch in slices(batches):
            if writer is None:
                store, inner = filesystem(name)
                store.create_dir(inner.rsplit("/", 1)[0], recursive=True)
                sink, index = store.open_output_stream(inner + ".ids.arrow"), store.open_output_stream(
                    inner + ".docs.arrow")
                writer, spans = SequenceWriter(sink, id_type, length, rows), pa.ipc.new_file(index, SPANS)
                n_docs = 0
            ids, ends = encoder(batch.column(1))
            before = writer.total
            if end_id is not None:
                ids, ends = np.insert(ids, ends[1:], end_id), ends + np.arange(len(ends))
            writer.append(ids)
            spans.write_batch(pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(ends[:-1] + before), pa.array(np.diff(ends))], schema=SPANS))
            n_docs += batch.num_rows
        if writer is not None:
            writer.close()
            spans.close()
            sink.close()
            index.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([name + ".ids.arrow"]), pa.array([name + ".docs.arrow"]),
                 pa.array([n_docs], pa.int64()), pa.array([writer.total], pa.int64())],
                ["part", "tokens", "docs", "n_docs", "n_tokens"])

    return staged(ordered.mapInArrow(run, MANIFEST), "token-manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``.

    ``start`` counts the ids of all documents before it. Only the manifest, a row per file, is
    ordered in one task; each file is read by one task.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("before", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tokens, docs, first in zip(*(batch.column(i).to_pylist() for i in range(3))):
                file = SequenceFile(tokens)
                store, inner = filesystem(docs)
                with store.open_input_file(inner) as source:
                    index = pa.ipc.open_file(source)
                    for i in range(index.num_record_batches):
                        spans = index.get_batch(i)
                        starts, counts = spans.column(1).to_numpy(), spans.column(2).to_numpy()
                        crcs = [zlib.crc32(file.ids(s, n).astype("<u4").tobytes())
                                for s, n in zip(starts.tolist(), counts.tolist())]
                        yield pa.RecordBatch.from_arrays(
                            [spans.column(0), pa.array(starts + first), spans.column(2),
                             pa.array(crcs, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.select("tokens", "docs", "before").repartition("tokens").mapInArrow(
        run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
