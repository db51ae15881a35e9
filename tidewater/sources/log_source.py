"""A log of records on shared storage as a Spark data source: batch and stream reads by offset.

A log is a folder ``partition=P/segment=B`` per segment, where B is the offset of its first record.
A segment holds the records of consecutive offsets as Parquet. The driver lists folders and reads
footers; records are read by the executors, one task per segment and batch, from the row groups
that the batch touches. Offsets of a stream are a number per partition, limited per micro-batch, and
kept in the query's checkpoint.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from tidewater.operators.windows import row_number, with_windows
from tidewater.sources.stores import open_store

FORMAT = "record-log"
RECORD = "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"
RECORD_TYPES = pa.schema([
    ("key", pa.binary()), ("value", pa.binary()), ("topic", pa.string()), ("partition", pa.int32()),
    ("offset", pa.int64()), ("timestamp", pa.timestamp("us", "UTC"))])
SEGMENT_RECORDS = 1_000_000
#: Records of a row group, the least that a batch reads of a segment.
GROUP_RECORDS = 8_192
#: Records of a partition that one task numbers; they are sorted with their payload.
NUMBERED_RECORDS = 1_000_000


def _folders(store: fs.FileSystem, path: str, label: str) -> dict[int, str]:
    """Folders named ``label=<number>`` under a path, by number in order."""
    listed = store.get_file_info(fs.FileSelector(path, allow_not_found=True))
    found = {int(f.base_name.split("=", 1)[1]): f.path for f in listed
             if f.type == fs.FileType.Directory and f.base_name.startswith(f"{label}=")}
    return dict(sorted(found.items()))


def _files(store: fs.FileSystem, folder: str) -> list[str]:
    return sorted(f.path for f in store.get_file_info(fs.FileSelector(folder)) if f.path.endswith(".parquet"))


def _records(store: fs.FileSystem, folder: str) -> int:
    """Records of a segment, from the footers of its files."""
    total = 0
    for path in _files(store, folder):
        with store.open_input_file(path) as file:
            total += pq.ParquetFile(file).metadata.num_rows
    return total


class Log:
    """Segments and offset ranges of a log."""

    def __init__(self, path: str):
        self.store, self.root = open_store(path)

    def segments(self) -> dict[int, dict[int, str]]:
        return {p: _folders(self.store, folder, "segment")
                for p, folder in _folders(self.store, self.root, "partition").items()}

    def bounds(self) -> dict[int, tuple[int, int]]:
        """First offset and end of every partition that has a segment."""
        found = {}
        for p, segments in self.segments().items():
            if segments:
                last = max(segments)
                found[p] = min(segments), last + _records(self.store, segments[last])
        return found

    def slices(self, start: dict[str, int], end: dict[str, int], fail_on_loss: bool) -> list[SegmentSlice]:
        """The parts of segments that hold the records from ``start`` up to ``end``.

        Offsets that no segment holds are lost: an error, or left out when that is wanted.
        """
        found = []
        segments = self.segments()
        for name, stop in end.items():
            p, at = int(name), start.get(name, 0)
            if at >= stop:
                continue
            firsts = segments.get(p, {})
            for first, following in zip(firsts, [*list(firsts)[1:], None]):
                if first >= stop or (following is not None and following <= at):
                    continue
                until = first + _records(self.store, firsts[first])
                if until <= at:
                    continue
                if first > at:
                    _lost(p, at, first, fail_on_loss)
                    at = first
                found.append(SegmentSlice(p, firsts[first], at, min(until, stop)))
                at = min(until, stop)
            if at < stop:
                _lost(p, at, stop, fail_on_loss)
        return found


def _lost(partition: int, first: int, last: int, fail: bool) -> None:
    if fail:
        raise RuntimeError(f"offsets {first} to {last - 1} of log partition {partition} are missing")


@dataclass
class SegmentSlice(InputPartition):
    """Records ``first`` to ``last`` - 1 of one segment."""
    partition: int
    folder: str
    first: int
    last: int


def _groups(file: pq.ParquetFile, part: SegmentSlice) -> list[int]:
    """Row groups that may hold records of a slice, by their smallest and largest offset if they state them."""
    column = file.schema.names.index("offset")
    found = []
    for group in range(file.num_row_groups):
        stated = file.metadata.row_group(group).column(column).statistics
        if stated is None or not stated.has_min_max or (stated.min < part.last and stated.max >= part.first):
            found.append(group)
    return found


def read_slice(path: str, part: SegmentSlice, topic: str) -> Iterator[pa.RecordBatch]:
    store, _ = open_store(path)
    for name in _files(store, part.folder):
        with store.open_input_file(name) as file:
            held = pq.ParquetFile(file)
            for batch in held.iter_batches(row_groups=_groups(held, part), columns=["key", "value", "offset", "timestamp"]):
                offset = batch.column("offset")
                batch = batch.filter(pc.and_(pc.greater_equal(offset, part.first), pc.less(offset, part.last)))
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays([
                    batch.column("key"), batch.column("value"), pa.array([topic] * n, pa.string()),
                    pa.array([part.partition] * n, pa.int32()), batch.column("offset"),
                    batch.column("timestamp").cast(RECORD_TYPES.field("timestamp").type)], schema=RECORD_TYPES)


def named_offsets(text: str, bounds: dict[int, tuple[int, int]]) -> dict[str, int]:
    """``earliest``, ``latest``, or JSON with an offset per partition, where -2 is earliest and -1 latest.

    Partitions that the JSON leaves out start at their earliest record.
    """
    given = json.loads(text) if text.lstrip().startswith("{") else {}
    if not given and text not in ("earliest", "latest"):
        raise ValueError(f"offsets are earliest, latest or JSON, not {text!r}")
    usual = -1 if text == "latest" else -2
    picked = {str(p): int(given.get(str(p), usual)) for p in bounds}
    return {p: {-2: bounds[int(p)][0], -1: bounds[int(p)][1]}.get(at, at) for p, at in picked.items()}


class _Options:
    def __init__(self, options: dict[str, str]):
        if "path" not in options:
            raise ValueError("a log needs its path")
        self.path = options["path"]
        self.topic = options.get("topic", self.path.rstrip("/").rsplit("/", 1)[-1])
        self.starting = options.get("startingOffsets", "earliest")
        self.ending = options.get("endingOffsets", "latest")
        self.per_trigger = int(options.get("maxOffsetsPerTrigger", 1_000_000))
        self.fail_on_loss = options.get("failOnDataLoss", "true").lower() == "true"
        self.resume_from = options.get("resumeFrom")


class LogReader(DataSourceReader):
    def __init__(self, options: _Options):
        self.options = options

    def partitions(self) -> Sequence[InputPartition]:
        log, o = Log(self.options.path), self.options
        bounds = log.bounds()
        return log.slices(named_offsets(o.starting, bounds), named_offsets(o.ending, bounds), o.fail_on_loss)

    def read(self, partition: SegmentSlice) -> Iterator[pa.RecordBatch]:
        return read_slice(self.options.path, partition, self.options.topic)


class LogStreamReader(DataSourceStreamReader):
    """Offers at most ``maxOffsetsPerTrigger`` records beyond those offered last.

    Spark asks for the end of the next batch without saying where the last one ended. So the reader
    remembers it, and after a restart takes it from the query's checkpoint (``resumeFrom``).
    """

    def __init__(self, options: _Options):
        self.options = options
        self.log = Log(options.path)
        self.offered: dict[str, int] | None = None

    def initialOffset(self) -> dict:
        return named_offsets(self.options.starting, self.log.bounds())

    def _resumed(self) -> dict[str, int] | None:
        """End of the newest batch in the checkpoint's offset log."""
        if not self.options.resume_from:
            return None
        store, root = open_store(self.options.resume_from)
        listed = store.get_file_info(fs.FileSelector(f"{root}/offsets", allow_not_found=True))
        batches = {int(f.base_name): f.path for f in listed if f.base_name.isdigit()}
        if not batches:
            return None
        with store.open_input_stream(batches[max(batches)]) as file:
            lines = file.read().decode().splitlines()
        return json.loads(lines[2]) if len(lines) > 2 and lines[2] != "-" else None

    def latestOffset(self) -> dict:
        bounds = self.log.bounds()
        if self.offered is None:
            self.offered = self._resumed() or named_offsets(self.options.starting, bounds)
        at = {str(p): self.offered.get(str(p), first) for p, (first, _) in bounds.items()}
        # A partition whose folders are gone keeps its place, so that its loss is noticed when it returns.
        at = {**self.offered, **at}
        waiting = {p: max(0, bounds[int(p)][1] - n) for p, n in at.items() if int(p) in bounds}
        self.offered = {**at, **{p: at[p] + n for p, n in shares(waiting, self.options.per_trigger).items()}}
        return self.offered

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        return self.log.slices(start, end, self.options.fail_on_loss)

    def read(self, partition: SegmentSlice) -> Iterator[pa.RecordBatch]:
        return read_slice(self.options.path, partition, self.options.topic)


def shares(waiting: dict[str, int], limit: int) -> dict[str, int]:
    """How many records each partition adds to a batch of at most ``limit``, by what waits in it."""
    total = sum(waiting.values())
    if total <= limit:
        return waiting
    taken = {p: n * limit // total for p, n in waiting.items()}
    rest = limit - sum(taken.values())
    for p in sorted(waiting, key=lambda p: (taken[p] - waiting[p], p)):
        more = min(rest, waiting[p] - taken[p], 1)
        taken[p] += more
        rest -= more
    return taken


class LogSource(DataSource):
    """``spark.read.format("record-log")`` and ``spark.readStream.format("record-log")``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return RECORD

    def reader(self, schema) -> LogReader:
        return LogReader(_Options(self.options))

    def streamReader(self, schema) -> LogStreamReader:
        return LogStreamReader(_Options(self.options))


def append_log(records: DataFrame, path: str, order: Sequence[str], segment_records: int = SEGMENT_RECORDS) -> None:
    """Append records to a log, in new segments after those it has.

    ``records`` have ``key``, ``value``, ``partition`` and ``timestamp``; within a partition they get
    consecutive offsets in the order of the columns ``order``. A null partition is partition 0. A
    partition of more than ``NUMBERED_RECORDS`` is numbered in chunks, and each segment is written by one task.
    """
    spark = records.sparkSession
    ends = {p: end for p, (_, end) in Log(path).bounds().items()}
    placed = records.withColumn("partition", F.coalesce(F.col("partition").cast("int"), F.lit(0)))
    numbered = with_windows(placed, ["partition"], list(order), {"at": row_number()}, max_group_rows=NUMBERED_RECORDS,
                            rows_per_chunk=NUMBERED_RECORDS).withColumn("at", F.col("at") - 1)
    known = spark.createDataFrame(list(ends.items()) or [(0, 0)], "partition int, _end bigint")
    based = numbered.join(F.broadcast(known), "partition", "left").withColumn("_end", F.coalesce("_end", F.lit(0)))
    based.select(
        "key", "value", (F.col("_end") + F.col("at")).alias("offset"), F.col("timestamp").cast("timestamp"), "partition",
        (F.col("_end") + F.floor(F.col("at") / segment_records) * segment_records).cast("bigint").alias("segment")
    ).repartition("partition", "segment").sortWithinPartitions("partition", "segment", "offset").write.mode(
        "append").option("parquet.block.row.count.limit", GROUP_RECORDS).partitionBy("partition", "segment").parquet(path)


def log_batch(spark: SparkSession, path: str, **options) -> DataFrame:
    """Bounded read; options as ``startingOffsets``, ``endingOffsets``, ``failOnDataLoss``, ``topic``."""
    spark.dataSource.register(LogSource)
    return spark.read.format(FORMAT).options(path=path, **options).load()


def log_stream(spark: SparkSession, path: str, checkpoint: str, **options) -> DataFrame:
    """Unbounded read for a query with this ``checkpoint``; options also ``maxOffsetsPerTrigger``.

    Run it with a processing-time trigger: ``availableNow`` takes one batch from a source of this kind.
    """
    spark.dataSource.register(LogSource)
    return spark.readStream.format(FORMAT).options(path=path, resumeFrom=checkpoint, **options).load()
