"""Starting queries, keyed file sinks and progress records."""

from __future__ import annotations

import json
from collections.abc import Callable
from concurrent.futures import Future, ThreadPoolExecutor
from functools import reduce
from threading import Condition

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidewater.operators.layout import persisted
from tidewater.operators.windows import best_per_key
from tidewater.session import scratch_path
from tidewater.sources.files import write_partitioned


def start_query(df: DataFrame, checkpoint: str, fmt: str | None = None, path: str | None = None,
                mode: str = "append", name: str | None = None, each_batch: Callable | None = None,
                every: str | None = None, **options) -> StreamingQuery:
    """Start a query with its own checkpoint.

    ``every`` is a processing-time interval; without it the query takes what is available, in
    as many micro-batches as the source asks for, and ends.
    """
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).options(**options)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    if name:
        writer = writer.queryName(name)
    if each_batch:
        return writer.foreachBatch(each_batch).start()
    writer = writer.format(fmt or "parquet")
    return writer.start(path) if path else writer.start()


def run_through(query: StreamingQuery) -> None:
    """Let a query with a processing-time trigger take all that its source has now, and end it."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def run_to_table(df: DataFrame, label: str) -> DataFrame:
    """Run an append query over what is available and read back what it wrote."""
    spark = df.sparkSession
    base = scratch_path(spark, label)
    start_query(df, f"{base}/checkpoint", path=f"{base}/out").awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{base}/out")


def run_versions(df: DataFrame, label: str, mode: str) -> DataFrame:
    """Run an update or complete query and read all emitted versions, with their ``batch``.

    Each batch overwrites its own folder, so a repeated batch does not add rows twice.
    """
    spark = df.sparkSession
    base = scratch_path(spark, label)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/out/batch={batch_id}")

    start_query(df, f"{base}/checkpoint", mode=mode, each_batch=write).awaitTermination()
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in df.schema)}, batch bigint"
    return spark.read.schema(schema).parquet(f"{base}/out")


def latest_version(versions: DataFrame, keys: list[str]) -> DataFrame:
    """The last emitted row per key of an update-mode result."""
    return best_per_key(versions, keys, [("batch", "desc")]).drop("batch")


def newest_batch(versions: DataFrame) -> DataFrame:
    """The last full result of a complete-mode query."""
    last = versions.agg(F.max("batch").alias("b")).scalar()
    return versions.filter(F.col("batch") == last).drop("batch")


class KeyedStore:
    """``foreachBatch`` writer that keeps one row per key, the one of the newest batch, by year and month.

    A batch writes its rows to a folder of its own and then a commit: the folders that are valid for
    every month. Readers follow the newest commit, so a batch that failed is invisible, and a batch
    that runs again builds on the commit before it and leaves the same table. A month is merged into
    one folder when a later month has begun or when it has more than ``max_folders``; only that month
    is read for it. Folders that no commit names any more can go by an expiry rule.

    Keys must decide ``time``, so that a key stays in its month. Null keys are keys like others.
    """

    COMMIT = "year int, month int, folder string, number bigint"

    def __init__(self, path: str, keys: list[str], time: str = "window_start", max_folders: int = 8):
        self.path, self.keys, self.time, self.max_folders = path, list(keys), time, max_folders

    def _commit_of(self, spark: SparkSession, batch_id: int) -> dict[tuple, list[tuple]]:
        """Month -> its valid (batch number, folder), after the given batch."""
        if batch_id < 0:
            return {}
        try:
            rows = spark.read.schema(self.COMMIT).parquet(f"{self.path}/commits/batch={batch_id}").collect()
        except AnalysisException:
            raise RuntimeError(f"the commit of batch {batch_id} is missing under {self.path}") from None
        found: dict[tuple, list[tuple]] = {}
        for r in sorted(rows, key=lambda r: r["number"]):
            found.setdefault((r["year"], r["month"]), []).append((r["number"], r["folder"]))
        return found

    def _newest(self, spark: SparkSession, months: dict[tuple, list[tuple]], schema) -> DataFrame:
        """The newest row per key of some months, from one read per batch number that they name."""
        by_number: dict[int, list[str]] = {}
        for folders in months.values():
            for number, folder in folders:
                by_number.setdefault(number, []).append(f"{self.path}/{folder}")
        parts = [spark.read.schema(schema).parquet(*folders).withColumn("_number", F.lit(number))
                 for number, folders in sorted(by_number.items())]
        rows = reduce(DataFrame.unionByName, parts)
        merged = all(len(folders) == 1 for folders in months.values())
        return (rows if merged else best_per_key(rows, self.keys, [("_number", "desc")])).drop("_number")

    def _stamped(self, rows: DataFrame) -> DataFrame:
        """With ``year`` and ``month``, 0 where there is no time."""
        return rows.withColumns({"year": F.coalesce(F.year(self.time), F.lit(0)),
                                 "month": F.coalesce(F.month(self.time), F.lit(0))})

    def _months(self, spark: SparkSession, folder: str) -> list[tuple[int, int]]:
        """The months that a delta holds, from its folders."""
        rows = spark.read.schema("year int, month int").parquet(folder)
        return [(r["year"], r["month"]) for r in rows.distinct().collect()]

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        valid = self._commit_of(spark, batch_id - 1)
        # One action on the batch: a second one would compute its state again, or need a copy of all its rows.
        write_partitioned(self._stamped(batch), f"{self.path}/delta-{batch_id}", ["year", "month"])
        touched = self._months(spark, f"{self.path}/delta-{batch_id}")
        for m in touched:
            valid.setdefault(m, []).append((batch_id, f"delta-{batch_id}/year={m[0]}/month={m[1]}"))
        newest = max(valid, default=None)
        due = {m: folders for m, folders in valid.items()
               if len(folders) > 1 and (m != newest or len(folders) > self.max_folders)}
        if due:
            write_partitioned(self._stamped(self._newest(spark, due, batch.schema)), f"{self.path}/merged-{batch_id}",
                              ["year", "month"])
            valid |= {m: [(batch_id, f"merged-{batch_id}/year={m[0]}/month={m[1]}")] for m in due}
        rows = [(*m, folder, number) for m, folders in valid.items() for number, folder in folders]
        spark.createDataFrame(rows, self.COMMIT).coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/commits/batch={batch_id}")

    def table(self, spark: SparkSession, schema) -> DataFrame:
        """One row per key as of the newest commit, with ``year`` and ``month``."""
        commits = spark.read.schema(f"{self.COMMIT}, batch bigint").parquet(f"{self.path}/commits")
        last = commits.agg(F.max("batch")).first()[0]
        valid = self._commit_of(spark, -1 if last is None else last)
        merged = {m: folders for m, folders in valid.items() if len(folders) == 1}
        parts = [self._newest(spark, months, schema)
                 for months in (merged, {m: f for m, f in valid.items() if m not in merged}) if months]
        return self._stamped(reduce(DataFrame.unionByName, parts, spark.createDataFrame([], schema)))


class LateSplit:
    """``foreachBatch`` writer that parts the rows behind the watermark from all others.

    A row is late when its time is not after the watermark by which Spark judges its batch: the
    latest time of the batches up to the one before the last, less the delay. So the late rows are
    the ones that a stateful operator of the same stream drops. Rows without a time are not late.
    A batch carries one number and replaces its own folders when it runs again.
    """

    def __init__(self, time: str, delay: str, base: str):
        self.time, self.delay, self.base = time, delay, base

    def _high(self, spark: SparkSession, batch_id: int):
        """Latest time of all batches up to ``batch_id``; a single value."""
        if batch_id < 0:
            return None
        try:
            return spark.read.schema("high timestamp").parquet(f"{self.base}/high/batch={batch_id}").first()["high"]
        except AnalysisException:
            raise RuntimeError(f"the latest time of batch {batch_id} is missing under {self.base}") from None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        time = F.col(self.time)
        judged = F.lit(self._high(spark, batch_id - 2)).cast("timestamp") - F.expr(f"INTERVAL {self.delay}")
        late = F.coalesce(time <= judged, F.lit(False))
        with persisted(batch) as kept:
            kept.filter(~late).write.mode("overwrite").parquet(f"{self.base}/kept/batch={batch_id}")
            kept.filter(late).write.mode("overwrite").parquet(f"{self.base}/late/batch={batch_id}")
            before = F.lit(self._high(spark, batch_id - 1)).cast("timestamp")
            kept.agg(F.greatest(F.max(time), before).alias("high")).write.mode("overwrite").parquet(
                f"{self.base}/high/batch={batch_id}")

    def tables(self, spark: SparkSession, schema) -> tuple[DataFrame, DataFrame]:
        """Kept rows and late rows of all batches."""
        read = spark.read.schema(schema)
        return read.parquet(f"{self.base}/kept/batch=*"), read.parquet(f"{self.base}/late/batch=*")


PROGRESS_SCHEMA = (
    "run string, query string, batch bigint, input_rows bigint, input_rate double, processing_rate double, "
    "duration_ms bigint, late_rows_dropped bigint"
)


def progress_row(progress) -> tuple:
    """Run, query, batch number, rates, duration and late rows of one progress report."""
    p = progress if isinstance(progress, dict) else json.loads(progress.json)
    dropped = sum(op.get("numRowsDroppedByWatermark", 0) for op in p.get("stateOperators", []))
    return (str(p["runId"]), p.get("name"), p["batchId"], p["numInputRows"], float(p.get("inputRowsPerSecond") or 0),
            float(p.get("processedRowsPerSecond") or 0), p.get("durationMs", {}).get("triggerExecution", 0),
            dropped)


class ProgressLog(StreamingQueryListener):
    """Every progress report of the session's queries while the ``with`` block lasts, as rows in a folder.

    Reports go to the folder in blocks of ``block`` and at the end of a query, so none is dropped,
    however long a query runs. A thread of its own writes the blocks, so that a report never waits
    for a write.
    """

    def __init__(self, spark: SparkSession, path: str, block: int = 100):
        self.spark, self.path, self.block = spark, path, block
        self.waiting: list[tuple] = []
        self.ended: set[str] = set()
        self.change = Condition()
        self.writer = ThreadPoolExecutor(1)
        self.writes: list[Future] = []

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *error) -> None:
        self.spark.streams.removeListener(self)
        self.flush()
        self.writer.shutdown()

    def write(self) -> None:
        """Hand the waiting reports to the writing thread."""
        with self.change:
            rows, self.waiting = self.waiting, []
            if rows:
                self.writes = [w for w in self.writes if not w.done() or w.exception()]
                self.writes.append(self.writer.submit(self.store, rows))

    def store(self, rows: list[tuple]) -> None:
        self.spark.createDataFrame(rows, PROGRESS_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def flush(self) -> None:
        """Write what waits and raise what went wrong in any write."""
        self.write()
        with self.change:
            writes, self.writes = self.writes, []
        for write in writes:
            write.result()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        with self.change:
            self.waiting.append(progress_row(event.progress))
        if len(self.waiting) >= self.block:
            self.write()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.change:
            self.ended.add(str(event.runId))
            self.change.notify_all()

    def table(self, query: StreamingQuery, timeout: float = 60) -> DataFrame:
        """All reports of a query that has ended; they reach a listener shortly after its end."""
        run = str(query.runId)
        with self.change:
            if not self.change.wait_for(lambda: run in self.ended, timeout):
                raise TimeoutError(f"no end of query {run} was reported")
        self.flush()
        rows = self.spark.read.schema(PROGRESS_SCHEMA).parquet(self.path)
        return rows.filter(F.col("run") == run).drop("run")
