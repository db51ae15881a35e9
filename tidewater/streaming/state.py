"""Keyed state across micro-batches."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import timedelta

import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import DecimalType

from tidewater.operators.layout import persisted
from tidewater.operators.windows import running_sum, with_windows
from tidewater.session import DEFAULTS


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, as stateful processors need it.

    A query takes the setting over when it starts, so the session's own value is put back after.
    """
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, DEFAULTS[name])
    try:
        yield
    finally:
        spark.conf.set(name, before)


MOMENTS = "n bigint, mean double, m2 double"
#: Partial rows that a task holds before it merges them again.
PARTIAL_ROWS = 100_000


def merged_moments(parts: pd.DataFrame, key: str) -> pd.DataFrame:
    """Count, mean and squared deviations per key from those of parts, by Chan's formula for many parts."""
    parts = parts.assign(weighted=parts["n"] * parts["mean"].where(parts["n"] > 0, 0.0))
    keys = parts.groupby(key, dropna=False, sort=False)
    n, mean = keys["n"].transform("sum"), keys["weighted"].transform("sum")
    mean = mean / n.where(n > 0, 1)
    apart = (parts["mean"].where(parts["n"] > 0, 0.0) - mean) ** 2 * parts["n"]
    spread = parts.assign(m2=parts["m2"].where(parts["n"] > 0, 0.0) + apart, mean=mean)
    return spread.groupby(key, dropna=False, sort=False).agg({"n": "sum", "mean": "first", "m2": "sum"}).reset_index()


class RunningMoments(StatefulProcessor):
    """State of a key: count, mean and squared deviations of all its values so far."""

    def __init__(self, key: str):
        self.key = key

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.moments = handle.getValueState("moments", MOMENTS)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        parts = [frame[["n", "mean", "m2"]] for frame in rows]
        if self.moments.exists():
            parts.append(pd.DataFrame([self.moments.get()], columns=["n", "mean", "m2"]))
        one = merged_moments(pd.concat(parts).assign(_one=0), "_one").iloc[0]
        new = int(one["n"]), float(one["mean"]), float(one["m2"])
        self.moments.update(new)
        yield pd.DataFrame({self.key: [key[0]], "n": [new[0]], "mean": [new[1]], "m2": [new[2]]})

    def close(self) -> None:
        pass


def running_moments(stream: DataFrame, key: str, value: str) -> DataFrame:
    """``n``, ``mean`` and ``m2`` per key after every micro-batch that touches it, for update mode.

    A task reduces its rows to one row per key before the shuffle (it merges again and passes on
    when it holds PARTIAL_ROWS), so a key with a third of all rows is a row per task. Null values
    do not count; a key without values has n = 0. The null key is a key of its own.
    """
    key_type = stream.schema[key].dataType.simpleString()

    def reduce_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(frame: pd.DataFrame) -> pa.RecordBatch:
            return pa.RecordBatch.from_pandas(frame, schema=schema, preserve_index=False)

        held, schema = [], None
        for batch in batches:
            schema = pa.schema([batch.schema.field(0), ("n", pa.int64()), ("mean", pa.float64()), ("m2", pa.float64())])
            found = pa.Table.from_batches([batch]).rename_columns([key, "v"]).group_by(key).aggregate(
                [("v", "count"), ("v", "mean"), ("v", "variance")]).to_pandas()
            held.append(pd.DataFrame({key: found[key], "n": found["v_count"], "mean": found["v_mean"],
                                      "m2": found["v_variance"] * found["v_count"]}))
            if sum(map(len, held)) > PARTIAL_ROWS:
                held = [merged_moments(pd.concat(held), key)]
                if len(held[0]) > PARTIAL_ROWS // 2:
                    yield rows(held.pop())
        if held:
            yield rows(merged_moments(pd.concat(held), key))

    schema = f"{key} {key_type}, {MOMENTS}"
    partial = stream.select(key, F.col(value).cast("double")).mapInArrow(reduce_rows, schema)
    return partial.groupBy(key).transformWithStateInPandas(RunningMoments(key), schema, "Update", "None")


RUN = "last bigint, n bigint"


class OccurrenceAlerts(StatefulProcessor):
    """State of a key: its current run, which an event-time timer ends ``idle`` after its last event."""

    def __init__(self, key: str, n: int, idle_us: int):
        self.key, self.n, self.idle_us = key, n, idle_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.run = handle.getValueState("run", RUN)

    def _ends(self, last: int) -> int:
        return (last + self.idle_us) // 1000 + 1

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        parts = sorted((start, last, int(n), list(zip(times, orders)))
                       for frame in rows
                       for start, last, n, times, orders in zip(*(frame[c] for c in ("start", "until", "n", "times", "orders"))))
        last, count = self.run.get() if self.run.exists() else (None, 0)
        if last is not None:
            self.handle.deleteTimer(self._ends(last))
        alerts: list[int] = []
        earliest: list[tuple] = []
        before = count
        for start, until, n, first in [*parts, (None, None, 0, [])]:
            if last is not None and (start is None or start > last + self.idle_us):
                alerts += self._alert(before, count, earliest)
                if start is None:
                    break
                last, count, earliest, before = None, 0, [], 0
            last = until if last is None else max(last, until)
            count += n
            earliest = sorted(earliest + first)[:self.n]
        self.run.update((last, count))
        if last is not None and timerValues.getCurrentWatermarkInMs() < self._ends(last):
            self.handle.registerTimer(self._ends(last))
        else:
            self.run.clear()
        if alerts:
            yield pd.DataFrame({self.key: [key[0]] * len(alerts), "at": alerts, "n": self.n})

    def _alert(self, before: int, count: int, earliest: list[tuple]) -> list[int]:
        return [earliest[self.n - before - 1][1]] if before < self.n <= count else []

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.run.clear()
        return iter([])

    def close(self) -> None:
        pass


def nth_occurrence_alerts(events: DataFrame, key: str, time: str, order: str, n: int, idle: timedelta,
                          delay: str = "0 seconds") -> DataFrame:
    """One alert at the ``n``-th event of each run of a key; ``order`` is a whole number.

    A run ends when the key has no event for longer than ``idle``; counting then starts anew. The
    state of a key is one counter and goes when the watermark (``delay`` behind the latest event)
    passes the end of its run, so the state holds only keys that were active lately. Events that
    arrive out of order within a batch are sorted; older ones count with the current run.

    Each Arrow batch is first reduced to the runs of its keys with their ``n`` first events, so a
    hot key sends a few rows per batch. Partial runs that the events of another task join are
    merged. Rows without a time or order take no part; the null key is a key of its own.
    """
    key_type = events.schema[key].dataType.simpleString()
    idle_us = idle // timedelta(microseconds=1)

    def reduce_rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if not len(frame):
                continue
            frame = frame.sort_values([key, "_time", order], ignore_index=True)
            same = frame[key].eq(frame[key].shift()) | (frame[key].isna() & frame[key].shift().isna() & (frame.index > 0))
            run = (~(same & (frame["_time"].diff() <= idle_us))).cumsum()
            runs = frame.groupby(run, sort=False)
            first = frame[runs.cumcount() < n]
            first = first.groupby(run[first.index], sort=False)
            yield pd.DataFrame({
                key: runs[key].first() if not frame[key].isna().any() else runs[key].agg(lambda k: k.iloc[0]),
                "start": runs["_time"].min(), "until": runs["_time"].max(), "n": runs.size(),
                "times": first["_time"].agg(list), "orders": first[order].agg(list),
                "seen": pd.to_datetime(runs["_time"].max(), unit="us")}).reset_index(drop=True)

    timed = events.filter(F.col(time).isNotNull() & F.col(order).isNotNull())
    partial = timed.select(key, F.unix_micros(F.col(time).cast("timestamp")).alias("_time"),
                           F.col(order).cast("bigint").alias(order)).mapInPandas(
        reduce_rows, f"{key} {key_type}, start bigint, until bigint, n bigint, times array<bigint>, "
                     "orders array<bigint>, seen timestamp").withWatermark("seen", delay)
    return partial.groupBy(key).transformWithStateInPandas(
        OccurrenceAlerts(key, n, idle_us), f"{key} {key_type}, at bigint, n bigint", "Append", "EventTime")


class ThresholdTrigger:
    """``foreachBatch`` writer that emits every running total at or above a threshold.

    A batch writes the sums of its own keys to a folder of its own; every ``full_every``-th batch
    writes the totals of all keys instead, and no batch reads further back than that. A repeated
    batch reads the same carry and overwrites its own output, so a restart gives the same rows.
    Inside a batch, the running sum splits hot keys into chunks.
    """

    def __init__(self, key: str, order: Sequence[str], value: str, threshold: float, base: str,
                 full_every: int = 50, **window_options):
        self.key, self.order, self.value = key, list(order), value
        self.threshold, self.base, self.options = threshold, base, window_options
        self.full_every = full_every

    def _carry(self, spark, batch_id: int) -> DataFrame | None:
        """Sums of all batches before this one, in parts."""
        if batch_id == 0:
            return None
        full = (batch_id - 1) // self.full_every * self.full_every
        try:
            return spark.read.parquet(*[f"{self.base}/carry/batch={b}" for b in range(full, batch_id)])
        except AnalysisException:
            raise RuntimeError(f"the carry of batches {full} to {batch_id - 1} is missing under {self.base}") from None

    def _sums(self, parts: DataFrame, value: str = "total") -> DataFrame:
        """Totals per key; decimals get the widest type at once, so that all batches write the same one."""
        kind, total = parts.schema[value].dataType, F.sum(value)
        wide = total.cast(DecimalType(38, kind.scale)) if isinstance(kind, DecimalType) else total
        return parts.groupBy(self.key).agg(wide.alias("total"))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        with persisted(batch) as kept:
            self._write(kept, batch_id)

    def _write(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        totals = self._sums(batch, self.value)
        running = with_windows(batch, [self.key], self.order, {"total": running_sum(self.value)},
                               **self.options)
        running = running.withColumn("total", F.col("total").cast(totals.schema["total"].dataType))
        carry = self._carry(spark, batch_id)
        if carry is not None:
            here = totals.select(F.col(self.key).alias("_key"))
            known = self._sums(carry.join(here, F.col(self.key).eqNullSafe(F.col("_key")), "left_semi")).select(
                F.col(self.key).alias("_key"), F.col("total").alias("_carried"))
            running = running.join(known, F.col(self.key).eqNullSafe(F.col("_key")), "left").withColumn(
                "total", (F.col("total") + F.coalesce(F.col("_carried"), F.lit(0))).cast(totals.schema["total"].dataType)).drop("_key", "_carried")
            if batch_id % self.full_every == 0:
                totals = self._sums(totals.unionByName(carry))
        running.filter(F.col("total") >= self.threshold).write.mode("overwrite").parquet(
            f"{self.base}/fired/batch={batch_id}")
        totals.write.mode("overwrite").parquet(f"{self.base}/carry/batch={batch_id}")

    def fired(self, spark) -> DataFrame:
        return spark.read.parquet(f"{self.base}/fired")
