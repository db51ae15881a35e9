"""Streams over several files: late data, restarts, state across batches, and parity with batch."""

from __future__ import annotations

import os
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidewater.operators.windows import running_sum, with_windows
from tidewater.streaming import aggregates as S
from tidewater.streaming import sinks
from tidewater.streaming.sources import parse_records, stream_files, with_event_time
from tidewater.streaming.state import ThresholdTrigger

START = datetime(2024, 1, 1)


def slices(spark, path, frames):
    """Write each frame as one file, with modification times that fix their order."""
    for i, frame in enumerate(frames):
        target = f"{path}/slice{i}"
        frame.coalesce(1).write.parquet(target)
        stamp = time.time() - 1000 + 10 * i
        for name in os.listdir(target):
            os.utime(f"{target}/{name}", (stamp, stamp))
    return f"{path}/*"


def stream_of(spark, path, schema):
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
    return reader.parquet(path)


def minutes(spark, values):
    return spark.createDataFrame(
        [(k, START + timedelta(minutes=m), i) for i, (k, m) in enumerate(values)], "k string, ts timestamp, i bigint")


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    frames = [minutes(spark, [("a", 0), ("a", 1)]), minutes(spark, [("a", 60), ("a", 2)]),
              minutes(spark, [("a", 61), ("a", 3), ("a", 4)]), minutes(spark, [("a", 62), ("a", 5)])]
    path = slices(spark, f"{tmp_path}/in", frames)
    stream = with_event_time(stream_of(spark, path, frames[0].schema), "ts", "5 minutes")
    counts = S.window_agg(stream, "event_time", "10 minutes", ["k"], [F.count(F.lit(1)).alias("n")])
    with sinks.ProgressLog(spark, f"{tmp_path}/progress") as log:
        q = sinks.start_query(counts, f"{tmp_path}/cp", path=f"{tmp_path}/out")
        q.awaitTermination()
        progress = log.table(q)
    # The watermark passes the first window with the second file. Spark judges lateness by the
    # watermark of the batch before, so the third file still counts and the fourth is late.
    assert rows(spark.read.parquet(f"{tmp_path}/out").select("k", "n")) == [("a", 5)]
    assert progress.agg(F.sum("late_rows_dropped")).first()[0] == 1
    assert progress.agg(F.sum("input_rows")).first()[0] == 9


def test_stream_equals_batch_for_closed_windows(spark, tables, tmp_path):
    events = tables.events
    cut = events.agg(F.percentile_approx("event_id", [0.33, 0.66])).first()[0]
    frames = [events.filter(F.col("event_id") <= cut[0]), events.filter(F.col("event_id").between(cut[0] + 1, cut[1])),
              events.filter(F.col("event_id") > cut[1])]
    path = slices(spark, f"{tmp_path}/in", frames)
    measures = [F.count(F.lit(1)).alias("n"), F.max("value").alias("high")]
    stream = with_event_time(stream_of(spark, path, events.schema), "ts", "5 minutes")
    streamed = sinks.run_to_table(S.window_agg(stream, "event_time", "1 hour", ["event_type"], measures), "parity")
    closed = events.agg(F.max("ts")).first()[0] - timedelta(minutes=5)
    batch = S.window_agg(events, "ts", "1 hour", ["event_type"], measures).filter(F.col("window_end") <= F.lit(closed))
    # Events are in time order, so no row is late and the closed windows agree.
    assert rows(streamed) == rows(batch)


@pytest.mark.parametrize("salts", [0, 3])
def test_dedupe_across_batches(spark, tmp_path, salts):
    frames = [minutes(spark, [("a", 0), ("a", 0), ("b", 0)]), minutes(spark, [("a", 0), ("a", 1)])]
    path = slices(spark, f"{tmp_path}/in", frames)
    stream = stream_of(spark, path, frames[0].schema).withColumnRenamed("ts", "event_time").withWatermark(
        "event_time", "10 minutes")
    out = sinks.run_to_table(S.dedupe(stream, ["k"], salts=salts).select("k", "event_time"), "dedupe")
    assert sorted((r["k"], r["event_time"].minute) for r in out.collect()) == [("a", 0), ("a", 1), ("b", 0)]


@pytest.mark.parametrize("every", [1, 2, 50])
def test_threshold_trigger_carries_totals(spark, tmp_path, every):
    amounts = spark.createDataFrame([("a", i, float(x)) for i, x in enumerate([100, 200, 250, 300, 150])]
                                    + [("b", 9, 10.0)], "k string, i bigint, x double")
    path = slices(spark, f"{tmp_path}/in", [amounts.filter("i < 2"), amounts.filter("i = 2"), amounts.filter("i > 2")])
    trigger = ThresholdTrigger("k", ["i"], "x", 500.0, f"{tmp_path}/state", full_every=every, max_group_rows=1, rows_per_chunk=2)
    sinks.start_query(stream_of(spark, path, amounts.schema), f"{tmp_path}/cp", each_batch=trigger).awaitTermination()
    fired = trigger.fired(spark).orderBy("i")
    assert [r["total"] for r in fired.collect()] == [550.0, 850.0, 1000.0]
    batch = with_windows(amounts, ["k"], ["i"], {"total": running_sum("x")}).filter("total >= 500")
    assert rows(fired.select("k", "i", "total")) == rows(batch.select("k", "i", "total"))
    # The same batch again replaces its own output.
    trigger(amounts.filter("i > 2"), 2)
    assert trigger.fired(spark).count() == 3


def test_threshold_trigger_fires_at_the_exact_total(spark, tmp_path):
    amounts = [("a", i, 0.1) for i in range(4999)] + [("a", 5000, 0.1), ("a", 5001, 0.01), ("b", 1, 499.99)]
    frame = spark.createDataFrame(amounts, "k string, i bigint, x double").withColumn("x", F.col("x").cast("decimal(18,2)"))
    trigger = ThresholdTrigger("k", ["i"], "x", 500, f"{tmp_path}/state", full_every=2)
    for number, part in enumerate(("i < 2000", "i >= 2000 AND i < 4000", "i >= 4000")):
        trigger(frame.filter(part), number)
    assert [(r["i"], float(r["total"])) for r in trigger.fired(spark).orderBy("i").collect()] == [
        (5000, 500.0), (5001, 500.01)]


def test_threshold_trigger_carries_the_null_key_and_keys_that_pause(spark, tmp_path):
    trigger = ThresholdTrigger("k", ["i"], "x", 100.0, f"{tmp_path}/state", full_every=2)
    for number, rows_ in enumerate([[(None, 1, 60.0), ("a", 2, 70.0)], [(None, 3, 60.0)], [("b", 4, 5.0)], [("a", 5, 40.0)]]):
        trigger(spark.createDataFrame(rows_, "k string, i bigint, x double"), number)
    assert sorted((r["i"], r["k"], r["total"]) for r in trigger.fired(spark).collect()) == [(3, None, 120.0), (5, "a", 110.0)]


def test_first_per_key_keeps_the_smallest(spark):
    frame = spark.createDataFrame(
        [(3, "s", START, 9.0), (1, "s", START, None), (1, "s", START, None), (2, None, START, 4.0), (7, "s", None, 1.0)],
        "i bigint, k string, event_time timestamp, x double")
    assert sorted((r["i"], r["k"], r["x"]) for r in S.first_per_key(frame, ["k"], "i").collect()) == [
        (1, "s", None), (2, None, 4.0)]


def test_threshold_trigger_refuses_a_missing_carry(spark, tmp_path):
    trigger = ThresholdTrigger("k", ["i"], "x", 1.0, f"{tmp_path}/none")
    with pytest.raises(RuntimeError, match="carry"):
        trigger(spark.createDataFrame([("a", 1, 1.0)], "k string, i bigint, x double"), 5)


def test_update_versions_keep_the_last(spark, tmp_path):
    frames = [minutes(spark, [("a", 0), ("b", 0)]), minutes(spark, [("a", 1)])]
    path = slices(spark, f"{tmp_path}/in", frames)
    counts = stream_of(spark, path, frames[0].schema).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    versions = sinks.run_versions(counts, "versions", "update")
    assert rows(versions.select("k", "n")) == [("a", 1), ("a", 2), ("b", 1)]
    assert rows(sinks.latest_version(versions, ["k"])) == [("a", 2), ("b", 1)]


def test_restart_continues_after_new_files(spark, tmp_path):
    first = minutes(spark, [("a", 0)])
    path = slices(spark, f"{tmp_path}/in", [first])

    def run():
        stream = stream_of(spark, path, first.schema)
        sinks.start_query(stream, f"{tmp_path}/cp", path=f"{tmp_path}/out").awaitTermination()
        return spark.read.parquet(f"{tmp_path}/out").count()

    assert [run(), run()] == [1, 1]
    minutes(spark, [("b", 5), ("b", 6)]).coalesce(1).write.parquet(f"{tmp_path}/in/slice9")
    assert run() == 3


def test_bad_json_gives_null_columns(spark):
    records = spark.createDataFrame([('{"a": 1, "t": "2024-01-01 00:00:00"}',), ("broken",)], "value string")
    out = parse_records(records, "a int, t string", "t").orderBy(F.col("a").desc()).collect()
    assert out[0]["event_time"] is not None
    assert (out[1]["a"], out[1]["event_time"]) == (None, None)


def test_stream_files_reads_a_file_or_a_folder(spark, tables, tmp_path):
    tables.nation.write.parquet(f"{tmp_path}/nation")
    for path in (tables.path("nation"), f"{tmp_path}/nation"):
        assert sinks.run_to_table(stream_files(spark, path, tables.nation.schema), "paths").count() == 25


def test_sensor_chain_matches_batch(spark, tables):
    """All readings of a sensor and second agree here, so the survivor of the dedupe is known."""
    from tidewater.plans.streams import event_stream
    from tidewater.plans.tables import sensors_of
    from tidewater.functions.expressions import parse_event_time

    def timed(events):
        return sensors_of(events).withColumn("event_time", parse_event_time(F.col("timestamp"))).filter(
            F.col("event_time").isNotNull())

    clashes = timed(tables.events).groupBy("sensor_id", "event_time").agg(
        F.countDistinct("event_id").alias("c")).filter("c > 1")
    stream = timed(event_stream(tables)).withWatermark("event_time", "5 minutes")
    streamed = sinks.run_to_table(S.sensor_windows(S.clean_sensor_stream(stream)), "chain")
    batch = S.sensor_windows(S.clean_sensor_stream(timed(tables.events)))
    last = timed(tables.events).agg(F.max("event_time")).first()[0] - timedelta(minutes=5)
    spoiled = S.window_agg(clashes, "event_time", "5 minutes", ["sensor_id"], [F.count(F.lit(1))]).select(
        "window_start", "sensor_id")
    key = ["window_start", "sensor_id"]
    expected = batch.filter(F.col("window_end") <= F.lit(last).cast("timestamp_ntz")).join(spoiled, key, "left_anti")
    assert rows(streamed.join(spoiled, key, "left_anti").select(expected.columns)) == rows(expected)


def test_progress_log_keeps_more_batches_than_the_engine(spark, tmp_path):
    """Twelve batches, two retained by the engine, blocks of five: twelve rows."""
    frames = [minutes(spark, [("a", i)]) for i in range(12)]
    path = slices(spark, f"{tmp_path}/in", frames)
    stream = stream_of(spark, path, frames[0].schema)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        with sinks.ProgressLog(spark, f"{tmp_path}/progress", block=5) as log:
            q = sinks.start_query(stream, f"{tmp_path}/cp", "noop")
            q.awaitTermination()
            progress = log.table(q)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert len(q.recentProgress) <= 2
    assert progress.agg(F.countDistinct("batch"), F.sum("input_rows")).first()[:] == (12, 12)


def test_cleaning_spans_micro_batches(spark, tables, tmp_path):
    from tidewater.functions import expressions as X
    from tidewater.operators.cleaning import clean_sensors
    from tidewater.plans.streams import clean_in_batches
    from tidewater.plans.tables import sensors_of

    tables.events.unionByName(tables.events.withColumn("event_id", F.col("event_id") + 1_000_000)).repartition(
        4, "event_id").write.parquet(f"{tmp_path}/events")

    def readings(events):
        return sensors_of(events).withColumn("event_time", X.parse_event_time(F.col("timestamp")))

    def found(df):
        return rows(df.select("event_id", "sensor_id", F.round("temperature", 4).alias("temperature"), "status", "hour_of_day"))

    stream = stream_files(spark, f"{tmp_path}/events", tables.events.schema, max_files=1)
    cleaned = found(clean_in_batches(readings(stream), f"{tmp_path}/out"))
    assert len(list((tmp_path / "out" / "sums").glob("batch=*"))) > 1
    assert cleaned == found(clean_sensors(readings(spark.read.parquet(f"{tmp_path}/events"))))
