"""Keyed state, sessions, late rows and the keyed store over several micro-batches."""

from __future__ import annotations

import glob
import math
import statistics
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import rows
from test_streaming import slices, stream_of
from tidewater.operators.aggregates import sessions
from tidewater.operators.windows import nth_row
from tidewater.sources.log_source import append_log, log_stream
from tidewater.streaming import aggregates as S
from tidewater.streaming import sinks
from tidewater.streaming import state
from tidewater.streaming.sources import with_event_time

START = datetime(2024, 1, 1)


def test_moments_merge_in_any_grouping():
    rng = np.random.default_rng(2)
    values = rng.normal(1e6, 3, 500)
    parts = pd.DataFrame({"k": ["a"] * 6, "n": 0, "mean": np.nan, "m2": np.nan})
    for i, cut in enumerate(np.split(values, [3, 4, 100, 350])):
        parts.loc[i, ["n", "mean", "m2"]] = len(cut), cut.mean(), ((cut - cut.mean()) ** 2).sum()
    one = state.merged_moments(parts, "k").iloc[0]
    assert one["n"] == 500 and math.isclose(one["mean"], values.mean(), rel_tol=1e-12)
    assert math.isclose(one["m2"], values.var() * 500, rel_tol=1e-9)
    nothing = state.merged_moments(parts[parts["n"] == 0], "k").iloc[0]
    assert (nothing["n"], nothing["m2"]) == (0, 0)


def test_running_moments_span_batches_and_a_restart(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(state, "PARTIAL_ROWS", 2)
    values = [("a", 1.0), ("b", None), ("a", 2.5), (None, 4.0), ("a", None), ("a", 7.25), ("c", 3.0), (None, 5.0), ("a", -1.0)]
    frames = [spark.createDataFrame(values[i:i + 3], "k string, x double") for i in (0, 3, 6)]
    slices(spark, f"{tmp_path}/in", frames[:2])

    def run():
        stream = stream_of(spark, f"{tmp_path}/in/*", frames[0].schema)

        def write(batch, number):
            batch.write.mode("overwrite").parquet(f"{tmp_path}/out/batch={number}")

        with state.keyed_state(spark):
            query = sinks.start_query(state.running_moments(stream, "k", "x"), f"{tmp_path}/cp", mode="update", each_batch=write)
        query.awaitTermination()

    run()
    frames[2].coalesce(1).write.parquet(f"{tmp_path}/in/slice2")
    run()
    versions = spark.read.parquet(f"{tmp_path}/out")
    # One row per key and batch that has it.
    assert sorted(versions.groupBy("batch").count().collect()) == [(0, 2), (1, 2), (2, 3)]
    last = {r["k"]: r for r in sinks.latest_version(versions, ["k"]).collect()}
    for key in ("a", "b", "c", None):
        held = [x for k, x in values if k == key and x is not None]
        assert last[key]["n"] == len(held)
        if held:
            assert math.isclose(last[key]["mean"], statistics.mean(held))
            assert math.isclose(last[key]["m2"], sum((x - statistics.mean(held)) ** 2 for x in held), abs_tol=1e-12)


def visits(spark, values):
    return spark.createDataFrame([(k, START + timedelta(minutes=m), i) for i, (k, m) in enumerate(values)],
                                 "name string, at_time timestamp, i bigint")


def alerts_of(spark, tmp_path, frames, idle, n=3):
    path = slices(spark, f"{tmp_path}/in", frames)
    stream = state.nth_occurrence_alerts(stream_of(spark, path, frames[0].schema), "name", "at_time", "i", n, idle)
    with state.keyed_state(spark), sinks.ProgressLog(spark, f"{tmp_path}/progress") as log:
        query = sinks.start_query(stream, f"{tmp_path}/cp", path=f"{tmp_path}/out")
        query.awaitTermination()
        log.table(query)
    held = [sum(op["numRowsTotal"] for op in p["stateOperators"]) for p in query.recentProgress]
    return spark.read.schema(stream.schema).parquet(f"{tmp_path}/out"), held


def test_alerts_inside_one_run_equal_the_nth_row(spark, tmp_path):
    names = ["Alice", "Bob", "Alice", "Alice", "Bob", "Charlie", "Bob", "Bob", None, None, None]
    all_visits = visits(spark, [(n, i) for i, n in enumerate(names)])
    frames = [all_visits.filter("i < 3"), all_visits.filter("i >= 3 AND i < 5"), all_visits.filter("i >= 5")]
    found, _ = alerts_of(spark, tmp_path, frames, timedelta(hours=1))
    assert rows(found.select(F.col("at").alias("i"), "name")) == rows(nth_row(all_visits, ["name"], ["i"], 3).select("i", "name"))


def test_state_goes_when_a_run_has_ended(spark, tmp_path):
    first = visits(spark, [(f"k{i}", 0) for i in range(20)] + [("a", 0), ("a", 10)])
    later = visits(spark, [("b", 200)])  # the watermark passes the end of all runs before
    again = visits(spark, [("a", 205), ("a", 206), ("a", 207), ("b", 201)])
    more = visits(spark, [("b", 202)])
    found, held = alerts_of(spark, tmp_path, [first, later, again, more], timedelta(minutes=60))
    # The two visits of the first run do not count towards the second one.
    assert sorted((r["name"], r["at"]) for r in found.collect()) == [("a", 2), ("b", 0)]
    assert max(held[:2]) >= 21 and held[-1] <= 4 < max(held)


def test_runs_of_several_tasks_join(spark, tmp_path):
    """Two partial runs with a gap are one run if the events of another task lie in between."""
    spread = spark.createDataFrame([("a", START + timedelta(minutes=m), m) for m in range(0, 400, 10)],
                                   "name string, at_time timestamp, i bigint").repartition(4)
    folder = f"{tmp_path}/many"
    spread.write.parquet(folder)
    stream = state.nth_occurrence_alerts(
        spark.readStream.schema(spread.schema).parquet(folder), "name", "at_time", "i", 30, timedelta(minutes=10))
    with state.keyed_state(spark):
        assert [tuple(r) for r in sinks.run_to_table(stream, "joined").collect()] == [("a", 290, 30)]


def test_sessions_span_micro_batches(spark, tmp_path):
    minutes = [("a", 0), ("b", 3), ("a", 8), ("a", 18), ("b", 30), ("a", 40), ("a", 45), ("b", 44), ("c", 300)]
    events = visits(spark, minutes)
    frames = [events.filter(f"i >= {a} AND i < {b}") for a, b in ((0, 3), (3, 6), (6, 9))]
    path = slices(spark, f"{tmp_path}/in", frames)
    stream = with_event_time(stream_of(spark, path, events.schema), "at_time", "1 hour")
    gap = F.when(F.col("name") == "a", "10 minutes").otherwise("20 minutes")
    found = sinks.run_to_table(S.session_agg(stream, "event_time", gap, ["name"], [F.count(F.lit(1)).alias("n")]), "sessions")
    columns = ["name", "n", "session_start", "session_end"]
    expected = [("a", 2, 40, 55), ("a", 3, 0, 28), ("b", 1, 3, 23), ("b", 2, 30, 64)]
    assert sorted((r["name"], r["n"], (r["session_start"] - START) // timedelta(minutes=1),
                   (r["session_end"] - START) // timedelta(minutes=1)) for r in found.select(columns).collect()) == expected
    interval = F.when(F.col("name") == "a", F.expr("INTERVAL 10 MINUTES")).otherwise(F.expr("INTERVAL 20 MINUTES"))
    for options in ({}, {"max_group_rows": 1, "rows_per_chunk": 2}):
        batch = sessions(events, ["name"], "at_time", ["i"], interval, [F.count(F.lit(1)).alias("n")], **options)
        assert sorted((r["name"], r["n"], (r["session_start"] - START) // timedelta(minutes=1),
                       (r["session_end"] - START) // timedelta(minutes=1)) for r in batch.collect()) == [
            *expected, ("c", 1, 300, 320)]


@pytest.mark.parametrize("per_batch", [7, 20, 1000])
def test_late_rows_are_those_that_spark_drops(spark, tmp_path, per_batch):
    rng = np.random.default_rng(4)
    minutes = np.arange(100) - np.where(rng.random(100) < 0.2, rng.integers(0, 60, 100), 0)
    records = spark.createDataFrame(
        [(str(i).encode(), str(i).encode(), 0, START + timedelta(minutes=int(m)), i) for i, m in enumerate(minutes)],
        "key binary, value binary, partition int, timestamp timestamp, i int")
    append_log(records, f"{tmp_path}/log", ["i"], 30)
    source = log_stream(spark, f"{tmp_path}/log", f"{tmp_path}/cp1", maxOffsetsPerTrigger=per_batch)
    split = sinks.LateSplit("timestamp", "5 minutes", f"{tmp_path}/split")
    sinks.run_through(sinks.start_query(source, f"{tmp_path}/cp1", each_batch=split, every="0 seconds"))
    kept, late = split.tables(spark, source.schema)
    assert sorted(r["offset"] for r in kept.union(late).collect()) == list(range(100))

    source = log_stream(spark, f"{tmp_path}/log", f"{tmp_path}/cp2", maxOffsetsPerTrigger=per_batch)
    unique = source.withWatermark("timestamp", "5 minutes").dropDuplicates(["offset", "timestamp"])
    query = sinks.start_query(unique, f"{tmp_path}/cp2", path=f"{tmp_path}/unique", every="0 seconds")
    sinks.run_through(query)
    dropped = sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
    assert late.count() == dropped
    assert rows(spark.read.parquet(f"{tmp_path}/unique").select("offset")) == rows(kept.select("offset"))
    assert (dropped > 0) == (per_batch < 1000)


FEATURE = "window_start timestamp, zone int, n int"


def window_rows(spark, *values):
    return spark.createDataFrame([(START + timedelta(days=d), z, n) for d, z, n in values], FEATURE)


def test_keyed_store_keeps_the_newest_row_per_key(spark, tmp_path):
    store = sinks.KeyedStore(f"{tmp_path}/store", ["zone", "window_start"], max_folders=3)

    def table():
        return sorted(((r["window_start"] - START).days, r["zone"], r["n"]) for r in store.table(spark, FEATURE).collect())

    def folders(month):
        valid = store._commit_of(spark, number)
        return len(valid.get((2024, month), []))

    number = 0
    store(window_rows(spark, (0, 1, 5), (0, 2, 7)), 0)
    for number in (1, 1):  # a repeated batch changes nothing
        store(window_rows(spark, (0, 1, 6), (1, None, 1)), 1)
        assert table() == [(0, 1, 6), (0, 2, 7), (1, None, 1)] or sorted(
            table(), key=repr) == sorted([(0, 1, 6), (0, 2, 7), (1, None, 1)], key=repr)
    assert folders(1) == 2
    number = 2
    store(window_rows(spark, (40, 1, 1)), 2)  # February begins, so January is merged
    assert (folders(1), folders(2)) == (1, 1)
    number = 3
    store(window_rows(spark, (0, 2, 8), (40, 1, 2)), 3)  # a late update of a closed month
    assert (folders(1), folders(2)) == (1, 2)
    for number in (4, 5, 6):
        store(window_rows(spark, (41, number, number)), number)
    assert folders(2) <= 3
    assert sorted(table(), key=repr) == sorted(
        [(0, 1, 6), (0, 2, 8), (1, None, 1), (40, 1, 2), (41, 4, 4), (41, 5, 5), (41, 6, 6)], key=repr)
    assert len(glob.glob(f"{tmp_path}/store/merged-3/year=2024/month=1/*.parquet")) == 1
    # What a failed batch left behind is not read.
    window_rows(spark, (0, 9, 9)).write.parquet(f"{tmp_path}/store/delta-7/year=2024/month=1")
    assert not any(z == 9 for _, z, _ in table())
    with pytest.raises(RuntimeError, match="commit"):
        store(window_rows(spark, (0, 1, 1)), 12)


def test_keyed_store_takes_update_mode(spark, tmp_path):
    frames = [visits(spark, [("a", 0), ("b", 1)]), visits(spark, [("a", 2), ("a", 60 * 24 * 40)])]
    path = slices(spark, f"{tmp_path}/in", frames)
    stream = with_event_time(stream_of(spark, path, frames[0].schema), "at_time", "1 hour")
    counted = S.window_agg(stream, "event_time", "1 hour", ["name"], [F.count(F.lit(1)).alias("n")])
    store = sinks.KeyedStore(f"{tmp_path}/store", ["name", "window_start"])
    sinks.start_query(counted, f"{tmp_path}/cp", mode="update", each_batch=store).awaitTermination()
    assert sorted((r["name"], r["month"], r["n"]) for r in store.table(spark, counted.schema).collect()) == [
        ("a", 1, 2), ("a", 2, 1), ("b", 1, 1)]


def test_keyed_store_keeps_no_copy_of_a_batch(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(type(spark.range(1)), "persist", lambda *a: pytest.fail("a batch was kept"))
    store = sinks.KeyedStore(f"{tmp_path}/store", ["zone", "window_start"])
    batch = spark.sql("SELECT 1 AS zone, TIMESTAMP_NTZ'2024-01-01' AS window_start UNION ALL SELECT 2, NULL")
    store(batch, 0)
    assert [r["year"] for r in store.table(spark, batch.schema).orderBy("zone").collect()] == [2024, 0]
