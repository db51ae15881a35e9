"""Kafka reader options, record-shaped tables and the scratch folder."""

from __future__ import annotations

from types import SimpleNamespace

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidewater.operators.windows import with_windows
from tidewater.session import scratch_path, scratch_root
from tidewater.sources import log_source, logs
from tidewater.streaming import sinks


def test_options():
    options = logs.kafka_options("host:9092", "rides", "latest", per_trigger=500, group_prefix="zones")
    assert options == {
        "kafka.bootstrap.servers": "host:9092", "subscribe": "rides", "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "500", "failOnDataLoss": "false", "groupIdPrefix": "zones"}


@pytest.mark.parametrize("reader", [logs.kafka_batch, logs.kafka_stream])
def test_reader_needs_the_connector(spark, reader):
    with pytest.raises(AnalysisException, match="kafka"):
        reader(spark, "host:9092", "rides")


def test_partition_stats(spark):
    rows = spark.range(10).select(F.col("id").alias("key"), F.col("id"))
    records = logs.as_records(rows, "key", "id", 2, "t", ["id"], F.timestamp_seconds(F.col("id")))
    stats = {r["partition"]: (r["records"], r["first_offset"], r["last_offset"], r["records_per_sec"])
             for r in logs.partition_stats(records).collect()}
    assert stats == {0: (5, 0, 8, 0.625), 1: (5, 1, 9, 0.625)}


def session_with(folder, master="local[2]"):
    settings = {"spark.checkpoint.dir": folder} if folder else {}
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: settings.get(key, default)),
                           sparkContext=SimpleNamespace(master=master, applicationId="app"))


def test_scratch_follows_the_session_setting():
    session = session_with("hdfs://shared/")
    assert scratch_root(session) == "hdfs://shared"
    assert scratch_path(session, "x").startswith("hdfs://shared/tidewater/x-")
    assert scratch_path(session, "x") != scratch_path(session, "x")


def test_scratch_without_a_setting():
    assert scratch_root(session_with(None)) == scratch_root(session_with(None))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(session_with(None, master="yarn"))


def numbered_records(spark, n, partitions=3):
    return spark.range(n).select(
        F.col("id").cast("string").cast("binary").alias("key"), F.col("id").cast("string").cast("binary").alias("value"),
        (F.col("id") % partitions).cast("int").alias("partition"), F.timestamp_seconds(F.col("id")).alias("timestamp"), "id")


def run_log(spark, root, limit, **options):
    stream = log_source.log_stream(spark, f"{root}/log", f"{root}/cp", maxOffsetsPerTrigger=limit, **options)
    query = sinks.start_query(stream, f"{root}/cp", path=f"{root}/out", every="0 seconds")
    sinks.run_through(query)
    return [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]


def read_offsets(spark, root):
    return sorted((r["partition"], r["offset"], int(bytes(r["value"]))) for r in spark.read.parquet(f"{root}/out").collect())


def test_log_has_offsets_without_gaps(spark, tmp_path):
    log_source.append_log(numbered_records(spark, 100), f"{tmp_path}/log", ["id"], 10)
    log_source.append_log(numbered_records(spark, 20), f"{tmp_path}/log", ["id"], 10)
    found = log_source.log_batch(spark, f"{tmp_path}/log")
    assert found.columns == ["key", "value", "topic", "partition", "offset", "timestamp"]
    first = [(p, i, 3 * i + p) for p in range(3) for i in range(34 if p == 0 else 33)]
    ends = {0: 34, 1: 33, 2: 33}
    second = [(i % 3, ends[i % 3] + i // 3, i) for i in range(20)]
    assert sorted((r["partition"], r["offset"], int(bytes(r["value"]))) for r in found.collect()) == sorted(first + second)
    assert {r["topic"] for r in found.collect()} == {"log"}
    part = log_source.log_batch(spark, f"{tmp_path}/log", startingOffsets='{"0": 5, "1": -1}', endingOffsets='{"0": 25, "2": 3}')
    assert sorted((r["partition"], r["offset"]) for r in part.collect()) == [
        *[(0, i) for i in range(5, 25)], *[(2, i) for i in range(3)]]
    assert part.filter("partition = 1").count() == 0


def test_log_stream_keeps_to_its_limit_and_resumes(spark, tmp_path):
    log_source.append_log(numbered_records(spark, 100), f"{tmp_path}/log", ["id"], 10)
    batches = run_log(spark, tmp_path, 30)
    assert batches == [30, 30, 30, 10]
    assert run_log(spark, tmp_path, 30) == []
    log_source.append_log(numbered_records(spark, 50, partitions=4), f"{tmp_path}/log", ["id"], 10)  # a new partition too
    assert run_log(spark, tmp_path, 30) == [30, 20]
    expected = log_source.log_batch(spark, f"{tmp_path}/log")
    assert read_offsets(spark, tmp_path) == sorted(
        (r["partition"], r["offset"], int(bytes(r["value"]))) for r in expected.collect())


def test_log_stream_may_start_at_the_end(spark, tmp_path):
    log_source.append_log(numbered_records(spark, 30), f"{tmp_path}/log", ["id"], 10)
    assert run_log(spark, tmp_path, 100, startingOffsets="latest") == []
    log_source.append_log(numbered_records(spark, 6), f"{tmp_path}/log", ["id"], 10)
    assert run_log(spark, tmp_path, 100, startingOffsets="latest") == [6]


def test_missing_segment_is_an_error_unless_loss_is_allowed(spark, tmp_path):
    log_source.append_log(numbered_records(spark, 90), f"{tmp_path}/log", ["id"], 10)
    (tmp_path / "log" / "partition=1" / "segment=10").rename(tmp_path / "gone")
    with pytest.raises(Exception, match="offsets 10 to 19 of log partition 1"):
        log_source.log_batch(spark, f"{tmp_path}/log").collect()
    with pytest.raises(Exception, match="offsets 10 to 19 of log partition 1"):
        run_log(spark, tmp_path, 1000)
    found = log_source.log_batch(spark, f"{tmp_path}/log", failOnDataLoss="false")
    assert found.count() == 80
    (tmp_path / "other").mkdir()
    (tmp_path / "log").rename(tmp_path / "other" / "log")
    assert sum(run_log(spark, tmp_path / "other", 25, failOnDataLoss="false")) == 80


def test_shares_of_a_batch():
    assert log_source.shares({"0": 5, "1": 6}, 20) == {"0": 5, "1": 6}
    for waiting, limit in (({"0": 1, "1": 1000, "2": 3}, 10), ({"0": 7, "1": 7, "2": 7}, 2), ({"0": 0, "1": 9}, 4)):
        taken = log_source.shares(waiting, limit)
        assert sum(taken.values()) == limit and all(0 <= taken[p] <= n for p, n in waiting.items())


def test_offsets_by_name():
    bounds = {0: (5, 9), 1: (0, 3)}
    assert log_source.named_offsets("earliest", bounds) == {"0": 5, "1": 0}
    assert log_source.named_offsets("latest", bounds) == {"0": 9, "1": 3}
    assert log_source.named_offsets('{"1": -1}', bounds) == {"0": 5, "1": 3}
    with pytest.raises(ValueError, match="earliest"):
        log_source.named_offsets("soon", bounds)


def test_a_partition_is_numbered_in_chunks(spark, tmp_path, monkeypatch):
    asked = []

    def noted(df, keys, order, specs, **options):
        asked.append(options)
        return with_windows(df, keys, order, specs, **options)

    monkeypatch.setattr(log_source, "with_windows", noted)
    monkeypatch.setattr(log_source, "NUMBERED_RECORDS", 10)
    log_source.append_log(numbered_records(spark, 100), f"{tmp_path}/log", ["id"], 10)
    assert asked == [{"max_group_rows": 10, "rows_per_chunk": 10}]
    for p, (first, end) in log_source.Log(f"{tmp_path}/log").bounds().items():
        found = log_source.log_batch(spark, f"{tmp_path}/log").filter(F.col("partition") == p).select("offset").collect()
        assert sorted(r["offset"] for r in found) == list(range(first, end))


def test_a_slice_is_read_from_the_row_groups_that_it_touches(spark, tmp_path, monkeypatch):
    decoded = []

    class Noted(pq.ParquetFile):
        def iter_batches(self, *args, **options):
            for batch in super().iter_batches(*args, **options):
                decoded.append(batch.num_rows)
                yield batch

    monkeypatch.setattr(log_source, "GROUP_RECORDS", 10, raising=False)
    monkeypatch.setattr(log_source.pq, "ParquetFile", Noted)
    path = f"{tmp_path}/log"
    log_source.append_log(numbered_records(spark, 250, partitions=1), path, ["id"], 100)
    for first, last in ((0, 5), (25, 30), (8, 12), (95, 105), (0, 250), (249, 250)):
        decoded.clear()
        slices = log_source.Log(path).slices({"0": first}, {"0": last}, True)
        found = [r for part in slices for batch in log_source.read_slice(path, part, "log") for r in batch.to_pylist()]
        assert [(r["offset"], int(r["value"])) for r in found] == [(i, i) for i in range(first, last)]
        assert sum(decoded) == (last + 9) // 10 * 10 - first // 10 * 10


@pytest.mark.parametrize("options", [{"write_statistics": False}, {"write_statistics": ["key"]}, {}])
def test_a_segment_may_have_files_of_any_layout(tmp_path, options):
    folder = tmp_path / "log" / "partition=0" / "segment=0"
    folder.mkdir(parents=True)
    for name, offsets in (("a", [7, 3, 9, 1]), ("b", [0, 8, 2]), ("c", [4, 5, 6]), ("d", [])):
        rows = [{"key": None, "value": b"%d" % i, "timestamp": None, "offset": i} for i in offsets]
        kinds = {f.name: f.type for f in log_source.RECORD_TYPES}
        table = pa.Table.from_pylist(rows, pa.schema([(n, kinds[n]) for n in ("key", "value", "timestamp", "offset")]))
        pq.write_table(table, folder / f"{name}.parquet", row_group_size=2, **options)
    slices = log_source.Log(f"{tmp_path}/log").slices({"0": 2}, {"0": 9}, True)
    found = [r for part in slices for batch in log_source.read_slice(f"{tmp_path}/log", part, "log") for r in batch.to_pylist()]
    assert sorted((r["offset"], r["value"]) for r in found) == [(i, b"%d" % i) for i in range(2, 9)]
