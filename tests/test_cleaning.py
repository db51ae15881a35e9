"""Audits add up, cleaning is idempotent, and layered tables can be written again."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import rows
from tidewater.functions.rules import Rule, rule_score, triggered_rules
from tidewater.operators import cleaning as C
from tidewater.operators import layout as O
from tidewater.operators import quality as Q
from tidewater.sources import files, lake


def test_audit_categories_add_up(tables):
    audit = C.sensor_audit(tables.readings).first().asDict()
    parts = ("invalid_timestamp", "missing_value", "out_of_range", "duplicates", "clean")
    assert sum(audit[p] for p in parts) == audit["received"] == tables.sensors.count()
    assert audit["invalid_timestamp"] == 2 * audit["received"] // 102


def test_clean_sensors_is_idempotent(tables):
    once = C.clean_sensors(tables.readings)
    twice = C.clean_sensors(once)
    assert rows(once) == rows(twice)


def test_valid_only_mean_ignores_faults(spark):
    df = spark.createDataFrame([(1, None), (2, 10.0), (3, 20.0), (4, 150.0)], "event_id int, temperature double")
    inside = F.col("temperature").between(-20, 100)
    assert C.fill_with_mean(df, ["temperature"]).first()["temperature"] == 60.0
    assert C.fill_with_mean(df, ["temperature"], inside).first()["temperature"] == 15.0


def test_dedupe_is_deterministic(tables):
    trips = tables.trips
    assert rows(C.dedupe_trips(trips)) == rows(C.dedupe_trips(trips.repartition(5)))


def test_rules_ignore_null_predicates(spark):
    df = spark.createDataFrame([(None,), (5,)], "x int")
    rules = [Rule("BIG", 2, F.col("x") > 1), Rule("ODD", 1, F.col("x") % 2 == 1)]
    out = df.select(rule_score(rules).alias("s"), triggered_rules(rules).alias("r")).collect()
    assert [(r["s"], r["r"]) for r in out] == [(0, []), (3, ["BIG", "ODD"])]


def test_overwrite_partitions_is_repeatable(spark, tables, tmp_path):
    path = f"{tmp_path}/t"
    files.overwrite_partitions(tables.orders, path, ["o_orderstatus"])
    files.overwrite_partitions(tables.orders.filter("o_orderstatus = 'F'"), path, ["o_orderstatus"])
    assert spark.read.parquet(path).count() == tables.orders.count()


def test_snapshots_are_immutable(spark, tables, tmp_path):
    import pytest
    from pyspark.errors import AnalysisException

    lake.write_snapshot(tables.nation, str(tmp_path), 1)
    with pytest.raises(AnalysisException):
        lake.write_snapshot(tables.region, str(tmp_path), 1)
    assert lake.read_snapshot(spark, str(tmp_path), 1).count() == 25


def test_single_file_takes_any_number_of_rows(spark, tmp_path):
    files.write_single_file(spark.range(0, 1_200_000, 1, 8), f"{tmp_path}/x", "parquet")
    assert len(list((tmp_path / "x").glob("part-*"))) == 1
    assert spark.read.parquet(f"{tmp_path}/x").count() == 1_200_000


def test_schema_checks(spark, tables):
    kinds = Q.columns_by_kind(tables.orders, exclude=["o_orderkey"])
    assert kinds["numeric"] == ["o_custkey", "o_totalprice"]
    diff = {r["name"]: r["change"] for r in Q.schema_diff(
        tables.orders, tables.orders.drop("o_custkey").withColumn("o_totalprice", F.col("o_totalprice").cast("float"))
    ).collect()}
    assert diff == {"o_custkey": "only_left", "o_totalprice": "type_changed"}


def test_persisted_releases(spark):
    df = spark.range(10)
    with O.persisted(df) as kept:
        assert kept.is_cached
        assert kept.count() == 10
        with O.persisted(kept) as again:
            assert again.count() == 10
        assert kept.storageLevel.useMemory
    assert not df.storageLevel.useMemory
