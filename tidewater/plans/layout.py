"""Partitioning, skew and caching."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators import aggregates as A
from tidewater.operators import layout as O
from tidewater.operators.sampling import salted_keys
from tidewater.plans.registry import query


def _n():
    return F.count(F.lit(1)).alias("n")


@query("partition_row_counts")
def partition_row_counts(t):
    return O.partition_row_counts(t.lineitem)


def _partitions(df):
    return O.partition_row_counts(df).agg(F.count(F.lit(1)).alias("parts"), F.sum("n").alias("rows"))


@query("repartition_n", "SELECT 16::BIGINT AS parts, count(*) AS rows FROM lineitem")
def repartition_n(t):
    return _partitions(t.lineitem.select("l_orderkey").repartition(16))


@query("coalesce_n", "SELECT 2::BIGINT AS parts, count(*) AS rows FROM lineitem")
def coalesce_n(t):
    return _partitions(t.lineitem.select("l_orderkey").repartition(16).coalesce(2))


@query("repartition_by_key", "SELECT l_suppkey, count(*) AS n, 1::BIGINT AS parts FROM lineitem GROUP BY l_suppkey")
def repartition_by_key(t):
    """Every key lies in one partition after hash partitioning by it."""
    placed = O.partition_row_counts(t.lineitem.repartition(8, "l_suppkey"), "l_suppkey")
    return placed.groupBy("l_suppkey").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("parts"))


@query("skew_report", """
    SELECT o_custkey, count(*) AS n, round(count(*) / (SELECT count(*) FROM orders), 6) AS share
    FROM orders GROUP BY o_custkey""")
def skew_report(t):
    return O.skew_report(t.orders, ["o_custkey"])


@query("salt_key", """
    SELECT event_type || '_' || CAST(CAST(('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 7)) AS BIGINT) % 10000 % 4
             AS VARCHAR) AS salted_key, count(*) AS n
    FROM events GROUP BY 1""")
def salt_key(t):
    salted = salted_keys(t.events.select("event_id", "event_type"), "event_type",
                         [F.col("event_id").cast("string")], 4)
    return salted.groupBy("salted_key").agg(_n())


@query("salted_aggregate", """
    SELECT event_type, count(*) AS n, round(sum(value), 2) AS total, max(value) AS high FROM events GROUP BY event_type""")
def salted_aggregate(t):
    return A.salted_aggregate(
        t.events, ["event_type"],
        [_n(), F.sum("value").alias("total"), F.max("value").alias("high")],
        [F.sum("n").alias("n"), F.round(F.sum("total"), 2).alias("total"), F.max("high").alias("high")],
        ["event_id"])


@query("cache_persist", """
    SELECT 'all' AS part, count(*) AS n FROM orders
    UNION ALL SELECT 'finished', count(*) FROM orders WHERE o_orderstatus = 'F'""")
def cache_persist(t):
    """Two actions over one kept frame, which is released before the result is returned."""
    with O.persisted(t.orders) as kept:
        rows = [("all", kept.count()), ("finished", kept.filter(F.col("o_orderstatus") == "F").count())]
    return t.spark.createDataFrame(rows, "part string, n bigint")
