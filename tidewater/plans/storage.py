"""Readers, writers, layered tables, snapshots and log tables.

Writers are checked by reading back what they wrote, from a fresh folder in the shared scratch
area.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.plans.registry import query
from tidewater.plans.tables import DEPARTMENTS, EMPLOYEES, TRIPS, Tables, trips_of
from tidewater.session import scratch_path
from tidewater.sources import files, lake, logs
from tidewater.sources.log_source import append_log, log_batch, log_stream
from tidewater.streaming.sinks import run_through, run_to_table, start_query
from tidewater.streaming.sources import parse_records, stream_files

ORDER_SCHEMA = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
                "o_orderdate timestamp_ntz, o_orderpriority string")


def _written(t: Tables, df, fmt: str, label: str, **options) -> str:
    path = scratch_path(t.spark, label)
    files.write_table(df, path, fmt, **options)
    return path


@query("scan_parquet", """
    SELECT l_orderkey, l_partkey, l_quantity, l_shipdate FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-01-01'""")
def scan_parquet(t):
    # Two columns besides the filter column are read; the filter reaches the Parquet scan.
    return t.lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate").filter(
        F.col("l_shipdate") >= F.lit("2000-01-01").cast("timestamp_ntz"))


@query("scan_csv_infer", """
    SELECT CAST(c_custkey AS BIGINT) AS c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment
    FROM customer""")
def scan_csv_infer(t):
    path = _written(t, t.customer, "csv", "csv", header=True)
    # Inference picks the narrowest whole-number type, so keys are widened again.
    return files.read_csv(t.spark, path).withColumns(
        {c: F.col(c).cast("bigint") for c in ("c_custkey", "c_nationkey")})


@query("scan_csv_schema", "SELECT * FROM orders")
def scan_csv_schema(t):
    return files.read_csv(t.spark, _written(t, t.orders, "csv", "csv", header=True), ORDER_SCHEMA)


@query("scan_json", "SELECT * FROM events")
def scan_json(t):
    return files.read_json(t.spark, _written(t, t.events, "json", "json"), t.events.schema)


@query("scan_orc", "SELECT * FROM events")
def scan_orc(t):
    return t.spark.read.orc(_written(t, t.events, "orc", "orc"))


@query("literal_table", f"""
    WITH {EMPLOYEES}, {DEPARTMENTS}
    SELECT d.department, office_block, manager_name, count(employee_id) AS employees
    FROM departments d LEFT JOIN employees e ON e.department = d.department GROUP BY 1, 2, 3""")
def literal_table(t):
    counted = t.employees.groupBy("department").agg(F.count(F.lit(1)).alias("n"))
    return t.departments.join(counted, "department", "left").select(
        "department", "office_block", "manager_name", F.coalesce("n", F.lit(0)).alias("employees"))


@query("scan_union_drift", """
    SELECT o_orderkey, CAST(o_custkey AS DOUBLE) AS o_custkey, o_totalprice,
           CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN o_orderpriority END AS o_orderpriority
    FROM orders""")
def scan_union_drift(t):
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    early = t.orders.filter(F.col("o_orderdate") < cut).select(
        "o_orderkey", F.col("o_custkey").cast("double").alias("o_custkey"), "o_totalprice")
    late = t.orders.filter(F.col("o_orderdate") >= cut).select(
        "o_orderkey", F.col("o_custkey").cast("int").alias("o_custkey"), "o_totalprice", "o_orderpriority")
    paths = [_written(t, early, "parquet", "drift"), _written(t, late, "parquet", "drift")]
    return files.read_drifted(t.spark, paths, {"o_custkey": "double"})


LOG_PARTITIONS = 3
LOG_SEGMENT = 100_000


def _records(t: Tables):
    """Events as log records in three partitions by user, with the event id as their offset."""
    return logs.as_records(t.events, "user_id", "event_id", LOG_PARTITIONS, "events",
                           ["event_id", "user_id", "event_type", "value"], F.col("ts"))


def _event_log(t: Tables) -> str:
    """A log of these records, where they get offsets without gaps in the order of the event ids."""
    path = scratch_path(t.spark, "log") + "/events"
    append_log(_records(t), path, ["offset"], LOG_SEGMENT)
    return path


_PAYLOAD = "event_id bigint, user_id bigint, event_type string, value double"
_LOG_SQL = """
    SELECT CAST(user_id % 3 AS BIGINT) AS "partition", event_id, user_id, event_type, value,
           row_number() OVER (PARTITION BY user_id % 3 ORDER BY event_id) - 1 AS "offset" FROM events"""


@query("scan_kafka_batch", _LOG_SQL)
def scan_kafka_batch(t):
    """Bounded read of a log by offset; ``logs.kafka_batch`` gives records of the same shape from a broker."""
    parsed = parse_records(log_batch(t.spark, _event_log(t)), _PAYLOAD, extra=("partition", "offset"))
    return parsed.withColumn("partition", F.col("partition").cast("bigint"))


@query("stream_kafka", _LOG_SQL)
def stream_kafka(t):
    """Stream over a log, at most so many offsets in a micro-batch (see ``logs.kafka_stream`` for a broker)."""
    base = scratch_path(t.spark, "stream-kafka")
    stream = log_stream(t.spark, _event_log(t), f"{base}/checkpoint", maxOffsetsPerTrigger=20_000)
    parsed = parse_records(stream, _PAYLOAD, extra=("partition", "offset"))
    run_through(start_query(parsed, f"{base}/checkpoint", path=f"{base}/out", every="0 seconds"))
    return t.spark.read.schema(parsed.schema).parquet(f"{base}/out").withColumn(
        "partition", F.col("partition").cast("bigint"))


@query("stream_files", "SELECT event_id, user_id, value FROM events")
def stream_files_query(t):
    stream = stream_files(t.spark, t.path("events"), t.events.schema, max_files=1)
    return run_to_table(stream.select("event_id", "user_id", "value"), "stream-files")


@query("sink_parquet", "SELECT * FROM orders")
def sink_parquet(t):
    path = scratch_path(t.spark, "parquet")
    files.write_partitioned(t.orders, path, ["o_orderstatus"])
    return t.spark.read.schema(ORDER_SCHEMA).parquet(path)


@query("sink_csv", "SELECT * FROM customer")
def sink_csv(t):
    return files.read_csv(t.spark, _written(t, t.customer, "csv", "csv", header=True), t.customer.schema)


@query("sink_json", "SELECT * FROM supplier")
def sink_json(t):
    """CSV rewritten as JSON lines."""
    schema = t.supplier.schema
    as_csv = _written(t, t.supplier, "csv", "csv", header=True)
    return files.read_json(t.spark, _written(t, files.read_csv(t.spark, as_csv, schema), "json", "json"), schema)


@query("sink_orc", "SELECT * FROM part")
def sink_orc(t):
    return t.spark.read.orc(_written(t, t.part, "orc", "orc"))


@query("sink_text", "SELECT p_partkey || ',' || p_name || ',' || p_type AS value FROM part")
def sink_text(t):
    path = scratch_path(t.spark, "text")
    files.write_text(t.part, path, F.concat_ws(",", F.col("p_partkey").cast("string"), "p_name", "p_type"))
    return t.spark.read.text(path)


CODECS = ("snappy", "gzip", "zstd", "lz4")


@query("sink_codec", " UNION ALL ".join(
    f"SELECT '{c}' AS codec, count(*) AS rows, round(sum(o_totalprice), 2) AS total FROM orders" for c in CODECS))
def sink_codec(t):
    out = None
    for codec in CODECS:
        written = t.spark.read.parquet(_written(t, t.orders, "parquet", codec, compression=codec))
        part = written.agg(F.lit(codec).alias("codec"), F.count(F.lit(1)).alias("rows"),
                           F.round(F.sum("o_totalprice"), 2).alias("total"))
        out = part if out is None else out.unionByName(part)
    return out


@query("sink_single_file", """
    SELECT event_type, count(*) AS n, 1::BIGINT AS files FROM events GROUP BY event_type""")
def sink_single_file(t):
    path = scratch_path(t.spark, "single")
    files.write_single_file(t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")), path)
    back = files.read_json(t.spark, path, "event_type string, n bigint")
    number = back.select(F.input_file_name().alias("f")).agg(F.countDistinct("f").alias("files")).scalar()
    return back.withColumn("files", number)


@query("incremental_extract", """
    SELECT 1 AS run, count(*) AS loaded, strftime(max(ts), '%Y-%m-%d') AS last_date FROM events
      WHERE ts < TIMESTAMP '2024-01-16'
    UNION ALL SELECT 2, count(*) FILTER (ts >= TIMESTAMP '2024-01-16'), strftime(max(ts), '%Y-%m-%d') FROM events
    UNION ALL SELECT 3, 0, strftime(max(ts), '%Y-%m-%d') FROM events""")
def incremental_extract(t):
    """Load a table that has half its days, then all of them, then nothing new."""
    base = scratch_path(t.spark, "incremental")
    half = t.events.filter(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"))
    runs = []
    for run, source in enumerate([half, t.events, t.events], start=1):
        loaded = lake.incremental_load(source, "ts", f"{base}/state", f"{base}/out")
        runs.append((run, loaded, lake.last_loaded(t.spark, f"{base}/state")))
    return t.spark.createDataFrame(runs, "run int, loaded bigint, last_date string")


@query("snapshot_versions", """
    SELECT 1 AS version, count(*) AS rows, max(o_orderkey) AS last_key FROM orders
      WHERE o_orderdate < TIMESTAMP '1998-01-01'
    UNION ALL SELECT 2, count(*), max(o_orderkey) FROM orders""")
def snapshot_versions(t):
    base = scratch_path(t.spark, "snapshots")
    early = t.orders.filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    lake.write_snapshot(early, base, 1)
    lake.write_snapshot(t.orders, base, 2)
    one, two = [
        lake.read_snapshot(t.spark, base, v).agg(F.lit(v).alias("version"), F.count(F.lit(1)).alias("rows"),
                                                F.max("o_orderkey").alias("last_key")) for v in (1, 2)]
    return one.unionByName(two)


@query("partition_overwrite", """
    SELECT o_orderstatus, count(*) AS rows, round(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice * 2
                                                      ELSE o_totalprice END), 2) AS total
    FROM orders GROUP BY o_orderstatus""")
def partition_overwrite(t):
    """Write all partitions, replace one with corrected rows twice, and read the table."""
    path = scratch_path(t.spark, "overwrite")
    files.overwrite_partitions(t.orders, path, ["o_orderstatus"])
    corrected = t.orders.filter(F.col("o_orderstatus") == "F").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    for _ in range(2):
        files.overwrite_partitions(corrected, path, ["o_orderstatus"])
    return t.spark.read.parquet(path).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("bronze_ingest", f"""
    WITH {TRIPS}
    SELECT year(pickup_ts) AS year, month(pickup_ts) AS month, count(*) AS rows, round(sum(fare), 2) AS fares,
           0::BIGINT AS without_source
    FROM trips GROUP BY 1, 2""")
def bronze_ingest(t):
    path = scratch_path(t.spark, "bronze")
    lake.bronze_ingest(t.trips, path, "pickup_ts")
    return t.spark.read.parquet(path).groupBy(
        F.col("_year").cast("bigint").alias("year"), F.col("_month").cast("bigint").alias("month")).agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum("fare"), 2).alias("fares"),
        F.count_if(F.col("_source_file").isNull()).alias("without_source"))


SILVER = TRIPS + """,
valid AS (
  SELECT * REPLACE (coalesce(airport_fee, 0) AS airport_fee, coalesce(congestion_fee, 0) AS congestion_fee)
  FROM trips WHERE fare BETWEEN 0.5 AND 1000 AND distance BETWEEN 0 AND 500 AND passengers BETWEEN 1 AND 9
    AND pickup_ts < dropoff_ts),
uniq AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY pickup_ts, pu_zone, do_zone, fare
                                 ORDER BY order_key, vendor_id, distance, tip) AS rn FROM valid) WHERE rn = 1),
timed AS (SELECT *, round(CAST((epoch(dropoff_ts) - epoch(pickup_ts)) / 60 AS DECIMAL(38, 10)), 1)::DOUBLE AS duration_min FROM uniq),
silver AS (
  SELECT *, round(CAST(distance / (duration_min / 60 + 0.001) AS DECIMAL(38, 10)), 1)::DOUBLE AS speed, rate_code IN (2, 3) AS is_airport FROM timed)"""


@query("silver_clean", f"WITH {SILVER} SELECT * FROM silver")
def silver_clean(t):
    return lake.silver_trips(t.trips)


@query("gold_daily_kpis", f"""
    WITH {SILVER}
    SELECT strftime(pickup_ts, '%Y-%m-%d') AS date, count(*) AS trips, round(sum(fare), 0) AS revenue,
           round(CAST(avg(fare) AS DECIMAL(38, 10)), 2)::DOUBLE AS avg_fare, round(CAST(avg(distance) AS DECIMAL(38, 10)), 2)::DOUBLE AS avg_distance,
           round(CAST(avg(duration_min) AS DECIMAL(38, 10)), 1)::DOUBLE AS avg_duration, round(sum(tip) / nullif(sum(fare), 0) * 100, 2) AS tip_rate_pct,
           count(DISTINCT pu_zone) AS active_zones
    FROM silver GROUP BY 1""")
def gold_daily_kpis(t):
    return lake.daily_kpis(lake.silver_trips(t.trips)).withColumn("date", F.col("date").cast("string"))


@query("gold_zone_performance", f"""
    WITH {SILVER}
    SELECT pu_zone, year(pickup_ts) AS year, count(*) AS trips, round(CAST(avg(fare) AS DECIMAL(38, 10)), 2)::DOUBLE AS avg_fare,
           round(sum(fare), 0) AS total_revenue, round(CAST(avg(speed) AS DECIMAL(38, 10)), 1)::DOUBLE AS avg_speed
    FROM silver GROUP BY 1, 2""")
def gold_zone_performance(t):
    return lake.zone_performance(lake.silver_trips(t.trips))


@query("lake_layers", f"""
    WITH {SILVER}
    SELECT 'daily' AS gold, year(pickup_ts) AS year, month(pickup_ts) AS month,
           strftime(pickup_ts, '%Y-%m-%d') AS key, count(*) AS trips, count(DISTINCT pu_zone) AS active_zones
    FROM silver GROUP BY ALL
    UNION ALL
    SELECT 'zones', year(pickup_ts), 0, CAST(pu_zone AS VARCHAR), count(*), 0 FROM silver GROUP BY ALL""")
def lake_layers(t):
    """Bronze, silver and both gold tables written and read in turn.

    Bronze, silver and the daily table are partitioned by year and month, the zone table by year.
    """
    base = scratch_path(t.spark, "lake")
    lake.bronze_ingest(trips_of(t.lineitem), f"{base}/bronze", "pickup_ts")
    lake.write_silver(t.spark.read.parquet(f"{base}/bronze"), f"{base}/silver")
    silver = t.spark.read.parquet(f"{base}/silver")
    daily = lake.daily_kpis(silver).withColumns({"_year": F.year("date"), "_month": F.month("date")})
    files.write_partitioned(daily, f"{base}/gold/daily_kpis", ["_year", "_month"])
    zones = lake.zone_performance(silver).withColumnRenamed("year", "_year")
    files.write_partitioned(zones, f"{base}/gold/zone_performance", ["_year"])
    year, month = F.col("_year").cast("bigint").alias("year"), F.col("_month").cast("bigint").alias("month")
    none = F.lit(0).cast("bigint")
    return t.spark.read.parquet(f"{base}/gold/daily_kpis").select(
        F.lit("daily").alias("gold"), year, month, F.col("date").cast("string").alias("key"), "trips", "active_zones"
    ).unionByName(t.spark.read.parquet(f"{base}/gold/zone_performance").select(
        F.lit("zones").alias("gold"), year, none.alias("month"), F.col("pu_zone").cast("string").alias("key"), "trips",
        none.alias("active_zones")))


@query("temp_views", """
    SELECT o_orderstatus, c_mktsegment, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey
    GROUP BY 1, 2""")
def temp_views(t):
    t.orders.createOrReplaceTempView("tw_orders")
    t.customer.createOrReplaceTempView("tw_customer")
    listed = {v.name for v in t.spark.catalog.listTables() if v.isTemporary}
    if not {"tw_orders", "tw_customer"} <= listed:
        raise RuntimeError("temporary views are missing from the catalog")
    return t.spark.sql("""
        SELECT o_orderstatus, c_mktsegment, count(*) AS n
        FROM tw_orders JOIN tw_customer ON o_custkey = c_custkey GROUP BY 1, 2""")


@query("kafka_partition_stats", """
    SELECT 'events' AS topic, CAST(user_id % 3 AS BIGINT) AS "partition", count(*) AS records, min(event_id) AS first_offset,
           max(event_id) AS last_offset,
           round(CAST(count(*) / (epoch(date_trunc('second', max(ts))) - epoch(date_trunc('second', min(ts)))) AS DECIMAL(38, 10)), 6)::DOUBLE
             AS records_per_sec
    FROM events GROUP BY 2""")
def kafka_partition_stats(t):
    return logs.partition_stats(_records(t)).withColumn("partition", F.col("partition").cast("bigint"))


@query("consumer_lag", """
    WITH h AS (SELECT user_id % 3 AS p, max(event_id) + 1 AS high FROM events GROUP BY 1),
    c AS (SELECT user_id % 3 AS p, max(event_id) + 1 AS done FROM events
          WHERE ts < TIMESTAMP '2024-01-20' AND user_id % 3 <> 2 GROUP BY 1)
    SELECT 'events' AS topic, CAST(h.p AS BIGINT) AS "partition", high AS high_watermark, coalesce(done, 0) AS committed,
           greatest(high - coalesce(done, 0), 0) AS lag, high AS safe_offset
    FROM h LEFT JOIN c USING (p)""")
def consumer_lag(t):
    records = _records(t)
    next_offset = F.max("offset") + 1
    high = records.groupBy("topic", "partition").agg(next_offset.alias("high_watermark"))
    # The third partition has not committed anything yet.
    read = records.filter((F.col("timestamp") < F.lit("2024-01-20").cast("timestamp_ntz")) & (F.col("partition") != 2))
    committed = read.groupBy("topic", "partition").agg(next_offset.alias("committed"))
    return logs.consumer_lag(high, committed).withColumn("partition", F.col("partition").cast("bigint"))
