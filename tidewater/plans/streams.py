"""Streaming queries: each reads the given tables as a stream, runs to the end of what is
available, and returns what its sink holds."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions import expressions as X
from tidewater.functions.rules import RIDE_ANOMALY_THRESHOLD, ride_anomaly_rules, rule_score, triggered_rule_names
from tidewater.operators.aggregates import describe_columns, sessions, top_rows
from tidewater.operators.cleaning import first_readings, plausible_sensors, sensor_audit
from tidewater.operators.layout import persisted
from tidewater.operators.windows import running_max, with_windows
from tidewater.plans.aggregates import CLEAN_SENSORS
from tidewater.plans.cleaning import SCORE, TRIGGERED
from tidewater.plans.registry import query
from tidewater.plans.scalars import RIDES
from tidewater.plans.tables import READINGS, Tables, sensors_of, trips_of
from tidewater.session import scratch_path
from tidewater.sources.log_source import append_log, log_stream
from tidewater.streaming import aggregates as S
from tidewater.streaming import sinks
from tidewater.streaming.sources import SENSOR_SCHEMA, parse_records, stream_files, with_event_time
from tidewater.streaming.state import ThresholdTrigger, keyed_state, nth_occurrence_alerts, running_moments

DELAY = "5 minutes"
LOG_SEGMENT = 100_000


def event_stream(t: Tables) -> DataFrame:
    return stream_files(t.spark, t.path("events"), t.events.schema)


def reading_stream(t: Tables) -> DataFrame:
    """Sensor readings as a stream with parsed event time and watermark."""
    readings = sensors_of(event_stream(t)).withColumn("event_time", X.parse_event_time(F.col("timestamp")))
    return readings.withWatermark("event_time", DELAY)


def ride_stream(t: Tables, delay: str = "1 minute") -> DataFrame:
    lines = stream_files(t.spark, t.path("lineitem"), t.lineitem.schema)
    return with_event_time(S.ride_columns(trips_of(lines)), "pickup_ts", delay)


# Append mode emits the windows that end at or before the latest event time minus the delay.
def _closed(source: str, time: str, minutes: int, where: str = "TRUE") -> str:
    return f"(SELECT max({time}) - INTERVAL {minutes} MINUTES FROM {source} WHERE {where})"


@query("st_parse_json", f"""
    WITH {READINGS}
    SELECT event_id, sensor_id, "timestamp", temperature, humidity, status, event_time FROM readings""")
def st_parse_json(t):
    sensors = sensors_of(event_stream(t))
    payload = F.to_json(F.struct("sensor_id", "timestamp", "temperature", "humidity", "status"))
    records = sensors.select("event_id", payload.cast("binary").alias("value"))
    parsed = parse_records(records, SENSOR_SCHEMA, "timestamp", extra=("event_id",))
    return sinks.run_to_table(parsed.withColumn("event_time", F.col("event_time").cast("timestamp_ntz")), "parse")


@query("st_project_filter", """
    SELECT event_id, user_id, value * 2 AS doubled, hour(ts) AS hour FROM events
    WHERE value > 50 AND event_type <> 'error'""")
def st_project_filter(t):
    stream = event_stream(t).filter((F.col("value") > 50) & (F.col("event_type") != "error"))
    return sinks.run_to_table(stream.select(
        "event_id", "user_id", (F.col("value") * 2).alias("doubled"), X.hour_of_day(F.col("ts")).alias("hour")), "project")


@query("st_watermark", f"""
    WITH w AS (
    SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
           CASE WHEN value < 10 THEN 'low' WHEN value < 50 THEN 'medium' ELSE 'high' END AS band, count(*) AS n,
           round(CAST(avg(value) AS DECIMAL(38, 10)), 4)::DOUBLE AS mean
    FROM events GROUP BY ALL)
    SELECT * FROM w WHERE window_end <= {_closed('events', 'ts', 10)}""")
def st_watermark(t):
    stream = with_event_time(event_stream(t), "ts", "10 minutes").withColumn(
        "band", X.banded(F.col("value"), [(10, "low"), (50, "medium")], "high"))
    return sinks.run_to_table(S.window_agg(stream, "event_time", "1 hour", ["band"], [
        F.count(F.lit(1)).alias("n"), X.steady(F.avg("value"), 4).alias("mean")]), "watermark")


_SENSOR_WINDOWS = """
    SELECT time_bucket(INTERVAL 5 MINUTES, event_time) AS window_start,
           time_bucket(INTERVAL 5 MINUTES, event_time) + INTERVAL 5 MINUTES AS window_end, sensor_id,
           round(CAST(avg(temperature) AS DECIMAL(38, 10)), 2)::DOUBLE AS avg_temp, max(temperature) AS max_temperature,
           count(status) AS total_status_records
    FROM {source} WHERE event_time IS NOT NULL GROUP BY ALL"""


@query("st_tumbling_agg", f"""
    WITH {READINGS}, w AS ({_SENSOR_WINDOWS.format(source='readings')})
    SELECT * FROM w WHERE window_end <= {_closed('readings', 'event_time', 5)}""")
def st_tumbling_agg(t):
    return sinks.run_to_table(S.sensor_windows(reading_stream(t)), "tumbling")


ZONE_FEATURES = RIDES + """,
zone_features AS (
  SELECT time_bucket(INTERVAL 5 MINUTES, pickup_ts) AS window_start,
         time_bucket(INTERVAL 5 MINUTES, pickup_ts) + INTERVAL 5 MINUTES AS window_end, pu_zone,
         count(*) AS demand_5m, round(CAST(avg(fare) AS DECIMAL(38, 10)), 2)::DOUBLE AS avg_fare_5m,
         round(CAST(max(fare) AS DECIMAL(38, 10)), 2)::DOUBLE AS max_fare_5m,
         round(CAST(stddev_samp(fare) AS DECIMAL(38, 10)), 2)::DOUBLE AS std_fare_5m,
         round(CAST(avg(distance) AS DECIMAL(38, 10)), 2)::DOUBLE AS avg_distance_5m,
         round(CAST(avg(duration_min) AS DECIMAL(38, 10)), 2)::DOUBLE AS avg_duration_5m,
         round(CAST(avg(tip_pct) AS DECIMAL(38, 10)), 2)::DOUBLE AS avg_tip_pct_5m,
         round(CAST(avg(tip) AS DECIMAL(38, 10)), 2)::DOUBLE AS avg_tip_5m, round(CAST(avg(is_airport) AS DECIMAL(38, 10)), 3)::DOUBLE AS airport_ratio_5m,
         round(CAST(avg(fare_per_mile) AS DECIMAL(38, 10)), 2)::DOUBLE AS avg_fare_per_mile_5m
  FROM rides GROUP BY ALL)"""


@query("st_zone_features", f"""
    WITH {ZONE_FEATURES} SELECT * FROM zone_features WHERE window_end <= {_closed('rides', 'pickup_ts', 1)}""")
def st_zone_features(t):
    return sinks.run_to_table(S.zone_features(ride_stream(t), "event_time"), "zones")


@query("st_demand_alerts", f"""
    WITH {RIDES}, busy AS (
    SELECT pickup_ts - to_days(CAST(date_diff('day', DATE '2024-01-01', CAST(pickup_ts AS DATE)) AS INTEGER)) AS pickup_ts,
           pu_zone % 3 AS pu_zone, fare, distance
    FROM rides),
    w AS (
    SELECT time_bucket(INTERVAL 5 MINUTES, pickup_ts) AS window_start,
           time_bucket(INTERVAL 5 MINUTES, pickup_ts) + INTERVAL 5 MINUTES AS window_end, pu_zone, count(*) AS ride_count,
           round(CAST(avg(fare) AS DECIMAL(38, 10)), 2)::DOUBLE AS avg_fare, round(CAST(avg(distance) AS DECIMAL(38, 10)), 2)::DOUBLE AS avg_distance
    FROM busy GROUP BY ALL HAVING count(*) > 10)
    SELECT * FROM w WHERE window_end <= {_closed('busy', 'pickup_ts', 1)}""")
def st_demand_alerts(t):
    """The rides of all days laid over one day and three districts, which makes five minutes busy."""
    days = F.datediff(F.to_date("pickup_ts"), F.lit("2024-01-01").cast("date"))
    rides = S.ride_columns(trips_of(stream_files(t.spark, t.path("lineitem"), t.lineitem.schema))).withColumns({
        "pickup_ts": F.col("pickup_ts") - F.make_dt_interval(days), "pu_zone": F.col("pu_zone") % 3})
    return sinks.run_to_table(S.demand_alerts(with_event_time(rides, "pickup_ts", "1 minute"), "event_time", 10), "alerts")


@query("st_fixed_window_sum", f"""
    WITH w AS (
      SELECT time_bucket(INTERVAL 5 MINUTES, ts) AS window_start,
             time_bucket(INTERVAL 5 MINUTES, ts) + INTERVAL 5 MINUTES AS window_end, round(sum(value), 2) AS total
      FROM events GROUP BY ALL)
    SELECT * FROM w WHERE window_end <= {_closed('events', 'ts', 5)}""")
def st_fixed_window_sum(t):
    stream = with_event_time(event_stream(t), "ts", DELAY)
    return sinks.run_to_table(S.window_agg(stream, "event_time", "5 minutes", [], [
        F.round(F.sum("value"), 2).alias("total")]), "fixed")


@query("st_sliding_agg", f"""
    WITH placed AS (
      SELECT time_bucket(INTERVAL 5 MINUTES, ts) - to_minutes(shift) AS window_start, event_type, value
      FROM events, (VALUES (0), (5)) s(shift))
    SELECT window_start, window_start + INTERVAL 10 MINUTES AS window_end, event_type, count(*) AS n,
           max(value) AS max_value
    FROM placed GROUP BY ALL HAVING window_start + INTERVAL 10 MINUTES <= {_closed('events', 'ts', 5)}""")
def st_sliding_agg(t):
    stream = with_event_time(event_stream(t), "ts", DELAY)
    return sinks.run_to_table(S.window_agg(stream, "event_time", "10 minutes", ["event_type"], [
        F.count(F.lit(1)).alias("n"), F.max("value").alias("max_value")], slide="5 minutes"), "sliding")


@query("st_dedup", f"""
    WITH {READINGS}
    SELECT DISTINCT sensor_id, event_time FROM readings WHERE event_time IS NOT NULL""")
def st_dedup(t):
    stream = reading_stream(t).filter(F.col("event_time").isNotNull()).select("sensor_id", "event_time")
    unique = S.dedupe(stream, ["sensor_id"], salts=8)
    return sinks.run_to_table(unique.withColumn("event_time", F.col("event_time").cast("timestamp_ntz")), "dedup")


_CLEAN_READINGS = f"""{READINGS},
    firsts AS (
      SELECT * FROM readings WHERE event_time IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY sensor_id, event_time ORDER BY event_id) = 1),
    kept AS (
      SELECT *, hour(event_time) AS hour_of_day FROM firsts
      WHERE temperature BETWEEN -20 AND 100 AND humidity BETWEEN 0 AND 100)"""


@query("st_clean_enrich", f"""
    WITH {_CLEAN_READINGS},
    windows AS (
      SELECT time_bucket(INTERVAL 5 MINUTES, event_time) AS window_start, sensor_id, count(*) AS n,
             max(hour_of_day) AS hour_of_day
      FROM kept GROUP BY ALL)
    SELECT * FROM windows WHERE window_start + INTERVAL 5 MINUTES <= {_closed('readings', 'event_time', 5)}""")
def st_clean_enrich(t):
    enriched = S.clean_sensor_stream(reading_stream(t), "event_id")
    return sinks.run_to_table(S.window_agg(enriched, "event_time", "5 minutes", ["sensor_id"], [
        F.count(F.lit(1)).alias("n"), F.max("hour_of_day").alias("hour_of_day")]).drop("window_end"), "enrich")


@query("st_clean_windows", f"""
    WITH {_CLEAN_READINGS}, w AS ({_SENSOR_WINDOWS.format(source='kept')})
    SELECT * FROM w WHERE window_end <= {_closed('readings', 'event_time', 5)}""")
def st_clean_windows(t):
    """Watermark, dedupe, range check, time features and window aggregate in one stream."""
    return sinks.run_to_table(S.sensor_windows(S.clean_sensor_stream(reading_stream(t), "event_id")), "clean-windows")


@query("st_output_modes", f"""
    WITH w AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS h, count(*) AS n FROM events GROUP BY 1)
    SELECT 'append' AS mode, count(*) AS windows, CAST(sum(n) AS BIGINT) AS events FROM w
      WHERE h + INTERVAL 1 HOUR <= {_closed('events', 'ts', 5)}
    UNION ALL SELECT 'update', count(*), CAST(sum(n) AS BIGINT) FROM w
    UNION ALL SELECT 'complete', count(*), CAST(sum(n) AS BIGINT) FROM w""")
def st_output_modes(t):
    def hourly():
        return S.window_agg(with_event_time(event_stream(t), "ts", DELAY), "event_time", "1 hour", [],
                            [F.count(F.lit(1)).alias("n")])

    results = {
        "append": sinks.run_to_table(hourly(), "append"),
        "update": sinks.latest_version(sinks.run_versions(hourly(), "update", "update"), ["window_start"]),
        "complete": sinks.newest_batch(sinks.run_versions(hourly(), "complete", "complete")),
    }
    out = None
    for mode, df in results.items():
        part = df.agg(F.lit(mode).alias("mode"), F.count(F.lit(1)).alias("windows"), F.sum("n").alias("events"))
        out = part if out is None else out.unionByName(part)
    return out


@query("st_late_events", f"""
    WITH {READINGS},
    seen AS (
      SELECT *, max(event_time) OVER (ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS latest
      FROM (SELECT DISTINCT event_id, sensor_id, event_time FROM readings WHERE event_time IS NOT NULL))
    SELECT event_id, sensor_id, event_time FROM seen WHERE event_time < latest - INTERVAL 5 MINUTES""")
def st_late_events(t):
    """Events that are behind the watermark when they arrive, in arrival order."""
    arrived = t.readings.filter(F.col("event_time").isNotNull()).select(
        "event_id", "sensor_id", F.col("event_time").cast("timestamp_ntz").alias("event_time")).distinct()
    seen = with_windows(arrived, [], ["event_id"], {"latest": running_max("event_time")})
    return seen.filter(F.col("event_time") < F.col("latest") - F.expr("INTERVAL 5 MINUTES")).drop("latest")


LATE_BATCHES = 8


@query("st_late_side_output", f"""
    WITH {READINGS},
    timed AS (SELECT event_id, sensor_id, event_time FROM readings WHERE event_time IS NOT NULL),
    numbered AS (
      SELECT *, (row_number() OVER (ORDER BY event_id) - 1)
             // ((SELECT count(*) FROM timed) // {LATE_BATCHES} + 1) AS batch FROM timed),
    high AS (SELECT batch, max(max(event_time)) OVER (ORDER BY batch) AS high FROM numbered GROUP BY batch)
    SELECT event_id, sensor_id, event_time,
           coalesce(event_time <= h.high - INTERVAL 5 MINUTES, FALSE) AS late
    FROM numbered n LEFT JOIN high h ON h.batch = n.batch - 2""")
def st_late_side_output(t):
    """All readings of a log, in eight batches; those behind the watermark of their batch are written apart."""
    base = scratch_path(t.spark, "late")
    timed = t.readings.filter(F.col("event_time").isNotNull()).select("event_id", "sensor_id", "event_time")
    records = timed.select(
        F.col("sensor_id").cast("binary").alias("key"), F.to_json(F.struct("event_id", "sensor_id")).cast("binary").alias("value"),
        F.lit(0).alias("partition"), F.col("event_time").cast("timestamp").alias("timestamp"), "event_id")
    append_log(records, f"{base}/log", ["event_id"], segment_records=LOG_SEGMENT)
    per_batch = timed.count() // LATE_BATCHES + 1
    stream = parse_records(log_stream(t.spark, f"{base}/log", f"{base}/checkpoint", maxOffsetsPerTrigger=per_batch),
                           "event_id bigint, sensor_id string", extra=("timestamp",)).withColumnRenamed("timestamp", "event_time")
    split = sinks.LateSplit("event_time", DELAY, base)
    sinks.run_through(sinks.start_query(stream, f"{base}/checkpoint", each_batch=split, every="0 seconds"))
    kept, late = split.tables(t.spark, stream.schema)
    return kept.withColumn("late", F.lit(False)).unionByName(late.withColumn("late", F.lit(True))).select(
        "event_id", "sensor_id", F.col("event_time").cast("timestamp_ntz").alias("event_time"), "late")


@query("st_batch_reports", f"""
    WITH {READINGS},
    numbered AS (
      SELECT *, (row_number() OVER (ORDER BY event_id) - 1)
             // ((SELECT count(*) FROM readings) // {LATE_BATCHES} + 1) AS batch FROM readings),
    judged AS (
      SELECT *, CASE WHEN event_time IS NULL THEN 'bad_time' WHEN temperature IS NULL THEN 'missing'
                     WHEN temperature NOT BETWEEN -20 AND 100 OR humidity NOT BETWEEN 0 AND 100 THEN 'range'
                     ELSE 'ok' END AS fault FROM numbered)
    SELECT batch, count(*) AS received, count(*) FILTER (fault = 'bad_time') AS invalid_timestamp,
           count(*) FILTER (fault = 'missing') AS missing_value, count(*) FILTER (fault = 'range') AS out_of_range,
           count(*) FILTER (fault = 'ok') - count(DISTINCT (sensor_id, "timestamp")) FILTER (fault = 'ok') AS duplicates,
           count(DISTINCT (sensor_id, "timestamp")) FILTER (fault = 'ok') AS clean,
           count(DISTINCT sensor_id) FILTER (fault = 'ok' AND status = 'click') AS active_sensors,
           max(temperature) FILTER (fault = 'ok') AS max_temperature
    FROM judged GROUP BY batch""")
def st_batch_reports(t):
    """Counters and analytics of each micro-batch of a log, written by batch and read as one table."""
    base = scratch_path(t.spark, "reports")
    payload = ["event_id", "sensor_id", "timestamp", "temperature", "humidity", "status"]
    records = t.readings.select(
        F.col("sensor_id").cast("binary").alias("key"), F.to_json(F.struct(*payload)).cast("binary").alias("value"),
        F.lit(0).alias("partition"), F.current_timestamp().alias("timestamp"), "event_id")
    append_log(records, f"{base}/log", ["event_id"], segment_records=LOG_SEGMENT)
    per_batch = t.readings.count() // LATE_BATCHES + 1
    stream = parse_records(log_stream(t.spark, f"{base}/log", f"{base}/checkpoint", maxOffsetsPerTrigger=per_batch),
                           "event_id bigint, " + SENSOR_SCHEMA, event_time_from="timestamp")

    def report(batch: DataFrame, batch_id: int) -> None:
        ok = plausible_sensors(batch.filter(F.col("event_time").isNotNull() & F.col("temperature").isNotNull()))
        with persisted(batch):
            analytics = ok.agg(
                F.count_distinct(F.when(F.col("status") == "click", F.col("sensor_id"))).alias("active_sensors"),
                F.max("temperature").alias("max_temperature"))
            sensor_audit(batch).crossJoin(analytics).write.mode("overwrite").parquet(f"{base}/reports/batch={batch_id}")

    sinks.run_through(sinks.start_query(stream, f"{base}/checkpoint", each_batch=report, every="0 seconds"))
    found = t.spark.read.parquet(f"{base}/reports")
    return found.withColumn("batch", F.col("batch").cast("bigint"))


@query("st_anomaly_stream", f"""
    WITH {RIDES}, scored AS (
      SELECT order_key, vendor_id, do_zone, CAST({SCORE} AS BIGINT) AS score, {TRIGGERED} AS rules FROM rides)
    SELECT * FROM scored WHERE score >= 3""")
def st_anomaly_stream(t):
    lines = stream_files(t.spark, t.path("lineitem"), t.lineitem.schema)
    rules = ride_anomaly_rules()
    scored = S.ride_columns(trips_of(lines)).select(
        "order_key", "vendor_id", "do_zone", rule_score(rules).alias("score"),
        triggered_rule_names(rules).alias("rules"))
    return sinks.run_to_table(scored.filter(F.col("score") >= RIDE_ANOMALY_THRESHOLD), "anomalies")


def clean_in_batches(readings: DataFrame, base: str) -> DataFrame:
    """What ``clean_sensors`` makes of all rows of a stream, however they are cut into micro-batches.

    A micro-batch writes its first reading per sensor and time, sum and number of its temperatures, and
    its audit; folders are per batch, so a repeat replaces them. Mean and first readings of the whole
    stream come from these folders.
    """
    spark = readings.sparkSession

    def carry(batch: DataFrame, batch_id: int) -> None:
        value = F.col("temperature").cast("double")
        with persisted(batch) as kept:
            first_readings(kept).write.mode("overwrite").parquet(f"{base}/first/batch={batch_id}")
            kept.agg(F.sum(value).alias("total"), F.count(value).alias("n")).write.mode("overwrite").parquet(
                f"{base}/sums/batch={batch_id}")
            sensor_audit(kept).write.mode("overwrite").parquet(f"{base}/audit/batch={batch_id}")

    sinks.start_query(readings, f"{base}/checkpoint", each_batch=carry).awaitTermination()
    first = first_readings(spark.read.parquet(f"{base}/first").drop("batch"))
    mean = spark.read.parquet(f"{base}/sums").agg((F.sum("total") / F.nullif(F.sum("n"), F.lit(0))).alias("m")).scalar()
    return plausible_sensors(first.withColumn("temperature", F.coalesce(F.col("temperature").cast("double"), mean)))


@query("st_foreach_batch_clean", f"""
    WITH {CLEAN_SENSORS}
    SELECT event_id, sensor_id, round(temperature, 4) AS temperature, status, hour_of_day, day_of_week, is_weekend
    FROM clean""")
def st_foreach_batch_clean(t):
    """Clean a stream whose means and copies span micro-batches, and log each batch's audit."""
    readings = sensors_of(event_stream(t)).withColumn("event_time", X.parse_event_time(F.col("timestamp")))
    return clean_in_batches(readings, scratch_path(t.spark, "foreach")).select(
        "event_id", "sensor_id", F.round("temperature", 4).alias("temperature"), "status", "hour_of_day",
        "day_of_week", "is_weekend")


@query("st_feature_store", f"""
    WITH {ZONE_FEATURES}
    SELECT window_start, pu_zone, demand_5m, avg_fare_5m, year(window_start) AS year, month(window_start) AS month
    FROM zone_features""")
def st_feature_store(t):
    """Features of all windows, open ones too, upserted by zone and window; closed months are merged."""
    base = scratch_path(t.spark, "feature-store")
    store = sinks.KeyedStore(f"{base}/zones", ["pu_zone", "window_start"])
    features = S.zone_features(ride_stream(t), "event_time")
    sinks.start_query(features, f"{base}/checkpoint", mode="update", each_batch=store).awaitTermination()
    return store.table(t.spark, features.schema).select(
        "window_start", "pu_zone", "demand_5m", "avg_fare_5m", F.col("year").cast("bigint").alias("year"),
        F.col("month").cast("bigint").alias("month"))


@query("st_csv_log", f"""
    WITH w AS (
      SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL)
    SELECT * FROM w WHERE window_start + INTERVAL 1 HOUR <= {_closed('events', 'ts', 5)}""")
def st_csv_log(t):
    base = scratch_path(t.spark, "csv-log")
    counts = S.window_agg(with_event_time(event_stream(t), "ts", DELAY), "event_time", "1 hour", ["event_type"],
                          [F.count(F.lit(1)).alias("n")]).drop("window_end")
    sinks.start_query(counts, f"{base}/checkpoint", "csv", f"{base}/out", header=True).awaitTermination()
    return t.spark.read.schema(counts.schema).option("header", True).csv(f"{base}/out")


@query("st_memory_table", """
    SELECT hour(ts) AS hour, count(*) AS n, round(CAST(avg(value) AS DECIMAL(38, 10)), 4)::DOUBLE AS mean FROM events GROUP BY 1""")
def st_memory_table(t):
    """The memory sink keeps its result in the driver; this one has at most 24 rows."""
    base = scratch_path(t.spark, "memory")
    name = f"hourly_{base.rsplit('-', 1)[1]}"
    counts = event_stream(t).groupBy(X.hour_of_day(F.col("ts")).alias("hour")).agg(
        F.count(F.lit(1)).alias("n"), X.steady(F.avg("value"), 4).alias("mean"))
    sinks.start_query(counts, f"{base}/checkpoint", "memory", mode="complete", name=name).awaitTermination()
    return t.spark.sql(f"SELECT hour, n, mean FROM {name}")


@query("st_console", "SELECT count(*) AS input_rows FROM events")
def st_console(t):
    counts = event_stream(t).groupBy("event_type").count()
    base = scratch_path(t.spark, "console")
    with sinks.ProgressLog(t.spark, f"{base}/progress") as log:
        q = sinks.start_query(counts, f"{base}/checkpoint", "console", mode="complete", truncate="false", numRows=5)
        q.awaitTermination()
        return log.table(q).agg(F.sum("input_rows").alias("input_rows"))


@query("st_progress_metrics")
def st_progress_metrics(t):
    base = scratch_path(t.spark, "progress")
    with sinks.ProgressLog(t.spark, f"{base}/progress") as log:
        q = sinks.start_query(S.sensor_windows(reading_stream(t)), f"{base}/checkpoint", "noop")
        q.awaitTermination()
        return log.table(q)


@query("st_triggers", """
    SELECT 'available_now' AS trigger, count(*) AS rows FROM events
    UNION ALL SELECT 'processing_time', count(*) FROM events""")
def st_triggers(t):
    once = sinks.run_to_table(event_stream(t).select("event_id"), "once")
    base = scratch_path(t.spark, "periodic")
    q = sinks.start_query(event_stream(t).select("event_id"), f"{base}/checkpoint", path=f"{base}/out", every="0 seconds")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    periodic = t.spark.read.parquet(f"{base}/out")
    return once.agg(F.lit("available_now").alias("trigger"), F.count(F.lit(1)).alias("rows")).unionByName(
        periodic.agg(F.lit("processing_time").alias("trigger"), F.count(F.lit(1)).alias("rows")))


@query("st_checkpoint", "SELECT 1 AS run, count(*) AS rows FROM events UNION ALL SELECT 2, count(*) FROM events")
def st_checkpoint(t):
    """A restart from the same checkpoint finds nothing new and adds no rows."""
    base = scratch_path(t.spark, "restart")
    runs = []
    for run in (1, 2):
        sinks.start_query(event_stream(t).select("event_id"), f"{base}/checkpoint", path=f"{base}/out").awaitTermination()
        runs.append((run, t.spark.read.parquet(f"{base}/out").count()))
    return t.spark.createDataFrame(runs, "run int, rows bigint")


@query("st_multi_query", """
    SELECT 'errors' AS query, count(*) FILTER (event_type = 'error') AS rows FROM events
    UNION ALL SELECT 'valuable', count(*) FILTER (value > 100) FROM events""")
def st_multi_query(t):
    """Two queries on one parsed stream, listed while active and stopped at the end."""
    base = scratch_path(t.spark, "multi")
    stream = event_stream(t)
    parts = {"errors": stream.filter(F.col("event_type") == "error"), "valuable": stream.filter(F.col("value") > 100)}
    started = {name: sinks.start_query(df.select("event_id"), f"{base}/{name}-checkpoint", path=f"{base}/{name}",
                                       every="1 second") for name, df in parts.items()}
    try:
        active = {q.id for q in t.spark.streams.active}
        if not {q.id for q in started.values()} <= active:
            raise RuntimeError("a started query is not active")
        for q in started.values():
            q.processAllAvailable()
    finally:
        for q in started.values():
            q.stop()
    one, two = [t.spark.read.parquet(f"{base}/{name}").agg(F.lit(name).alias("query"), F.count(F.lit(1)).alias("rows"))
                for name in parts]
    return one.unionByName(two)


@query("st_replay", """
    SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n, round(sum(value), 2) AS total FROM events
    WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-13' GROUP BY 1""")
def st_replay(t):
    """Recompute a date range from the beginning of the stream with a fresh checkpoint."""
    wanted = F.col("ts").between(F.lit("2024-01-10").cast("timestamp_ntz"),
                                 F.lit("2024-01-12 23:59:59.999999").cast("timestamp_ntz"))
    daily = event_stream(t).filter(wanted).groupBy(F.to_date("ts").cast("string").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))
    return sinks.newest_batch(sinks.run_versions(daily, "replay", "complete"))


@query("st_running_stats", f"""
    WITH {READINGS}
    SELECT sensor_id, count(temperature) AS n, round(CAST(avg(temperature) AS DECIMAL(38, 10)), 6)::DOUBLE AS mean,
           round(CAST(stddev_samp(temperature) AS DECIMAL(38, 10)), 6)::DOUBLE AS std
    FROM readings GROUP BY sensor_id""")
def st_running_stats(t):
    """Count, mean and deviation so far, as keyed state that merges the moments of each task's rows."""
    moments = running_moments(sensors_of(event_stream(t)), "sensor_id", "temperature")
    with keyed_state(t.spark):
        latest = sinks.latest_version(sinks.run_versions(moments, "stats", "update"), ["sensor_id"])
    n = F.col("n")
    return latest.select(
        "sensor_id", "n", X.steady(F.when(n > 0, F.col("mean")), 6).alias("mean"),
        X.steady(F.when(n > 1, F.sqrt(F.col("m2") / (n - 1))), 6).alias("std"))


@query("st_counter", "SELECT user_id, count(*) AS n FROM events GROUP BY user_id")
def st_counter(t):
    counts = event_stream(t).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return sinks.latest_version(sinks.run_versions(counts, "counter", "update"), ["user_id"])


@query("st_state_alert", """
    WITH gaps AS (
      SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) > INTERVAL 2 DAYS
                THEN 1 ELSE 0 END AS fresh FROM events),
    runs AS (
      SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM gaps)
    SELECT user_id, event_id AS at, 3::BIGINT AS n FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id, run ORDER BY ts, event_id) AS rn FROM runs) WHERE rn = 3""")
def st_state_alert(t):
    """The third event of every run of a user's events; two days without an event end a run and its state."""
    alerts = nth_occurrence_alerts(event_stream(t), "user_id", "ts", "event_id", 3, timedelta(days=2))
    with keyed_state(t.spark):
        return sinks.run_to_table(alerts, "alert")


SESSIONS = """
    WITH gaps AS (
      SELECT *, CASE WHEN user_id % 2 = 0 THEN INTERVAL 6 HOURS ELSE INTERVAL 12 HOURS END AS gap FROM events),
    marked AS (
      SELECT *, CASE WHEN ts <= lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + gap THEN 0 ELSE 1 END AS fresh
      FROM gaps),
    numbered AS (
      SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session FROM marked),
    sessions AS (
      SELECT min(ts) AS session_start, max(ts + gap) AS session_end, user_id, count(*) AS n_events,
             CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS total
      FROM numbered GROUP BY user_id, session)"""


def _session_measures() -> list:
    return [F.count(F.lit(1)).alias("n_events"), F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total")]


@query("session_windows", f"{SESSIONS} SELECT * FROM sessions")
def session_windows(t):
    """Sessions of each user's events; the gap that ends one depends on the user."""
    gap = F.when(F.col("user_id") % 2 == 0, F.expr("INTERVAL 6 HOURS")).otherwise(F.expr("INTERVAL 12 HOURS"))
    return sessions(t.events, ["user_id"], "ts", ["event_id"], gap, _session_measures())


@query("st_session_windows", f"""{SESSIONS}
    SELECT * FROM sessions WHERE session_end <= {_closed('events', 'ts', 5)}""")
def st_session_windows(t):
    """The same sessions from a stream, as soon as the watermark has passed their end."""
    stream = with_event_time(event_stream(t), "ts", DELAY)
    gap = F.when(F.col("user_id") % 2 == 0, "6 hours").otherwise("12 hours")
    return sinks.run_to_table(S.session_agg(stream, "event_time", gap, ["user_id"], _session_measures()), "sessions")


@query("st_threshold_trigger", """
    SELECT user_id, event_id, CAST(total AS DOUBLE) AS total FROM (
      SELECT *, sum(CAST(value AS DECIMAL(18, 2))) OVER (
        PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS total
      FROM events) WHERE total >= 500""")
def st_threshold_trigger(t):
    """Amounts have two decimals and are added as such, so a total of exactly 500 fires."""
    base = scratch_path(t.spark, "trigger")
    trigger = ThresholdTrigger("user_id", ["event_id"], "value", 500, f"{base}/state")
    stream = event_stream(t).select("user_id", "event_id", F.col("value").cast("decimal(18,2)").alias("value"))
    sinks.start_query(stream, f"{base}/checkpoint", each_batch=trigger).awaitTermination()
    return trigger.fired(t.spark).select("user_id", "event_id", F.col("total").cast("double").alias("total"))


@query("fs_explore", f"""
    WITH {ZONE_FEATURES},
    top AS (SELECT pu_zone, sum(demand_5m) AS rides, round(CAST(avg(avg_fare_5m) AS DECIMAL(38, 10)), 2)::DOUBLE AS fare FROM zone_features
            GROUP BY 1 ORDER BY rides DESC, pu_zone LIMIT 10)
    SELECT 'rows' AS report, 'all' AS key, CAST(count(*) AS DOUBLE) AS value FROM zone_features
    UNION ALL SELECT 'zones', 'all', CAST(count(DISTINCT pu_zone) AS DOUBLE) FROM zone_features
    UNION ALL SELECT 'top_zone', CAST(pu_zone AS VARCHAR), CAST(rides AS DOUBLE) FROM top
    UNION ALL SELECT 'surge_windows', 'all', CAST(count(*) FILTER (avg_fare_per_mile_5m > 5) AS DOUBLE) FROM zone_features
    UNION ALL SELECT 'airport_windows', 'all', CAST(count(*) FILTER (airport_ratio_5m > 0.5) AS DOUBLE) FROM zone_features
    UNION ALL SELECT 'mean', 'demand_5m', round(CAST(avg(demand_5m) AS DECIMAL(38, 10)), 4)::DOUBLE FROM zone_features
    UNION ALL SELECT 'mean', 'avg_fare_5m', round(CAST(avg(avg_fare_5m) AS DECIMAL(38, 10)), 4)::DOUBLE FROM zone_features""")
def fs_explore(t):
    """Reports over a feature store that is written once and read by each of them."""
    path = scratch_path(t.spark, "features")
    S.zone_features(S.ride_columns(t.trips), "pickup_ts").write.parquet(path)
    store = t.spark.read.parquet(path)

    def report(df: DataFrame, name: str, key, value) -> DataFrame:
        key = F.lit(key) if isinstance(key, str) else key
        return df.select(F.lit(name).alias("report"), key.alias("key"), value.cast("double").alias("value"))

    totals = store.agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("pu_zone").alias("zones"),
        F.count_if(F.col("avg_fare_per_mile_5m") > 5).alias("surge"),
        F.count_if(F.col("airport_ratio_5m") > 0.5).alias("airport"))
    top = top_rows(store.groupBy("pu_zone").agg(F.sum("demand_5m").alias("rides")), 10, F.desc("rides"), F.asc("pu_zone"))
    spread = describe_columns(store, ["demand_5m", "avg_fare_5m"])
    parts = [
        report(totals, "rows", "all", F.col("rows")), report(totals, "zones", "all", F.col("zones")),
        report(top, "top_zone", F.col("pu_zone").cast("string"), F.col("rides")),
        report(totals, "surge_windows", "all", F.col("surge")),
        report(totals, "airport_windows", "all", F.col("airport")),
        report(spread, "mean", F.col("column"), F.col("mean")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query("window_trend", f"""
    WITH {READINGS}{_SENSOR_WINDOWS.format(source='readings')}
    ORDER BY window_start, sensor_id""")
def window_trend(t):
    return S.sensor_windows(t.readings).orderBy("window_start", "sensor_id")
