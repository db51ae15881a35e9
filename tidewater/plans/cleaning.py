"""Cleaning, imputation and data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions import expressions as X
from tidewater.functions.rules import RIDE_ANOMALY_THRESHOLD, ride_anomaly_rules, rule_score, triggered_rule_names
from tidewater.ml.evaluation import binary_metrics
from tidewater.operators import cleaning as C
from tidewater.operators import quality as Q
from tidewater.operators.sampling import split_column
from tidewater.plans.registry import query
from tidewater.plans.scalars import RIDES
from tidewater.plans.tables import EMPLOYEES, READINGS, SENSORS, TRIPS
from tidewater.session import scratch_path
from tidewater.sources.files import write_table
from tidewater.streaming.aggregates import ride_columns

_KEYS = ["order_key", "vendor_id", "do_zone"]
_ID = "order_key, vendor_id, do_zone"


@query("impute_constant", f"""
    WITH {TRIPS}
    SELECT {_ID}, coalesce(passengers, 1) AS passengers, coalesce(airport_fee, 0) AS airport_fee,
           coalesce(congestion_fee, 0) AS congestion_fee FROM trips""")
def impute_constant(t):
    return t.trips.select(*_KEYS, "passengers", "airport_fee", "congestion_fee").na.fill(
        {"passengers": 1.0, "airport_fee": 0.0, "congestion_fee": 0.0})


@query("impute_mean", f"""
    WITH {SENSORS}
    SELECT event_id, round(coalesce(temperature, (SELECT avg(temperature) FROM sensors)), 4) AS temperature
    FROM sensors""")
def impute_mean(t):
    return C.fill_with_mean(t.sensors, ["temperature"]).select("event_id", F.round("temperature", 4).alias("temperature"))


@query("impute_median", f"""
    WITH {SENSORS}
    SELECT event_id, coalesce(temperature, (SELECT quantile_disc(temperature, 0.5) FROM sensors)) AS temperature
    FROM sensors""")
def impute_median(t):
    fills = C.learn_fill_values(t.sensors, ["temperature"], [])
    return C.apply_fill_values(t.sensors, fills).select("event_id", "temperature")


_MODE = """(SELECT city FROM employees WHERE city IS NOT NULL GROUP BY city ORDER BY count(*) DESC, city LIMIT 1)"""


@query("impute_mode", f"""
    WITH {EMPLOYEES} SELECT employee_id, coalesce(city, {_MODE}) AS city FROM employees""")
def impute_mode(t):
    fills = C.learn_fill_values(t.employees, [], ["city"])
    return C.apply_fill_values(t.employees, fills).select("employee_id", "city")


@query("impute_zero_as_missing", f"""
    WITH {TRIPS}
    SELECT {_ID}, CASE WHEN distance = 0 THEN (SELECT quantile_disc(distance, 0.5) FROM trips WHERE distance <> 0)
                       ELSE distance END AS distance,
           CASE WHEN tip = 0 THEN (SELECT quantile_disc(tip, 0.5) FROM trips WHERE tip <> 0) ELSE tip END AS tip
    FROM trips""")
def impute_zero_as_missing(t):
    return C.fill_zero_with_median(t.trips, ["distance", "tip"]).select(*_KEYS, "distance", "tip")


@query("blank_to_null", """
    SELECT p_partkey, nullif(trim(CASE WHEN p_size % 10 = 0 THEN '   ' ELSE ' ' || p_type END), '') AS p_type FROM part""")
def blank_to_null(t):
    raw = F.when(F.col("p_size") % 10 == 0, "   ").otherwise(F.concat(F.lit(" "), "p_type"))
    return t.part.select("p_partkey", X.blank_to_null(raw).alias("p_type"))


_SPLIT = """CASE WHEN CAST(('0x' || substr(md5(employee_id || '#42'), 1, 7)) AS BIGINT) % 10000 < 8000
                 THEN 'train' ELSE 'test' END"""


@query("impute_fit_apply", f"""
    WITH {EMPLOYEES}, marked AS (
      SELECT employee_id, {_SPLIT} AS split, city, CASE WHEN age % 7 <> 0 THEN CAST(age AS DOUBLE) END AS age
      FROM employees),
    fills AS (
      SELECT (SELECT quantile_disc(age, 0.5) FROM marked WHERE split = 'train') AS age,
             (SELECT city FROM marked WHERE split = 'train' AND city IS NOT NULL
              GROUP BY city ORDER BY count(*) DESC, city LIMIT 1) AS city)
    SELECT employee_id, split, coalesce(m.city, f.city) AS city, coalesce(m.age, f.age) AS age
    FROM marked m CROSS JOIN fills f""")
def impute_fit_apply(t):
    marked = t.employees.select(
        "employee_id", split_column("employee_id", {"train": 0.8, "test": 0.2}).alias("split"), "city",
        F.when(F.col("age") % 7 != 0, F.col("age").cast("double")).alias("age"))
    fills = C.learn_fill_values(marked.filter(F.col("split") == "train"), ["age"], ["city"])
    return C.apply_fill_values(marked, fills)


@query("drop_invalid_range", f"""
    WITH {READINGS}
    SELECT event_id, sensor_id, temperature, humidity FROM readings
    WHERE temperature BETWEEN -20 AND 100 AND humidity BETWEEN 0 AND 100 AND event_time IS NOT NULL""")
def drop_invalid_range(t):
    return C.within(t.readings, {"temperature": C.SENSOR_RANGE, "humidity": C.HUMIDITY_RANGE}, ["event_time"]).select(
        "event_id", "sensor_id", "temperature", "humidity")


_UNIQUE_TRIPS = """SELECT * FROM (
      SELECT *, row_number() OVER (PARTITION BY pickup_ts, pu_zone, do_zone, fare
                                   ORDER BY order_key, vendor_id, distance, tip) AS rn FROM valid) WHERE rn = 1"""


@query("etl_transform", f"""
    WITH {TRIPS},
    valid AS (
      SELECT * REPLACE (coalesce(passengers, 1) AS passengers, coalesce(airport_fee, 0) AS airport_fee,
                        coalesce(congestion_fee, 0) AS congestion_fee)
      FROM trips WHERE fare BETWEEN 0.5 AND 1000 AND distance BETWEEN 0 AND 500 AND pickup_ts < dropoff_ts),
    uniq AS ({_UNIQUE_TRIPS})
    SELECT * EXCLUDE (rn), year(pickup_ts) AS year, month(pickup_ts) AS month, hour(pickup_ts) AS pickup_hour,
           round(CAST((epoch(dropoff_ts) - epoch(pickup_ts)) / 60 AS DECIMAL(38, 10)), 1)::DOUBLE AS duration_min,
           CASE WHEN fare < 10 THEN 'low' WHEN fare < 25 THEN 'medium' ELSE 'high' END AS fare_band
    FROM uniq""")
def etl_transform(t):
    return C.clean_trips(Q.require_columns(t.trips, ["fare", "pickup_ts", "distance"]))


CARD_TRIP = """fare > 0 AND distance > 0 AND passengers > 0 AND passengers <= 6 AND payment_type = 1
               AND pickup_ts IS NOT NULL AND dropoff_ts IS NOT NULL"""


def _card_trip():
    """Complete trips with plausible values, paid by card, so that their tip is known."""
    return X.all_of([F.col("fare") > 0, F.col("distance") > 0, F.col("passengers") > 0, F.col("passengers") <= 6,
                     F.col("payment_type") == 1, F.col("pickup_ts").isNotNull(), F.col("dropoff_ts").isNotNull()])


@query("taxi_clean", f"WITH {TRIPS} SELECT * FROM trips WHERE {CARD_TRIP}")
def taxi_clean(t):
    """The cleaned trips, written as Parquet and read back."""
    path = scratch_path(t.spark, "taxi-clean")
    write_table(t.trips.filter(_card_trip()), path)
    return t.spark.read.parquet(path)


@query("taxi_clean_counts", f"""
    WITH {TRIPS},
    tally AS (SELECT count(*) AS raw_rows, count(*) FILTER ({CARD_TRIP}) AS clean_rows FROM trips)
    SELECT raw_rows, clean_rows, raw_rows - clean_rows AS dropped,
           round(CAST((raw_rows - clean_rows) / raw_rows * 100 AS DECIMAL(38, 10)), 1)::DOUBLE AS dropped_pct FROM tally""")
def taxi_clean_counts(t):
    tally = t.trips.agg(F.count(F.lit(1)).alias("raw_rows"), F.count_if(_card_trip()).alias("clean_rows"))
    dropped = F.col("raw_rows") - F.col("clean_rows")
    return tally.select("raw_rows", "clean_rows", dropped.alias("dropped"),
                        F.round(dropped / F.col("raw_rows") * 100, 1).alias("dropped_pct"))


@query("ml_clean", f"""
    WITH {RIDES}
    SELECT {_ID}, fare, distance, duration_min, tip FROM rides
    WHERE fare > 0 AND fare < 200 AND distance > 0 AND distance < 50 AND duration_min > 0 AND duration_min < 120
      AND tip >= 0 AND tip < 60 AND passengers IS NOT NULL""")
def ml_clean(t):
    def inside(column, low, high):
        return (F.col(column) > low) & (F.col(column) < high)

    return ride_columns(t.trips).filter(X.all_of([
        inside("fare", 0, 200), inside("distance", 0, 50), inside("duration_min", 0, 120),
        (F.col("tip") >= 0) & (F.col("tip") < 60), F.col("passengers").isNotNull()])).select(
        *_KEYS, "fare", "distance", "duration_min", "tip")


@query("cleaning_audit", f"""
    WITH {READINGS},
    judged AS (
      SELECT *, CASE WHEN event_time IS NULL THEN 'bad_time' WHEN temperature IS NULL THEN 'missing'
                     WHEN temperature NOT BETWEEN -20 AND 100 OR humidity NOT BETWEEN 0 AND 100 THEN 'range'
                     ELSE 'ok' END AS fault FROM readings)
    SELECT count(*) AS received, count(*) FILTER (fault = 'bad_time') AS invalid_timestamp,
           count(*) FILTER (fault = 'missing') AS missing_value, count(*) FILTER (fault = 'range') AS out_of_range,
           count(*) FILTER (fault = 'ok')
             - count(DISTINCT (sensor_id, "timestamp")) FILTER (fault = 'ok') AS duplicates,
           count(DISTINCT (sensor_id, "timestamp")) FILTER (fault = 'ok') AS clean
    FROM judged""")
def cleaning_audit(t):
    return C.sensor_audit(t.readings)


@query("outliers_iqr", """
    WITH q AS (SELECT quantile_disc(value, 0.25) AS q1, quantile_disc(value, 0.75) AS q3 FROM events),
    f AS (SELECT q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high FROM q)
    SELECT event_id, value, round(low, 6) AS lower_fence, round(high, 6) AS upper_fence
    FROM events, f WHERE value < low OR value > high""")
def outliers_iqr(t):
    return C.iqr_outliers(t.events, "value").select(
        "event_id", "value", F.round("lower_fence", 6).alias("lower_fence"),
        F.round("upper_fence", 6).alias("upper_fence"))


# The checks in SQL: name, failing predicate.
_FAILED = [
    ("fare_not_null", "fare IS NULL"), ("pickup_not_null", "pickup_ts IS NULL"),
    ("distance_not_null", "distance IS NULL"), ("fare_positive", "NOT fare > 0"),
    ("fare_range", "NOT fare BETWEEN 0.5 AND 1000"), ("distance_non_neg", "NOT distance >= 0"),
    ("payment_valid", "payment_type NOT IN (1, 2, 3, 4, 5, 6)"),
    ("pickup_before_dropoff", "NOT pickup_ts < dropoff_ts"),
    ("reasonable_duration", "NOT epoch(dropoff_ts) - epoch(pickup_ts) BETWEEN 60 AND 7200"),
    ("no_high_fare_short_trip", "fare > 100 AND distance < 0.5"),
]
_REPORT = " UNION ALL ".join(
    f"SELECT '{name}' AS \"check\", count(*) FILTER ({bad}) AS failed_rows, count(*) AS n FROM trips"
    for name, bad in _FAILED)
_STATUS = """CASE WHEN failed_rows = 0 THEN 'PASS' WHEN failed_rows / n * 100 < 1 THEN 'WARN' ELSE 'FAIL' END"""


@query("dq_report", f"""
    WITH {TRIPS}, counted AS ({_REPORT})
    SELECT "check", {_STATUS} AS status, failed_rows, round(CAST(failed_rows / n * 100 AS DECIMAL(38, 10)), 3)::DOUBLE AS pct_failed FROM counted""")
def dq_report(t):
    return Q.quality_report(t.trips, Q.trip_checks()).drop("description")


@query("dq_summary", f"""
    WITH {TRIPS}, counted AS ({_REPORT}) SELECT {_STATUS} AS status, count(*) AS checks FROM counted GROUP BY 1""")
def dq_summary(t):
    return Q.quality_report(t.trips, Q.trip_checks()).groupBy("status").agg(F.count(F.lit(1)).alias("checks"))


@query("require_columns", "SELECT count(*) AS rows FROM events")
def require_columns(t):
    return Q.require_columns(t.events, ["event_id", "ts", "value"]).agg(F.count(F.lit(1)).alias("rows"))


@query("enforce_types", """
    WITH expected(name, expected) AS (VALUES ('event_id', 'bigint'), ('ts', 'timestamp_ntz'), ('value', 'string'),
                                             ('nonexistent', 'string')),
    actual AS (
      SELECT column_name AS name, CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
             WHEN 'DOUBLE' THEN 'double' ELSE 'string' END AS actual
      FROM (DESCRIBE events))
    SELECT name, expected, actual, CASE WHEN actual IS NULL THEN 'MISSING' WHEN actual = expected THEN 'OK'
           ELSE 'TYPE MISMATCH' END AS status, (SELECT count(*) FROM events) AS rows
    FROM expected LEFT JOIN actual USING (name)""")
def enforce_types(t):
    report = Q.type_report(t.events, {"event_id": "bigint", "ts": "timestamp_ntz", "value": "string",
                                      "nonexistent": "string"})
    rows = t.events.agg(F.count(F.lit(1)).alias("rows")).scalar()
    return report.withColumn("rows", rows)


@query("schema_diff", """
    SELECT 'c_acctbal' AS name, NULL AS left_type, 'double' AS right_type, 'only_right' AS change, count(*) AS rows
      FROM customer
    UNION ALL SELECT 'c_mktsegment', 'string', NULL, 'only_left', count(*) FROM customer
    UNION ALL SELECT 'c_nationkey', 'int', 'bigint', 'type_changed', count(*) FROM customer""")
def schema_diff(t):
    left = t.customer.drop("c_acctbal")
    right = t.customer.drop("c_mktsegment").withColumn("c_nationkey", F.col("c_nationkey").cast("bigint"))
    rows = t.customer.agg(F.count(F.lit(1)).alias("rows")).scalar()
    return Q.schema_diff(left, right).withColumn("rows", rows)


@query("duplicate_report", f"""
    WITH {SENSORS}, s AS (SELECT sensor_id, "timestamp", temperature, status FROM sensors)
    SELECT count(*) AS total_rows, (SELECT count(*) FROM (SELECT DISTINCT * FROM s)) AS distinct_rows,
           count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM s)) AS exact_duplicates,
           count(DISTINCT (sensor_id, "timestamp")) AS after_key_dedupe
    FROM s""")
def duplicate_report(t):
    return Q.duplicate_report(t.sensors.select("sensor_id", "timestamp", "temperature", "status"),
                              ["sensor_id", "timestamp"])


_RULES = [("OVERCHARGE", 3, "fare_per_mile > 10 AND is_airport = 0"), ("LONG_TRIP", 2, "duration_min > 90"),
          ("GHOST_RIDE", 3, "distance < 0.1 AND fare > 15"), ("LATE_SURGE", 1, "hour_of_day < 5 AND fare > 80"),
          ("OVERLOAD", 2, "passengers > 6")]
SCORE = " + ".join(f"CASE WHEN {p} THEN {w} ELSE 0 END" for _, w, p in _RULES)
TRIGGERED = "concat_ws(',', " + ", ".join(f"CASE WHEN {p} THEN '{n}' END" for n, _, p in _RULES) + ")"


@query("anomaly_score", f"""
    WITH {RIDES}, scored AS (SELECT {_ID}, CAST({SCORE} AS BIGINT) AS score FROM rides)
    SELECT * FROM scored WHERE score >= 3""")
def anomaly_score(t):
    scored = ride_columns(t.trips).select(*_KEYS, rule_score(ride_anomaly_rules()).alias("score"))
    return scored.filter(F.col("score") >= RIDE_ANOMALY_THRESHOLD)


@query("anomaly_rules", f"WITH {RIDES} SELECT {_ID}, {TRIGGERED} AS rules FROM rides")
def anomaly_rules(t):
    return ride_columns(t.trips).select(*_KEYS, triggered_rule_names(ride_anomaly_rules()).alias("rules"))


@query("quality_gate", f"""
    WITH {SENSORS}, m AS (
      SELECT count(*) AS total_rows, count(*) FILTER (temperature IS NULL OR temperature < -20 OR temperature > 100)
               AS invalid_rows FROM sensors)
    SELECT total_rows, invalid_rows, round(CAST(invalid_rows / total_rows AS DECIMAL(38, 10)), 6)::DOUBLE AS invalid_fraction,
           CASE WHEN invalid_rows / total_rows <= 0.2 THEN 'valid' ELSE 'invalid' END AS status FROM m""")
def quality_gate(t):
    bad = F.col("temperature").isNull() | ~F.col("temperature").between(*C.SENSOR_RANGE)
    return Q.fraction_gate(t.sensors, bad, 0.20)


@query("row_count_gate", """
    SELECT count(*) AS total_rows, CASE WHEN count(*) >= 1000000 THEN 'process_data' ELSE 'flag_bad_data' END AS branch
    FROM lineitem""")
def row_count_gate(t):
    return Q.row_count_gate(t.lineitem, 1_000_000)


@query("metric_gate", """
    WITH p AS (SELECT quality AS label, CASE WHEN n_chars > 500 THEN 1 ELSE 0 END AS prediction
               FROM labels JOIN documents USING (doc_id)),
    c AS (SELECT count(*) AS n, count(*) FILTER (label = 1 AND prediction = 1) AS tp,
                 count(*) FILTER (label <> 1 AND prediction = 1) AS fp, count(*) FILTER (label = prediction) AS hits
          FROM p),
    m AS (SELECT 'accuracy' AS metric, round(CAST(hits / n AS DECIMAL(38, 10)), 6)::DOUBLE AS value FROM c
          UNION ALL SELECT 'precision', round(CAST(tp / nullif(tp + fp, 0) AS DECIMAL(38, 10)), 6)::DOUBLE FROM c),
    thresholds(metric, minimum) AS (VALUES ('accuracy', 0.85::DOUBLE), ('precision', 0.80::DOUBLE),
                                           ('latency', 0.5::DOUBLE))
    SELECT metric, minimum, value, CASE WHEN value >= minimum THEN 'PASS' ELSE 'FAIL' END AS status
    FROM thresholds LEFT JOIN m USING (metric)""")
def metric_gate(t):
    predicted = t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id").select(
        F.col("quality").alias("label"), F.when(F.col("n_chars") > 500, 1).otherwise(0).alias("prediction"))
    measured = binary_metrics(predicted).select(F.inline(F.array(
        F.struct(F.lit("accuracy").alias("metric"), F.col("accuracy").alias("value")),
        F.struct(F.lit("precision").alias("metric"), F.col("precision").alias("value")))))
    thresholds = t.spark.createDataFrame([("accuracy", 0.85), ("precision", 0.80), ("latency", 0.5)],
                                         "metric string, minimum double")
    return Q.metric_gate(measured, thresholds)


@query("validate_numeric_fields", """
    WITH payload AS (
      SELECT p_partkey, CASE WHEN p_size % 13 <> 0 THEN CAST(p_size AS VARCHAR) END AS size,
             CASE WHEN p_partkey % 9 = 0 THEN p_type ELSE CAST(p_retailprice AS VARCHAR) END AS price FROM part)
    SELECT p_partkey, CASE WHEN size IS NULL THEN 'missing field size' WHEN price IS NULL THEN 'missing field price'
           WHEN TRY_CAST(size AS DOUBLE) IS NULL THEN 'field size is not numeric'
           WHEN TRY_CAST(price AS DOUBLE) IS NULL THEN 'field price is not numeric' END AS error
    FROM payload""")
def validate_numeric_fields(t):
    payload = t.part.select(
        "p_partkey", F.when(F.col("p_size") % 13 != 0, F.col("p_size").cast("string")).alias("size"),
        F.when(F.col("p_partkey") % 9 == 0, F.col("p_type")).otherwise(F.col("p_retailprice").cast("string"))
        .alias("price"))
    return payload.select("p_partkey", Q.first_field_error(["size", "price"]).alias("error"))


@query("sensor_stats", f"""
    WITH {READINGS}
    SELECT sensor_id, round(CAST(avg(temperature) AS DECIMAL(38, 10)), 4)::DOUBLE AS mean_temp, round(CAST(stddev_samp(temperature) AS DECIMAL(38, 10)), 4)::DOUBLE AS std_temp
    FROM readings WHERE temperature BETWEEN -20 AND 100 GROUP BY sensor_id""")
def sensor_stats(t):
    return C.within(t.readings, {"temperature": C.SENSOR_RANGE}).groupBy("sensor_id").agg(
        X.steady(F.avg("temperature"), 4).alias("mean_temp"), X.steady(F.stddev_samp("temperature"), 4).alias("std_temp"))
