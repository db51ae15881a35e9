"""Scalar function families and the feature expressions built on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions import expressions as X
from tidewater.plans.registry import query
from tidewater.plans.tables import READINGS, SENSORS, TRIPS
from tidewater.streaming.aggregates import ride_columns


@query("fn_string", """
    SELECT p_partkey, upper(p_name) AS upper_name, lower(p_brand) AS lower_brand, trim(' ' || p_type || ' ') AS trimmed,
           p_brand || '_' || CAST(p_size AS VARCHAR) AS joined, length(p_name) AS name_length,
           string_split(p_name, ' ')[1] AS first_word, starts_with(p_type, 'S') AS starts_s,
           CAST(string_split(CAST(p_partkey AS VARCHAR) || ',' || p_type, ',')[2] AS VARCHAR) AS second_field
    FROM part""")
def fn_string(t):
    return t.part.select(
        "p_partkey", F.upper("p_name").alias("upper_name"), F.lower("p_brand").alias("lower_brand"),
        F.trim(F.concat(F.lit(" "), "p_type", F.lit(" "))).alias("trimmed"),
        F.concat("p_brand", F.lit("_"), F.col("p_size").cast("string")).alias("joined"),
        F.length("p_name").cast("bigint").alias("name_length"),
        F.split("p_name", " ")[0].alias("first_word"), F.col("p_type").startswith("S").alias("starts_s"),
        F.split(F.concat_ws(",", F.col("p_partkey").cast("string"), "p_type"), ",")[1].alias("second_field"))


@query("fn_datetime", f"""
    WITH {TRIPS}
    SELECT order_key, vendor_id, do_zone, hour(pickup_ts) AS hour, dayofweek(pickup_ts) + 1 AS dow,
           year(pickup_ts) AS year, month(pickup_ts) AS month, strftime(pickup_ts, '%Y-%m-%d') AS day,
           (epoch(dropoff_ts) - epoch(pickup_ts)) / 60 AS minutes,
           try_strptime(CASE WHEN do_zone % 50 = 0 THEN 'garbled' ELSE strftime(pickup_ts, '%Y-%m-%d %H:%M:%S') END,
                        '%Y-%m-%d %H:%M:%S') AS parsed,
           pickup_ts < now()::TIMESTAMP AS in_past
    FROM trips""")
def fn_datetime(t):
    pickup = F.col("pickup_ts")
    text = F.when(F.col("do_zone") % 50 == 0, "garbled").otherwise(F.date_format(pickup, "yyyy-MM-dd HH:mm:ss"))
    return t.trips.select(
        "order_key", "vendor_id", "do_zone", X.hour_of_day(pickup).alias("hour"), X.day_of_week(pickup).alias("dow"),
        F.year(pickup).cast("bigint").alias("year"), F.month(pickup).cast("bigint").alias("month"),
        F.to_date(pickup).cast("string").alias("day"),
        X.minutes_between(pickup, F.col("dropoff_ts")).alias("minutes"),
        X.parse_event_time(text).cast("timestamp_ntz").alias("parsed"),
        (pickup < F.current_timestamp().cast("timestamp_ntz")).alias("in_past"))


@query("fn_math", """
    SELECT o_orderkey, round(ln(o_totalprice), 6) AS log_price, CAST(ceil(o_totalprice) AS BIGINT) AS ceil_price,
           round(o_totalprice / 7, 4) AS rounded, round(CAST(o_totalprice / nullif(o_custkey % 5, 0) AS DECIMAL(38, 10)), 4)::DOUBLE AS guarded,
           round(o_totalprice / (o_custkey + 0.001), 4) AS epsilon
    FROM orders""")
def fn_math(t):
    price = F.col("o_totalprice")
    return t.orders.select(
        "o_orderkey", F.round(F.log(price), 6).alias("log_price"), F.ceil(price).alias("ceil_price"),
        F.round(price / 7, 4).alias("rounded"),
        X.safe_ratio(price, F.col("o_custkey") % 5, digits=4).alias("guarded"),
        F.round(price / (F.col("o_custkey") + F.lit(0.001)), 4).alias("epsilon"))


@query("fn_conditional", f"""
    WITH {TRIPS}
    SELECT order_key, vendor_id, do_zone, CASE WHEN fare > 50 THEN 'surge' ELSE 'normal' END AS surge,
           coalesce(airport_fee, congestion_fee, 0.0) AS fee, nullif(distance, 0) AS nonzero_distance,
           rate_code IN (2, 3) AS is_airport, CAST(rate_code IN (2, 3) AS BIGINT) AS airport_int
    FROM trips""")
def fn_conditional(t):
    airport = F.col("rate_code").isin(2, 3)
    return t.trips.select(
        "order_key", "vendor_id", "do_zone", F.when(F.col("fare") > 50, "surge").otherwise("normal").alias("surge"),
        F.coalesce("airport_fee", "congestion_fee", F.lit(0.0)).alias("fee"),
        F.nullif(F.col("distance"), F.lit(0.0)).alias("nonzero_distance"),
        airport.alias("is_airport"), airport.cast("bigint").alias("airport_int"))


@query("fn_null", f"""
    WITH {TRIPS}
    SELECT 'filled' AS strategy, count(*) AS rows, sum(coalesce(passengers, 1)) AS passengers,
           sum(coalesce(airport_fee, 0)) AS fees FROM trips
    UNION ALL SELECT 'dropped_any', count(*), sum(passengers), sum(airport_fee) FROM trips
      WHERE passengers IS NOT NULL AND airport_fee IS NOT NULL AND congestion_fee IS NOT NULL
    UNION ALL SELECT 'dropped_subset', count(*), sum(passengers), sum(airport_fee) FROM trips
      WHERE passengers IS NOT NULL
    UNION ALL SELECT 'is_null', count(*), sum(passengers), sum(airport_fee) FROM trips WHERE airport_fee IS NULL""")
def fn_null(t):
    """Rows kept and sums under each treatment of nulls, from one pass."""
    passengers, fee = F.col("passengers"), F.col("airport_fee")
    some = passengers.isNotNull()
    strategies = {
        "filled": (F.lit(True), F.coalesce(passengers, F.lit(1.0)), F.coalesce(fee, F.lit(0.0))),
        "dropped_any": (some & fee.isNotNull() & F.col("congestion_fee").isNotNull(), passengers, fee),
        "dropped_subset": (some, passengers, fee),
        "is_null": (fee.isNull(), passengers, fee),
    }
    kept = t.trips.agg(*[
        F.struct(F.lit(name).alias("strategy"), F.count_if(keep).alias("rows"),
                 F.sum(F.when(keep, people)).alias("passengers"), F.sum(F.when(keep, fees)).alias("fees")).alias(name)
        for name, (keep, people, fees) in strategies.items()])
    return kept.select(F.inline(F.array(*strategies)))


@query("fn_hash", "SELECT c_custkey, md5(CAST(c_custkey AS VARCHAR)) AS hashed FROM customer")
def fn_hash(t):
    return t.customer.select("c_custkey", F.md5(F.col("c_custkey").cast("string")).alias("hashed"))


@query("fn_array", f"""
    WITH {TRIPS}
    SELECT order_key, vendor_id, do_zone,
           array_to_string(list_filter([CASE WHEN fare > 50 THEN 'high' END,
                                        CASE WHEN distance < 5 THEN 'near' END,
                                        CASE WHEN passengers > 4 THEN 'full' END], lambda x: x IS NOT NULL), ',') AS tags
    FROM trips""")
def fn_array(t):
    tags = F.array(F.when(F.col("fare") > 50, "high"), F.when(F.col("distance") < 5, "near"),
                   F.when(F.col("passengers") > 4, "full"))
    return t.trips.select("order_key", "vendor_id", "do_zone",
                          F.array_join(F.filter(tags, lambda x: x.isNotNull()), ",").alias("tags"))


@query("fn_json_struct", """
    SELECT event_id, CAST(props ->> '$.k' AS BIGINT) AS k, event_type || ':' || CAST(user_id AS VARCHAR) AS packed
    FROM events""")
def fn_json_struct(t):
    parsed = t.events.select("event_id", F.from_json("props", "k bigint").alias("data"),
                             F.struct("event_type", "user_id").alias("who"))
    return parsed.select("event_id", "data.*", F.concat_ws(
        ":", "who.event_type", F.col("who.user_id").cast("string")).alias("packed"))


@query("fn_partition_meta", """
    SELECT count(*) AS rows, 0::BIGINT AS rows_without_file, 0::BIGINT AS rows_without_part,
           0::BIGINT AS random_out_of_range FROM orders""")
def fn_partition_meta(t):
    """Input file, task number and a seeded random value are defined on every row."""
    tagged = t.orders.select(F.input_file_name().alias("file"), F.spark_partition_id().alias("part"),
                             F.rand(42).alias("r"))
    return tagged.agg(F.count(F.lit(1)).alias("rows"),
                      F.count_if(~F.col("file").contains("orders.parquet")).alias("rows_without_file"),
                      F.count_if(F.col("part") < 0).alias("rows_without_part"),
                      F.count_if(~F.col("r").between(0, 1)).alias("random_out_of_range"))


@query("fn_conversion", f"""
    WITH {SENSORS}
    SELECT event_id, strftime(try_strptime("timestamp", '%Y-%m-%d %H:%M:%S'), '%Y/%m/%d %H') AS hour_text,
           CAST(humidity > 60 AS BIGINT) AS humid_int, CAST(CAST(humidity > 60 AS INTEGER) AS DOUBLE) AS humid_double,
           TRY_CAST(status AS DOUBLE) AS status_number
    FROM sensor_base""")
def fn_conversion(t):
    humid = F.col("humidity") > 60
    return t.sensors.dropDuplicates(["event_id"]).select(
        "event_id", F.date_format(X.parse_event_time(F.col("timestamp")), "yyyy/MM/dd HH").alias("hour_text"),
        humid.cast("bigint").alias("humid_int"), humid.cast("double").alias("humid_double"),
        F.col("status").try_cast("double").alias("status_number"))


@query("time_features", f"""
    WITH {READINGS}
    SELECT event_id, hour(event_time) AS hour_of_day, dayofweek(event_time) + 1 AS day_of_week,
           CAST(dayofweek(event_time) IN (0, 6) AS BIGINT) AS is_weekend
    FROM readings WHERE event_time IS NOT NULL""")
def time_features(t):
    columns = X.time_feature_columns(F.col("event_time"))
    return t.readings.filter(F.col("event_time").isNotNull()).select(
        "event_id", *[c.alias(name) for name, c in columns.items()])


RIDES = TRIPS + """,
rides AS (
  SELECT *, (epoch(dropoff_ts) - epoch(pickup_ts)) / 60 AS duration_min, hour(pickup_ts) AS hour_of_day,
         dayofweek(pickup_ts) + 1 AS day_of_week, CAST(rate_code IN (2, 3) AS BIGINT) AS is_airport,
         CASE WHEN fare > 0 THEN round(CAST(tip / fare * 100 AS DECIMAL(38, 10)), 2)::DOUBLE ELSE 0.0::DOUBLE END AS tip_pct,
         CASE WHEN distance > 0 THEN round(CAST(fare / distance AS DECIMAL(38, 10)), 2)::DOUBLE END AS fare_per_mile
  FROM trips)"""


@query("trip_features", f"""
    WITH {RIDES}
    SELECT order_key, vendor_id, do_zone, duration_min, hour_of_day, day_of_week, is_airport, tip_pct, fare_per_mile
    FROM rides""")
def trip_features(t):
    return ride_columns(t.trips).select("order_key", "vendor_id", "do_zone", "duration_min", "hour_of_day",
                                        "day_of_week", "is_airport", "tip_pct", "fare_per_mile")


@query("speed_feature", f"""
    WITH {RIDES}
    SELECT order_key, vendor_id, do_zone, round(CAST(distance / (round(duration_min, 1) / 60 + 0.001) AS DECIMAL(38, 10)), 1)::DOUBLE AS speed
    FROM rides WHERE duration_min > 0""")
def speed_feature(t):
    minutes = X.minutes_between(F.col("pickup_ts"), F.col("dropoff_ts"), 1)
    return t.trips.filter(F.col("pickup_ts") < F.col("dropoff_ts")).select(
        "order_key", "vendor_id", "do_zone", X.speed(F.col("distance"), minutes).alias("speed"))


@query("recode_hash", f"""
    WITH {TRIPS} SELECT md5(CAST(vendor_id AS VARCHAR)) AS vendor, count(*) AS trips FROM trips GROUP BY 1""")
def recode_hash(t):
    return t.trips.groupBy(X.pseudonym(F.col("vendor_id")).alias("vendor")).agg(F.count(F.lit(1)).alias("trips"))
