"""Aggregations and window functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions import expressions as X
from tidewater.operators import aggregates as A
from tidewater.operators import pythonic as P
from tidewater.operators import windows as W
from tidewater.operators.cleaning import clean_sensors, sensor_report
from tidewater.operators.quantiles import exact_quantiles
from tidewater.operators.sampling import split_column
from tidewater.plans.registry import query
from tidewater.plans.tables import EMPLOYEES, READINGS, TRIPS
from tidewater.streaming.aggregates import ride_columns


def _n():
    return F.count(F.lit(1))


@query("agg_global", """
    SELECT count(*) AS n, round(sum(o_totalprice), 2) AS total, round(CAST(avg(o_totalprice) AS DECIMAL(38, 10)), 4)::DOUBLE AS mean,
           round(CAST(stddev_samp(o_totalprice) AS DECIMAL(38, 10)), 4)::DOUBLE AS std, min(o_totalprice) AS low, max(o_totalprice) AS high
    FROM orders WHERE o_totalprice > 0""")
def agg_global(t):
    price = F.col("o_totalprice")
    return t.orders.filter(price > 0).agg(
        _n().alias("n"), F.round(F.sum(price), 2).alias("total"), X.steady(F.avg(price), 4).alias("mean"),
        X.steady(F.stddev(price), 4).alias("std"), F.min(price).alias("low"), F.max(price).alias("high"))


@query("agg_percentiles", """
    SELECT quantile_disc(value, 0.5) AS median, quantile_disc(value, 0.25) AS q1, quantile_disc(value, 0.75) AS q3
    FROM events""")
def agg_percentiles(t):
    found = exact_quantiles(t.events, {"value": [0.5, 0.25, 0.75]})["value"]
    return t.spark.createDataFrame([tuple(found)], "median double, q1 double, q3 double")


@query("agg_count_distinct", """
    SELECT count(DISTINCT user_id) AS users, count(DISTINCT event_type) AS kinds FROM events""")
def agg_count_distinct(t):
    return t.events.agg(F.countDistinct("user_id").alias("users"), F.countDistinct("event_type").alias("kinds"))


@query("group_count", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def group_count(t):
    return t.events.groupBy("event_type").agg(_n().alias("n"))


@query("group_multi_agg", f"""
    WITH {TRIPS}
    SELECT hour(pickup_ts) AS hour, count(*) AS trips, round(CAST(avg(fare) AS DECIMAL(38, 10)), 2)::DOUBLE AS avg_fare,
           round(CAST(avg(distance) AS DECIMAL(38, 10)), 2)::DOUBLE AS avg_distance, round(sum(tip) / sum(fare) * 100, 1) AS tip_rate_pct
    FROM trips WHERE fare > 0 GROUP BY 1 ORDER BY 1""")
def group_multi_agg(t):
    tip_rate = F.round(F.sum("tip") / F.sum("fare") * 100, 1).alias("tip_rate_pct")
    paid = t.trips.filter(F.col("fare") > 0).withColumn("hour", X.hour_of_day(F.col("pickup_ts")))
    hourly = paid.groupBy("hour").agg(
        _n().alias("trips"), *X.means({"avg_fare": "fare", "avg_distance": "distance"}), tip_rate)
    return hourly.orderBy("hour")


@query("group_two_keys", f"""
    WITH {EMPLOYEES} SELECT department, city, count(*) AS n FROM employees GROUP BY department, city""")
def group_two_keys(t):
    return t.employees.groupBy("department", "city").agg(_n().alias("n"))


@query("group_min_max_sum", f"""
    WITH {EMPLOYEES}
    SELECT department, max(salary) AS max_salary, min(age) AS min_age, round(sum(salary), 2) AS total
    FROM employees GROUP BY department""")
def group_min_max_sum(t):
    return t.employees.groupBy("department").agg(
        F.max("salary").alias("max_salary"), F.min("age").alias("min_age"),
        F.round(F.sum("salary"), 2).alias("total"))


@query("group_ratio", f"""
    WITH {TRIPS}
    SELECT payment_type, round(sum(tip) / nullif(sum(fare), 0) * 100, 2) AS tip_pct,
           round(sum(tip) / nullif(sum(CASE WHEN payment_type = 7 THEN 0.0::DOUBLE ELSE distance END), 0) * 100, 2)
             AS tip_per_distance
    FROM trips GROUP BY payment_type""")
def group_ratio(t):
    measured = F.when(F.col("payment_type") == 7, 0.0).otherwise(F.col("distance"))
    return t.trips.groupBy("payment_type").agg(
        X.ratio_of_sums(F.col("tip"), F.col("fare")).alias("tip_pct"),
        X.ratio_of_sums(F.col("tip"), measured).alias("tip_per_distance"))


@query("yoy_summary", f"""
    WITH {TRIPS}
    SELECT year(pickup_ts) AS year, count(*) AS total_trips, round(CAST(avg(fare) AS DECIMAL(38, 10)), 2)::DOUBLE AS avg_fare,
           round(CAST(avg(distance) AS DECIMAL(38, 10)), 2)::DOUBLE AS avg_distance, round(CAST(avg(tip) AS DECIMAL(38, 10)), 2)::DOUBLE AS avg_tip,
           round(CAST(avg(round(CAST(tip / fare * 100 AS DECIMAL(38, 10)), 2)::DOUBLE) AS DECIMAL(38, 10)), 2)::DOUBLE AS avg_tip_pct,
           round(CAST(avg((epoch(dropoff_ts) - epoch(pickup_ts)) / 60) AS DECIMAL(38, 10)), 2)::DOUBLE AS avg_duration_min,
           round(sum(fare), 0) AS total_revenue
    FROM trips WHERE fare > 0 GROUP BY 1""")
def yoy_summary(t):
    paid = ride_columns(t.trips).filter(F.col("fare") > 0)
    return paid.groupBy(F.year("pickup_ts").cast("bigint").alias("year")).agg(
        _n().alias("total_trips"),
        X.steady(F.avg("fare"), 2).alias("avg_fare"),
        X.steady(F.avg("distance"), 2).alias("avg_distance"),
        X.steady(F.avg("tip"), 2).alias("avg_tip"),
        X.steady(F.avg("tip_pct"), 2).alias("avg_tip_pct"),
        X.steady(F.avg("duration_min"), 2).alias("avg_duration_min"),
        F.round(F.sum("fare"), 0).alias("total_revenue"))


@query("collect_set_struct", f"""
    WITH {TRIPS}, per_hour AS (
      SELECT hour(pickup_ts) AS hour, min(fare) AS low, max(fare) AS high,
             array_to_string(list_sort(list(DISTINCT payment_type)), ',') AS payment_types
      FROM trips GROUP BY 1)
    SELECT hour, 0::BIGINT AS part, payment_types, low, high FROM per_hour""")
def collect_set_struct(t):
    trips = t.trips.withColumn("hour", X.hour_of_day(F.col("pickup_ts")))
    spread = F.struct(F.min("fare").alias("low"), F.max("fare").alias("high")).alias("spread")
    return A.value_sets(trips, ["hour"], "payment_type", [spread]).select(
        "hour", "part", F.array_join(F.transform("values", lambda v: v.cast("string")), ",").alias("payment_types"),
        "spread.low", "spread.high")


@query("group_by_key", """
    WITH numbered AS (
      SELECT l_partkey, l_quantity,
             row_number() OVER (PARTITION BY l_partkey ORDER BY l_quantity, l_orderkey, l_linenumber, l_suppkey)
               AS pos
      FROM lineitem)
    SELECT l_partkey, (pos - 1) // 16 AS part,
           array_to_string(list(CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) ORDER BY pos), ',') AS quantities
    FROM numbered GROUP BY 1, 2""")
def group_by_key(t):
    lists = A.grouped_lists(t.lineitem, ["l_partkey"], "l_quantity",
                            ["l_orderkey", "l_linenumber", "l_suppkey"], max_values=16)
    text = F.array_join(F.transform("values", lambda v: v.cast("bigint").cast("string")), ",")
    return lists.select("l_partkey", "part", text.alias("quantities"))


@query("combine_per_key", "SELECT l_partkey, sum(l_quantity) AS quantity FROM lineitem GROUP BY l_partkey")
def combine_per_key(t):
    return t.lineitem.groupBy("l_partkey").agg(F.sum("l_quantity").alias("quantity"))


@query("count_per_element", "SELECT p_name AS element, count(*) AS n FROM part GROUP BY p_name")
def count_per_element(t):
    return t.part.groupBy(F.col("p_name").alias("element")).agg(_n().alias("n"))


@query("combine_globally_avg", "SELECT round(CAST(avg(value) AS DECIMAL(38, 10)), 6)::DOUBLE AS mean FROM events")
def combine_globally_avg(t):
    return t.events.agg(X.steady(F.avg("value"), 6).alias("mean"))


@query("word_count", """
    SELECT word, count(*) AS n
    FROM (SELECT unnest(regexp_split_to_array(lower(trim(text, ' ')), '\\s+')) AS word FROM conversations)
    WHERE word <> '' GROUP BY word""")
def word_count(t):
    return A.word_counts(t.conversations, "text")


@query("agg_first_in_group", """
    SELECT user_id, arg_max(event_type, (ts, event_id)) AS current_status, max(ts) AS last_seen
    FROM events GROUP BY user_id""")
def agg_first_in_group(t):
    return t.events.groupBy("user_id").agg(
        F.max_by("event_type", F.struct("ts", "event_id")).alias("current_status"),
        F.max("ts").alias("last_seen"))


@query("active_count", "SELECT count(DISTINCT CASE WHEN event_type = 'click' THEN user_id END) AS active FROM events")
def active_count(t):
    return t.events.agg(F.countDistinct(F.when(F.col("event_type") == "click", F.col("user_id"))).alias("active"))


@query("status_distribution", """
    SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY o_orderstatus""")
def status_distribution(t):
    return t.orders.groupBy(F.col("o_orderstatus").alias("status")).agg(_n().alias("n"))


@query("crosstab", """
    SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS F, count(*) FILTER (o_orderstatus = 'O') AS O,
           count(*) FILTER (o_orderstatus = 'P') AS P
    FROM orders GROUP BY o_orderpriority""")
def crosstab(t):
    return A.contingency_table(t.orders, "o_orderpriority", "o_orderstatus")


def _described(column: str) -> str:
    return f"""SELECT '{column}' AS "column", count({column}) AS n, round(CAST(avg({column}) AS DECIMAL(38, 10)), 4)::DOUBLE AS mean,
       round(CAST(stddev_samp({column}) AS DECIMAL(38, 10)), 4)::DOUBLE AS stddev, CAST(min({column}) AS DOUBLE) AS min,
       CAST(max({column}) AS DOUBLE) AS max FROM lineitem"""


@query("describe_table", " UNION ALL ".join(
    _described(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber")))
def describe_table(t):
    return A.describe_columns(
        t.lineitem, ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"])


def _nulls(column: str) -> str:
    return f"""SELECT '{column}' AS "column", count(*) FILTER ({column} IS NULL) AS null_count,
       round(CAST(count(*) FILTER ({column} IS NULL) / count(*) * 100 AS DECIMAL(38, 10)), 2)::DOUBLE AS null_pct FROM trips"""


@query("null_profile", f"WITH {TRIPS} " + " UNION ALL ".join(
    _nulls(c) for c in ("fare", "passengers", "airport_fee", "congestion_fee", "flag")))
def null_profile(t):
    return A.null_profile(t.trips.select("fare", "passengers", "airport_fee", "congestion_fee", "flag"))


@query("row_col_counts", """
    SELECT count(*) AS rows, (SELECT count(*) FROM (DESCRIBE lineitem)) AS columns FROM lineitem""")
def row_col_counts(t):
    return t.lineitem.agg(_n().alias("rows"), F.lit(len(t.lineitem.columns)).cast("bigint").alias("columns"))


@query("conditional_having", """
    SELECT user_id, event_type, count(*) AS n FROM events GROUP BY user_id, event_type HAVING count(*) > 10""")
def conditional_having(t):
    return t.events.groupBy("user_id", "event_type").agg(_n().alias("n")).filter(F.col("n") > 10)


@query("class_distribution", """
    WITH marked AS (
      SELECT CASE WHEN CAST(('0x' || substr(md5(doc_id || '#42'), 1, 7)) AS BIGINT) % 10000 < 8000
                  THEN 'train' ELSE 'test' END AS split, CAST(quality AS VARCHAR) AS class FROM labels)
    SELECT CASE WHEN grouping(split) = 1 THEN 'all' ELSE split END AS split,
           CASE WHEN grouping(class) = 1 THEN 'all' ELSE class END AS class, count(*) AS n
    FROM marked GROUP BY ROLLUP (split, class)""")
def class_distribution(t):
    marked = t.labels.select(split_column("doc_id", {"train": 0.8, "test": 0.2}).alias("split"),
                             F.col("quality").alias("class"))
    return A.class_distribution(marked, "split", "class")


CLEAN_SENSORS = READINGS + """,
filled AS (
  SELECT * REPLACE (coalesce(temperature, (SELECT avg(temperature) FROM readings)) AS temperature) FROM readings),
uniq AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sensor_id, "timestamp" ORDER BY event_id) AS rn
                 FROM filled) WHERE rn = 1),
clean AS (
  SELECT event_id, sensor_id, event_time, temperature, humidity, status, hour(event_time) AS hour_of_day,
         dayofweek(event_time) + 1 AS day_of_week,
         CAST(dayofweek(event_time) IN (0, 6) AS BIGINT) AS is_weekend
  FROM uniq WHERE temperature BETWEEN -20 AND 100 AND event_time IS NOT NULL)"""


@query("analytics_summary", f"""
    WITH {CLEAN_SENSORS}
    SELECT 'avg_temperature' AS metric, sensor_id AS key, round(CAST(avg(temperature) AS DECIMAL(38, 10)), 4)::DOUBLE AS value
    FROM clean GROUP BY sensor_id
    UNION ALL SELECT 'max_temperature', sensor_id, max(temperature) FROM clean GROUP BY sensor_id
    UNION ALL SELECT 'active_sensors', 'all', CAST(count(DISTINCT sensor_id) AS DOUBLE) FROM clean
              WHERE status = 'click'
    UNION ALL SELECT 'status_count', status, CAST(count(*) AS DOUBLE) FROM clean GROUP BY status""")
def analytics_summary(t):
    return sensor_report(clean_sensors(t.readings), active="click")


# Window functions


@query("win_rank", """
    SELECT o_orderkey, o_orderpriority, rank() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC) AS rnk
    FROM orders""")
def win_rank(t):
    return W.with_windows(t.orders, ["o_orderpriority"], [("o_totalprice", "desc")], {"rnk": W.rank()}).select(
        "o_orderkey", "o_orderpriority", "rnk")


@query("win_dense_rank", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
           dense_rank() OVER (PARTITION BY l_suppkey ORDER BY l_quantity DESC) AS rnk
    FROM lineitem""")
def win_dense_rank(t):
    return W.with_windows(t.lineitem, ["l_suppkey"], [("l_quantity", "desc")], {"rnk": W.dense_rank()}).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "rnk")


@query("win_lag", """
    SELECT event_id, user_id, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous_value
    FROM events""")
def win_lag(t):
    return W.with_windows(t.events, ["user_id"], ["ts", "event_id"], {"previous_value": W.previous("value")}
                          ).select("event_id", "user_id", "previous_value")


@query("win_lead", """
    SELECT event_id, user_id, lead(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_value
    FROM events""")
def win_lead(t):
    return W.with_windows(t.events, ["user_id"], ["ts", "event_id"], {"next_value": W.following("value")}
                          ).select("event_id", "user_id", "next_value")


@query("win_percent_rank", """
    SELECT event_id, event_type,
           round(percent_rank() OVER (PARTITION BY event_type ORDER BY value DESC), 3) AS pct
    FROM events""")
def win_percent_rank(t):
    ranked = W.with_windows(t.events, ["event_type"], [("value", "desc")], {"p": W.percent_rank()})
    return ranked.select("event_id", "event_type", F.round("p", 3).alias("pct"))


@query("win_running_sum", """
    SELECT event_id, user_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                    ROWS UNBOUNDED PRECEDING), 2) AS running
    FROM events""")
def win_running_sum(t):
    summed = W.with_windows(t.events, ["user_id"], ["ts", "event_id"], {"s": W.running_sum("value")})
    return summed.select("event_id", "user_id", F.round("s", 2).alias("running"))


@query("win_ntile", """
    SELECT event_type, quartile, count(*) AS n, round(CAST(avg(value) AS DECIMAL(38, 10)), 4)::DOUBLE AS mean
    FROM (SELECT *, ntile(4) OVER (PARTITION BY event_type ORDER BY value, event_id) AS quartile FROM events)
    GROUP BY event_type, quartile""")
def win_ntile(t):
    tiled = W.with_windows(t.events, ["event_type"], ["value", "event_id"], {"quartile": W.ntile(4)})
    return tiled.groupBy("event_type", "quartile").agg(_n().alias("n"), X.steady(F.avg("value"), 4).alias("mean"))


@query("win_row_number", """
    SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) AS rn
    FROM orders""")
def win_row_number(t):
    return W.with_windows(t.orders, ["o_custkey"], ["o_totalprice", "o_orderkey"], {"rn": W.row_number()}).select(
        "o_orderkey", "o_custkey", "rn")


@query("win_top_n", """
    SELECT o_custkey, o_orderkey, o_totalprice, rnk FROM (
      SELECT *, rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC) AS rnk FROM orders) WHERE rnk <= 3""")
def win_top_n(t):
    return W.top_per_group(t.orders, ["o_custkey"], [("o_totalprice", "desc")], 3, "rnk").select(
        "o_custkey", "o_orderkey", "o_totalprice", "rnk")


_BEST_CUSTOMERS = """
    SELECT o_orderpriority, o_custkey, purchases, spent, place
    FROM (SELECT o_orderpriority, o_custkey, count(*) AS purchases, round(sum(o_totalprice), 2) AS spent,
                 CAST(rank() OVER (PARTITION BY o_orderpriority ORDER BY sum(o_totalprice) DESC) AS BIGINT) AS place
          FROM {orders} GROUP BY o_orderpriority, o_custkey) totals
    WHERE place <= 3"""


@query("win_top_n_sql", _BEST_CUSTOMERS.format(orders="orders"))
def win_top_n_sql(t):
    """Top-n per group as SQL text over a DataFrame: the three best customers per order priority."""
    return t.spark.sql(_BEST_CUSTOMERS, orders=t.orders)


@query("win_forward_fill", f"""
    WITH {READINGS}
    SELECT event_id, sensor_id, last_value(temperature IGNORE NULLS) OVER (
             PARTITION BY sensor_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS filled
    FROM sensor_base""")
def win_forward_fill(t):
    once = t.sensors.dropDuplicates(["event_id"])
    return W.with_windows(once, ["sensor_id"], ["event_id"], {"filled": W.last_known("temperature")}).select(
        "event_id", "sensor_id", "filled")


@query("win_latest_per_key", """
    SELECT user_id, event_type, event_id, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY value DESC, event_id) AS rn
      FROM events) WHERE rn = 1""")
def win_latest_per_key(t):
    return W.best_per_key(t.events, ["user_id", "event_type"], [("value", "desc"), "event_id"]).select(
        "user_id", "event_type", "event_id", "value")


def _hot_events(t):
    """Events of which one user holds a third, and window options under which that user is cut."""
    rows = t.events.count()
    hot = t.events.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, 0).otherwise(F.col("user_id")))
    return hot, {"max_group_rows": rows // 10, "rows_per_chunk": max(rows // 8, 1)}


HOT_EVENTS = "hot AS (SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS user_id) FROM events)"


@query("win_hot_ranks", f"""
    WITH {HOT_EVENTS}
    SELECT event_id, user_id, rank() OVER peers AS rnk, dense_rank() OVER peers AS dense,
           round(percent_rank() OVER peers, 6) AS pct
    FROM hot WINDOW peers AS (PARTITION BY user_id ORDER BY floor(value) DESC)""")
def win_hot_ranks(t):
    """Ranks with many ties while one user holds a third of all rows; that user is cut into chunks."""
    hot, options = _hot_events(t)
    ranked = W.with_windows(hot.withColumn("level", F.floor("value")), ["user_id"], [("level", "desc")], {
        "rnk": W.rank(), "dense": W.dense_rank(), "p": W.percent_rank()}, tiebreak=["event_id"], **options)
    return ranked.select("event_id", "user_id", "rnk", "dense", F.round("p", 6).alias("pct"))


@query("win_hot_rows", f"""
    WITH {HOT_EVENTS}
    SELECT event_id, user_id, row_number() OVER w AS rn, ntile(4) OVER w AS quartile, lag(value) OVER w AS before,
           lead(value) OVER w AS after, round(sum(value) OVER (w ROWS UNBOUNDED PRECEDING), 2) AS running
    FROM hot WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def win_hot_rows(t):
    """Row windows while one user holds a third of all rows; that user is cut into chunks."""
    hot, options = _hot_events(t)
    out = W.with_windows(hot, ["user_id"], ["ts", "event_id"], {
        "rn": W.row_number(), "quartile": W.ntile(4), "before": W.previous("value"), "after": W.following("value"),
        "s": W.running_sum("value")}, **options)
    return out.select("event_id", "user_id", "rn", "quartile", "before", "after", F.round("s", 2).alias("running"))


@query("group_by_key_hot", f"""
    WITH {HOT_EVENTS}, numbered AS (
      SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS pos FROM hot)
    SELECT user_id, (pos - 1) // 64 AS part, array_to_string(list(event_id ORDER BY pos), ',') AS ids
    FROM numbered GROUP BY 1, 2""")
def group_by_key_hot(t):
    """Lists per user while one user holds a third of all rows."""
    hot, options = _hot_events(t)
    lists = A.grouped_lists(hot, ["user_id"], "event_id", [], max_values=64, **options)
    text = F.array_join(F.transform("values", lambda v: v.cast("string")), ",")
    return lists.select("user_id", "part", text.alias("ids"))


@query("win_threshold_trigger", """
    SELECT user_id, event_id, round(total, 2) AS total FROM (
      SELECT *, sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS total
      FROM events) WHERE round(total, 2) >= 500""")
def win_threshold_trigger(t):
    running = W.with_windows(t.events, ["user_id"], ["ts", "event_id"], {"s": W.running_sum("value")})
    return running.select("user_id", "event_id", F.round("s", 2).alias("total")).filter(F.col("total") >= 500)


@query("win_nth_occurrence", """
    SELECT user_id, event_id FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events) WHERE rn = 3""")
def win_nth_occurrence(t):
    return W.nth_row(t.events, ["user_id"], ["event_id"], 3).select("user_id", "event_id")


# User-defined functions


@query("udf_scalar", f"""
    WITH {TRIPS}
    SELECT CASE WHEN passengers IS NULL THEN 'unknown' WHEN fare < 5 THEN 'micro' WHEN fare < 15 THEN 'short'
                WHEN fare < 30 THEN 'medium' ELSE 'long' END AS band, count(*) AS n
    FROM trips WHERE fare > 0 GROUP BY 1""")
def udf_scalar(t):
    limits = [(5, "micro"), (15, "short"), (30, "medium")]

    def band(fare):
        if fare is None:
            return "unknown"
        return next((label for limit, label in limits if fare < limit), "long")

    fare = F.when(F.col("passengers").isNotNull(), F.col("fare"))
    return t.trips.filter(F.col("fare") > 0).select(P.scalar_udf(band, "string")(fare).alias("band")).groupBy(
        "band").agg(_n().alias("n"))


@query("udf_pandas", f"""
    WITH {TRIPS}
    SELECT payment_type, round(CAST(avg(coalesce(tip / nullif(distance, 0), 0)) AS DECIMAL(38, 10)), 6)::DOUBLE AS mean_ratio
    FROM trips GROUP BY payment_type""")
def udf_pandas(t):
    return t.trips.select("payment_type", P.vector_ratio("tip", "distance").alias("r")).groupBy(
        "payment_type").agg(X.steady(F.avg("r"), 6).alias("mean_ratio"))


@query("udtf_flatmap", """
    SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part WHERE p_retailprice > 910""")
def udtf_flatmap(t):
    def words(name, price):
        if price is not None and price > 910:
            for word in (name or "").split(" "):
                yield (word,)

    return P.flat_map(t.part.select("p_partkey", "p_name", "p_retailprice"), words, ["p_name", "p_retailprice"],
                      "word string", keep=["p_partkey"])


class LongestStreak:
    """Longest run of equal event types in a group, and where it begins; the first of several."""

    def __init__(self):
        self.user, self.kind, self.first, self.length = None, None, None, 0
        self.best = (0, None, None)

    def eval(self, row):
        if self.length and row["event_type"] == self.kind:
            self.length += 1
        else:
            self.kind, self.first, self.length = row["event_type"], row["event_id"], 1
        self.user = row["user_id"]
        if self.length > self.best[0]:
            self.best = self.length, self.kind, self.first

    def terminate(self):
        length, kind, first = self.best
        yield self.user, kind, first, length


@query("udtf_partitioned", """
    WITH runs AS (
      SELECT user_id, event_type, event_id,
             row_number() OVER (PARTITION BY user_id ORDER BY event_id)
             - row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS run FROM events),
    streaks AS (
      SELECT user_id, event_type, min(event_id) AS first_event, count(*) AS length FROM runs
      GROUP BY user_id, event_type, run)
    SELECT user_id, event_type, first_event, length FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY length DESC, first_event) AS rn FROM streaks)
    WHERE rn = 1""")
def udtf_partitioned(t):
    """Longest streak of one event type per user, by a table function over partitions of its table argument."""
    return P.group_rows(t.events.select("user_id", "event_type", "event_id"), LongestStreak, ["user_id"], ["event_id"],
                        "user_id bigint, event_type string, first_event bigint, length bigint")


@query("udaf_custom", """
    SELECT event_type, round(CAST(avg(value) AS DECIMAL(38, 10)), 6)::DOUBLE AS mean FROM events GROUP BY event_type""")
def udaf_custom(t):
    return P.combine(
        t.events.select("event_type", "value"), ["event_type"],
        create=lambda rows: {"total": float(rows["value"].sum()), "n": len(rows)},
        state_schema="total double, n bigint",
        merge=[F.sum("total").alias("total"), F.sum("n").alias("n")],
        finish=[X.steady(F.col("total") / F.col("n"), 6).alias("mean")])


@query("map_batches", """
    SELECT event_id, value / 16 AS scaled FROM events""")
def map_batches(t):
    return P.map_batches(t.events.select("event_id", "value"),
                         lambda rows: rows[["event_id"]].assign(scaled=rows["value"] / 16),
                         "event_id bigint, scaled double")


@query("row_map", "SELECT event_id, value * 12 AS yearly, value * 12 > 600 AS large FROM events")
def row_map(t):
    return t.events.select("event_id", (F.col("value") * 12).alias("yearly"),
                           (F.col("value") * 12 > 600).alias("large"))
