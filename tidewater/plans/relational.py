"""Projections, filters, joins, sorting, sampling and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from tidewater.functions import expressions as X
from tidewater.ml.features import sql_projection
from tidewater.operators import joins as J
from tidewater.operators.aggregates import top_rows
from tidewater.operators.quality import columns_by_kind
from tidewater.operators.sampling import sample_rows, split_column, stratified_split
from tidewater.operators.windows import best_per_key
from tidewater.plans.registry import query
from tidewater.plans.tables import DEPARTMENTS, EMPLOYEES, TRIPS, ZONES
from tidewater.sources.files import stripped_headers

# Projections and filters


@query("select_columns", f"WITH {EMPLOYEES} SELECT employee_id, department, salary FROM employees")
def select_columns(t):
    return t.employees.select("employee_id", "department", "salary")


@query("with_arithmetic", f"""
    WITH {EMPLOYEES}
    SELECT employee_id, round(salary * 0.10, 6) AS bonus, round(salary * 0.05, 6) AS tax,
           round(salary * 12, 2) AS yearly
    FROM employees""")
def with_arithmetic(t):
    salary = F.col("salary")
    return t.employees.select("employee_id", F.round(salary * 0.10, 6).alias("bonus"),
                              F.round(salary * 0.05, 6).alias("tax"),
                              F.round(salary * 12, 2).alias("yearly"))


@query("sql_transform", """
    SELECT o_orderkey, o_totalprice, round(o_totalprice * 12, 2) AS yearly,
           o_totalprice / (o_custkey + 1) AS per_customer
    FROM orders WHERE o_totalprice > 1000""")
def sql_transform(t):
    return sql_projection(t.orders, """
        SELECT o_orderkey, o_totalprice, round(o_totalprice * 12, 2) AS yearly,
               o_totalprice / (o_custkey + 1) AS per_customer
        FROM __THIS__ WHERE o_totalprice > 1000""")


@query("rename_drop", """
    SELECT event_id, ts, user_id, event_type AS kind FROM events""")
def rename_drop(t):
    return t.events.withColumnRenamed("event_type", "kind").drop("props", "value")


@query("normalize_column_names", """
    SELECT n_nationkey AS nation_key, n_name AS name, n_regionkey AS region_key FROM nation""")
def normalize_column_names(t):
    return stripped_headers(t.nation.toDF(" nation_key", "name ", "  region_key "))


@query("cast_columns", """
    SELECT o_orderkey, CAST(o_totalprice AS BIGINT) AS price_long, CAST(o_custkey AS DOUBLE) AS cust_double,
           CAST(o_orderkey AS VARCHAR) AS key_text, TRY_CAST(o_orderstatus AS DOUBLE) AS status_number,
           CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date
    FROM (SELECT * REPLACE (floor(o_totalprice) AS o_totalprice) FROM orders)""")
def cast_columns(t):
    # Casting to a whole number truncates here and rounds in the oracle, so both start from floor.
    return t.orders.select(
        "o_orderkey", F.floor("o_totalprice").cast("bigint").alias("price_long"),
        F.col("o_custkey").cast("double").alias("cust_double"),
        F.col("o_orderkey").cast("string").alias("key_text"),
        F.col("o_orderstatus").try_cast("double").alias("status_number"),
        F.col("o_orderdate").cast("date").cast("string").alias("order_date"))


@query("filter_expr", "SELECT * FROM customer WHERE c_acctbal < 5000")
def filter_expr(t):
    return t.customer.filter(F.col("c_acctbal") < 5000)


@query("filter_sql_string", "SELECT * FROM orders WHERE o_totalprice > 100000 AND o_orderstatus = 'F'")
def filter_sql_string(t):
    return t.orders.filter("o_totalprice > 100000 AND o_orderstatus = 'F'")


@query("filter_between_in", """
    SELECT event_id, value, event_type FROM events
    WHERE value BETWEEN 10 AND 60 AND event_type IN ('click', 'purchase')""")
def filter_between_in(t):
    return t.events.filter(F.col("value").between(10, 60) & F.col("event_type").isin("click", "purchase")
                           ).select("event_id", "value", "event_type")


@query("filter_not_null", f"""
    WITH {TRIPS} SELECT order_key, vendor_id, do_zone, passengers, fare FROM trips
    WHERE passengers IS NOT NULL AND fare > 0""")
def filter_not_null(t):
    return t.trips.filter(F.col("passengers").isNotNull() & (F.col("fare") > 0)).select(
        "order_key", "vendor_id", "do_zone", "passengers", "fare")


@query("filter_compound", f"""
    WITH {EMPLOYEES} SELECT employee_id, department, salary, experience FROM employees
    WHERE department = 'BUILDING' AND salary > 6000 AND experience > 10""")
def filter_compound(t):
    return t.employees.filter(
        (F.col("department") == "BUILDING") & (F.col("salary") > 6000) & (F.col("experience") > 10)
    ).select("employee_id", "department", "salary", "experience")


@query("filter_column_vs_column", f"""
    WITH {TRIPS} SELECT order_key, vendor_id, do_zone, pickup_ts, dropoff_ts FROM trips
    WHERE pickup_ts < dropoff_ts""")
def filter_column_vs_column(t):
    return t.trips.filter(F.col("pickup_ts") < F.col("dropoff_ts")).select(
        "order_key", "vendor_id", "do_zone", "pickup_ts", "dropoff_ts")


@query("filter_vs_global_avg", f"""
    WITH {EMPLOYEES} SELECT employee_id, age FROM employees WHERE age > (SELECT avg(age) FROM employees)""")
def filter_vs_global_avg(t):
    mean_age = t.employees.agg(F.avg("age")).scalar()
    return t.employees.filter(F.col("age") > mean_age).select("employee_id", "age")


@query("filter_string_prefix", """
    SELECT 'S' AS branch, p_partkey, p_type FROM part WHERE starts_with(p_type, 'S')
    UNION ALL SELECT 'P', p_partkey, p_type FROM part WHERE starts_with(p_type, 'P')
    UNION ALL SELECT 'long', p_partkey, p_type FROM part WHERE length(p_type) > 6""")
def filter_string_prefix(t):
    kind = F.col("p_type")
    branch = F.explode(F.array_compact(F.array(
        F.when(kind.startswith("S"), F.lit("S")), F.when(kind.startswith("P"), F.lit("P")),
        F.when(F.length(kind) > 6, F.lit("long")))))
    return t.part.select(branch.alias("branch"), "p_partkey", "p_type")


@query("case_banding", f"""
    WITH {TRIPS}
    SELECT order_key, vendor_id, do_zone, fare,
           CASE WHEN fare < 5 THEN 'micro' WHEN fare < 15 THEN 'short' WHEN fare < 30 THEN 'medium'
                ELSE 'long' END AS fare_band,
           CASE WHEN fare < 10 THEN 'low' WHEN fare < 25 THEN 'medium' ELSE 'high' END AS price_level,
           CASE WHEN fare > 50 THEN 'surge' ELSE 'normal' END AS surge_flag,
           CASE WHEN distance < 10 THEN 'slow' WHEN distance < 30 THEN 'normal' ELSE 'fast' END AS speed_bin
    FROM trips""")
def case_banding(t):
    fare = F.col("fare")
    return t.trips.select(
        "order_key", "vendor_id", "do_zone", "fare",
        X.banded(fare, [(5, "micro"), (15, "short"), (30, "medium")], "long").alias("fare_band"),
        X.banded(fare, [(10, "low"), (25, "medium")], "high").alias("price_level"),
        F.when(fare > 50, "surge").otherwise("normal").alias("surge_flag"),
        X.banded(F.col("distance"), [(10, "slow"), (30, "normal")], "fast").alias("speed_bin"))


@query("label_binarize", f"""
    WITH {TRIPS}
    SELECT order_key, vendor_id, do_zone,
           CASE WHEN lower(trim(CASE WHEN rate_code = 1 THEN ' YES ' ELSE 'no' END)) = 'yes'
                THEN 1.0::DOUBLE ELSE 0.0 END AS label,
           CAST(tip / fare > 0.20 AS INTEGER)::DOUBLE AS high_tip
    FROM trips WHERE fare > 0""")
def label_binarize(t):
    answer = F.when(F.col("rate_code") == 1, " YES ").otherwise("no")
    return t.trips.filter(F.col("fare") > 0).select(
        "order_key", "vendor_id", "do_zone", X.yes_no_label(answer).alias("label"),
        (F.col("tip") / F.col("fare") > 0.20).cast("double").alias("high_tip"))


@query("split_by_dtype", """
    SELECT column_name AS name,
           CASE WHEN column_type IN ('BIGINT', 'INTEGER', 'DOUBLE') THEN 'numeric' ELSE 'categorical' END AS kind,
           (SELECT count(*) FROM orders) AS rows
    FROM (DESCRIBE orders)""")
def split_by_dtype(t):
    kinds = columns_by_kind(t.orders)
    names = F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.lit(kind).alias("kind"))
                               for kind, columns in kinds.items() for c in columns]))
    return t.orders.agg(F.count(F.lit(1)).alias("rows")).select(names, "rows")


# Joins


@query("join_inner_using", f"""
    WITH {EMPLOYEES}, {DEPARTMENTS}
    SELECT department, employee_id, salary, office_block, manager_name
    FROM employees JOIN departments USING (department)""")
def join_inner_using(t):
    return J.lookup_join(t.employees, t.departments, ["department"]).select(
        "department", "employee_id", "salary", "office_block", "manager_name")


@query("join_inner_expr", f"""
    WITH {TRIPS}, {ZONES}
    SELECT t.order_key, t.vendor_id, t.do_zone, z.zone, t.fare
    FROM trips t JOIN zones z ON t.pu_zone = z.zone_id""")
def join_inner_expr(t):
    return t.trips.alias("t").join(t.zones.alias("z"), F.col("t.pu_zone") == F.col("z.zone_id")).select(
        "t.order_key", "t.vendor_id", "t.do_zone", "z.zone", "t.fare")


@query("join_left", f"""
    WITH {EMPLOYEES}, {DEPARTMENTS}
    SELECT employee_id, e.department, office_block, manager_name
    FROM employees e LEFT JOIN departments d ON e.department = d.department""")
def join_left(t):
    return J.lookup_join(t.employees, t.departments, ["department"], "left").select(
        "employee_id", "department", "office_block", "manager_name")


@query("join_left_default", f"""
    WITH {TRIPS}, {ZONES}
    SELECT coalesce(zone, 'Other') AS zone, count(*) AS trips, round(CAST(avg(fare) AS DECIMAL(38, 10)), 2)::DOUBLE AS avg_fare
    FROM trips LEFT JOIN zones ON pu_zone = zone_id GROUP BY 1""")
def join_left_default(t):
    # Pre-aggregated by zone id, so the join sees one row per zone instead of one per trip.
    per_zone = t.trips.groupBy("pu_zone").agg(F.count(F.lit(1)).alias("n"), F.sum("fare").alias("fares"))
    named = per_zone.join(t.zones, F.col("pu_zone") == F.col("zone_id"), "left")
    return named.groupBy(F.coalesce("zone", F.lit("Other")).alias("zone")).agg(
        F.sum("n").alias("trips"), X.steady(F.sum("fares") / F.sum("n"), 2).alias("avg_fare"))


@query("join_right", f"""
    WITH {EMPLOYEES}, {DEPARTMENTS}
    SELECT d.department, CAST(employee_id AS VARCHAR) AS employee, office_block
    FROM employees e RIGHT JOIN departments d ON e.department = d.department""")
def join_right(t):
    return J.right_join(t.employees, t.departments, ["department"]).select(
        "department", F.col("employee_id").cast("string").alias("employee"), "office_block")


@query("join_full", f"""
    WITH {EMPLOYEES}, {DEPARTMENTS}
    SELECT coalesce(e.department, d.department) AS department, CAST(employee_id AS VARCHAR) AS employee,
           manager_name
    FROM employees e FULL JOIN departments d ON e.department = d.department""")
def join_full(t):
    return J.full_join(t.employees, t.departments, ["department"]).select(
        "department", F.col("employee_id").cast("string").alias("employee"), "manager_name")


@query("join_left_anti", f"""
    WITH {TRIPS}, {ZONES}
    SELECT order_key, vendor_id, pu_zone, do_zone FROM trips
    WHERE NOT EXISTS (SELECT 1 FROM zones WHERE zone_id = pu_zone)""")
def join_left_anti(t):
    return t.trips.join(t.zones, F.col("pu_zone") == F.col("zone_id"), "left_anti").select(
        "order_key", "vendor_id", "pu_zone", "do_zone")


@query("join_broadcast", """
    SELECT l_orderkey, l_linenumber, l_partkey, s_name, n_name
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey""")
def join_broadcast(t):
    suppliers = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("l_suppkey"), "s_name", "n_name")
    return J.lookup_join(t.lineitem, suppliers, ["l_suppkey"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "s_name", "n_name")


@query("join_shuffle", """
    SELECT l_orderkey, l_linenumber, l_partkey, o_orderpriority
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def join_shuffle(t):
    orders = t.orders.select("o_orderkey", "o_orderpriority")
    return t.lineitem.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "o_orderpriority")


@query("join_then_aggregate", f"""
    WITH {EMPLOYEES}, {DEPARTMENTS}
    SELECT office_block, count(*) AS employees, max(salary) AS max_salary, min(age) AS min_age,
           round(sum(salary), 2) AS total_salary, round(CAST(avg(experience) AS DECIMAL(38, 10)), 4)::DOUBLE AS avg_experience
    FROM employees JOIN departments USING (department) GROUP BY office_block""")
def join_then_aggregate(t):
    return J.lookup_join(t.employees, t.departments, ["department"]).groupBy("office_block").agg(
        F.count(F.lit(1)).alias("employees"), F.max("salary").alias("max_salary"),
        F.min("age").alias("min_age"), F.round(F.sum("salary"), 2).alias("total_salary"),
        X.steady(F.avg("experience"), 4).alias("avg_experience"))


@query("merge_group_stats", """
    SELECT event_id, user_id, value, round(CAST(avg(value) OVER (PARTITION BY user_id) AS DECIMAL(38, 10)), 4)::DOUBLE AS user_mean,
           round(CAST(stddev_samp(value) OVER (PARTITION BY user_id) AS DECIMAL(38, 10)), 4)::DOUBLE AS user_std
    FROM events""")
def merge_group_stats(t):
    return J.with_group_statistics(t.events.select("event_id", "user_id", "value"), ["user_id"], [
        X.steady(F.avg("value"), 4).alias("user_mean"),
        X.steady(F.stddev_samp("value"), 4).alias("user_std")])


@query("join_salted", """
    SELECT o_orderkey, o_custkey, c_mktsegment, c_nationkey
    FROM orders JOIN customer ON o_custkey = c_custkey""")
def join_salted(t):
    customers = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_nationkey")
    return J.salted_join(t.orders, customers, ["o_custkey"]).select(
        "o_orderkey", "o_custkey", "c_mktsegment", "c_nationkey")


@query("join_salted_hot", """
    SELECT o_custkey, o_orderstatus, c_mktsegment, c_nationkey
    FROM (SELECT CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END AS o_custkey, o_orderstatus FROM orders)
    LEFT JOIN customer ON o_custkey = c_custkey""")
def join_salted_hot(t):
    """One customer holds a third of the orders, most of them equal rows; its key is salted."""
    orders = t.orders.select(F.when(F.col("o_orderkey") % 3 == 0, 1).otherwise(F.col("o_custkey")).alias("o_custkey"),
                             "o_orderstatus")
    customers = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_nationkey")
    return J.salted_join(orders, customers, ["o_custkey"], "left", run=100)


# Sorting, limits and samples


@query("sort_by", f"""
    WITH {EMPLOYEES} SELECT employee_id, department, experience FROM employees
    ORDER BY experience DESC, department, employee_id""")
def sort_by(t):
    return t.employees.select("employee_id", "department", "experience").orderBy(
        F.desc("experience"), "department", "employee_id")


@query("top_k", """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def top_k(t):
    return top_rows(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), 10,
                    F.desc("o_totalprice"), F.asc("o_orderkey"))


@query("limit_rows", "SELECT * FROM events ORDER BY event_id LIMIT 100")
def limit_rows(t):
    return top_rows(t.events, 100, F.asc("event_id"))


_BUCKET = "CAST(('0x' || substr(md5(CAST({key} AS VARCHAR) || '#42'), 1, 7)) AS BIGINT) % 10000"


@query("sample_fraction", f"""
    SELECT event_id, user_id, value FROM events WHERE {_BUCKET.format(key='event_id')} < 1000""")
def sample_fraction(t):
    return sample_rows(t.events.select("event_id", "user_id", "value"), "event_id", 0.1)


@query("split_random", f"""
    SELECT o_orderkey, CASE WHEN {_BUCKET.format(key='o_orderkey')} < 8000 THEN 'train' ELSE 'test' END AS split
    FROM orders""")
def split_random(t):
    return t.orders.select("o_orderkey", split_column("o_orderkey", {"train": 0.8, "test": 0.2}).alias("split"))


@query("split_stratified", """
    SELECT doc_id, quality,
           CASE WHEN row_number() OVER (PARTITION BY quality ORDER BY md5(doc_id || '#42'), doc_id)
                     <= floor(0.8 * count(*) OVER (PARTITION BY quality))
                THEN 'train' ELSE 'test' END AS split
    FROM labels""")
def split_stratified(t):
    return stratified_split(t.labels, "quality", ["doc_id"]).select("doc_id", "quality", "split")


# Set operations


@query("union_by_name", """
    SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, NULL::DOUBLE AS balance FROM customer
    UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier""")
def union_by_name(t):
    customers = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                                  F.col("c_mktsegment").alias("segment"))
    suppliers = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                                  F.col("s_acctbal").alias("balance"))
    return customers.unionByName(suppliers, allowMissingColumns=True)


@query("flatten_branches", """
    SELECT event_id AS id, 'event' AS source FROM events
    UNION ALL SELECT o_orderkey, 'order' FROM orders
    UNION ALL SELECT c_custkey, 'customer' FROM customer""")
def flatten_branches(t):
    branches = [(t.events, "event_id", "event"), (t.orders, "o_orderkey", "order"),
                (t.customer, "c_custkey", "customer")]
    return reduce(lambda a, b: a.unionByName(b), [
        df.select(F.col(key).alias("id"), F.lit(name).alias("source")) for df, key, name in branches])


@query("distinct_rows", "SELECT DISTINCT user_id, event_type FROM events")
def distinct_rows(t):
    return t.events.select("user_id", "event_type").distinct()


@query("drop_duplicates_all", """
    SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus, l_quantity FROM lineitem""")
def drop_duplicates_all(t):
    return t.lineitem.select("l_suppkey", "l_returnflag", "l_linestatus", "l_quantity").dropDuplicates()


@query("drop_duplicates_keys", """
    SELECT o_custkey, o_orderstatus, o_orderkey, o_totalprice FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderstatus
                                   ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def drop_duplicates_keys(t):
    return best_per_key(t.orders, ["o_custkey", "o_orderstatus"], ["o_orderdate", "o_orderkey"]).select(
        "o_custkey", "o_orderstatus", "o_orderkey", "o_totalprice")
