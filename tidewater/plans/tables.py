"""The given tables and the views the queries derive from them.

Each derived view exists twice: as a DataFrame here and as a common table expression in the
SQL constants below, so that a query and its oracle start from the same rows.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


class Tables:
    """Lazy access to the tables under one directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLE_NAMES:
            return self.spark.read.parquet(self.path(name))
        raise AttributeError(name)

    @cached_property
    def trips(self) -> DataFrame:
        """Trip records with missing, negative and inconsistent values, one per order line."""
        return trips_of(self.lineitem)

    @cached_property
    def zones(self) -> DataFrame:
        """Named pickup zones: suppliers with a low balance, after their nation; most zones have no name."""
        nations = self.nation.select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
        return self.supplier.filter(F.col("s_acctbal") < 2500).join(F.broadcast(nations), "s_nationkey").select(
            F.col("s_suppkey").alias("zone_id"), F.concat_ws(" ", "n_name", F.col("s_suppkey").cast("string")).alias("zone"))

    @cached_property
    def employees(self) -> DataFrame:
        """Customers in the role of employees."""
        return self.customer.select(
            F.col("c_custkey").alias("employee_id"),
            F.col("c_name").alias("name"),
            (18 + F.col("c_custkey") % 50).alias("age"),
            F.col("c_acctbal").alias("salary"),
            F.col("c_mktsegment").alias("department"),
            F.when(F.col("c_custkey") % 11 != 0, F.concat(F.lit("city "), F.col("c_nationkey").cast("string")))
            .alias("city"),
            (F.col("c_custkey") % 30).alias("experience"),
        )

    @cached_property
    def departments(self) -> DataFrame:
        """Literal department lookup; one department has no employees and one is missing."""
        return self.spark.createDataFrame(
            DEPARTMENT_ROWS, "department string, office_block string, manager_name string")

    @cached_property
    def sensors(self) -> DataFrame:
        """Sensor readings with injected faults, one row per event plus repeated rows."""
        return sensors_of(self.events)

    @cached_property
    def readings(self) -> DataFrame:
        """Sensor readings with the parsed event time (null where it does not parse)."""
        from tidewater.functions.expressions import parse_event_time

        return self.sensors.withColumn("event_time", parse_event_time(F.col("timestamp")))


# Department lookup rows.
DEPARTMENT_ROWS = [
    ("AUTOMOBILE", "A Block", "Manager 1"), ("BUILDING", "B Block", "Manager 2"),
    ("FURNITURE", "A Block", "Manager 3"), ("MACHINERY", "C Block", "Manager 4"),
    ("LEGAL", "D Block", "Manager 5"),
]


def trips_of(lineitem: DataFrame) -> DataFrame:
    """Trip view of order lines; see ``TRIPS`` for the same definition in SQL."""
    pickup_minute = ((F.col("l_partkey") * 13 + F.col("l_orderkey")) % 1440).cast("int")
    duration = (
        F.when(F.col("l_partkey") % 61 == 0, F.lit(-15))
        .otherwise((F.col("l_partkey") * 7 + F.col("l_linenumber")) % 130)
        .cast("int")
    )
    zero = F.lit(0)
    pickup = F.col("l_shipdate") + F.make_dt_interval(zero, zero, pickup_minute)
    fare = F.col("l_extendedprice") / 1000.0
    return lineitem.select(
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").cast("bigint").alias("vendor_id"),
        F.col("l_suppkey").alias("pu_zone"),
        F.col("l_partkey").alias("do_zone"),
        pickup.alias("pickup_ts"),
        (pickup + F.make_dt_interval(zero, zero, duration)).alias("dropoff_ts"),
        F.when(F.col("l_partkey") % 17 != 0, F.col("l_linenumber").cast("double")).alias("passengers"),
        F.when(F.col("l_partkey") % 53 == 0, 0.0).otherwise(F.col("l_quantity")).alias("distance"),
        (F.col("l_partkey") % 6 + 1).alias("rate_code"),
        (F.col("l_orderkey") % 7 + 1).alias("payment_type"),
        F.when(F.col("l_orderkey") % 97 == 0, -fare).otherwise(fare).alias("fare"),
        (fare * F.col("l_discount") * 4).alias("tip"),
        F.when(F.col("l_partkey") % 10 != 0, 1.25).alias("airport_fee"),
        F.when(F.col("l_partkey") % 7 != 0, 2.5).alias("congestion_fee"),
        F.lower("l_linestatus").alias("flag"),
    )


TRIPS = """
trips AS (
  SELECT l_orderkey AS order_key, CAST(l_linenumber AS BIGINT) AS vendor_id,
         l_suppkey AS pu_zone, l_partkey AS do_zone,
         l_shipdate + to_minutes(CAST((l_partkey * 13 + l_orderkey) % 1440 AS INTEGER)) AS pickup_ts,
         l_shipdate + to_minutes(CAST((l_partkey * 13 + l_orderkey) % 1440
           + CASE WHEN l_partkey % 61 = 0 THEN -15
                  ELSE (l_partkey * 7 + l_linenumber) % 130 END AS INTEGER)) AS dropoff_ts,
         CASE WHEN l_partkey % 17 <> 0 THEN CAST(l_linenumber AS DOUBLE) END AS passengers,
         CASE WHEN l_partkey % 53 = 0 THEN 0.0::DOUBLE ELSE l_quantity END AS distance,
         l_partkey % 6 + 1 AS rate_code, l_orderkey % 7 + 1 AS payment_type,
         CASE WHEN l_orderkey % 97 = 0 THEN -(l_extendedprice / 1000.0::DOUBLE)
              ELSE l_extendedprice / 1000.0::DOUBLE END AS fare,
         l_extendedprice / 1000.0::DOUBLE * l_discount * 4 AS tip,
         CASE WHEN l_partkey % 10 <> 0 THEN 1.25::DOUBLE END AS airport_fee,
         CASE WHEN l_partkey % 7 <> 0 THEN 2.5::DOUBLE END AS congestion_fee,
         lower(l_linestatus) AS flag
  FROM lineitem)"""

ZONES = """
zones AS (
  SELECT s_suppkey AS zone_id, n_name || ' ' || s_suppkey AS zone
  FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal < 2500)"""

EMPLOYEES = """
employees AS (
  SELECT c_custkey AS employee_id, c_name AS name, 18 + c_custkey % 50 AS age,
         c_acctbal AS salary, c_mktsegment AS department,
         CASE WHEN c_custkey % 11 <> 0 THEN 'city ' || c_nationkey END AS city,
         c_custkey % 30 AS experience
  FROM customer)"""

DEPARTMENTS = """
departments(department, office_block, manager_name) AS (VALUES
  ('AUTOMOBILE', 'A Block', 'Manager 1'), ('BUILDING', 'B Block', 'Manager 2'),
  ('FURNITURE', 'A Block', 'Manager 3'), ('MACHINERY', 'C Block', 'Manager 4'),
  ('LEGAL', 'D Block', 'Manager 5'))"""


def sensors_of(events: DataFrame) -> DataFrame:
    """Fault-injected sensor view of events; see ``SENSORS`` for the same definition in SQL."""
    m = F.col("event_id") % 100
    late_minutes = (6 + F.floor(F.col("event_id") / 100) % 10).cast("int")
    zero = F.lit(0)
    shifted = F.when(m.between(7, 9), F.col("ts") - F.make_dt_interval(zero, zero, late_minutes))
    copies = F.when(m.isin(10, 11), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return events.select(
        "event_id",
        F.concat(F.lit("sensor_"), (F.col("user_id") % 10 + 1).cast("string")).alias("sensor_id"),
        F.when(m.isin(3, 4), F.lit("NOT_A_TIMESTAMP"))
        .otherwise(F.date_format(F.coalesce(shifted, F.col("ts")), "yyyy-MM-dd HH:mm:ss"))
        .alias("timestamp"),
        F.when(m < 3, F.lit(None).cast("double"))
        .when(m == 5, F.lit(-50.0))
        .when(m == 6, F.lit(150.0))
        .otherwise(F.round(15 + F.col("value") % 20, 2))
        .alias("temperature"),
        (F.lit(30.0) + F.col("event_id") % 61).alias("humidity"),
        F.col("event_type").alias("status"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


SENSORS = """
sensor_base AS (
  SELECT event_id, 'sensor_' || CAST(user_id % 10 + 1 AS VARCHAR) AS sensor_id,
         CASE WHEN event_id % 100 IN (3, 4) THEN 'NOT_A_TIMESTAMP'
              WHEN event_id % 100 BETWEEN 7 AND 9
              THEN strftime(ts - to_minutes(CAST(6 + floor(event_id / 100) % 10 AS INTEGER)),
                            '%Y-%m-%d %H:%M:%S')
              ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS "timestamp",
         CASE WHEN event_id % 100 < 3 THEN NULL WHEN event_id % 100 = 5 THEN -50.0::DOUBLE
              WHEN event_id % 100 = 6 THEN 150.0::DOUBLE
              ELSE round(15 + value % 20, 2) END AS temperature,
         30.0::DOUBLE + event_id % 61 AS humidity, event_type AS status
  FROM events),
sensors AS (
  SELECT * FROM sensor_base
  UNION ALL
  SELECT * FROM sensor_base WHERE event_id % 100 IN (10, 11))"""

READINGS = SENSORS + """,
readings AS (
  SELECT *, try_strptime("timestamp", '%Y-%m-%d %H:%M:%S') AS event_time FROM sensors)"""
