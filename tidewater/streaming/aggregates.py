"""Event-time windows, deduplication and enrichment; usable on batch frames too."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions import expressions as X
from tidewater.operators.cleaning import HUMIDITY_RANGE, SENSOR_RANGE, within


def window_agg(df: DataFrame, time: str, width: str, keys: Sequence[str | Column],
               measures: Sequence[Column], slide: str | None = None) -> DataFrame:
    """Tumbling (or sliding) windows per key, with the window bounds as plain columns."""
    window = F.window(time, width, slide) if slide else F.window(time, width)
    grouped = df.groupBy(window.alias("window"), *keys).agg(*measures)
    rest = [c for c in grouped.columns if c != "window"]
    return grouped.select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("window.end").cast("timestamp_ntz").alias("window_end"), *rest)


def session_agg(df: DataFrame, time: str, gap: str | Column, keys: Sequence[str | Column],
                measures: Sequence[Column]) -> DataFrame:
    """Sessions per key: events at most ``gap`` after the one before, which may differ per key.

    ``session_start`` is the first event and ``session_end`` the last one plus its gap. A stream keeps
    one state row per open session and emits it when the watermark passes its end. With the session
    setting of ``tidewater.session`` each task merges the sessions of its own rows before the shuffle.
    """
    grouped = df.groupBy(F.session_window(time, gap).alias("session"), *keys).agg(*measures)
    rest = [c for c in grouped.columns if c != "session"]
    return grouped.select(
        F.col("session.start").cast("timestamp_ntz").alias("session_start"),
        F.col("session.end").cast("timestamp_ntz").alias("session_end"), *rest)


def dedupe(df: DataFrame, keys: Sequence[str], event_time: str = "event_time", salts: int = 0) -> DataFrame:
    """Drop repeats; the event time is part of the key, so the watermark evicts old state.

    With ``salts``, copies are first reduced by (key, reading task modulo salts). One reading that
    is repeated millions of times is then spread over several tasks, and the second step sees at
    most ``salts`` rows of it. Any salting gives the same set of keys, so a retried task may
    number itself differently.
    """
    key = [*keys, event_time]
    if salts:
        salted = df.withColumn("_salt", F.spark_partition_id() % salts)
        df = salted.dropDuplicates([*key, "_salt"]).drop("_salt")
    return df.dropDuplicates(key)


def first_per_key(df: DataFrame, keys: Sequence[str], order: str, event_time: str = "event_time") -> DataFrame:
    """One row per key and event time: the one with the smallest ``order``, so a rerun keeps the same row.

    A stream emits a row when the watermark passes its event time. Each task first reduces its own
    rows, so a reading that is repeated millions of times is one row per task in the shuffle. Rows
    without an event time go.
    """
    key = [*keys, event_time]
    first = F.min(F.struct(order, *[c for c in df.columns if c not in (*key, order)]))
    timed = df.filter(F.col(event_time).isNotNull())
    return timed.groupBy(*key).agg(first.alias("_row")).select(*key, "_row.*")


def clean_sensor_stream(readings: DataFrame, order: str | None = None) -> DataFrame:
    """Deduplicated, range-checked readings with time features.

    Of several readings of a sensor and second the first by ``order`` stays; without it, any one.
    """
    unique = first_per_key(readings, ["sensor_id"], order) if order else dedupe(readings, ["sensor_id"])
    kept = within(unique, {"temperature": SENSOR_RANGE, "humidity": HUMIDITY_RANGE})
    return kept.withColumns(X.time_feature_columns(F.col("event_time")))


def sensor_windows(clean: DataFrame, width: str = "5 minutes") -> DataFrame:
    return window_agg(clean, "event_time", width, ["sensor_id"], [
        X.steady(F.avg("temperature"), 2).alias("avg_temp"),
        F.max("temperature").alias("max_temperature"),
        F.count("status").alias("total_status_records"),
    ])


def ride_columns(trips: DataFrame) -> DataFrame:
    """Per-ride features: duration, time parts, airport flag, tip share and fare per distance."""
    fare, distance = F.col("fare"), F.col("distance")
    return trips.withColumns({
        "duration_min": X.minutes_between(F.col("pickup_ts"), F.col("dropoff_ts")),
        "hour_of_day": X.hour_of_day(F.col("pickup_ts")),
        "day_of_week": X.day_of_week(F.col("pickup_ts")),
        "is_airport": F.col("rate_code").isin(2, 3).cast("bigint"),
        "tip_pct": X.safe_ratio(F.col("tip"), fare, 100.0, 2, default=0.0),
        "fare_per_mile": X.safe_ratio(fare, distance, 1.0, 2),
    })


# Feature names, the statistic and ride column behind each, and the digits kept.
ZONE_FEATURES = [
    ("avg_fare_5m", F.avg, "fare", 2),
    ("max_fare_5m", F.max, "fare", 2),
    ("std_fare_5m", F.stddev, "fare", 2),
    ("avg_distance_5m", F.avg, "distance", 2),
    ("avg_duration_5m", F.avg, "duration_min", 2),
    ("avg_tip_pct_5m", F.avg, "tip_pct", 2),
    ("avg_tip_5m", F.avg, "tip", 2),
    ("airport_ratio_5m", F.avg, "is_airport", 3),
    ("avg_fare_per_mile_5m", F.avg, "fare_per_mile", 2),
]


def zone_features(rides: DataFrame, time: str, width: str = "5 minutes") -> DataFrame:
    """Demand, fare, trip, tip and surge features per zone and window."""
    return window_agg(rides, time, width, ["pu_zone"], [
        F.count(F.lit(1)).alias("demand_5m"),
        *[X.steady(statistic(source), digits).alias(name) for name, statistic, source, digits in ZONE_FEATURES]])


def demand_alerts(rides: DataFrame, time: str, minimum: int, width: str = "5 minutes") -> DataFrame:
    """Zones and windows with more than ``minimum`` rides."""
    counted = window_agg(rides, time, width, ["pu_zone"], [
        F.count(F.lit(1)).alias("ride_count"), *X.means({"avg_fare": "fare", "avg_distance": "distance"})])
    return counted.filter(F.col("ride_count") > minimum)
