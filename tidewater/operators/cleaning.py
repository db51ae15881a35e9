"""Imputation, range filters, deduplication and cleaning audits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions import expressions as X
from tidewater.operators.quantiles import exact_quantiles
from tidewater.operators.windows import OrderKey, best_per_key


def fill_with_mean(df: DataFrame, columns: Sequence[str], valid: Column | None = None) -> DataFrame:
    """Replace nulls by the column mean, as one lazy plan with a scalar subquery.

    ``valid`` restricts the rows the mean is taken over; by default all non-null values count.
    """
    def mean(c: str) -> Column:
        value = F.col(c).cast("double")
        return F.avg(value if valid is None else F.when(valid, value))

    means = df.agg(F.struct(*[mean(c).alias(c) for c in columns]).alias("m")).scalar()
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), means[c]) for c in columns})


def learn_fill_values(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]
                      ) -> dict[str, float | str]:
    """Median per numeric and mode per categorical column (ties go to the smaller value).

    Blank strings count as missing; a column without any value gets 0.0 or 'unknown'. All
    medians share their passes. Modes come from one grouped count over (column, value) pairs.
    """
    fills: dict[str, float | str] = {}
    if numeric:
        medians = exact_quantiles(df, {c: [0.5] for c in numeric})
        fills |= {c: 0.0 if medians[c][0] is None else medians[c][0] for c in numeric}
    if categorical:
        pairs = df.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("name"), X.blank_to_null(F.col(c)).alias("value"))
            for c in categorical]))).filter(F.col("value").isNotNull())
        # One row per categorical column reaches the driver.
        modes = best_per_key(pairs.groupBy("name", "value").count(), ["name"],
                             [("count", "desc"), "value"]).collect()
        found = {r["name"]: r["value"] for r in modes}
        fills |= {c: found.get(c, "unknown") for c in categorical}
    return fills


def apply_fill_values(df: DataFrame, fills: dict[str, float | str]) -> DataFrame:
    """Fill nulls (and blank strings) with learned values."""
    columns = {}
    for name, value in fills.items():
        source = X.blank_to_null(F.col(name)) if isinstance(value, str) else F.col(name).cast("double")
        columns[name] = F.coalesce(source, F.lit(value))
    return df.withColumns(columns)


def fill_zero_with_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Treat 0 as missing and replace it by the median of the non-zero values."""
    nonzero = df.select(*[F.when(F.col(c) != 0, F.col(c)).alias(c) for c in columns])
    medians = exact_quantiles(nonzero, {c: [0.5] for c in columns})
    return df.withColumns({
        c: F.when(F.col(c) == 0, F.lit(medians[c][0])).otherwise(F.col(c)) for c in columns})


def within(df: DataFrame, ranges: dict[str, tuple[float, float]], not_null: Sequence[str] = ()
           ) -> DataFrame:
    """Rows whose columns lie in their closed ranges; a null is outside every range."""
    tests = [F.col(c).between(lo, hi) for c, (lo, hi) in ranges.items()]
    tests += [F.col(c).isNotNull() for c in not_null]
    return df.filter(X.all_of(tests))


def iqr_outliers(df: DataFrame, column: str, factor: float = 1.5) -> DataFrame:
    """Rows outside the quartile fences, with the fences as columns.

    The fences are plain numbers by the time the rows are read, so the scan can skip on them.
    """
    low, high = exact_quantiles(df, {column: [0.25, 0.75]})[column]
    if low is None:
        return df.limit(0).withColumns({"lower_fence": F.lit(None).cast("double"),
                                        "upper_fence": F.lit(None).cast("double")})
    lower, upper = low - factor * (high - low), high + factor * (high - low)
    outside = df.filter((F.col(column) < lower) | (F.col(column) > upper))
    return outside.withColumns({"lower_fence": F.lit(lower), "upper_fence": F.lit(upper)})


def clean_trips(trips: DataFrame) -> DataFrame:
    """Plausible trips with defaults filled, one row per business key, and derived columns."""
    kept = within(trips, {"fare": (0.5, 1000), "distance": (0, 500)}).filter(
        F.col("pickup_ts") < F.col("dropoff_ts"))
    filled = kept.na.fill({"passengers": 1.0, "airport_fee": 0.0, "congestion_fee": 0.0})
    unique = dedupe_trips(filled)
    return unique.withColumns({
        "year": F.year("pickup_ts").cast("bigint"),
        "month": F.month("pickup_ts").cast("bigint"),
        "pickup_hour": X.hour_of_day(F.col("pickup_ts")),
        "duration_min": X.minutes_between(F.col("pickup_ts"), F.col("dropoff_ts"), 1),
        "fare_band": X.banded(F.col("fare"), [(10, "low"), (25, "medium")], "high"),
    })


TRIP_KEY = ["pickup_ts", "pu_zone", "do_zone", "fare"]


def dedupe_trips(trips: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """One trip per business key; the survivor is the first in a fixed total order.

    Columns ``within`` must follow from the key. Where rows are already dealt by them, they stay there.
    """
    rest: list[OrderKey] = [c for c in ("order_key", "vendor_id", "distance", "tip")]
    return best_per_key(trips, [*within, *TRIP_KEY], rest)


SENSOR_RANGE = (-20.0, 100.0)
HUMIDITY_RANGE = (0.0, 100.0)


def sensor_audit(readings: DataFrame) -> DataFrame:
    """Counts per disjoint fault, judged in the order: time, missing, range, duplicate.

    Equal (sensor, time) rows are counted per group first, so one shuffle of partial counts is
    all the audit needs.
    """
    fault = (
        F.when(F.col("event_time").isNull(), "bad_time")
        .when(F.col("temperature").isNull(), "missing")
        .when(~F.col("temperature").between(*SENSOR_RANGE)
              | ~F.col("humidity").between(*HUMIDITY_RANGE), "range")
        .otherwise("ok")
    )
    per_key = readings.select("sensor_id", "timestamp", fault.alias("fault")).groupBy(
        "fault", "sensor_id", "timestamp").agg(F.count(F.lit(1)).alias("n"))

    def of(name: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("fault") == name, F.col("n"))), F.lit(0))

    unique = F.count_if(F.col("fault") == "ok")
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("received"),
        of("bad_time").alias("invalid_timestamp"),
        of("missing").alias("missing_value"),
        of("range").alias("out_of_range"),
        (of("ok") - unique).alias("duplicates"),
        unique.alias("clean"),
    )


def clean_sensors(readings: DataFrame, valid_only: bool = False) -> DataFrame:
    """Mean-imputed, deduplicated, range-checked readings with time features.

    ``valid_only`` takes the mean over in-range values only, instead of over all of them.
    """
    in_range = F.col("temperature").between(*SENSOR_RANGE)
    filled = fill_with_mean(readings, ["temperature"], in_range if valid_only else None)
    return plausible_sensors(first_readings(filled))


def first_readings(readings: DataFrame) -> DataFrame:
    """One reading per sensor and time: the one with the smallest event id."""
    return best_per_key(readings, ["sensor_id", "timestamp"], ["event_id"])


def plausible_sensors(readings: DataFrame) -> DataFrame:
    """Readings in range and with a time, with time features."""
    kept = within(readings, {"temperature": SENSOR_RANGE}, not_null=["event_time"])
    return kept.withColumns(X.time_feature_columns(F.col("event_time")))


def sensor_report(clean: DataFrame, active: str) -> DataFrame:
    """Average and maximum per sensor, active sensors and status counts as (metric, key, value).

    All four come from the same (sensor, status) cells, so the readings are read once.
    """
    cells = clean.groupBy("sensor_id", "status").agg(
        F.count(F.lit(1)).alias("n"), F.sum("temperature").alias("total"), F.max("temperature").alias("high"))

    def entry(metric: str, key: Column, value: Column) -> Column:
        return F.struct(F.lit(metric).alias("metric"), key.alias("key"), value.cast("double").alias("value"),
                        F.col("n"))

    sensor = F.col("sensor_id")
    entries = cells.select(F.inline(F.array_compact(F.array(
        entry("avg_temperature", sensor, F.col("total")),
        entry("max_temperature", sensor, F.col("high")),
        entry("status_count", F.col("status"), F.col("n")),
        F.when(F.col("status") == active, entry("active_sensors", F.lit("all"), F.lit(1))),
    ))))
    merged = entries.groupBy("metric", "key").agg(
        F.sum("value").alias("total"), F.max("value").alias("high"), F.sum("n").alias("n"))
    value = (
        F.when(F.col("metric") == "avg_temperature", X.steady(F.col("total") / F.col("n"), 4))
        .when(F.col("metric") == "max_temperature", F.col("high"))
        .otherwise(F.col("total"))
    )
    return merged.select("metric", "key", value.alias("value"))
