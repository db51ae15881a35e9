"""Data quality checks, gates and schema checks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


WARN_BELOW_PCT = 1.0


@dataclass(frozen=True)
class Check:
    name: str
    predicate: Column
    description: str


def quality_report(df: DataFrame, checks: Sequence[Check], nulls_fail: bool = False) -> DataFrame:
    """Failed rows, share and status of every check, from one pass over the table.

    A row fails where the predicate is false; with ``nulls_fail`` also where it is null.
    """
    def failed(check: Check) -> Column:
        bad = ~check.predicate
        return F.count_if(F.coalesce(bad, F.lit(True)) if nulls_fail else bad)

    counts = df.agg(F.count(F.lit(1)).alias("_rows"),
                    *[failed(c).alias(f"f_{i}") for i, c in enumerate(checks)])
    rows = F.array(*[
        F.struct(F.lit(c.name).alias("check"), F.col(f"f_{i}").alias("failed_rows"),
                 F.lit(c.description).alias("description"))
        for i, c in enumerate(checks)
    ])
    pct = F.col("failed_rows") / F.col("_rows") * 100
    status = F.when(F.col("failed_rows") == 0, "PASS").when(pct < WARN_BELOW_PCT, "WARN").otherwise("FAIL")
    return (
        counts.filter(F.col("_rows") > 0)
        .select("_rows", F.inline(rows))
        .select("check", status.alias("status"), "failed_rows",
                F.round(pct, 3).alias("pct_failed"), "description")
    )


def trip_checks() -> list[Check]:
    """Completeness, validity, consistency and business-rule checks over trips."""
    fare, distance = F.col("fare"), F.col("distance")
    seconds = F.unix_timestamp("dropoff_ts") - F.unix_timestamp("pickup_ts")
    # Check names and limits.
    return [
        Check("fare_not_null", fare.isNotNull(), "fare is present"),
        Check("pickup_not_null", F.col("pickup_ts").isNotNull(), "pickup time is present"),
        Check("distance_not_null", distance.isNotNull(), "distance is present"),
        Check("fare_positive", fare > 0, "fare is above 0"),
        Check("fare_range", fare.between(0.5, 1000), "fare is within 0.5 to 1000"),
        Check("distance_non_neg", distance >= 0, "distance is not negative"),
        Check("payment_valid", F.col("payment_type").isin(1, 2, 3, 4, 5, 6), "payment type is 1 to 6"),
        Check("pickup_before_dropoff", F.col("pickup_ts") < F.col("dropoff_ts"),
              "pickup comes before dropoff"),
        Check("reasonable_duration", seconds.between(60, 7200), "trip takes 1 to 120 minutes"),
        Check("no_high_fare_short_trip", ~((fare > 100) & (distance < 0.5)),
              "no fare above 100 for less than 0.5 distance"),
    ]


def duplicate_report(df: DataFrame, business_key: Sequence[str]) -> DataFrame:
    """Rows, distinct rows, exact duplicates and rows left when one row per key is kept.

    Identical rows are counted together first; the business keys are then counted over those
    groups, so a heavily repeated row is one row after the first shuffle.
    """
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    per_key = groups.groupBy(*business_key).agg(
        F.sum("_n").alias("_n"), F.count(F.lit(1)).alias("_distinct"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum("_distinct"), F.lit(0)).alias("distinct_rows"),
        F.coalesce(F.sum(F.col("_n") - F.col("_distinct")), F.lit(0)).alias("exact_duplicates"),
        F.count(F.lit(1)).alias("after_key_dedupe"),
    )


def fraction_gate(df: DataFrame, invalid: Column, limit: float) -> DataFrame:
    """One decision row: valid while the invalid share is within ``limit``; empty is invalid."""
    measured = df.agg(F.count(F.lit(1)).alias("total_rows"), F.count_if(invalid).alias("invalid_rows"))
    share = F.coalesce(F.try_divide(F.col("invalid_rows"), F.col("total_rows")), F.lit(1.0))
    return measured.select(
        "total_rows", "invalid_rows", F.round(share, 6).alias("invalid_fraction"),
        F.when(share <= limit, "valid").otherwise("invalid").alias("status"))


def row_count_gate(df: DataFrame, min_rows: int, passed: str = "process_data",
                   failed: str = "flag_bad_data") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_rows")).select(
        "total_rows", F.when(F.col("total_rows") >= min_rows, passed).otherwise(failed).alias("branch"))


def metric_gate(metrics: DataFrame, thresholds: DataFrame) -> DataFrame:
    """PASS or FAIL per metric against its minimum; a metric that was not measured fails."""
    verdict = F.when(F.col("value") >= F.col("minimum"), "PASS").otherwise("FAIL")
    return thresholds.join(metrics, "metric", "left").withColumn("status", verdict)


def first_field_error(required: Sequence[str]) -> Column:
    """Message for the first required text field that is missing or not numeric, else null."""
    problems = []
    for name in required:
        problems.append(F.when(F.col(name).isNull(), F.lit(f"missing field {name}")))
    for name in required:
        problems.append(F.when(F.col(name).try_cast("double").isNull(),
                               F.lit(f"field {name} is not numeric")))
    return F.coalesce(*problems)


# Schemas


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """The frame itself, or an error naming the columns it lacks."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")
    return df


def schema_table(spark: SparkSession, df: DataFrame) -> DataFrame:
    """One row per column with its type; reads no data."""
    return spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in df.schema],
                                 "name string, type string")


def type_report(df: DataFrame, expected: dict[str, str]) -> DataFrame:
    """OK, MISSING or TYPE MISMATCH per expected column."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema}
    rows = []
    for name, wanted in expected.items():
        found = actual.get(name)
        status = "MISSING" if found is None else "OK" if found == wanted else "TYPE MISMATCH"
        rows.append((name, wanted, found, status))
    return df.sparkSession.createDataFrame(
        rows, "name string, expected string, actual string, status string")


def schema_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Columns found on one side only or with another type."""
    spark = left.sparkSession
    a = schema_table(spark, left).withColumnRenamed("type", "left_type")
    b = schema_table(spark, right).withColumnRenamed("type", "right_type")
    change = (
        F.when(F.col("right_type").isNull(), "only_left")
        .when(F.col("left_type").isNull(), "only_right")
        .when(F.col("left_type") != F.col("right_type"), "type_changed")
    )
    return a.join(b, "name", "full").withColumn("change", change).filter(F.col("change").isNotNull())


def columns_by_kind(df: DataFrame, exclude: Sequence[str] = ()) -> dict[str, list[str]]:
    """Column names split into numeric and categorical (everything else)."""
    kinds: dict[str, list[str]] = {"numeric": [], "categorical": []}
    for field in df.schema:
        if field.name not in exclude:
            kind = "numeric" if isinstance(field.dataType, T.NumericType) else "categorical"
            kinds[kind].append(field.name)
    return kinds


