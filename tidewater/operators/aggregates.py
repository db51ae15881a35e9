"""Aggregations beyond a plain ``groupBy().agg()``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.expressions import all_of, salt_of, steady
from tidewater.operators.windows import previous, row_number, running_sum, with_windows

MAX_LIST_VALUES = 10_000


def grouped_lists(df: DataFrame, keys: Sequence[str], value: str, tiebreak: Sequence[str],
                  max_values: int = MAX_LIST_VALUES, **window_options) -> DataFrame:
    """All values of each key in sorted order, as lists of at most ``max_values`` values.

    A key with more values gets several rows numbered by ``part``; their concatenation in part
    order is the whole group, so no group is built as one array in one task.
    """
    keys = list(keys)
    numbered = with_windows(df, keys, [value], {"_pos": row_number()}, tiebreak, **window_options)
    part = F.floor((F.col("_pos") - 1) / max_values).alias("part")
    return (
        numbered.groupBy(*keys, part)
        .agg(F.array_sort(F.collect_list(F.struct("_pos", value))).alias("_rows"))
        .select(*keys, "part", F.col(f"_rows.{value}").alias("values"))
    )


def value_sets(df: DataFrame, keys: Sequence[str], value: str, measures: Sequence[Column] = (),
               max_values: int = MAX_LIST_VALUES, **window_options) -> DataFrame:
    """Distinct values of each key as sorted lists (see ``grouped_lists``), plus ``measures``."""
    keys = list(keys)
    pairs = df.select(*keys, value).filter(F.col(value).isNotNull()).distinct()
    sets = grouped_lists(pairs, keys, value, (), max_values, **window_options)
    if not measures:
        return sets
    measured = df.groupBy(*keys).agg(*measures)
    renamed = sets.withColumnsRenamed({k: f"_s_{k}" for k in keys})
    # Null keys are groups too, so they must meet their lists.
    match = all_of([F.col(k).eqNullSafe(F.col(f"_s_{k}")) for k in keys])
    return measured.join(renamed, match, "left").drop(*[f"_s_{k}" for k in keys])


def salted_aggregate(df: DataFrame, keys: Sequence[str], partial: Sequence[Column],
                     final: Sequence[Column], salt_on: Sequence[str], salts: int = 16) -> DataFrame:
    """Aggregate by (keys, salt), then merge the partial results by keys.

    ``partial`` aggregates rows and ``final`` merges the columns it produced. Sums and counts
    do not need this, since Spark combines them before the shuffle anyway; it helps aggregates
    whose state grows with the group.
    """
    salted = df.withColumn("_salt", salt_of([F.col(c) for c in salt_on], salts))
    return salted.groupBy(*keys, "_salt").agg(*partial).groupBy(*keys).agg(*final)


def describe_columns(df: DataFrame, columns: Sequence[str], digits: int = 4) -> DataFrame:
    """Count, mean, sample standard deviation, minimum and maximum, one row per column."""
    measures = []
    for c in columns:
        value = F.col(c).cast("double")
        measures += [F.count(value).alias(f"{c}_n"), F.avg(value).alias(f"{c}_mean"),
                     F.stddev_samp(value).alias(f"{c}_std"), F.min(value).alias(f"{c}_min"),
                     F.max(value).alias(f"{c}_max")]
    wide = df.agg(*measures)
    rows = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"{c}_n").alias("n"),
                 steady(F.col(f"{c}_mean"), digits).alias("mean"),
                 steady(F.col(f"{c}_std"), digits).alias("stddev"),
                 F.col(f"{c}_min").alias("min"), F.col(f"{c}_max").alias("max"))
        for c in columns
    ])
    return wide.select(F.inline(rows))


def null_profile(df: DataFrame, digits: int = 2) -> DataFrame:
    """Nulls per column and their share in percent, from one pass over the table."""
    counts = df.agg(F.count(F.lit(1)).alias("_rows"),
                    *[F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in df.columns])
    rows = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"_null_{c}").alias("null_count"),
                 steady(F.try_divide(F.col(f"_null_{c}"), F.col("_rows")) * 100, digits)
                 .alias("null_pct"))
        for c in df.columns
    ])
    return counts.select(F.inline(rows))


def contingency_table(df: DataFrame, row: str, column: str) -> DataFrame:
    """Counts of ``row`` against all values of ``column``; 0 where a pair is absent.

    Every value found becomes a column, a null one the column ``null``, so the values must be few
    enough to be columns; ``spark.sql.pivotMaxValues`` makes Spark refuse more instead of dropping
    any. A null row key stays null.
    """
    counts = df.groupBy(row).pivot(column).agg(F.count(F.lit(1)))
    return counts.na.fill(0, subset=counts.columns[1:])


def class_distribution(df: DataFrame, split: str, label: str) -> DataFrame:
    """Rows per (split, class), per split and overall; 'all' marks the totals."""
    totals = df.rollup(split, label).agg(
        F.count(F.lit(1)).alias("n"), F.grouping(split).alias("_s"), F.grouping(label).alias("_l"))
    return totals.select(
        F.when(F.col("_s") == 1, "all").otherwise(F.col(split).cast("string")).alias(split),
        F.when(F.col("_l") == 1, "all").otherwise(F.col(label).cast("string")).alias(label), "n")


def word_counts(df: DataFrame, text: str) -> DataFrame:
    """Occurrences of each lower-case whitespace-separated word."""
    words = F.explode(F.split(F.lower(F.trim(F.col(text))), r"\s+"))
    return df.select(words.alias("word")).filter(F.col("word") != "").groupBy("word").agg(
        F.count(F.lit(1)).alias("n"))


def top_rows(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first ``n`` rows of a total order; each task keeps only its own ``n`` best."""
    return df.orderBy(*order).limit(n)


def sessions(df: DataFrame, keys: Sequence[str], time: str, tiebreak: Sequence[str], gap: Column,
             measures: Sequence[Column], **window_options) -> DataFrame:
    """``measures`` per session of a key: rows at most ``gap`` (an interval) after the one before.

    ``session_start`` is the time of the first row, ``session_end`` the last one's time plus its gap.
    Sessions are numbered by windows that cut a large key into chunks, then grouped with partial
    sums, so a key that holds much of the table is never in one task. ``tiebreak`` makes the order
    of rows unique. Rows without a time take no part; null keys are a key of their own.
    """
    keys, order = list(keys), [time, *tiebreak]
    timed = df.filter(F.col(time).isNotNull()).withColumn("_until", F.col(time) + gap)
    seen = with_windows(timed, keys, order, {"_before": previous(time)}, **window_options)
    fresh = F.when(F.col(time) <= F.col("_before") + gap, 0).otherwise(1)
    numbered = with_windows(seen.withColumn("_fresh", fresh), keys, order, {"_session": running_sum("_fresh")},
                            **window_options)
    return numbered.groupBy(*keys, "_session").agg(
        F.min(time).alias("session_start"), F.max("_until").alias("session_end"), *measures).drop("_session")
