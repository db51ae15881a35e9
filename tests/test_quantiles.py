"""Exact quantiles against sorted values, with ties, nulls, brackets and chunks."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidewater.ml.features import index_strings
from tidewater.operators.cleaning import iqr_outliers
from tidewater.operators.quantiles import exact_quantiles

PROBABILITIES = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]


def by_hand(values, p):
    values = sorted(v for v in values if v is not None)
    return float(values[max(math.ceil(p * len(values)), 1) - 1])


@pytest.fixture(scope="module")
def numbers(spark):
    return spark.range(20_000, numPartitions=6).select(
        ((F.col("id") * 7919) % 20_011).alias("wide"),
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 11).alias("tied"),
        F.when(F.col("id") % 2 == 0, -F.sqrt("id")).alias("gaps"))


@pytest.mark.parametrize("options", [{}, {"k": 20}, {"k": 100, "max_group_rows": 5, "rows_per_chunk": 40}])
def test_equals_sorted_values(numbers, options):
    found = exact_quantiles(numbers, {c: PROBABILITIES for c in numbers.columns}, **options)
    local = numbers.toPandas()
    for c in numbers.columns:
        values = [None if v != v else v for v in local[c].tolist()]
        assert found[c] == [by_hand(values, p) for p in PROBABILITIES], c


def test_no_values(spark):
    df = spark.createDataFrame([(None, 1)], "a double, b int")
    assert exact_quantiles(df, {"a": [0.5], "b": [0.5]}) == {"a": [None], "b": [1.0]}
    assert iqr_outliers(df, "a").isEmpty()


def test_outliers(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 5, 6, 7, 8, 100]], "x double")
    assert [r["x"] for r in iqr_outliers(df, "x").collect()] == [100.0]


def test_wide_index_equals_fitted_index(spark):
    df = spark.range(500).select(
        F.when(F.col("id") % 50 != 0, F.concat(F.lit("v"), (F.col("id") % 37).cast("string"))).alias("s"))
    fitted = index_strings(df, ["s"])
    joined = index_strings(df, ["s"], max_labels=1, rows_per_chunk=5)
    assert rows(fitted) == rows(joined)
