"""Null keys, NaN, numeric labels, unlisted values and wide join types."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidewater.functions.expressions import yes_no_label
from tidewater.ml.features import one_hot
from tidewater.operators import aggregates as A
from tidewater.operators import joins as J
from tidewater.operators.quantiles import exact_quantiles


def test_labels(spark):
    df = spark.createDataFrame([(" YES ",), ("no",), ("1",), ("0",), ("2.5",), ("maybe",), ("",), (None,)], "a string")
    assert [r[0] for r in df.select(yes_no_label(F.col("a"))).collect()] == [1.0, 0.0, 1.0, 0.0, 2.5, 0.0, 0.0, None]
    number = spark.createDataFrame([(1,), (0,), (None,)], "a int")
    assert [r[0] for r in number.select(yes_no_label(F.col("a"))).collect()] == [1.0, 0.0, None]


def test_one_hot_has_every_category(spark):
    df = spark.createDataFrame([(i, c) for i, c in enumerate("aaaabbbccdefg")] + [(99, None)], "i int, c string")
    hot = one_hot(df, "c").collect()
    names = [f"c_{i}" for i in range(6)]
    assert [n for n in hot[0].asDict() if n.startswith("c_")] == names
    codes = {r.c: tuple(r[n] for n in names) for r in hot}
    assert len(set(codes.values())) == 8 and codes["g"] == (0.0,) * 6 and codes[None] == (None,) * 6


def test_contingency_counts_every_value(spark):
    df = spark.createDataFrame([(1, "F"), (1, "X"), (None, "F"), (None, "F"), (2, None)], "k int, s string")
    table = A.contingency_table(df, "k", "s")
    assert sorted(table.columns) == ["F", "X", "k", "null"]
    found = {r.k: (r.F, r.X, r["null"]) for r in table.collect()}
    assert found == {1: (1, 1, 0), None: (2, 0, 0), 2: (0, 0, 1)}


def test_value_sets_of_a_null_key(spark):
    df = spark.createDataFrame([(None, "b"), (None, "a"), (1, "c"), (2, None)], "k int, v string")
    found = {r.k: (r["values"], r.n) for r in A.value_sets(df, ["k"], "v", [F.count(F.lit(1)).alias("n")]).collect()}
    assert found == {None: (["a", "b"], 2), 1: (["c"], 1), 2: (None, 1)}


def test_quantiles_leave_out_nan(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (float("nan"),), (None,)], "x double")
    assert exact_quantiles(df, {"x": [0.5, 1.0]}) == {"x": [1.0, 2.0]}
    assert exact_quantiles(df.filter("isnan(x)"), {"x": [0.5]}) == {"x": [None]}


@pytest.mark.parametrize("how", ["inner", "left", "right", "full", "full_outer", "left_semi", "left_anti"])
def test_lookup_join_beyond_its_limit(spark, how):
    left = spark.createDataFrame([(i % 7 if i % 5 else None, i) for i in range(60)], "k int, a int")
    right = spark.createDataFrame([(k, f"b{k}") for k in (0, 1, 2, 9, None)], "k int, b string")
    assert rows(J.lookup_join(left, right, ["k"], how, max_rows=1)) == rows(left.join(right, ["k"], how))
