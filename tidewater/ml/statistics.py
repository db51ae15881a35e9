"""Correlation, distribution summaries and independence tests."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import ChiSquareTest, Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.expressions import steady
from tidewater.ml.features import index_strings
from tidewater.operators.windows import running_sum, with_windows


def correlation_matrix(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """Pearson correlation of every column pair, long form, from one aggregation pass."""
    pairs = list(combinations_with_replacement(columns, 2))
    wide = df.agg(*[F.corr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    rows = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"),
                     F.round(f"r{i}", digits).alias("r")) for i, (a, b) in enumerate(pairs)]
    rows += [F.struct(F.lit(b).alias("a"), F.lit(a).alias("b"),
                      F.round(f"r{i}", digits).alias("r"))
             for i, (a, b) in enumerate(pairs) if a != b]
    return wide.select(F.inline(F.array(*rows)))


def average_ranks(df: DataFrame, columns: Sequence[str], **window_options) -> DataFrame:
    """Add ``<column>_rank``: the rank in the whole table, ties sharing their mean rank.

    Ranks are computed over the distinct values with their counts and joined back, so ties are
    pre-aggregated; the running count over distinct values is cut into chunks.
    """
    for c in columns:
        counts = df.groupBy(F.col(c).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
        ranked = with_windows(counts, [], ["_v"], {"_upto": running_sum("_n")}, **window_options)
        mean_rank = F.col("_upto") - (F.col("_n") - 1) / 2
        df = df.join(ranked.select("_v", mean_rank.alias(f"{c}_rank")),
                     F.col(c) == F.col("_v"), "left").drop("_v")
    return df


def spearman(df: DataFrame, a: str, b: str, digits: int = 6, **window_options) -> DataFrame:
    """Rank correlation as the Pearson correlation of average ranks, over rows with both values."""
    both = df.select(a, b).na.drop()
    return average_ranks(both, [a, b], **window_options).agg(
        F.round(F.corr(f"{a}_rank", f"{b}_rank"), digits).alias("rho"))


def vector_summary(df: DataFrame, columns: Sequence[str], digits: int = 4) -> DataFrame:
    """Mean, variance, standard deviation, minimum and maximum per component, long form."""
    metrics = ["mean", "variance", "std", "min", "max"]
    vectors = VectorAssembler(inputCols=list(columns), outputCol="v").transform(df)
    summary = vectors.agg(Summarizer.metrics(*metrics).summary(F.col("v")).alias("s"))
    arrays = summary.select(*[vector_to_array(F.col(f"s.{m}")).alias(m) for m in metrics])
    rows = F.array(*[
        F.struct(F.lit(c).alias("column"),
                 *[(F.col(m)[i] if m in ("min", "max") else steady(F.col(m)[i], digits)).alias(m) for m in metrics])
        for i, c in enumerate(columns)
    ])
    return arrays.select(F.inline(rows))


def chi_square(df: DataFrame, features: Sequence[str], label: str, alpha: float = 0.05,
               digits: int = 6) -> DataFrame:
    """Independence of each categorical feature and the label."""
    indexed = index_strings(df, [*features, label])
    vectors = VectorAssembler(inputCols=[f"{f}_idx" for f in features], outputCol="v").transform(indexed)
    tested = ChiSquareTest.test(vectors, "v", f"{label}_idx", flatten=True)
    names = F.array(*[F.lit(f) for f in features])
    return tested.select(
        names[F.col("featureIndex")].alias("feature"),
        F.round("statistic", digits).alias("statistic"),
        F.col("degreesOfFreedom").cast("bigint").alias("dof"),
        F.col("pValue").alias("p_value"),
        (F.col("pValue") < alpha).alias("dependent"))

