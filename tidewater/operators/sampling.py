"""Repeatable samples and splits that do not depend on partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.expressions import hash_percent
from tidewater.operators.windows import group_size, row_number, with_windows

BUCKETS = 10_000


def _seeded_key(key: str | Column, seed: int) -> Column:
    column = F.col(key) if isinstance(key, str) else key
    return F.concat(column.cast("string"), F.lit(f"#{seed}"))


def sample_rows(df: DataFrame, key: str | Column, fraction: float, seed: int = 42) -> DataFrame:
    """Bernoulli sample decided by a hash of the row key."""
    return df.filter(hash_percent(_seeded_key(key, seed), BUCKETS) < int(fraction * BUCKETS))


def split_column(key: str | Column, fractions: dict[str, float], seed: int = 42) -> Column:
    """Name of the split a key falls into; ``fractions`` should add up to 1."""
    bucket = hash_percent(_seeded_key(key, seed), BUCKETS)
    names = list(fractions)
    expr, edge = F.lit(names[-1]), 1.0
    for name in reversed(names[:-1]):
        edge -= fractions[names[names.index(name) + 1]]
        expr = F.when(bucket < round(edge * BUCKETS), name).otherwise(expr)
    return expr


def split_two(df: DataFrame, key: str | Column, fraction: float = 0.8, seed: int = 42
              ) -> tuple[DataFrame, DataFrame]:
    """Disjoint (train, test) parts that together cover the table."""
    marked = df.withColumn("_split", split_column(key, {"train": fraction, "test": 1 - fraction}, seed))
    return (marked.filter(F.col("_split") == "train").drop("_split"),
            marked.filter(F.col("_split") == "test").drop("_split"))


def stratified_split(df: DataFrame, label: str, key: Sequence[str], fraction: float = 0.8,
                     seed: int = 42, **window_options) -> DataFrame:
    """Add ``split``: exactly floor(fraction * n) rows of each label go to train.

    Rows are ordered by a hash of their key inside each label. With few labels every group is
    large, which ``with_windows`` handles by cutting groups into chunks.
    """
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in key])
    hashed = df.withColumn("_hash", F.md5(_seeded_key(text, seed)))
    numbered = with_windows(hashed, [label], ["_hash"], {"_pos": row_number(), "_size": group_size()},
                            list(key), **window_options)
    in_train = F.col("_pos") <= F.floor(F.col("_size") * fraction)
    return numbered.withColumn("split", F.when(in_train, "train").otherwise("test")).drop(
        "_hash", "_pos", "_size")


def salted_keys(df: DataFrame, key: str, salt_on: Sequence[Column], salts: int) -> DataFrame:
    """Add ``salted_key`` = key_salt, with a salt that a retried task reproduces."""
    salt = hash_percent(F.concat_ws("|", *salt_on), BUCKETS) % salts
    return df.withColumn("salted_key", F.concat_ws("_", F.col(key).cast("string"), salt.cast("string")))
