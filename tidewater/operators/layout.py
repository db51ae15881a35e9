"""Physical layout: partition counts, co-location, skew and caching."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def partition_row_counts(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per physical partition, optionally also per key."""
    return df.select(*keys, F.spark_partition_id().alias("part")).groupBy("part", *keys).agg(
        F.count(F.lit(1)).alias("n"))


def skew_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key with the share of the table, from pre-aggregated counts."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("t")).scalar()
    return counts.withColumn("share", F.round(F.col("n") / total, 6))


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Keep a frame for several actions and release it afterwards, also after an error.

    A frame that is kept already stays so: whoever kept it releases it.
    """
    if df.storageLevel.useMemory or df.storageLevel.useDisk:
        yield df
        return
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()
