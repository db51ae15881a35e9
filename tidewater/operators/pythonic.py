"""Hooks for user Python code: vectorised, batch-wise, and always per task."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A table function gets a task per ``SPREAD_ROWS`` rows as long as cores wait for one, and never more than ``TASK_ROWS`` in it.
SPREAD_ROWS, TASK_ROWS = 10_000, 1_000_000


def scalar_udf(fn: Callable, return_type: T.DataType | str) -> Callable[..., Column]:
    """Row function with Arrow transfer; prefer built-in expressions where they exist."""
    return F.udf(fn, return_type, useArrow=True)


def vector_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Vectorised ratio that is 0 where the denominator is 0 or either side is missing."""

    @F.pandas_udf(T.DoubleType())
    def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
        return (a / b.where(b != 0)).fillna(0.0)

    return ratio(numerator, denominator)


def flat_map(df: DataFrame, fn: Callable[..., Iterable[tuple]], inputs: Sequence[str], schema: str,
             keep: Sequence[str] = ()) -> DataFrame:
    """Zero or more output rows per input row: an Arrow table function in a lateral join.

    ``fn`` takes the values of the columns ``inputs`` and yields rows of ``schema``; the columns
    ``keep`` of the input row stand beside each of them. Rows cost far more here than in a scan, so they
    are counted and spread over the tasks first: a small file would go through one task.
    """
    rows = df.count()
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = max(min(rows // SPREAD_ROWS, 4 * cores), rows // TASK_ROWS) + 1
    spread = df.select(*dict.fromkeys([*inputs, *keep])).repartition(tasks)

    class Rows:
        def eval(self, *values):
            yield from fn(*values)

    fields = T.StructType.fromDDL(schema).fields
    # Names of its own, so that a result may be called like an input.
    made = T.StructType([T.StructField(f"_made{i}", f.dataType) for i, f in enumerate(fields)])
    table = F.udtf(Rows, returnType=made, useArrow=True)
    joined = spread.lateralJoin(table(*[F.col(c).outer() for c in inputs]))
    return joined.select(*keep, *[F.col(f"_made{i}").alias(f.name) for i, f in enumerate(fields)])


def group_rows(df: DataFrame, handler: type, keys: Sequence[str], order: Sequence[str], schema: str) -> DataFrame:
    """Rows that a table function makes of each group, as SQL's TABLE argument PARTITION BY keys ORDER BY.

    ``handler`` has ``eval(row)`` and ``terminate()``, which yield rows of ``schema``, and a fresh
    instance per group. It sees the rows one by one in order, so a group of any length takes the
    memory of its state only; but one task reads a whole group, as the order asks for.
    """
    table = F.udtf(handler, returnType=schema)
    return table(df.asTable().partitionBy(*keys).orderBy(*order))


def map_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Apply a function to each Arrow batch of each partition."""
    return df.mapInPandas(lambda frames: (fn(frame) for frame in frames), schema)


def combine(df: DataFrame, keys: Sequence[str], create: Callable[[pd.DataFrame], dict],
            state_schema: str, merge: Sequence[Column], finish: Sequence[Column]) -> DataFrame:
    """User-defined aggregate in three steps: batch accumulators, merge, result.

    ``create`` turns the rows of one key in one batch into accumulator fields; ``merge`` are
    aggregates that combine accumulators; ``finish`` computes the result from the merged ones.
    Batches are reduced before the shuffle, so a hot key costs one row per batch, not per row.
    """
    keys = list(keys)
    key_types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.select(*keys).schema)
    schema = f"{key_types}, {state_schema}" if keys else state_schema

    def partials(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if keys:
                rows = [{**dict(zip(keys, key)), **create(group)}
                        for key, group in frame.groupby(keys, dropna=False)]
            else:
                rows = [create(frame)] if len(frame) else []
            if rows:
                yield pd.DataFrame(rows)

    return df.mapInPandas(partials, schema).groupBy(*keys).agg(*merge).select(*keys, *finish)
