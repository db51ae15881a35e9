"""Joins that hold up under hot keys and state the size bound of what they broadcast."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.expressions import all_of, salt_of

MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
# Most copies of one left row that a salted join writes out from one joined row.
COPY_RUN = 10_000
# Rows of one key that a salted join means for one task.
ROWS_PER_SALT = 1_000_000


def fits_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS,
                   max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether ``df`` is small by measurement; looks at no more than ``max_rows`` + 1 rows."""
    width = F.length(F.to_json(F.struct(*[F.col(c) for c in df.columns])))
    seen = df.select(width.alias("w")).limit(max_rows + 1).agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("w"), F.lit(0)).alias("bytes")).first()
    return seen["rows"] <= max_rows and seen["bytes"] <= max_bytes


def lookup_join(big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner",
                max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Join with a lookup: broadcast when it is measured to be small, shuffled beyond that.

    Every join type gives the same rows either way. Inner and left joins spread hot keys by salts,
    right and full joins are built from them and an anti join; the others join as Spark plans them.
    """
    if fits_broadcast(small, max_rows):
        return big.join(F.broadcast(small), list(on), how)
    kind = how.lower().replace("_", "").replace("outer", "")
    if kind in ("inner", "left"):
        return salted_join(big, small, on, kind)
    if kind == "right":
        return right_join(big, small, on)
    if kind == "full":
        return full_join(big, small, on)
    return big.join(small, list(on), how)


def hot_keys(df: DataFrame, on: Sequence[str], fraction: float) -> DataFrame:
    """Keys that hold more than ``fraction`` of all rows; at most 1/fraction rows."""
    return hot_key_counts(df, on, fraction).select(*on)


def hot_key_counts(df: DataFrame, on: Sequence[str], fraction: float) -> DataFrame:
    """The keys of ``hot_keys`` with their ``_rows``.

    One grouping gives the counts and, summed up, the size of the table.
    """
    counts = df.groupBy(*on).count()
    total = counts.agg(F.sum("count").alias("t")).scalar()
    return counts.filter(F.col("count") > total * fraction).select(*on, F.col("count").alias("_rows"))


def has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(has_map(f.dataType) for f in kind)
    return isinstance(kind, T.MapType) or isinstance(kind, T.ArrayType) and has_map(kind.elementType)


def salted_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner",
                salts: int | None = None, fraction: float = 0.01, run: int = COPY_RUN,
                rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """Inner or left join that spreads the hot keys of the left side over tasks.

    A hot key has as many salts as ``rows_per_salt`` fit into its counted rows, two at least, or
    ``salts`` if given. Only the right rows of hot keys are repeated, once per salt; all other keys join as usual.
    Equal left rows of a hot key are counted first, cut into runs of at most ``run`` copies with a
    salt each, and written out after the join. So copies of one row spread too, and as a salt
    depends on nothing but the row and its run, a retried task repeats it. Left rows with a null
    key match nothing; they never meet the shuffle. Columns that are maps are counted by their
    entries; a map inside another column is an error, whatever the keys hold.
    """
    maps = [f.name for f in left.schema if isinstance(f.dataType, T.MapType)]
    for f in left.schema:
        inner = f.dataType.valueType if f.name in maps else f.dataType
        if has_map(inner):
            raise TypeError(f"salted_join cannot count rows by {f.name}: {f.dataType.simpleString()}")
    if how not in ("inner", "left"):
        raise ValueError(f"salted_join supports inner and left joins, not {how}")
    on = list(on)
    # At most 1/fraction rows, so collecting and broadcasting them is bounded.
    found = hot_key_counts(left, on, fraction).collect()
    if not found:
        return left.join(right, on, how)
    each = F.lit(salts) if salts else F.greatest(F.lit(2), F.ceil(F.col("_rows") / rows_per_salt).cast("int"))
    named = left.sparkSession.createDataFrame(found, T.StructType([*left.select(*on).schema, T.StructField("_rows", T.LongType())]))
    dealt = F.broadcast(named.select(*on, each.alias("_salts")))
    hot = F.broadcast(named.select(*on))
    keyless = reduce(or_, [F.col(k).isNull() for k in on])
    keyed = left.filter(~keyless)
    usual = keyed.join(hot, on, "left_anti").join(right, on, how)

    counted = keyed.join(dealt, on).withColumns({m: F.map_entries(m) for m in maps}).groupBy(
        *left.columns, "_salts").agg(F.count(F.lit(1)).alias("_n"))
    runs = counted.withColumn("_run", F.explode(F.sequence(F.lit(0), F.expr(f"(_n - 1) div {run}").cast("long"))))
    salted_left = runs.withColumns({
        "_copies": F.least(F.lit(run), F.col("_n") - F.col("_run") * run),
        "_salt": salt_of([*[F.col(c) for c in left.columns], F.col("_run")], F.col("_salts"))}).withColumns(
        {m: F.map_from_entries(m) for m in maps}).select(*left.columns, "_copies", "_salt")
    salted_right = right.join(dealt, on).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))).select(*right.columns, "_salt")
    spread = salted_left.join(salted_right, [*on, "_salt"], how).withColumn(
        "_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).drop("_salt", "_copies", "_copy")
    joined = usual.union(spread)
    # Against no rows at all, a left join only adds the null columns.
    return joined.union(left.filter(keyless).join(right.limit(0), on, "left")) if how == "left" else joined


def right_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Right outer join as inner rows plus unmatched right rows.

    A hot key on the left cannot be split in one outer join, but can in the salted inner join, and
    the anti join sees each left key once.
    """
    on = list(on)
    matched = salted_join(left, right, on, "inner")
    unmatched = right.join(left.select(*on).distinct(), on, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)


def full_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Full outer join as a left join plus unmatched right rows; see ``right_join``."""
    on = list(on)
    matched = salted_join(left, right, on, "left")
    unmatched = right.join(left.select(*on).distinct(), on, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)


def with_group_statistics(df: DataFrame, keys: Sequence[str], statistics: Sequence[Column]
                          ) -> DataFrame:
    """Every row with the statistics of its group.

    The statistics are pre-aggregated per task and joined back, so a hot group is split by the
    adaptive skew join; a window over the keys would put it into one task.
    """
    keys = list(keys)
    grouped = df.groupBy(*keys).agg(*statistics)
    renamed = grouped.withColumnsRenamed({k: f"_g_{k}" for k in keys})
    match = all_of([F.col(k).eqNullSafe(F.col(f"_g_{k}")) for k in keys])
    return df.join(renamed, match, "left").drop(*[f"_g_{k}" for k in keys])
