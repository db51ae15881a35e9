"""Window columns that stay distributed when one group holds most of the rows.

A plain ``Window.partitionBy(key)`` puts every row of a key into one task. ``with_windows``
measures the largest group first. Where all groups are small it uses the plain window.
Otherwise it range-partitions the rows by (keys, order), so that a large group is cut into
ordered chunks, evaluates each window inside its chunk, and adds what the earlier chunks of the
same group contribute. That carry has at most two rows per chunk, so it is broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.session import scratch_path

MAX_GROUP_ROWS = 20_000_000
ROWS_PER_CHUNK = 5_000_000
# Spark's default for spark.sql.optimizer.windowGroupLimitThreshold.
GROUP_LIMIT = 1_000

OrderKey = str | tuple[str, str]


@dataclass(frozen=True)
class Spec:
    kind: str
    column: str | None = None
    n: int = 0


def row_number() -> Spec:
    return Spec("row_number")


def rank() -> Spec:
    return Spec("rank")


def dense_rank() -> Spec:
    return Spec("dense_rank")


def percent_rank() -> Spec:
    return Spec("percent_rank")


def ntile(n: int) -> Spec:
    return Spec("ntile", n=n)


def group_size() -> Spec:
    return Spec("group_size")


def running_sum(column: str) -> Spec:
    return Spec("sum", column)


def running_max(column: str) -> Spec:
    return Spec("max", column)


def previous(column: str) -> Spec:
    return Spec("lag", column)


def following(column: str) -> Spec:
    return Spec("lead", column)


def last_known(column: str) -> Spec:
    """Latest non-null value up to and including the row."""
    return Spec("fill", column)


def _sort_columns(order: Sequence[OrderKey]) -> list[Column]:
    columns = []
    for key in order:
        name, direction = (key, "asc") if isinstance(key, str) else key
        columns.append(F.desc(name) if direction == "desc" else F.asc(name))
    return columns


def _names(order: Sequence[OrderKey]) -> list[str]:
    return [key if isinstance(key, str) else key[0] for key in order]


def group_extent(df: DataFrame, keys: Sequence[str]) -> tuple[int, int]:
    """Rows of the table and of its largest group, from one pass over the key columns."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    found = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
                      F.coalesce(F.max("n"), F.lit(0)).alias("largest")).first()
    return found["rows"], found["largest"]


def with_windows(df: DataFrame, keys: Sequence[str], order: Sequence[OrderKey],
                 specs: dict[str, Spec], tiebreak: Sequence[OrderKey] = (),
                 max_group_rows: int = MAX_GROUP_ROWS,
                 rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Add one column per entry of ``specs``.

    Rank, dense rank and percent rank treat rows equal in ``order`` as peers; all other
    functions follow ``order`` and then ``tiebreak``, which together should be unique. Without
    ``keys`` the whole table is one group and is always cut into chunks.
    """
    keys, order, tiebreak = list(keys), list(order), list(tiebreak)
    rows, largest = group_extent(df, keys)
    if keys and largest <= max_group_rows:
        return _plain(df, keys, order, tiebreak, specs)
    chunks = max(2, math.ceil(rows / rows_per_chunk))
    return _chunked(df, keys, order, tiebreak, specs, chunks)


def _local_columns(partition: list, order: list, tiebreak: list,
                   specs: dict[str, Spec]) -> dict[str, Column]:
    """The window function of each spec over the given partitioning."""
    total = Window.partitionBy(*partition).orderBy(*_sort_columns(order + tiebreak))
    peers = Window.partitionBy(*partition).orderBy(*_sort_columns(order))
    up_to_row = total.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*partition)
    columns = {}
    for name, spec in specs.items():
        columns[name] = {
            "row_number": lambda s: F.row_number().over(total).cast("bigint"),
            "rank": lambda s: F.rank().over(peers).cast("bigint"),
            "dense_rank": lambda s: F.dense_rank().over(peers).cast("bigint"),
            "percent_rank": lambda s: F.percent_rank().over(peers),
            "ntile": lambda s: F.ntile(s.n).over(total).cast("bigint"),
            "group_size": lambda s: F.count(F.lit(1)).over(whole),
            "sum": lambda s: F.sum(s.column).over(up_to_row),
            "max": lambda s: F.max(s.column).over(up_to_row),
            "lag": lambda s: F.lag(s.column).over(total),
            "lead": lambda s: F.lead(s.column).over(total),
            "fill": lambda s: F.last(s.column, ignorenulls=True).over(up_to_row),
        }[spec.kind](spec)
    return columns


def _plain(df, keys, order, tiebreak, specs) -> DataFrame:
    return df.withColumns(_local_columns(keys, order, tiebreak, specs))


def _chunked(df, keys, order, tiebreak, specs, chunks: int) -> DataFrame:
    spark = df.sparkSession
    # Chunk numbers come from the range exchange, whose bounds are sampled when it runs. The rows
    # are written once with their chunk, so every later step sees the same cut.
    cut = df.repartitionByRange(
        chunks, *[F.asc(k) for k in keys], *_sort_columns(order + tiebreak)
    ).withColumn("_w_chunk", F.spark_partition_id())
    local = {f"_w_l_{name}": spec for name, spec in specs.items()}
    local |= {"_w_rn": row_number(), "_w_n": group_size()}
    if any(s.kind in ("rank", "dense_rank", "percent_rank") for s in specs.values()):
        local |= {"_w_rank": rank(), "_w_dense": dense_rank()}
    path = scratch_path(spark, "chunks")
    cut.withColumns(_local_columns([*keys, "_w_chunk"], order, tiebreak, local)).write.parquet(path)
    staged = spark.read.parquet(path)

    carry = _carry(staged, keys, order, specs)
    carry = carry.withColumnsRenamed({c: f"_k_{c}" for c in (*keys, "_w_chunk")})
    match = F.col("_w_chunk") == F.col("_k__w_chunk")
    for key in keys:
        match &= F.col(key).eqNullSafe(F.col(f"_k_{key}"))
    # At most two rows per chunk, so the size of the broadcast is bounded by the chunk count.
    joined = staged.join(F.broadcast(carry), match, "left")
    offset = F.coalesce(F.col("_w_offset"), F.lit(0))
    size = F.coalesce(F.col("_w_total"), F.col("_w_n"))
    position = F.col("_w_rn") + offset
    out = [F.col(c) for c in df.columns]
    for name, spec in specs.items():
        here = F.col(f"_w_l_{name}")
        carried = F.col(f"_w_c_{name}")
        if spec.kind == "row_number":
            value = position
        elif spec.kind == "group_size":
            value = size
        elif spec.kind == "rank":
            value = _global_rank(offset)
        elif spec.kind == "dense_rank":
            value = F.col("_w_dense") + F.coalesce(F.col("_w_dense_offset"), F.lit(0))
        elif spec.kind == "percent_rank":
            value = F.when(size > 1, (_global_rank(offset) - 1) / (size - 1)).otherwise(0.0)
        elif spec.kind == "ntile":
            value = _tile(position, size, spec.n)
        elif spec.kind == "sum":
            value = F.coalesce(here + carried, here, carried)
        elif spec.kind == "max":
            value = F.greatest(here, carried)
        elif spec.kind == "lag":
            value = F.when(F.col("_w_rn") == 1, carried).otherwise(here)
        elif spec.kind == "lead":
            value = F.when(F.col("_w_rn") == F.col("_w_n"), carried).otherwise(here)
        else:
            value = F.coalesce(here, carried)
        out.append(value.alias(name))
    return joined.select(*out)


def _global_rank(offset: Column) -> Column:
    """Rank in the whole group: peers of a chunk's first row may have begun in an earlier chunk."""
    return F.when((F.col("_w_dense") == 1) & F.col("_w_lead_start").isNotNull(),
                  F.col("_w_lead_start")).otherwise(F.col("_w_rank") + offset)


def _tile(position: Column, size: Column, n: int) -> Column:
    small = F.floor(size / n)
    extra = size % n
    edge = extra * (small + 1)
    return F.when(position <= edge, F.ceil(position / (small + 1))).otherwise(
        extra + F.ceil((position - edge) / F.greatest(small, F.lit(1)))
    ).cast("bigint")


def _carry(staged: DataFrame, keys: list, order: list, specs: dict[str, Spec]) -> DataFrame:
    """What the other chunks of a group contribute, for groups that span several chunks."""
    first_row, last_row = F.col("_w_rn") == 1, F.col("_w_rn") == F.col("_w_n")
    ranked = any(s.kind in ("rank", "dense_rank", "percent_rank") for s in specs.values())
    measures = [F.max("_w_n").alias("_w_size")]
    if ranked:
        peers = F.struct(*_names(order))
        measures += [F.max(F.when(first_row, peers)).alias("_w_first"),
                     F.max(F.when(last_row, peers)).alias("_w_last"),
                     F.max("_w_rank").alias("_w_last_start"), F.max("_w_dense").alias("_w_distinct")]
    for name, spec in specs.items():
        edge = {"sum": last_row, "max": last_row, "fill": last_row,
                "lag": last_row, "lead": first_row}.get(spec.kind)
        if edge is not None:
            source = spec.column if spec.kind in ("lag", "lead") else f"_w_l_{name}"
            measures.append(F.max(F.when(edge, F.struct(F.col(source).alias("v")))).alias(f"_w_e_{name}"))
    summary = staged.groupBy(*keys, "_w_chunk").agg(*measures)

    whole = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    ordered = whole.orderBy("_w_chunk")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        summary.withColumn("_w_pieces", F.count(F.lit(1)).over(whole))
        .filter(F.col("_w_pieces") > 1)
        .withColumns({
            "_w_offset": F.coalesce(F.sum("_w_size").over(before), F.lit(0)),
            "_w_total": F.sum("_w_size").over(whole),
        })
    )
    if ranked:
        carry = carry.withColumn(
            "_w_continues", F.col("_w_first").eqNullSafe(F.lag("_w_last").over(ordered))
            & F.lag("_w_chunk").over(ordered).isNotNull())
        # Where the run of peers that ends this chunk began, unless it began even earlier.
        own_start = F.when(F.col("_w_distinct") > 1, F.col("_w_offset") + F.col("_w_last_start")).when(
            ~F.col("_w_continues"), F.col("_w_offset") + 1)
        carry = carry.withColumn("_w_run_start", own_start).withColumns({
            "_w_lead_start": F.when(
                F.col("_w_continues"), F.last("_w_run_start", ignorenulls=True).over(before)),
            "_w_dense_offset": F.coalesce(F.sum("_w_distinct").over(before), F.lit(0))
            - F.sum(F.col("_w_continues").cast("bigint")).over(
                ordered.rowsBetween(Window.unboundedPreceding, 0)),
        })
    for name, spec in specs.items():
        edge = F.col(f"_w_e_{name}.v") if f"_w_e_{name}" in summary.columns else None
        carried = {
            "sum": lambda: F.sum(edge).over(before),
            "max": lambda: F.max(edge).over(before),
            "fill": lambda: F.last(edge, ignorenulls=True).over(before),
            "lag": lambda: F.lag(edge).over(ordered),
            "lead": lambda: F.lead(edge).over(ordered),
        }.get(spec.kind)
        if carried:
            carry = carry.withColumn(f"_w_c_{name}", carried())
    kept = [c for c in carry.columns if c in (*keys, "_w_chunk", "_w_offset", "_w_total", "_w_lead_start",
                                              "_w_dense_offset") or c.startswith("_w_c_")]
    return carry.select(*kept)


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[OrderKey], n: int,
                  name: str = "rank", ties: bool = True, **window_options) -> DataFrame:
    """Rows ranked within the first ``n`` of their group.

    The filter on the rank lets Spark keep only each task's own best rows before the shuffle
    (WindowGroupLimit), so a large group never travels whole. Spark does so up to ``GROUP_LIMIT``;
    beyond it the rank comes from ``with_windows``.
    """
    if n > GROUP_LIMIT:
        ranked = with_windows(df, keys, order, {name: rank() if ties else row_number()}, **window_options)
        return ranked.filter(F.col(name) <= n)
    w = Window.partitionBy(*keys).orderBy(*_sort_columns(order))
    ranked = (F.rank() if ties else F.row_number()).over(w)
    return df.withColumn(name, ranked).filter(F.col(name) <= n).withColumn(
        name, F.col(name).cast("bigint"))


def best_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[OrderKey]) -> DataFrame:
    """The first row of each key in a total order, cut down per task before the shuffle."""
    return top_per_group(df, keys, order, 1, name="_rn", ties=False).drop("_rn")


def nth_row(df: DataFrame, keys: Sequence[str], order: Sequence[OrderKey], n: int) -> DataFrame:
    """The ``n``-th row of each key; tasks forward at most ``n`` rows per key to the shuffle."""
    first = top_per_group(df, keys, order, n, name="_rn", ties=False)
    return first.filter(F.col("_rn") == n).drop("_rn")
