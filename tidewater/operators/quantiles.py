"""Exact quantiles from a small sketch and one refining pass."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.layout import persisted
from tidewater.operators.windows import running_sum, with_windows

#: Size parameter of the sketches; the largest that Spark takes.
SKETCH_K = 65_535
#: Half widths of the bracket around a quantile, in shares of all rows. The sketch is off by less than
#: the first in about 94 of 100 cases and by less than the second in practice always.
MARGINS = (5e-5, 1e-3, 1.0)


def exact_quantiles(df: DataFrame, wanted: dict[str, Sequence[float]], k: int = SKETCH_K,
                    margins: Sequence[float] = MARGINS, **window_options) -> dict[str, list[float | None]]:
    """The smallest value whose share of rows up to it reaches each probability, per column.

    A mergeable KLL sketch per column brackets every quantile; its size depends on ``k``, not on the
    table. A second pass keeps the values inside the brackets with their counts and folds all
    smaller values into one, so a frequent value is one row before the shuffle. A running sum
    then finds the exact position. A bracket that missed its rank is widened and searched again. Only
    some numbers per quantile reach the driver. Nulls and NaN are missing values; a column without
    others gives None.
    """
    sketched, numbers = [], []
    for c, probabilities in wanted.items():
        value = _number(c)
        sketched += [F.count(value).alias(f"n_{c}"), F.kll_sketch_agg_double(value, F.lit(k)).alias(f"s_{c}")]
        edges = [min(max(p + side * m, 0.0), 1.0) for p in probabilities for m in margins[:-1] for side in (-1, 1)]
        asked = F.array(*[F.kll_sketch_get_quantile_double(f"s_{c}", F.lit(e)) for e in edges]) if edges else F.array()
        numbers += [f"n_{c}", F.when(F.col(f"n_{c}") > 0, asked).alias(f"q_{c}")]
    sketch = df.agg(*sketched).select(*numbers).first()

    def bracket(c: str, i: int, p: float, step: int) -> tuple[float, float]:
        if step == len(margins) - 1:
            return -math.inf, math.inf
        at = 2 * (i * (len(margins) - 1) + step)
        low, high = sketch[f"q_{c}"][at:at + 2]
        return low if p > margins[step] else -math.inf, high if p + margins[step] < 1 else math.inf

    waiting = [(c, i, p) for c, ps in wanted.items() for i, p in enumerate(ps) if sketch[f"n_{c}"]]
    found: dict[tuple[str, int], float] = {}
    for step in range(len(margins)):
        targets = [(c, i, max(math.ceil(p * sketch[f"n_{c}"]), 1), *bracket(c, i, p, step)) for c, i, p in waiting]
        found |= _refine(df, targets, window_options)
        waiting = [w for w in waiting if found.get(w[:2]) is None]
        if not waiting:
            break
    return {c: [found.get((c, i)) for i in range(len(ps))] for c, ps in wanted.items()}


def _number(column: str) -> Column:
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)


def _refine(df: DataFrame, targets: list[tuple], window_options: dict) -> dict[tuple[str, int], float]:
    if not targets:
        return {}
    below = F.lit(-math.inf)
    cells = []
    for t, (c, _, _, low, high) in enumerate(targets):
        value = _number(c)
        folded = F.when(value < low, below).otherwise(value)
        cells.append(F.when(value <= high, F.struct(F.lit(t).alias("t"), folded.alias("value"))))
    counted = (
        df.select(F.inline(F.array_compact(F.array(*cells))))
        .groupBy("t", "value").agg(F.count(F.lit(1)).alias("rows"))
    )
    ranks = F.array(*[F.lit(t[2]).cast("bigint") for t in targets])
    with persisted(counted) as kept:
        upto = with_windows(kept, ["t"], ["value"], {"upto": running_sum("rows")}, **window_options)
        picked = upto.filter(F.col("upto") >= ranks[F.col("t")]).groupBy("t").agg(F.min("value").alias("value"))
        rows = picked.collect()
    return {targets[r["t"]][:2]: r["value"] for r in rows
            if r["value"] != -math.inf or targets[r["t"]][3] == -math.inf}
