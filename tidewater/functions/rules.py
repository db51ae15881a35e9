"""Weighted row rules: scoring and naming the rules a row triggers."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A named predicate with a weight; a null predicate does not trigger."""

    name: str
    weight: int
    predicate: Column


def rule_score(rules: Sequence[Rule]) -> Column:
    """Sum of the weights of the triggered rules."""
    total = F.lit(0)
    for rule in rules:
        total = total + F.when(rule.predicate, rule.weight).otherwise(0)
    return total.cast("bigint")


def triggered_rules(rules: Sequence[Rule]) -> Column:
    """Array of the names of the triggered rules, in rule order."""
    return F.array_compact(F.array(*[F.when(r.predicate, F.lit(r.name)) for r in rules]))


def triggered_rule_names(rules: Sequence[Rule], separator: str = ",") -> Column:
    """The names of the triggered rules as one text; concat_ws skips the others."""
    return F.concat_ws(separator, *[F.when(r.predicate, F.lit(r.name)) for r in rules])


def ride_anomaly_rules() -> list[Rule]:
    """Rules over rides; expects fare, distance, duration_min, hour_of_day, is_airport,
    fare_per_mile and passengers."""
    # Rule names, weights and limits.
    return [
        Rule("OVERCHARGE", 3, (F.col("fare_per_mile") > 10) & (F.col("is_airport") == 0)),
        Rule("LONG_TRIP", 2, F.col("duration_min") > 90),
        Rule("GHOST_RIDE", 3, (F.col("distance") < 0.1) & (F.col("fare") > 15)),
        Rule("LATE_SURGE", 1, (F.col("hour_of_day") < 5) & (F.col("fare") > 80)),
        Rule("OVERLOAD", 2, F.col("passengers") > 6),
    ]


RIDE_ANOMALY_THRESHOLD = 3
