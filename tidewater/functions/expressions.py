"""Reusable column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


#: Decimal places that a sum of parts, taken in any order, still gets right.
EXACT_DIGITS = 10


def steady(value: Column, digits: int) -> Column:
    """Round an average or ratio to ``digits`` places, halves away from zero.

    Partial sums arrive in any order, which moves the last bits of a mean. Those go first, by
    rounding to ten places; the value that is left is rounded as a decimal number. Null stays null.
    """
    return F.round(F.round(value, EXACT_DIGITS), digits)


def means(columns: dict[str, str], digits: int = 2) -> list[Column]:
    """One rounded average per entry of {output name: input column}."""
    return [steady(F.avg(source), digits).alias(name) for name, source in columns.items()]


def banded(value: Column, bands: Sequence[tuple[float, str]], otherwise: str,
           null_label: str | None = None) -> Column:
    """Label of the first band whose upper bound exceeds ``value``.

    ``null_label`` names the label for a missing value; without it a missing value gets the
    ``otherwise`` label, as an ordered CASE WHEN would give.
    """
    expr = F.lit(otherwise)
    for upper, label in reversed(list(bands)):
        expr = F.when(value < upper, label).otherwise(expr)
    if null_label is not None:
        expr = F.when(value.isNull(), null_label).otherwise(expr)
    return expr


def minutes_between(start: Column, end: Column, digits: int | None = None) -> Column:
    """Whole seconds between two timestamps, in minutes."""
    minutes = (F.unix_timestamp(end) - F.unix_timestamp(start)) / F.lit(60.0)
    return minutes if digits is None else steady(minutes, digits)


def safe_ratio(numerator: Column, denominator: Column, scale: float = 1.0,
               digits: int | None = None, default: float | None = None) -> Column:
    """``scale * numerator / denominator``, or ``default`` where the denominator is not positive."""
    ratio = F.when(denominator > 0, numerator / denominator * F.lit(scale))
    if digits is not None:
        ratio = steady(ratio, digits)
    return ratio if default is None else F.coalesce(ratio, F.lit(default))


def ratio_of_sums(numerator: Column, denominator: Column, scale: float = 100.0,
                  digits: int = 2) -> Column:
    """Aggregate ratio that is null when the denominator sums to zero."""
    return F.round(F.sum(numerator) / F.nullif(F.sum(denominator), F.lit(0.0)) * scale, digits)


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts).cast("bigint")


def day_of_week(ts: Column) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(ts).cast("bigint")


def weekend_flag(ts: Column) -> Column:
    return F.dayofweek(ts).isin(1, 7).cast("bigint")


def time_feature_columns(ts: Column) -> dict[str, Column]:
    return {
        "hour_of_day": hour_of_day(ts),
        "day_of_week": day_of_week(ts),
        "is_weekend": weekend_flag(ts),
    }


def speed(distance: Column, minutes: Column, digits: int = 1) -> Column:
    """Distance per hour; a small constant keeps zero-length trips finite."""
    return steady(distance / (minutes / 60 + 0.001), digits)


def pseudonym(identifier: Column) -> Column:
    """Stable MD5 pseudonym of an identifier."""
    return F.md5(identifier.cast("string"))


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def yes_no_label(text: Column) -> Column:
    """1.0 for a yes (any case, surrounding blanks ignored), the value of a number or of text that
    reads as one, null for null, 0.0 for all other text."""
    plain = F.lower(F.trim(text.cast("string")))
    return F.when(plain == "yes", 1.0).when(plain.isNotNull(), F.coalesce(plain.try_cast("double"), F.lit(0.0)))


def parse_event_time(text: Column, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Timestamp of a string; text that does not parse becomes null instead of raising."""
    return F.try_to_timestamp(text, F.lit(pattern))


def hash_percent(key: Column, buckets: int = 100) -> Column:
    """Bucket 0..buckets-1 of a key from its MD5, independent of partitioning and engine."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 7), 16, 10).cast("bigint") % buckets


def salt_of(columns: Sequence[Column], salts: int | Column) -> Column:
    """Deterministic salt 0..salts-1; a retried task reproduces it, unlike ``rand``."""
    return F.pmod(F.xxhash64(*columns), salts if isinstance(salts, Column) else F.lit(salts)).cast("int")


def all_of(predicates: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, predicates)
