"""Scalar building blocks as Spark columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_HOUR = 3_600_000_000
MICROS_PER_DAY = 86_400_000_000


def micros(ts: Column) -> Column:
    return F.unix_micros(ts)


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts)


def hour_bin(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def days_between(later: Column, earlier: Column) -> Column:
    """Elapsed days between two microsecond columns, never below zero."""
    return F.greatest(F.lit(0.0), (later - earlier) / F.lit(float(MICROS_PER_DAY)))


def subnet24(ip: Column) -> Column:
    """`a.b.c.0/24` for four dot-separated parts, anything else as it is."""
    parts = F.split(ip, r"\.")
    network = F.concat(F.concat_ws(".", F.slice(parts, 1, 3)), F.lit(".0/24"))
    return F.when(F.size(parts) == 4, network).otherwise(ip)


def has_any_text(text: Column, words: tuple[str, ...]) -> Column:
    """Case-insensitive "contains one of these words"; null text contains none."""
    return F.coalesce(text.rlike("(?i)" + "|".join(words)), F.lit(False))


def clamp01(value: Column) -> Column:
    return F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0))


def age_decay(hours: Column, scale: float) -> Column:
    return F.exp(-hours / F.lit(scale))


def joined_or(items: Column, fallback: str) -> Column:
    """Comma-joined items, or a set phrase when there are none."""
    return F.when(F.coalesce(F.size(items), F.lit(0)) > 0, F.array_join(items, ", ")).otherwise(F.lit(fallback))
