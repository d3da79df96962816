"""Column expressions shared by the operators; all of them stay in the JVM."""

from ringsight.functions.columns import (
    age_decay,
    clamp01,
    days_between,
    has_any_text,
    hour_bin,
    hour_of_day,
    joined_or,
    micros,
    subnet24,
)

__all__ = [
    "age_decay",
    "clamp01",
    "days_between",
    "has_any_text",
    "hour_bin",
    "hour_of_day",
    "joined_or",
    "micros",
    "subnet24",
]
