"""Named rules as boolean columns with a weight each."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringsight.config import DEFAULT, Settings


@dataclass(frozen=True)
class Rule:
    name: str
    fires: Callable[[Settings], Column]


def _yes(condition: Column) -> Column:
    """Unknown is "does not fire"."""
    return F.coalesce(condition, F.lit(False))


def card_testing(cfg: Settings) -> Column:
    return _yes((F.col("velocity_1min") > cfg.card_testing_velocity) & (F.col("amount") < cfg.card_testing_amount))


def high_deviation(cfg: Settings) -> Column:
    return _yes((F.col("amount_zscore") > cfg.deviation_zscore) & ~F.col("geo_device_consistency"))


def odd_hour_new_category(cfg: Settings) -> Column:
    return _yes(F.col("is_unusual_hour") & F.col("is_new_merchant_category"))


RULES = (
    Rule("card_testing_flag", card_testing),
    Rule("high_deviation_flag", high_deviation),
    Rule("odd_hour_new_category_flag", odd_hour_new_category),
)


def evaluate_rules(features: DataFrame, cfg: Settings = DEFAULT, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Adds `triggered_rules` (names in rule order) and `rule_score`; a rule without a weight counts nothing."""
    weights = [cfg.rule_weights.get(r.name, 0.0) for r in rules]
    hits = [r.fires(cfg) for r in rules]
    names = F.array_compact(F.array(*[F.when(hit, r.name) for r, hit in zip(rules, hits)])) if rules else F.array().cast("array<string>")
    total = F.lit(0.0)
    override = F.lit(False)
    for hit, weight in zip(hits, weights):
        total = total + F.when(hit, weight).otherwise(0.0)
        if weight >= 1.0:
            override = override | hit
    score = F.when(override, 1.0).otherwise(F.least(F.lit(1.0), total))
    return features.withColumns({"rule_score": score, "triggered_rules": names})
