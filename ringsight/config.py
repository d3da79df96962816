"""Every threshold and weight in one immutable object, passed to the operators that need it."""

from __future__ import annotations

from dataclasses import dataclass, field

# The published thresholds, weights and windows the results depend on.
RULE_WEIGHTS = {
    "card_testing_flag": 1.0,
    "high_deviation_flag": 0.8,
    "odd_hour_new_category_flag": 0.6,
}
LINK_WEIGHTS = {
    "device": 1.0,
    "payment_instrument": 1.0,
    "subnet": 1.0,
    "reg_proximity": 0.1,
}
CLUSTER_WEIGHTS = {
    "age_homogeneity": 0.2,
    "synchrony": 0.3,
    "identifier_density": 0.2,
    "kyc_lack": 0.15,
    "financial_behavior": 0.15,
}


@dataclass(frozen=True)
class Settings:
    # transaction rules
    card_testing_velocity: int = 5
    card_testing_amount: float = 50.0
    deviation_zscore: float = 4.0
    unusual_hour_share: float = 0.05
    retry_gap_seconds: int = 300
    rule_weights: dict = field(default_factory=lambda: dict(RULE_WEIGHTS))

    # model
    seed: int = 42
    holdout_percent: int = 20
    trees: int = 100
    learning_rate: float = 0.1
    depth: int = 5
    bins: int = 32
    rule_share: float = 0.4
    override_floor: float = 0.9

    # account graph
    proximity_minutes: int = 360
    link_weights: dict = field(default_factory=lambda: dict(LINK_WEIGHTS))
    recency_bonus: float = 0.5
    recency_days: float = 30.0
    community_min_size: int = 6

    # cluster score
    cluster_weights: dict = field(default_factory=lambda: dict(CLUSTER_WEIGHTS))
    age_decay_hours: float = 12.0

    # decisions
    block_threshold: float = 0.85
    review_threshold: float = 0.5

    # physical limits: none of them changes a result, they only pick the plan
    account_rows_per_task: int = 2_000_000
    feature_rows_per_task: int = 100_000
    broadcast_rows: int = 200_000
    block_members: int = 256
    group_rows: int = 100_000
    audit_buckets: int = 64
    community_links_per_task: int = 1_000_000
    community_block_links: int = 200_000
    training_cells_per_task: int = 20_000
    stream_buckets: int = 1024

    # a gain in modularity below this counts as none
    community_tolerance: float = 1e-7

    @property
    def proximity_micros(self) -> int:
        return self.proximity_minutes * 60_000_000


DEFAULT = Settings()
