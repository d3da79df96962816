"""Join the transaction score with the score of the account's cluster and decide."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringsight.config import DEFAULT, Settings


def final_score() -> Column:
    return F.greatest(F.col("layer1_score"), F.coalesce("ring_score", F.lit(0.0)))


def action(cfg: Settings = DEFAULT) -> Column:
    return F.when(F.col("final_score") >= cfg.review_threshold, "flag_for_review").otherwise("log_only")


def ring_lookup(mapping: DataFrame, scored: DataFrame) -> DataFrame:
    """(account_id, ring_membership, ring_score): the published table that transactions are looked up in."""
    return mapping.join(scored.select("cluster_id", "ring_score"), "cluster_id", "left").select(
        "account_id", F.col("cluster_id").alias("ring_membership"), "ring_score"
    )


# The published columns of a decision, and the evidence its explanation needs.
DECISION = ("txn_id", "layer1_score", "ring_membership", "ring_score", "final_score", "action")
EVIDENCE = ("triggered_rules", "top_features")


def fuse_scores(
    layer1: DataFrame, transactions: DataFrame, lookup: DataFrame, cfg: Settings = DEFAULT, evidence: bool = False
) -> DataFrame:
    """One decision per layer-1 row; with `evidence`, the layer-1 evidence stays on the row for the log.

    Joined on ids, never on row positions. Layer-1 rows that carry their account skip the join back to `transactions`.
    """
    if "account_id" not in layer1.columns:
        layer1 = layer1.join(transactions.select("txn_id", "account_id"), "txn_id", "left")
    return (
        layer1.join(lookup, "account_id", "left")
        .withColumn("final_score", final_score())
        .withColumn("action", action(cfg))
        .select(*DECISION, *(EVIDENCE if evidence else ()))
    )
