"""Explain decisions, keep them as log entries, and look them up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringsight.config import DEFAULT, Settings
from ringsight.functions import joined_or
from ringsight.operators.fusion import DECISION, EVIDENCE
from ringsight.sources.tables import audit_bucket


# The published wording of reasons.
BLOCKED, FLAGGED, LOGGED = "blocked", "flagged for review", "logged"
FEATURE_TEXT = "%s (%s)"
RULES_TEXT = "Triggered hard rules (%s)"
MODEL_TEXT = "Suspicious behavior detected by ML model"
LAYER1_TEXT = "Transaction %s: %s. Top contributing features were %s."
LAYER2_TEXT = "Transaction %s: account belongs to %s (%s accounts sharing %s; %s)."
NO_SIGNALS = "weak proximity signals"
NO_FLAGS = "general suspicious synchrony"


def _verb(action: Column) -> Column:
    return F.when(action == "block", BLOCKED).when(action == "flag_for_review", FLAGGED).otherwise(LOGGED)


def _filled(wording: str, *values: Column) -> Column:
    """The wording with its `%s` filled in, a missing value as "null"; unlike `format_string` it parses no pattern per row."""
    first, *rest = wording.split("%s")
    parts = [F.lit(first)]
    for value, text in zip(values, rest, strict=True):
        parts += [F.coalesce(value.cast("string"), F.lit("null")), F.lit(text)]
    return F.concat(*parts)


def layer1_explanation(action: Column, rules: Column, top: Column) -> Column:
    named = F.transform(top, lambda t: _filled(FEATURE_TEXT, t["feature"], t["contribution"]))
    cause = F.when(
        F.size(rules) > 0, _filled(RULES_TEXT, F.array_join(rules, ", "))
    ).otherwise(MODEL_TEXT)
    return _filled(
        LAYER1_TEXT, _verb(action), cause, F.array_join(named, ", ")
    )


def layer2_explanation(action: Column, cluster_id: Column, size: Column, signals: Column, flags: Column) -> Column:
    return _filled(
        LAYER2_TEXT,
        _verb(action),
        cluster_id,
        size,
        joined_or(signals, NO_SIGNALS),
        joined_or(flags, NO_FLAGS),
    )


def log_entries(fused: DataFrame, layer1: DataFrame, scored: DataFrame) -> DataFrame:
    """One log entry per decision that has a layer-1 row. Decisions that kept their evidence need no join to find it.

    The cluster speaks when its score is at least the transaction's, else the transaction's own evidence.
    """
    clusters = scored.select(F.col("cluster_id").alias("ring_membership"), "size", "shared_signals", "flags")
    if any(column not in fused.columns for column in EVIDENCE):
        fused = fused.select(*DECISION).join(layer1.select("txn_id", *EVIDENCE), "txn_id")
    rows = fused.join(clusters, "ring_membership", "left")
    by_ring = (F.coalesce("ring_score", F.lit(0.0)) >= F.col("layer1_score")) & F.col("size").isNotNull()
    act = F.col("action")
    text = F.when(
        by_ring, layer2_explanation(act, F.col("ring_membership"), F.col("size"), F.col("shared_signals"), F.col("flags"))
    ).otherwise(layer1_explanation(act, F.col("triggered_rules"), F.col("top_features")))
    return rows.select(
        "txn_id",
        F.current_timestamp().alias("timestamp"),
        "layer1_score",
        F.col("triggered_rules").alias("layer1_triggers"),
        "ring_membership",
        "ring_score",
        "final_score",
        act.alias("action_taken"),
        text.alias("explanation"),
    )


def audit_trail(log: DataFrame, txn_id: str, cfg: Settings = DEFAULT) -> DataFrame:
    """The first entry of a transaction, or no row; of entries at one time the least by action and text.

    In the published layout only the files of the transaction's bucket are read.
    """
    if "bucket" in log.columns:
        log = log.where(F.col("bucket") == audit_bucket(F.lit(txn_id), cfg))
    return log.where(F.col("txn_id") == txn_id).orderBy("timestamp", "action_taken", "explanation").limit(1)


def cluster_history(log: DataFrame, cluster_id: str) -> DataFrame:
    """Every entry of a cluster."""
    return log.where(F.col("ring_membership") == cluster_id)


def last_decisions(log: DataFrame, n: int = 5) -> DataFrame:
    return log.orderBy(F.col("timestamp").desc(), F.col("txn_id").desc()).limit(n)


def action_counts(log: DataFrame) -> DataFrame:
    return log.groupBy("action_taken").agg(F.count(F.lit(1)).alias("decisions"))


def score_histogram(log: DataFrame, bins: int = 50) -> DataFrame:
    """Rows per equal-width bin of the layer-1 score on [0, 1]; 1.0 belongs to the last bin."""
    edge = F.least(F.floor(F.col("layer1_score") * bins), F.lit(bins - 1)).cast("int")
    return log.groupBy(edge.alias("bin")).agg(F.count(F.lit(1)).alias("decisions"))


def actions_per_minute(log: DataFrame) -> DataFrame:
    return (
        log.groupBy(F.window("timestamp", "1 minute").alias("w"), "action_taken")
        .agg(F.count(F.lit(1)).alias("decisions"))
        .select(F.col("w.start").alias("minute"), "action_taken", "decisions")
    )
