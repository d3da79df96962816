"""Measure decisions against labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringsight.config import DEFAULT, Settings
from ringsight.functions import hour_bin
from ringsight.session import materialize


def labelled(log: DataFrame, transactions: DataFrame) -> DataFrame:
    """Log entries with the true label and the account."""
    return log.join(transactions.select("txn_id", "label_fraud", "account_id"), "txn_id", "left")


def uplift(rows: DataFrame, cfg: Settings = DEFAULT) -> DataFrame:
    """One row: frauds, those layer 1 caught, those only layer 2 caught, and layer 2's false alarms."""
    fraud = F.col("label_fraud")
    first = F.col("layer1_score") >= cfg.review_threshold
    only_second = ~first & (F.col("final_score") >= cfg.review_threshold)
    return rows.agg(
        F.count_if(fraud).alias("total_fraud_test_set"),
        F.count_if(fraud & first).alias("caught_layer1"),
        F.count_if(fraud & only_second).alias("caught_layer2_only"),
        F.count_if(~fraud & only_second).alias("false_positives_layer2"),
    )


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, 0.0).otherwise(part / whole)


def decision_counts(rows: DataFrame, accounts: DataFrame | None = None, cfg: Settings = DEFAULT) -> DataFrame:
    """(score, block, review, flagged, label_fraud, ambiguous, n): all that the metrics need to know about the decisions.

    One pass. Layer-1 scores have four digits, so there are at most 10,001 scores times a few flags, however many rows.
    """
    ambiguous = F.lit(False)
    if accounts is not None:
        known = accounts.where("is_ambiguous").select(F.col("account_id").alias("ambiguous_id")).distinct()
        rows = rows.join(known, rows["account_id"] == F.col("ambiguous_id"), "left")
        ambiguous = F.col("ambiguous_id").isNotNull()
    score = F.col("layer1_score")
    return rows.groupBy(
        F.round(score, 4).alias("score"),
        (score >= cfg.block_threshold).alias("block"),
        (score >= cfg.review_threshold).alias("review"),
        (F.col("final_score") >= cfg.review_threshold).alias("flagged"),
        "label_fraud",
        ambiguous.alias("ambiguous"),
    ).agg(F.count(F.lit(1)).alias("n"))


def _sum(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))


def tier_metrics(rows: DataFrame, cfg: Settings = DEFAULT) -> DataFrame:
    """(tier, precision, recall, f1) of the layer-1 score at both thresholds; an empty denominator gives 0."""
    return _tiers(decision_counts(rows, None, cfg))


def _tiers(counts: DataFrame) -> DataFrame:
    tiers = F.array(*[F.struct(F.lit(t).alias("tier"), F.col(t).alias("hit")) for t in ("block", "review")])
    hit = F.col("t.hit")
    sums = (
        counts.select("label_fraud", "n", F.explode(tiers).alias("t"))
        .groupBy(F.col("t.tier").alias("tier"))
        .agg(_sum(hit & F.col("label_fraud")).alias("tp"), _sum(hit).alias("flagged"), _sum(F.col("label_fraud")).alias("frauds"))
    )
    return sums.select(
        "tier",
        _ratio(F.col("tp"), F.col("flagged")).alias("precision"),
        _ratio(F.col("tp"), F.col("frauds")).alias("recall"),
        _ratio(2 * F.col("tp"), F.col("flagged") + F.col("frauds")).alias("f1"),
    )


def roc_auc(rows: DataFrame) -> DataFrame:
    """One row: the chance that a fraud scores above a legitimate row, ties counting half.

    Scores are rounded to four digits, so the window runs over at most 10,001 rows.
    """
    counted = rows.groupBy(F.round("layer1_score", 4).alias("score"), "label_fraud").agg(F.count(F.lit(1)).alias("n"))
    return _auc(counted)


def _auc(counts: DataFrame) -> DataFrame:
    by_score = counts.groupBy("score").agg(
        _sum(F.col("label_fraud")).cast("double").alias("pos"), _sum(~F.col("label_fraud")).cast("double").alias("neg")
    )
    below = Window.orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    wins = F.col("pos") * (F.coalesce(F.sum("neg").over(below), F.lit(0.0)) + F.col("neg") / 2)
    ranked = by_score.select("pos", "neg", wins.alias("wins"))
    return ranked.agg((F.sum("wins") / F.nullif(F.sum("pos") * F.sum("neg"), F.lit(0.0))).alias("roc_auc"))


def ring_recovery(accounts: DataFrame, mapping: DataFrame, scored: DataFrame, cfg: Settings = DEFAULT) -> DataFrame:
    """(ring_id, members, found, clusters, outcome) for every true ring."""
    flagged = mapping.join(
        scored.where(F.col("ring_score") >= cfg.review_threshold).select("cluster_id"), "cluster_id", "left_semi"
    )
    members = accounts.where(F.col("label_ring_member") & F.col("ring_id").isNotNull()).select("ring_id", "account_id")
    # one row per ring and cluster first, so a hot ring is combined before it is counted
    by_cluster = (
        members.join(flagged, "account_id", "left").groupBy("ring_id", "cluster_id").agg(F.count(F.lit(1)).alias("n"))
    )
    counts = by_cluster.groupBy("ring_id").agg(
        F.sum("n").alias("members"),
        F.coalesce(F.sum(F.when(F.col("cluster_id").isNotNull(), F.col("n"))), F.lit(0)).alias("found"),
        F.count("cluster_id").alias("clusters"),
    )
    whole = (F.col("found") == F.col("members")) & (F.col("clusters") == 1)
    return counts.withColumn("outcome", F.when(whole, "full").when(F.col("found") > 0, "partial").otherwise("missed"))


def ambiguous_friction(rows: DataFrame, accounts: DataFrame, cfg: Settings = DEFAULT) -> DataFrame:
    """One row: legitimate rows of ambiguous accounts, those flagged, and the share in percent."""
    return _friction(decision_counts(rows, accounts, cfg))


def _friction(counts: DataFrame) -> DataFrame:
    legit = ~F.col("label_fraud") & F.col("ambiguous")
    total, flagged = _sum(legit), _sum(legit & F.col("flagged"))
    return counts.agg(
        total.alias("legit_rows"), flagged.alias("flagged_rows"), (_ratio(flagged, total) * 100).alias("friction_percent")
    )


def _ambiguous_legit(rows: DataFrame, accounts: DataFrame) -> DataFrame:
    ambiguous = accounts.where("is_ambiguous").select("account_id")
    return rows.where(~F.col("label_fraud")).join(ambiguous, "account_id", "left_semi")


def exemplars(rows: DataFrame, accounts: DataFrame, cfg: Settings = DEFAULT) -> DataFrame:
    """At most one log entry of each kind: a plain layer-1 case, a layer-2 escalation, an ambiguous false alarm."""
    score, ring = F.col("layer1_score"), F.col("ring_score")
    cases = {
        "layer1_block": rows.where((score >= cfg.block_threshold) & ring.isNull()),
        "layer2_escalation": rows.where((score < cfg.review_threshold) & (ring >= cfg.review_threshold)),
        "ambiguous_false_positive": _ambiguous_legit(rows, accounts).where(F.col("final_score") >= cfg.review_threshold),
    }
    picked = None
    for name, found in cases.items():
        first = found.orderBy("timestamp", "txn_id").limit(1).select(F.lit(name).alias("example"), *rows.columns)
        picked = first if picked is None else picked.unionByName(first)
    return picked


def evaluation_table(
    rows: DataFrame, accounts: DataFrame, mapping: DataFrame, scored: DataFrame, cfg: Settings = DEFAULT
) -> DataFrame:
    """Every figure of the report in one long table (metric, tier, value). The decisions are read once."""
    counts = materialize(decision_counts(rows, accounts, cfg), "decision-counts")

    def melt(df: DataFrame, tier: Column, names: list[str]) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names])
        return df.select(tier.alias("tier"), F.explode(pairs).alias("p")).select("p.metric", "tier", "p.value")

    every = F.lit("all")
    rings = ring_recovery(accounts, mapping, scored, cfg).agg(
        *[F.count_if(F.col("outcome") == o).alias(f"rings_{o}") for o in ("full", "partial", "missed")]
    )
    return (
        melt(_tiers(counts), F.col("tier"), ["precision", "recall", "f1"])
        .unionByName(melt(_auc(counts), every, ["roc_auc"]))
        .unionByName(melt(rings, every, ["rings_full", "rings_partial", "rings_missed"]))
        .unionByName(melt(_friction(counts), every, ["legit_rows", "flagged_rows", "friction_percent"]))
    )


def clusters_by_score(scored: DataFrame) -> DataFrame:
    return scored.orderBy(F.col("ring_score").desc(), "cluster_id")


def synchrony_timeline(transactions: DataFrame, mapping: DataFrame, cluster_id: str) -> DataFrame:
    """(hour, account_id, n) for the members of one cluster."""
    members = mapping.where(F.col("cluster_id") == cluster_id).select("account_id")
    return (
        transactions.join(members, "account_id", "left_semi")
        .groupBy(hour_bin(F.col("timestamp")).alias("hour"), "account_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def score_separation(mapping: DataFrame, scored: DataFrame, accounts: DataFrame) -> DataFrame:
    """One row: mean score of clusters that are mostly ring accounts, and of the other clusters with company."""
    ring = F.col("label_ring_member")
    shares = (
        mapping.join(accounts.select("account_id", "label_ring_member"), "account_id")
        .groupBy("cluster_id")
        .agg((F.count_if(ring) > F.count(F.lit(1)) * 0.5).alias("mostly_ring"))
    )
    rows = scored.join(shares, "cluster_id")
    benign = ~F.col("mostly_ring") & (F.col("size") > 1)
    return rows.agg(
        F.count_if("mostly_ring").alias("ring_clusters"),
        F.coalesce(F.avg(F.when(F.col("mostly_ring"), F.col("ring_score"))), F.lit(0.0)).alias("ring_mean"),
        F.count_if(benign).alias("benign_clusters"),
        F.coalesce(F.avg(F.when(benign, F.col("ring_score"))), F.lit(0.0)).alias("benign_mean"),
    )


def component_recovery(components: DataFrame, accounts: DataFrame, smallest_ring: int = 4) -> DataFrame:
    """One row: ring accounts, those in too small a component, and ring-free components of two or three."""
    rows = components.join(accounts.select("account_id", "label_ring_member"), "account_id")
    per = rows.groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("size"), F.count_if("label_ring_member").alias("ring_accounts")
    )
    small = F.col("size") < smallest_ring
    return per.agg(
        F.sum("ring_accounts").alias("ring_accounts"),
        F.coalesce(F.sum(F.when(small, F.col("ring_accounts"))), F.lit(0)).alias("in_small_component"),
        F.count_if((F.col("ring_accounts") == 0) & F.col("size").between(2, 3)).alias("benign_small_components"),
    )


def recovered_sizes(components: DataFrame, accounts: DataFrame) -> DataFrame:
    """(size, ring_accounts): how large the components are that ring accounts ended up in."""
    rows = components.join(accounts.select("account_id", "label_ring_member"), "account_id")
    per = rows.groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("size"), F.count_if("label_ring_member").alias("ring_accounts")
    )
    return per.where(F.col("ring_accounts") > 0).groupBy("size").agg(F.sum("ring_accounts").alias("ring_accounts")).orderBy("size")
