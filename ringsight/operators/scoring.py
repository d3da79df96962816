"""Score groups of accounts: registration age, activity in step, shared identifiers, missing KYC, bad outcomes.

Transactions are first reduced to one row per account and hour. That row count is bounded by accounts times hours, so an
account, or a cluster, with a third of all transactions costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringsight.config import DEFAULT, Settings
from ringsight.functions import age_decay, clamp01, has_any_text, hour_bin, micros
from ringsight.functions.columns import MICROS_PER_HOUR
from ringsight.session import materialize

# Words that mark a bad outcome; the score cut-offs and names of the flags, in reporting order.
BAD_STATUS = ("fail", "refund", "disput")
FLAGS = (
    ("age_homogeneity", 0.8, "synchronized_registration"),
    ("synchrony", 0.7, "high_behavioral_synchrony"),
    ("identifier_density", 0.7, "dense_identifier_sharing"),
    ("kyc_lack", 0.8, "low_kyc_verification"),
    ("financial_behavior", 0.8, "concentrated_refund_activity"),
)


def hourly_activity(transactions: DataFrame) -> DataFrame:
    """(account_id, hour, n, bad)."""
    bad = has_any_text(F.col("status"), BAD_STATUS)
    return transactions.groupBy("account_id", hour_bin(F.col("timestamp")).alias("hour")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("bad")
    )


def age_homogeneity(mapping: DataFrame, accounts: DataFrame, cfg: Settings = DEFAULT) -> DataFrame:
    hours = micros(F.col("created_at")) / MICROS_PER_HOUR
    spread = F.stddev_samp(hours)
    return _grouped(mapping, accounts, "age_homogeneity", F.coalesce(age_decay(spread, cfg.age_decay_hours), F.lit(0.0)))


def kyc_lack(mapping: DataFrame, accounts: DataFrame) -> DataFrame:
    return _grouped(mapping, accounts, "kyc_lack", F.coalesce(1 - F.avg(F.col("kyc_verified").cast("int")), F.lit(0.0)))


def _grouped(mapping: DataFrame, accounts: DataFrame, name: str, value) -> DataFrame:
    return mapping.join(accounts, "account_id").groupBy("cluster_id").agg(value.alias(name))


def synchrony(mapping: DataFrame, activity: DataFrame) -> DataFrame:
    """Mean Pearson correlation of the members' hourly counts, over the hours in which any member is active.

    All pairs at once: with every member scaled to zero mean and unit length, the squared length of their sum is the member
    count plus twice the sum of all pair correlations. Members whose counts never vary have no correlation and are left out.
    """
    rows = activity.select("account_id", "hour", "n").join(mapping, "account_id")
    hours = rows.groupBy("cluster_id", "hour").agg(F.lit(1).alias("one")).groupBy("cluster_id").agg(F.count("one").alias("hours"))
    # squares as decimals: exact, and no overflow for an account with billions of rows in an hour
    count = F.col("n").cast("decimal(12,0)")
    sums = rows.groupBy("cluster_id", "account_id").agg(
        F.sum("n").alias("sx"), F.sum(count * count).cast("decimal(28,0)").alias("sxx")
    )
    sx = F.col("sx").cast("decimal(18,0)")
    varies = F.col("hours").cast("decimal(9,0)") * F.col("sxx") != sx * sx
    scaled = (
        sums.join(hours, "cluster_id")
        .where(varies)
        .withColumn("length", F.sqrt(F.col("sxx").cast("double") - F.col("sx") * (F.col("sx") / F.col("hours"))))
    )
    centre = scaled.groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("k"), F.sum(F.col("sx") / F.col("hours") / F.col("length")).alias("centre")
    )
    # every active hour counts, also those in which only constant members are active
    per_hour = (
        rows.join(scaled.select("account_id", "length"), "account_id", "left")
        .groupBy("cluster_id", "hour")
        .agg(F.coalesce(F.sum(F.col("n") / F.col("length")), F.lit(0.0)).alias("s"))
    )
    off = F.col("s") - F.col("centre")
    k = F.col("k")
    mean_r = (F.col("ss") - k) / (k * (k - 1))
    return (
        per_hour.join(centre, "cluster_id")
        .groupBy("cluster_id", "k")
        .agg(F.sum(off * off).alias("ss"))
        .where(k > 1)
        .select("cluster_id", clamp01(mean_r).alias("synchrony"))
    )


def identifier_density(summary: DataFrame, cfg: Settings = DEFAULT) -> DataFrame:
    share = F.size("shared_types") / F.lit(float(len(cfg.link_weights)))
    return summary.select("cluster_id", F.least(share, F.lit(1.0)).alias("identifier_density"))


def financial_behavior(mapping: DataFrame, activity: DataFrame) -> DataFrame:
    """How far the cluster's share of bad outcomes is above everyone's: 1x scores 0, 5x and more scores 1."""
    everyone = activity.agg((F.sum("bad") / F.sum("n")).alias("rate")).scalar()
    base = F.coalesce(F.nullif(everyone, F.lit(0.0)), F.lit(0.01))
    rates = (
        activity.join(mapping, "account_id")
        .groupBy("cluster_id")
        .agg((F.sum("bad") / F.sum("n")).alias("rate"))
    )
    return rates.select("cluster_id", clamp01((F.col("rate") / base - 1.0) / 4.0).alias("financial_behavior"))


def score_clusters(
    mapping: DataFrame, summary: DataFrame, accounts: DataFrame, transactions: DataFrame, cfg: Settings = DEFAULT
) -> DataFrame:
    """(cluster_id, size, shared_signals, five sub-scores, ring_score, flags), one row per cluster."""
    activity = materialize(hourly_activity(transactions), "hourly-activity")
    parts = [
        age_homogeneity(mapping, accounts, cfg),
        synchrony(mapping, activity),
        identifier_density(summary, cfg),
        kyc_lack(mapping, accounts),
        financial_behavior(mapping, activity),
    ]
    scored = summary.select("cluster_id", "size", F.col("shared_types").alias("shared_signals"))
    for part in parts:
        scored = scored.join(part, "cluster_id", "left")
    names = list(cfg.cluster_weights)
    scored = scored.select(
        "cluster_id", "size", "shared_signals", *[F.coalesce(n, F.lit(0.0)).alias(n) for n in names]
    )
    return ring_score(scored, cfg)


def ring_score(scored: DataFrame, cfg: Settings = DEFAULT) -> DataFrame:
    total = sum((F.col(n) * w for n, w in cfg.cluster_weights.items()), F.lit(0.0))
    flags = F.array_compact(F.array(*[F.when(F.col(name) > cut, flag) for name, cut, flag in FLAGS]))
    return scored.withColumns({"ring_score": F.round(total, 4), "flags": flags})


def cluster_output(scored: DataFrame, lists: DataFrame) -> DataFrame:
    """The published cluster rows with their members; `lists` is `components.member_lists`."""
    return scored.join(lists, "cluster_id").select(
        "cluster_id", "size", "member_accounts", "ring_score", "shared_signals", "flags"
    )
