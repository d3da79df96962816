"""Accounts and transactions derived from the `events` table, as stateless projections of it.

Rings of five, families of three, card-testing bursts and off-profile rows are planted by arithmetic on the ids, so the
same two tables can be written in any SQL engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _text(*parts) -> Column:
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])


def _user_columns(u: Column) -> dict[str, Column]:
    ring, family = u % 25 < 5, (u % 25).between(10, 12)
    five, batch = F.floor(u / 5), F.floor(u / 25)
    minute = F.when(ring, five * 7919 % 525600 + (u % 5) * 11).otherwise(u * 104729 % 525600)
    return {
        "account_id": _text("a", u),
        "created_at": F.timestamp_seconds(F.unix_timestamp(F.lit("2023-01-01 00:00:00")) + minute * 60),
        "kyc_verified": F.when(ring, u % 5 == 0).otherwise(u % 10 != 9),
        "registration_device_id": F.when(ring, _text("dr", five))
        .when(family, _text("df", batch))
        .otherwise(_text("d", u)),
        "registration_ip": F.when(ring, _text("10.1.", five % 256, ".", u % 5))
        .when(family, _text("10.2.", batch % 256, ".7"))
        .otherwise(_text("10.", F.floor(u / 256) + 3, ".", u % 256, ".9")),
        "historical_avg_amount": (u % 40 + 30).cast("double"),
        "label_ring_member": ring,
        "ring_id": F.when(ring, _text("ring_", batch)),
        "is_ambiguous": family,
    }


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = events(spark, sf_dir).select("user_id").distinct()
    return users.select(*[c.alias(n) for n, c in _user_columns(F.col("user_id")).items()])


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    u, e, v = F.col("user_id"), F.col("event_id"), F.col("value")
    who = _user_columns(u)
    k = F.get_json_object("props", "$.k").cast("int")
    burst = (F.col("event_type") == "error") & (F.col("k") < 5)
    rows = (
        events(spark, sf_dir)
        .withColumn("k", k)
        .withColumn("i", F.explode(F.sequence(F.lit(0), F.when(burst, 7).otherwise(0))))
    )
    k, i, away = F.col("k"), F.col("i"), F.col("k") >= 90
    purchase = F.col("event_type") == "purchase"
    return rows.select(
        _text("t", e * 100 + i).alias("txn_id"),
        who["account_id"].alias("account_id"),
        F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + i.cast("long") * 5_000_000).alias("timestamp"),
        F.when(burst, F.least(v, F.lit(5.0))).otherwise(v).alias("amount"),
        _text("m", F.floor(k / 2)).alias("merchant_id"),
        F.col("event_type").alias("merchant_category"),
        F.when(burst, _text("pt", e))
        .when(who["label_ring_member"] & (k < 30), _text("pr", F.floor(u / 5)))
        .otherwise(_text("p", u, "_", k % 3))
        .alias("payment_instrument_id"),
        F.when(away, _text("dn", e)).otherwise(who["registration_device_id"]).alias("device_id"),
        F.when(away, _text("172.", e % 256, ".", F.floor(e / 256) % 256, ".1"))
        .otherwise(who["registration_ip"])
        .alias("ip_address"),
        F.when(away, _text("city", k)).otherwise(_text("city", u % 40)).alias("geo_location"),
        F.when(F.col("event_type") == "error", "failed")
        .when(purchase & (k < 20), "refunded")
        .when(purchase & (k < 25), "disputed")
        .otherwise("success")
        .alias("status"),
        (burst | (away & (v > 120)) | (who["label_ring_member"] & (k < 10))).alias("label_fraud"),
    )
