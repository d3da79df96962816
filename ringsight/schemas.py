"""Declared types of every table read or written, so nothing is ever inferred from data."""

from pyspark.sql import types as T

STATUSES = ("success", "failed", "refunded", "disputed")

TRANSACTIONS = T.StructType(
    [
        T.StructField("txn_id", T.StringType()),
        T.StructField("account_id", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("merchant_id", T.StringType()),
        T.StructField("merchant_category", T.StringType()),
        T.StructField("payment_instrument_id", T.StringType()),
        T.StructField("device_id", T.StringType()),
        T.StructField("ip_address", T.StringType()),
        T.StructField("geo_location", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("label_fraud", T.BooleanType()),
    ]
)

ACCOUNTS = T.StructType(
    [
        T.StructField("account_id", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("kyc_verified", T.BooleanType()),
        T.StructField("registration_device_id", T.StringType()),
        T.StructField("registration_ip", T.StringType()),
        T.StructField("historical_avg_amount", T.DoubleType()),
        T.StructField("label_ring_member", T.BooleanType()),
        T.StructField("ring_id", T.StringType()),
        T.StructField("is_ambiguous", T.BooleanType()),
    ]
)

TOP_FEATURE = T.StructType(
    [
        T.StructField("feature", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("contribution", T.StringType()),
    ]
)

LAYER1 = T.StructType(
    [
        T.StructField("txn_id", T.StringType()),
        T.StructField("layer1_score", T.DoubleType()),
        T.StructField("triggered_rules", T.ArrayType(T.StringType())),
        T.StructField("top_features", T.ArrayType(TOP_FEATURE)),
    ]
)

CLUSTERS = T.StructType(
    [
        T.StructField("cluster_id", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("member_accounts", T.ArrayType(T.StringType())),
        T.StructField("ring_score", T.DoubleType()),
        T.StructField("shared_signals", T.ArrayType(T.StringType())),
        T.StructField("flags", T.ArrayType(T.StringType())),
    ]
)

AUDIT = T.StructType(
    [
        T.StructField("txn_id", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("layer1_score", T.DoubleType()),
        T.StructField("layer1_triggers", T.ArrayType(T.StringType())),
        T.StructField("ring_membership", T.StringType()),
        T.StructField("ring_score", T.DoubleType()),
        T.StructField("final_score", T.DoubleType()),
        T.StructField("action_taken", T.StringType()),
        T.StructField("explanation", T.StringType()),
    ]
)

AUDIT_INDEX = T.StructType([*AUDIT.fields, T.StructField("run", T.StringType()), T.StructField("bucket", T.IntegerType())])

METRICS = T.StructType(
    [
        T.StructField("total_fraud_test_set", T.LongType()),
        T.StructField("caught_layer1", T.LongType()),
        T.StructField("caught_layer2_only", T.LongType()),
        T.StructField("false_positives_layer2", T.LongType()),
    ]
)
