"""Rolling behaviour features per account.

Order inside an account is (timestamp, txn_id). Accounts of ordinary size are one window partition each: a single shuffle on
account_id carries every feature. An account with more rows than one task should hold goes through `long_accounts`, which
cuts its history into time segments and carries running totals from one segment to the next, with equal results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringsight.config import DEFAULT, Settings
from ringsight.functions import hour_of_day, micros
from ringsight.operators import long_accounts
from ringsight.session import hint

SECOND = 1_000_000
# The three look-back windows, open on the left, in microseconds.
LOOKBACKS = {
    "velocity_1min": 60 * SECOND,
    "velocity_1hr": 3_600 * SECOND,
    "velocity_24hr": 86_400 * SECOND,
}
FEATURES = [
    "velocity_1min",
    "velocity_1hr",
    "velocity_24hr",
    "amount_zscore",
    "is_new_merchant_category",
    "geo_device_consistency",
    "is_unusual_hour",
    "failure_retry_ratio",
]


def extract_features(transactions: DataFrame, accounts: DataFrame, cfg: Settings = DEFAULT) -> DataFrame:
    """`transactions` with the eight feature columns."""
    columns = transactions.columns
    averages = accounts.select("account_id", "historical_avg_amount")
    rows, most = long_accounts.sizes(transactions)
    long = long_accounts.find(transactions, cfg, most)
    parts = -(-rows // cfg.feature_rows_per_task)
    if long is None:
        return _whole_accounts(transactions, averages, columns, cfg, parts)

    tagged = long_accounts.tag(transactions, long, averages, cfg)
    short_rows = transactions.join(hint(long.select("account_id"), cfg.broadcast_rows), "account_id", "left_anti")
    short = _whole_accounts(short_rows, averages, columns, cfg, parts)
    return short.unionByName(long_accounts.features(tagged, columns, LOOKBACKS, cfg))


def _whole_accounts(transactions: DataFrame, averages: DataFrame, columns: list[str], cfg: Settings, parts: int) -> DataFrame:
    # One shuffle: the join and every window below need rows of an account together, whatever else they sort by.
    # Several sorts of a task's rows are held at once, so tasks become more, not longer, as the input grows.
    many = parts > transactions.sparkSession.sparkContext.defaultParallelism
    rows = (
        (transactions.repartition(parts, "account_id") if many else transactions.repartition("account_id"))
        .join(averages, "account_id", "left")
        .withColumn("us", micros(F.col("timestamp")))
        .withColumn("hour", hour_of_day(F.col("timestamp")))
    )

    def ordered(*keys: str):
        return Window.partitionBy("account_id", *keys).orderBy("us", "txn_id")

    own = ordered()
    before = own.rowsBetween(Window.unboundedPreceding, -1)
    upto = own.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    by_time = Window.partitionBy("account_id").orderBy("us")

    # One sort per secondary key, then everything that needs plain account order behind a single last sort.
    rows = rows.withColumns(
        {"category_seen": F.row_number().over(ordered("merchant_category"))}
    ).withColumns({"hour_seen": F.row_number().over(ordered("hour"))}
    ).withColumns({"pair_seen": F.row_number().over(ordered("geo_location", "device_id"))})

    rows = rows.withColumns(
        {
            "position": F.row_number().over(own),
            "prior_std": F.stddev_samp("amount").over(before),
            "prior_peak": F.coalesce(F.max("pair_seen").over(before), F.lit(0)),
            "is_retry": is_retry(F.lag("status").over(own), F.lag("us").over(own), cfg),
        }
    ).withColumns(
        {
            "usual_pair": F.last(
                F.when(F.col("pair_seen") > F.col("prior_peak"), F.struct("geo_location", "device_id")), ignorenulls=True
            ).over(upto),
            "retries": F.sum("is_retry").over(upto),
        }
    )
    # Rows inside a look-back window = rows so far minus rows that have left it. The frame only ever grows, so Spark adds
    # each row to it once; a frame with two moving ends would be summed up again for every row.
    rows = rows.withColumns(
        {
            **{f"in_{name}": F.col("position") - F.count(F.lit(1)).over(_left(by_time, w)) for name, w in LOOKBACKS.items()},
            "in_retries": F.col("retries") - F.coalesce(F.sum("is_retry").over(_left(by_time, LOOKBACKS["velocity_24hr"])), F.lit(0)),
        }
    )
    prior_rows = F.col("position") - 1
    return rows.select(
        *columns,
        *[F.col(f"in_{name}").cast("double").alias(name) for name in LOOKBACKS],
        zscore(F.col("amount"), F.col("historical_avg_amount"), F.col("prior_std")).alias("amount_zscore"),
        (F.col("category_seen") == 1).alias("is_new_merchant_category"),
        F.struct("geo_location", "device_id").eqNullSafe(F.col("usual_pair")).alias("geo_device_consistency"),
        unusual_hour(F.col("hour_seen") - 1, prior_rows, cfg).alias("is_unusual_hour"),
        retry_ratio(F.col("in_retries"), F.col("in_velocity_24hr")).alias("failure_retry_ratio"),
    )


def _left(by_time, width: int):
    return by_time.rangeBetween(Window.unboundedPreceding, -width)


def zscore(amount: Column, average: Column, prior_std: Column) -> Column:
    return (amount - average) / F.coalesce(F.nullif(prior_std, F.lit(0.0)), F.lit(1.0))


def unusual_hour(same_hour_before: Column, rows_before: Column, cfg: Settings) -> Column:
    return F.when(rows_before == 0, False).otherwise(same_hour_before / rows_before < cfg.unusual_hour_share)


def is_retry(previous_status: Column, previous_us: Column, cfg: Settings) -> Column:
    """1 when the account's previous row failed at most `retry_gap_seconds` ago."""
    soon = F.col("us") - previous_us <= cfg.retry_gap_seconds * SECOND
    return F.coalesce((previous_status == "failed") & soon, F.lit(False)).cast("long")


def retry_ratio(retries: Column, rows: Column) -> Column:
    return F.coalesce(retries / rows, F.lit(0.0))
