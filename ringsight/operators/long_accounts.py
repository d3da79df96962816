"""Features of accounts too long for one task, as running sums over segments of equal row count.

The rows of long accounts are sorted over all tasks by (account, time, id), numbered by partial counts, and cut by that rank: a
dense burst, even one within a single moment, is as many segments as it has rows for. A row entering a look-back window counts +1 at
its own time and -1 at the moment it leaves the window, so every window feature is a running sum over those marks; the marks are
sorted and cut in the same way, because many rows can leave at once too. A segment starts from the totals of all earlier
segments, which are computed on one small row per segment and key. Amounts carry (n, mean, M2), not raw squares.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ringsight.config import Settings
from ringsight.functions import hour_of_day, micros
from ringsight.session import hint, materialize

KEYS = ["account_id", "seg"]
MARK_CARRY, MARK_LEAVE, MARK_ROW = 0, 1, 2


def sizes(transactions: DataFrame) -> tuple[int, int]:
    """(all rows, rows of the longest account)."""
    rows, most = transactions.groupBy("account_id").count().agg(F.sum("count"), F.max("count")).first()
    return rows or 0, most or 0


def find(transactions: DataFrame, cfg: Settings, most: int | None = None) -> DataFrame | None:
    """(account_id) of the accounts above the limit, or None when there are none; most: rows of the longest one, if known."""
    if (sizes(transactions)[1] if most is None else most) <= cfg.account_rows_per_task:
        return None
    counts = transactions.groupBy("account_id").count()
    return materialize(counts.where(F.col("count") > cfg.account_rows_per_task).select("account_id"), "long-accounts")


def segments(rows: DataFrame, order: list[str], label: str, cfg: Settings) -> DataFrame:
    """`rows` with `seg`: runs of `account_rows_per_task` rows of an account, in the given order.

    A range partitioning sorts all rows; a row's rank is its place in its partition plus the rows that earlier partitions hold of its
    account. Those are counted in a table of at most one row per account and partition border.
    """
    keys = ["account_id", *order]
    laid = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = materialize(laid.withColumns({"part": F.spark_partition_id(), "place": F.monotonically_increasing_id()}), label)
    runs = placed.groupBy("account_id", "part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("account_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("account_id", "part", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("off"))
    rank = F.col("place") - F.col("first") + F.col("off")
    met = placed.join(hint(materialize(runs, f"{label}-runs"), cfg.broadcast_rows), ["account_id", "part"])
    return met.withColumn("seg", F.floor(rank / cfg.account_rows_per_task)).drop("part", "place", "first", "off")


def tag(transactions: DataFrame, long: DataFrame, averages: DataFrame, cfg: Settings) -> DataFrame:
    """Rows of long accounts with their segment and the account average."""
    about = materialize(long.join(averages, "account_id", "left"), "long-account-facts")
    rows = transactions.join(hint(about, cfg.broadcast_rows), "account_id").withColumn("us", micros(F.col("timestamp")))
    return segments(rows, ["us", "txn_id"], "long-ordered", cfg)


def features(tagged: DataFrame, columns: list[str], lookbacks: dict[str, int], cfg: Settings) -> DataFrame:
    from ringsight.operators.features import retry_ratio, unusual_hour, zscore

    rows = materialize(_with_retries(tagged, cfg), "long-rows")
    counted = materialize(_running_sums(rows, columns, lookbacks, cfg), "long-sums")
    counted = _with_usual_pair(counted)

    # sums are taken around the mean of the earlier segments, which adds nothing to the first and M2 to the second
    n, s1, s2 = F.col("n_carried") + F.col("n_before"), F.col("s1_before"), F.col("m2_carried") + F.col("s2_before")
    spread = F.greatest(s2 - s1 * s1 / n, F.lit(0.0)) / (n - 1)
    prior_std = F.when(n > 1, F.sqrt(spread))
    return counted.select(
        *columns,
        *[F.col(f"in_{name}").cast("double").alias(name) for name in lookbacks],
        zscore(F.col("amount"), F.col("historical_avg_amount"), prior_std).alias("amount_zscore"),
        (F.col("category_seen") == 1).alias("is_new_merchant_category"),
        F.struct("geo_location", "device_id").eqNullSafe(F.col("usual_pair")).alias("geo_device_consistency"),
        unusual_hour(F.col("hour_seen") - 1, F.col("rows_before"), cfg).alias("is_unusual_hour"),
        retry_ratio(F.col("in_retries"), F.col("in_velocity_24hr")).alias("failure_retry_ratio"),
    )


def _earlier_segments():
    return Window.partitionBy("account_id").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)


def _with_retries(tagged: DataFrame, cfg: Settings) -> DataFrame:
    """Mark retries; the first row of a segment looks at the last row of the segment before it."""
    from ringsight.operators.features import is_retry

    own = Window.partitionBy(*KEYS).orderBy("us", "txn_id")
    tails = (
        tagged.groupBy(*KEYS)
        .agg(F.max_by(F.struct("status", "us"), F.struct("us", "txn_id")).alias("tail"))
        .withColumn("tail", F.lag("tail").over(Window.partitionBy("account_id").orderBy("seg")))
        .select(*KEYS, F.col("tail.status").alias("tail_status"), F.col("tail.us").alias("tail_us"))
    )
    rows = tagged.withColumns({"place": F.row_number().over(own), "s": F.lag("status").over(own), "u": F.lag("us").over(own)})
    rows = rows.join(tails, KEYS, "left")
    status = F.when(F.col("place") == 1, F.col("tail_status")).otherwise(F.col("s"))
    us = F.when(F.col("place") == 1, F.col("tail_us")).otherwise(F.col("u"))
    return rows.withColumn("is_retry", is_retry(status, us, cfg)).drop("place", "s", "u", "tail_status", "tail_us")


def _amounts_before(marks: DataFrame) -> DataFrame:
    """Per segment (n, mean, M2) of the amounts in earlier segments, and the value that sums are taken around.

    Means are combined around the account's own mean; equal amounts are told by their least and greatest, so that their spread is
    exactly zero.
    """
    first = F.min_by("amount", F.when(F.col("amount").isNotNull(), F.struct("us", "txn_id")))
    per = marks.where(F.col("kind") == MARK_ROW).groupBy(*KEYS).agg(
        F.count("amount").alias("n"), F.avg("amount").alias("mean"), (F.var_pop("amount") * F.count("amount")).alias("m2"),
        F.min("amount").alias("low"), F.max("amount").alias("high"), first.alias("first_amount"),
    )
    every = marks.select(*KEYS).distinct().join(per, KEYS, "left")
    whole = per.groupBy("account_id").agg((F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("middle"))
    off = F.col("mean") - F.col("middle")
    earlier = _earlier_segments()
    sums = every.join(whole, "account_id", "left").select(
        *KEYS, "middle", "first_amount",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n_carried"),
        F.coalesce(F.sum(F.col("n") * off).over(earlier), F.lit(0.0)).alias("a"),
        F.coalesce(F.sum(F.col("m2") + F.col("n") * off * off).over(earlier), F.lit(0.0)).alias("b"),
        F.min("low").over(earlier).alias("low"), F.max("high").over(earlier).alias("high"),
    )
    n, same = F.col("n_carried"), F.col("low") == F.col("high")
    return sums.select(
        *KEYS, "n_carried",
        F.when((n == 0) | same, 0.0).otherwise(F.greatest(F.col("b") - F.col("a") * F.col("a") / n, F.lit(0.0))).alias("m2_carried"),
        F.when(n == 0, F.col("first_amount")).when(same, F.col("low")).otherwise(F.col("middle") + F.col("a") / n).alias("origin"),
    )


def _running_sums(rows: DataFrame, columns: list[str], lookbacks: dict[str, int], cfg: Settings) -> DataFrame:
    longest = max(lookbacks, key=lookbacks.get)
    totals = [*lookbacks, "retries", "rows"]

    def marks(kind: int, **values):
        return [F.lit(kind).alias("kind"), *[values.get(t, F.lit(0)).cast("long").alias(t) for t in totals]]

    arrivals = rows.withColumn("hour", hour_of_day(F.col("timestamp"))).select(
        "account_id",
        "us",
        *[c for c in columns if c != "account_id"],
        "historical_avg_amount",
        "hour",
        *marks(MARK_ROW, **{name: F.lit(1) for name in lookbacks}, retries=F.col("is_retry"), rows=F.lit(1)),
    )
    leaving = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.lit(w).alias("after")) for n, w in lookbacks.items()]))
    departures = rows.select("account_id", "us", "is_retry", leaving.alias("leave")).select(
        "account_id",
        (F.col("us") + F.col("leave.after")).alias("us"),
        *marks(
            MARK_LEAVE,
            **{name: F.when(F.col("leave.name") == name, -1).otherwise(0) for name in lookbacks},
            retries=F.when(F.col("leave.name") == longest, -F.col("is_retry")).otherwise(0),
        ),
    )
    every = arrivals.unionByName(departures, allowMissingColumns=True)
    every = materialize(segments(every, ["us", "kind", "txn_id"], "long-marks", cfg), "long-segments")
    amounts = _amounts_before(every)
    weight = F.when(F.col("kind") == MARK_ROW, 1).cast("long")
    every = every.withColumns({w: weight for w in ("category_w", "pair_w", "hour_w")})
    arrivals = every.where(F.col("kind") == MARK_ROW)

    carried = (
        every.groupBy(*KEYS)
        .agg(*[F.sum(t).alias(t) for t in totals])
        .select(*KEYS, *[F.sum(t).over(_earlier_segments()).alias(t) for t in totals])
        .where(F.col("rows").isNotNull())
        .withColumn("kind", F.lit(MARK_CARRY))
    )

    def carried_by(weight: str, *key: str) -> DataFrame:
        earlier = Window.partitionBy("account_id", *key).orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
        return (
            arrivals.groupBy(*KEYS, *key)
            .count()
            .select(*KEYS, *key, F.sum("count").over(earlier).alias(weight))
            .where(F.col(weight).isNotNull())
            .withColumn("kind", F.lit(MARK_CARRY))
        )

    everything = every
    for part in (
        carried,
        carried_by("category_w", "merchant_category"),
        carried_by("pair_w", "geo_location", "device_id"),
        carried_by("hour_w", "hour"),
    ):
        everything = everything.unionByName(part, allowMissingColumns=True)

    # one shuffle for all the windows, whatever else they group by
    everything = everything.repartition(*KEYS).join(amounts, KEYS, "left")
    shifted = F.col("amount") - F.col("origin")
    everything = everything.withColumns(
        {
            "n": F.col("amount").isNotNull().cast("long"),
            "s1": F.coalesce(shifted, F.lit(0.0)),
            "s2": F.coalesce(shifted * shifted, F.lit(0.0)),
        }
    )
    order = [F.col("us").asc_nulls_first(), "kind", "txn_id"]

    def upto(*key: str):
        return Window.partitionBy(*KEYS, *key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)

    before = Window.partitionBy(*KEYS).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    sums = everything.withColumn("category_seen", F.sum("category_w").over(upto("merchant_category")))
    sums = sums.withColumn("hour_seen", F.sum("hour_w").over(upto("hour")))
    sums = sums.withColumn("pair_seen", F.sum("pair_w").over(upto("geo_location", "device_id")))
    sums = sums.withColumns(
        {
            **{f"in_{name}": F.sum(name).over(upto()) for name in [*lookbacks, "retries"]},
            **{f"{name}_before": F.coalesce(F.sum(name).over(before), F.lit(0)) for name in ("rows", "n", "s1", "s2")},
        }
    )
    kept = [
        *KEYS,
        "us",
        *[c for c in columns if c != "account_id"],
        "historical_avg_amount",
        "category_seen",
        "hour_seen",
        "pair_seen",
        *[f"in_{name}" for name in [*lookbacks, "retries"]],
        *[f"{name}_before" for name in ("rows", "n", "s1", "s2")],
        "n_carried",
        "m2_carried",
    ]
    return sums.where(F.col("kind") == MARK_ROW).select(*kept)


def _with_usual_pair(rows: DataFrame) -> DataFrame:
    """The (place, device) pair that first reached the highest count so far, this row included."""
    pair = F.struct("geo_location", "device_id")
    peaks = rows.groupBy(*KEYS).agg(
        F.max("pair_seen").alias("peak"),
        F.min_by(pair, F.struct(-F.col("pair_seen"), F.col("us"), F.col("txn_id"))).alias("holder"),
    )
    earlier = _earlier_segments()
    peaks = peaks.withColumn("peak_before", F.coalesce(F.max("peak").over(earlier), F.lit(0)))
    peaks = peaks.select(
        *KEYS,
        "peak_before",
        F.last(F.when(F.col("peak") > F.col("peak_before"), F.col("holder")), ignorenulls=True).over(earlier).alias("holder_before"),
    )
    own = Window.partitionBy(*KEYS).orderBy("us", "txn_id")
    rows = rows.join(peaks, KEYS)
    highest = F.greatest(
        F.coalesce(F.max("pair_seen").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), F.col("peak_before")
    )
    rows = rows.withColumn("record", F.col("pair_seen") > highest)
    latest = F.last(F.when(F.col("record"), pair), ignorenulls=True).over(
        own.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return rows.withColumn("usual_pair", F.coalesce(latest, F.col("holder_before")))
