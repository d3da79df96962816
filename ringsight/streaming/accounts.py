"""Layer-1 scoring of a stream of transactions.

Features depend on the order of an account's rows, and a stream brings them in any order. Rows wait in keyed state until the
watermark has passed them; an event-time timer then takes all rows that are due, in (timestamp, txn_id) order by account, and
advances the accounts' totals over them in one vectorised step. So every row within the watermark has the features of the batch,
whatever the order of arrival; later rows are dropped by Spark and counted in its progress (`numRowsDroppedByWatermark`).

The key is a bucket of accounts (`stream_buckets`, by hash; fixed for the life of a checkpoint): a message between Spark and Python
then carries a packed table of many accounts in place of one value of one account, and a step runs over all of them at once. A batch
reads and writes the state of the buckets it touches.

State per bucket: waiting rows (freed when they are due), the times of the last 24 hours (freed by a timer when the account falls
silent), counts per category and per place and device, and one row of totals an account. With `forget_after` an account that has
been silent for so long is forgotten altogether; it then starts afresh, which the batch does not do, so the default keeps it.

Rules, model, blending and decisions follow as plain columns on the rows that come out.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor

from ringsight.config import DEFAULT, Settings
from ringsight.functions import hour_of_day, micros
from ringsight.operators import audit, fusion, model
from ringsight.operators.features import FEATURES, LOOKBACKS, SECOND
from ringsight.operators.rules import evaluate_rules

DAY = LOOKBACKS["velocity_24hr"]
_FLAGS = ("is_new_merchant_category", "geo_device_consistency", "is_unusual_hour")
_HELPERS = ("event_us", "event_hour", "known_average", "account_key")


@dataclass
class Totals:
    """What an account's later rows need to know about its earlier ones, besides counts per value."""

    rows: int = 0
    amounts: int = 0
    mean: float = 0.0
    m2: float = 0.0
    last_us: int = 0
    has_last: bool = False
    last_failed: bool = False
    peak: int = 0
    usual: str | None = None
    hours: list[int] = field(default_factory=lambda: [0] * 24)


def _key(*values: object) -> str:
    return json.dumps([None if pd.isna(v) else v for v in values], ensure_ascii=False)


def value_keys(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The category and the (place, device) of each row as text that keeps nulls apart."""
    out = []
    for columns in (["merchant_category"], ["geo_location", "device_id"]):
        at, names = np.zeros(len(rows), np.int64), []
        for column in columns:
            code, values = pd.factorize(rows[column], use_na_sentinel=False)
            at, names = at * len(values) + code, [*names, values]
        pairs, at = np.unique(at, return_inverse=True)
        parts = [v.take(pairs // int(np.prod([len(x) for x in names[k + 1 :]])) % len(v)) for k, v in enumerate(names)]
        out.append(np.array([_key(*v) for v in zip(*parts, strict=True)], object)[at])
    return out[0], out[1]


@dataclass
class Accounts:
    """What later rows need to know about the earlier ones of some accounts.

    `names` in order, and by account: `totals` (a frame with the fields of `Totals` but `hours`) and `hours`. recent: account number,
    time and retry mark of the rows of the last 24 hours, in order. categories, pairs: account number, value (`value_keys`) and count.
    """

    names: np.ndarray
    totals: pd.DataFrame
    hours: np.ndarray
    recent: tuple[np.ndarray, np.ndarray, np.ndarray]
    categories: tuple[np.ndarray, np.ndarray, np.ndarray]
    pairs: tuple[np.ndarray, np.ndarray, np.ndarray]

    @classmethod
    def none(cls) -> Accounts:
        return cls.of(np.array([], object), [])

    @classmethod
    def of(cls, names: np.ndarray, totals: list[Totals]) -> Accounts:
        columns = {c: np.array([getattr(t, c) for t in totals], kind) for c, kind in _TOTAL_KINDS.items()}
        number, count = np.empty(0, np.int64), np.empty(0, np.int64)
        counts = (number, np.empty(0, object), count)
        hours = np.array([t.hours for t in totals], np.int64).reshape(-1, 24)
        return cls(names, pd.DataFrame(columns), hours, (number, count, np.empty(0, bool)), counts, counts)

    def at(self, places: np.ndarray) -> Accounts:
        """The accounts at these places, in order; -1: a new one."""
        fresh = Accounts.of(np.array([""], object), [Totals()])
        old = places >= 0
        pick = np.where(old, places, len(self.names))
        to = np.full(len(self.names), -1, np.int64)
        to[places[old]] = np.flatnonzero(old)

        def kept(rows: tuple) -> tuple:
            there = to[rows[0]] >= 0
            return (to[rows[0]][there], *[x[there] for x in rows[1:]])

        totals = pd.concat([self.totals, fresh.totals], ignore_index=True) if len(self.names) else fresh.totals
        return Accounts(
            np.append(self.names, "")[pick], totals.iloc[pick].reset_index(drop=True), np.concatenate((self.hours, fresh.hours))[pick],
            kept(self.recent), kept(self.categories), kept(self.pairs),
        )

    def packed(self) -> bytes:
        columns = {c: pa.array(self.totals[c], from_pandas=True) for c in _TOTAL_KINDS}
        columns |= {f"h{k}": pa.array(self.hours[:, k]) for k in range(24)}
        tables = [pa.table({"name": pa.array(self.names, pa.string()), **columns})]
        for rows in (self.recent, self.categories, self.pairs):
            arrays = [pa.array(x, pa.string() if x.dtype == object else None) for x in rows]
            tables.append(pa.table(arrays, names=["account", "of", "what"]))
        return b"".join(len(x).to_bytes(8, "big") + x for x in map(_packed, tables))

    @classmethod
    def unpacked(cls, data: bytes) -> Accounts:
        tables, low = [], 0
        while low < len(data):
            size = int.from_bytes(data[low : low + 8], "big")
            tables.append(_unpacked(data[low + 8 : low + 8 + size]))
            low += 8 + size
        known, *rest = tables
        columns = {c: known[c].to_numpy() if kind is not object else np.array(known[c].to_pylist(), object) for c, kind in _TOTAL_KINDS.items()}
        hours = np.stack([known[f"h{k}"].to_numpy() for k in range(24)], axis=1)
        rows = [tuple(np.array(t[c].to_pylist(), object) if pa.types.is_string(t[c].type) else t[c].to_numpy() for c in t.column_names) for t in rest]
        return cls(np.array(known["name"].to_pylist(), object), pd.DataFrame(columns), hours, *rows)


#: `has_last`: whether `last_us` counts
_TOTAL_KINDS = {"rows": np.int64, "amounts": np.int64, "mean": float, "m2": float, "last_us": np.int64, "has_last": bool, "last_failed": bool, "peak": np.int64, "usual": object}


def _packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(bytes(data))).read_all()


def _seen(at: np.ndarray, keys: np.ndarray, known: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, tuple]:
    """How often each row's value has come in its account, itself and the known count included; and the counts after all rows."""
    codes, names = pd.factorize(np.concatenate((known[1], keys)))
    each, first, place = np.unique(np.concatenate((known[0], at)) * max(1, len(names)) + codes, return_index=True, return_inverse=True)
    old, new = place[: len(known[0])], place[len(known[0]) :]
    before = np.zeros(len(each), np.int64)
    before[old] = known[2]
    seen = _position(new) + 1 + before[new]
    owner = each // max(1, len(names))
    return seen, (owner, np.asarray(names, object)[codes[first]], before + np.bincount(new, minlength=len(each)))


def _position(groups: np.ndarray) -> np.ndarray:
    """How many rows of its group are before each row."""
    return pd.Series(groups).groupby(groups).cumcount().to_numpy()


def advance_all(rows: pd.DataFrame, at: np.ndarray, known: Accounts, cfg: Settings) -> tuple[pd.DataFrame, Accounts]:
    """(features, what is known after) of the next rows of accounts; every account has rows here.

    rows: event_us, event_hour, known_average, amount, status, merchant_category, geo_location, device_id, in order by account and
    inside it; at: the account number of each row.
    """
    n = len(rows)
    totals = known.totals
    given = {c: totals[c].to_numpy()[at] for c in totals}
    first = np.concatenate(([True], at[1:] != at[:-1]))
    begin = np.flatnonzero(first)[at]
    final = np.append(begin[1:] != begin[:-1], True)
    position = np.arange(n) - begin
    us = rows["event_us"].to_numpy(np.int64)
    failed = (rows["status"] == "failed").to_numpy(bool)
    out = pd.DataFrame(index=rows.index)

    def earlier(values: np.ndarray, start: np.ndarray) -> np.ndarray:
        """The value after the account's row before."""
        return np.where(first, start, np.concatenate((values[:1], values[:-1])))

    after_failure, before_us = earlier(failed, given["last_failed"]), earlier(us, np.where(given["has_last"], given["last_us"], 0))
    retry = after_failure.astype(bool) & (us - before_us <= cfg.retry_gap_seconds * SECOND)

    # look-back windows are open on the left and hold earlier rows of the same time; times are ranked, so that (account, time) is a number
    owner = np.concatenate((known.recent[0], at))
    order = np.argsort(owner, kind="stable")  # an account's recent rows, then its new ones
    place = np.argsort(order)[len(known.recent[0]) :]
    owner, times, retries = owner[order], np.concatenate((known.recent[1], us))[order], np.concatenate((known.recent[2], retry))[order]
    ranks = np.unique(times)
    line = owner * (len(ranks) + 1) + np.searchsorted(ranks, times) + 1
    left = {}
    for name, width in LOOKBACKS.items():
        left[name] = np.searchsorted(line, at * (len(ranks) + 1) + np.searchsorted(ranks, us - width, "right"), "right")
        out[name] = (place + 1 - left[name]).astype(float)
    sums = np.concatenate(([0], np.cumsum(retries)))
    in_day = sums[place + 1] - sums[left["velocity_24hr"]]

    # deviation of the earlier amounts, from sums around a value near their mean
    amount = rows["amount"].to_numpy(float)
    there = ~np.isnan(amount)
    origin = np.where(totals["amounts"] > 0, totals["mean"], pd.Series(amount).groupby(at).first().fillna(0.0).to_numpy())
    shifted = np.where(there, amount - origin[at], 0.0)
    counts, total, squares = (pd.Series(x).groupby(at).cumsum().to_numpy() for x in (there.astype(np.int64), shifted, shifted * shifted))
    counts = counts + given["amounts"]
    m2 = np.maximum(given["m2"] + squares - total * total / np.maximum(counts, 1), 0.0)
    counts_before = earlier(counts, given["amounts"])
    deviation = np.sqrt(earlier(m2, np.maximum(given["m2"], 0.0)) / np.maximum(counts_before - 1, 1))
    deviation = np.where((counts_before < 2) | (deviation == 0), 1.0, deviation)
    out["amount_zscore"] = (amount - rows["known_average"].to_numpy(float)) / deviation

    category, pair = value_keys(rows)
    category_seen, categories = _seen(at, category, known.categories)
    pair_seen, pairs = _seen(at, pair, known.pairs)
    out["is_new_merchant_category"] = category_seen == 1
    peak = np.maximum(pd.Series(pair_seen).groupby(at).cummax().to_numpy(), given["peak"])
    record = np.maximum.accumulate(np.where(pair_seen > earlier(peak, given["peak"]), np.arange(n), -1))
    usual = np.where(record >= begin, pair[record], given["usual"])
    out["geo_device_consistency"] = pair == usual

    hour = rows["event_hour"].to_numpy(np.int64)
    same = known.hours[at, hour] + _position(at * 24 + hour)
    before = given["rows"] + position
    out["is_unusual_hour"] = (before > 0) & (same / np.maximum(before, 1) < cfg.unusual_hour_share)
    out["failure_retry_ratio"] = in_day / out["velocity_24hr"].to_numpy()

    later = pd.DataFrame({
        "rows": before[final] + 1, "amounts": counts[final], "mean": (origin[at] + total / np.maximum(counts, 1))[final], "m2": m2[final],
        "last_us": us[final], "has_last": True, "last_failed": failed[final], "peak": peak[final], "usual": usual[final],
    })
    hours = known.hours + np.bincount(at * 24 + hour, minlength=24 * len(known.names)).reshape(-1, 24)
    kept = times > later["last_us"].to_numpy()[owner] - DAY
    return out[FEATURES], Accounts(known.names, later, hours, (owner[kept], times[kept], retries[kept]), categories, pairs)


def advance(
    rows: pd.DataFrame, totals: Totals, recent: tuple[np.ndarray, np.ndarray], categories: dict, pairs: dict, cfg: Settings
) -> tuple[pd.DataFrame, Totals, tuple[np.ndarray, np.ndarray], dict, dict]:
    """(features, totals, recent, categories, pairs) after the next rows of one account, see `advance_all`.

    recent: times and retry marks of the rows of the last 24 hours. categories, pairs: counts so far of the values in these rows.
    """
    known = Accounts.of(np.array([""], object), [totals])
    known.recent = (np.zeros(len(recent[0]), np.int64), *recent)
    known.categories, known.pairs = (
        (np.zeros(len(x), np.int64), np.array(list(x), object), np.array(list(x.values()), np.int64)) for x in (categories, pairs)
    )
    features, known = advance_all(rows, np.zeros(len(rows), np.int64), known, cfg)
    later = known.totals.iloc[0]
    totals = Totals(
        int(later["rows"]), int(later["amounts"]), float(later["mean"]), float(later["m2"]), int(later["last_us"]), True,
        bool(later["last_failed"]), int(later["peak"]), later["usual"], known.hours[0].tolist(),
    )
    return features, totals, known.recent[1:], *(dict(zip(x[1], x[2].tolist(), strict=True)) for x in (known.categories, known.pairs))


class AccountFeatures(StatefulProcessor):
    """Keeps the rows of a bucket of accounts until they are final, then adds their features."""

    def __init__(self, schema: T.StructType, cfg: Settings = DEFAULT, forget_after_ms: int | None = None):
        self.schema, self.cfg, self.forget_after_ms = schema, cfg, forget_after_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "rows binary")
        self.accounts = handle.getValueState("accounts", "data binary")
        self.served = None

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        kinds = to_arrow_schema(self.schema)
        first = None
        for frame in rows:
            if len(frame):
                self.waiting.appendValue((_packed(pa.Table.from_pandas(frame[self.schema.names], kinds, preserve_index=False)),))
                least = int(frame["event_us"].min())
                first = least if first is None else min(first, least)
        if first is not None:
            self._wake_by(-(-first // 1000), timerValues.getCurrentWatermarkInMs())
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        if self.served == (key, watermark):  # the first of several timers did it all
            return iter(())
        self.served = (key, watermark)
        out, rows, left = [], None, None
        if self.waiting.exists():
            left = pa.concat_tables([_unpacked(r[0]) for r in self.waiting.get()])
            due = left["event_us"].to_numpy() <= watermark * 1000
            if due.any():
                rows, left = left.filter(pa.array(due)), left.filter(pa.array(~due))
                self.waiting.clear()
                if len(left):
                    self.waiting.appendValue((_packed(left),))
        known = Accounts.unpacked(self.accounts.get()[0]) if self.accounts.exists() else Accounts.none()
        if rows is not None:
            features, known = self._step(rows.to_pandas(), known)
            out.append(features)
        self._tidy(known, rows is not None, left, watermark)
        return iter(out)

    def _step(self, rows: pd.DataFrame, known: Accounts) -> tuple[pd.DataFrame, Accounts]:
        rows = rows.sort_values(["account_key", "event_us", "txn_id"], kind="stable", ignore_index=True)
        rows["amount"] = pd.to_numeric(rows["amount"])
        rows["known_average"] = pd.to_numeric(rows["known_average"])
        at, names = pd.factorize(rows["account_key"])
        place = pd.Index(known.names).get_indexer(names)
        stay = np.setdiff1d(np.arange(len(known.names)), place)
        here = known.at(place)
        here.names = np.asarray(names, object)
        features, here = advance_all(rows, at, here, self.cfg)
        rest = known.at(stay)
        n = len(rest.names)
        both = lambda a, b: tuple(np.concatenate((x, y + n if k == 0 else y)) for k, (x, y) in enumerate(zip(a, b, strict=True)))
        merged = Accounts(
            np.concatenate((rest.names, here.names)), pd.concat([rest.totals, here.totals], ignore_index=True) if n else here.totals,
            np.concatenate((rest.hours, here.hours)), both(rest.recent, here.recent), both(rest.categories, here.categories), both(rest.pairs, here.pairs),
        )
        return pd.concat([rows.drop(columns=["event_hour", "known_average", "account_key"]), features], axis=1), merged

    def _tidy(self, known: Accounts, changed: bool, left: pa.Table | None, watermark: int) -> None:
        """Free what no later row can need, write what changed, and wake up when there is more to do."""
        waits = np.zeros(len(known.names), bool)
        if left is not None and len(left):
            self._wake_by(-(-int(left["event_us"].to_numpy().min()) // 1000), watermark)
            waits = np.isin(known.names, np.array(left["account_key"].to_pylist(), object))
        if not len(known.names):
            return
        last = known.totals["last_us"].to_numpy() // 1000
        held = last[known.recent[0]] + DAY // 1000 >= watermark
        if not held.all():
            known.recent, changed = tuple(x[held] for x in known.recent), True
        if len(known.recent[0]):
            self._wake_by(int(last[known.recent[0]].min()) + DAY // 1000 + 1, watermark)
        if self.forget_after_ms is not None:
            young = last + self.forget_after_ms >= watermark
            if young.any():
                self._wake_by(int(last[young].min()) + self.forget_after_ms + 1, watermark)
            if not (young | waits).all():
                known, changed = known.at(np.flatnonzero(young | waits)), True
        if not len(known.names):
            self.accounts.clear()
        elif changed:
            self.accounts.update((known.packed(),))

    def _wake_by(self, at_ms: int, watermark: int) -> None:
        """One more timer, unless one is due as early. Those behind the watermark are being served and go."""
        if not any(watermark <= t <= at_ms for t in self.handle.listTimers()):
            self.handle.registerTimer(at_ms)

    def close(self) -> None:
        pass


def prepare_state(spark: SparkSession) -> None:
    """The state store that timers and several states per key need."""
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    )


def feature_stream(
    transactions: DataFrame, accounts: DataFrame, late_by: str = "1 hour", cfg: Settings = DEFAULT, forget_after_days: float | None = None
) -> DataFrame:
    """The rows of a stream of transactions with the batch's feature columns, each once the watermark has passed it.

    `accounts` is a written table: a stream-static join brings the account's average along. Rows without a time have no place in
    the order and are left out.
    """
    prepare_state(transactions.sparkSession)
    columns = transactions.columns
    averages = accounts.select("account_id", F.col("historical_avg_amount").alias("known_average"))
    rows = (
        transactions.where(F.col("timestamp").isNotNull())
        .withWatermark("timestamp", late_by)
        .join(averages, "account_id", "left")
        .withColumns({"event_us": micros(F.col("timestamp")), "event_hour": hour_of_day(F.col("timestamp"))})
        .withColumn("account_key", F.coalesce(F.concat(F.lit("="), F.col("account_id")), F.lit("")))
    )
    kept = [c for c in columns if c != "timestamp"] + list(_HELPERS)
    held = T.StructType([T.StructField(f.name, f.dataType) for f in rows.select(*kept).schema])
    added = [T.StructField(c, T.BooleanType() if c in _FLAGS else T.DoubleType()) for c in FEATURES]
    out = T.StructType([f for f in held if f.name not in ("event_hour", "known_average", "account_key")] + added)
    forget = None if forget_after_days is None else int(forget_after_days * 86_400_000)
    scored = (
        rows.select(F.pmod(F.xxhash64("account_key"), F.lit(cfg.stream_buckets)).alias("bucket"), "timestamp", *kept)
        .groupBy("bucket")
        .transformWithStateInPandas(AccountFeatures(held, cfg, forget), out, "Append", "EventTime")
    )
    return scored.withColumn("timestamp", F.timestamp_micros("event_us")).select(*columns, *FEATURES)


def rule_stream(features: DataFrame, cfg: Settings = DEFAULT) -> DataFrame:
    return evaluate_rules(features, cfg)


def saved_statistics(row: Row) -> Column:
    """The statistics of the training rows (`model.input_statistics`, one row read from a file) as a constant."""
    values = row["statistics"].asDict()
    return F.struct(*[F.lit(v).cast("double").alias(k) for k, v in values.items()])


def decision_stream(
    ruled: DataFrame, fitted: PipelineModel, statistics: Column, lookup: DataFrame, clusters: DataFrame, cfg: Settings = DEFAULT
) -> DataFrame:
    """Log entries for the rows of `rule_stream`: model, blend, reasons, cluster score, action, explanation.

    `lookup` and `clusters` are the published tables (`fusion.ring_lookup`, the scored clusters): stream-static joins.
    """
    importances = [float(x) for x in fitted.stages[-1].featureImportances.toArray()]
    layer1 = model.layer1_output(model.with_probability(ruled, fitted), statistics, importances, cfg)
    fused = fusion.fuse_scores(layer1, ruled, lookup, cfg, evidence=True)
    return audit.log_entries(fused, layer1, clusters)
