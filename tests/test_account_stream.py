"""Layer-1 scoring of a stream: equal to the batch for any order of arrival, across restarts, with bounded state."""

import os
from datetime import timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from samples import START, account, accounts_frame, expected_features, random_tables, transaction, transactions_frame

from ringsight.config import DEFAULT, Settings
from ringsight.operators import audit, fusion, model
from ringsight.operators.features import FEATURES, extract_features
from ringsight.operators.rules import evaluate_rules
from ringsight.sources import tables
from ringsight.streaming import accounts as stream
from ringsight.streaming import live

#: Moves the watermark past everything; no account of the tests.
LAST = transaction("zz", "sentinel", START + timedelta(days=4000))


@pytest.fixture(autouse=True)
def few_state_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def replay(spark, folder, parts, accounts, late_by="1 day", **options):
    """Append the parts one by one, running the stream over each; every run but the first starts from the checkpoint."""
    path, sink, state = (os.path.join(folder, x) for x in ("in", "out", "state"))
    tables.write_table(accounts, os.path.join(folder, "accounts"))
    known = tables.read_accounts(spark, os.path.join(folder, "accounts"))
    progress = []
    for part in parts:
        tables.write_table(transactions_frame(spark, part).coalesce(1), path, "append")
        features = stream.feature_stream(live.tail_transactions(spark, path), known, late_by, **options)
        query = live.run_available(features, sink, state)
        query.awaitTermination()
        progress += query.recentProgress
    return spark.read.schema(features.schema).parquet(sink), progress


def plain(rows):
    return {r["txn_id"]: {c: r[c] for c in FEATURES} for r in rows}


def same(got, want):
    assert got.keys() == want.keys()
    for txn, features in want.items():
        for name, value in features.items():
            other = got[txn][name]
            assert other == value or value is not None and other is not None and abs(other - value) < 1e-9, (txn, name, other, value)


@pytest.mark.parametrize("order", ["forward", "backward", "mixed"])
def test_any_order_of_files_gives_the_batch_features(spark, tmp_path, order):
    accounts, transactions = random_tables(seed=11, n_accounts=12, n_transactions=240)
    for k in (7, 50, 90):
        transactions[k]["amount"] = None
    rows = sorted(transactions, key=lambda t: t["timestamp"])
    parts = [rows[k : k + 80] for k in range(0, 240, 80)]
    if order == "backward":
        parts = parts[::-1]
    if order == "mixed":
        parts = [rows[k::3] for k in (1, 0, 2)]
    frames = accounts_frame(spark, accounts)
    found, _ = replay(spark, str(tmp_path), [*parts, [LAST]], frames, "1 day" if order == "forward" else "400 days")
    got = plain(found.collect())
    batch = plain(extract_features(transactions_frame(spark, transactions), frames).collect())
    same(got, batch)


def test_features_come_once_final_and_late_rows_are_counted(spark, tmp_path):
    rows = [transaction(f"t{k}", "a", START + timedelta(minutes=10 * k), status="failed") for k in range(12)]
    late = transaction("late", "a", START + timedelta(minutes=5))
    found, progress = replay(
        spark, str(tmp_path), [rows[:6], rows[6:], [late], [LAST]], accounts_frame(spark, [account("a")]), "30 minutes"
    )
    want = expected_features([account("a")], rows)
    same(plain(found.collect()), {k: {c: float(v) if "velocity" in c else v for c, v in f.items()} for k, f in want.items()})
    dropped = [op["numRowsDroppedByWatermark"] for p in progress for op in p["stateOperators"]]
    assert sum(dropped) == 1
    # nothing waits for rows that the watermark has passed: after the second part those up to 30 minutes before its end are out
    assert found.count() == 12


def test_state_is_kept_by_buckets_of_accounts(spark, tmp_path):
    """Messages and state rows follow the buckets, not the accounts; accounts of a bucket do not touch each other."""
    accounts, transactions = random_tables(seed=21, n_accounts=30, n_transactions=400)
    for k in (3, 40, 41, 300):
        transactions[k]["account_id"] = None
    for k in (8, 90):
        transactions[k] |= {"amount": None, "merchant_category": None, "geo_location": None}
    for k in (120, 121):  # half a millisecond behind the watermark's own
        transactions[k]["timestamp"] += timedelta(microseconds=500)
    rows = sorted(transactions, key=lambda t: t["timestamp"])
    frames = accounts_frame(spark, accounts)
    parts = [rows[k : k + 100] for k in range(0, 400, 100)]
    found, progress = replay(spark, str(tmp_path), [*parts, [LAST]], frames, "10 days", cfg=Settings(stream_buckets=2))
    same(plain(found.collect()), plain(extract_features(transactions_frame(spark, transactions), frames).collect()))
    # per bucket the accounts, a list of waiting rows and a few timers
    assert max(op["numRowsTotal"] for p in progress for op in p["stateOperators"]) <= 16


def test_silent_accounts_are_freed(spark, tmp_path):
    rows = [transaction(f"{who}{k}", who, START + timedelta(hours=k)) for who in "abcdef" for k in range(4)]
    later = [transaction(f"z{k}", "z", START + timedelta(days=40 + k)) for k in range(3)]
    kept, forgot = ([], [])
    for days, seen in ((None, kept), (10, forgot)):
        folder = str(tmp_path / str(days))
        _, progress = replay(spark, folder, [rows, later[:2], later[2:]], accounts_frame(spark, [account("a")]), "1 hour", forget_after_days=days)
        seen += [op["numRowsTotal"] for p in progress for op in p["stateOperators"]]
    # of the six silent accounts, waiting rows and recent times go in both runs, everything in the second
    assert forgot[-1] < kept[-1] < max(kept)
    assert forgot[-1] <= 8


def test_steps_of_any_size_give_the_same_features():
    _, transactions = random_tables(seed=5, n_accounts=2, n_transactions=300)
    rows = pd.DataFrame([t for t in transactions if t["account_id"] == "a001"])
    rows["event_us"] = [int((t - START).total_seconds()) * 1_000_000 for t in rows["timestamp"]]
    rows["event_hour"], rows["known_average"] = [t.hour for t in rows["timestamp"]], 50.0
    rows.loc[3, "amount"] = np.nan
    rows = rows.sort_values(["event_us", "txn_id"], ignore_index=True)

    def run(size):
        totals, recent, categories, pairs, out = stream.Totals(), (np.empty(0, np.int64), np.empty(0, bool)), {}, {}, []
        for k in range(0, len(rows), size):
            features, totals, recent, c, p = stream.advance(rows[k : k + size], totals, recent, categories, pairs, DEFAULT)
            categories.update(c)
            pairs.update(p)
            out.append(features)
        return pd.concat(out)

    whole = run(len(rows))
    for size in (1, 7, 64):
        pd.testing.assert_frame_equal(run(size), whole, check_exact=False, rtol=1e-12)


def test_constant_amounts_have_no_deviation():
    rows = pd.DataFrame(
        {"event_us": range(5), "event_hour": 1, "known_average": 10.0, "amount": 37.21, "status": "success", "merchant_category": None, "geo_location": "x", "device_id": None}
    )
    features, totals, *_ = stream.advance(rows, stream.Totals(), (np.empty(0, np.int64), np.empty(0, bool)), {}, {}, DEFAULT)
    assert np.allclose(features["amount_zscore"], 27.21) and totals.m2 == 0 and totals.amounts == 5
    assert features["is_new_merchant_category"].tolist() == [True, False, False, False, False]


def test_decisions_of_the_stream_equal_the_batch(spark, tmp_path):
    accounts, transactions = random_tables(seed=3, n_accounts=12, n_transactions=150)
    cfg = Settings(trees=3, depth=3)
    a, t = accounts_frame(spark, accounts), transactions_frame(spark, transactions)
    features = evaluate_rules(extract_features(t, a, cfg), cfg)
    fitted = model.train(features, cfg)
    prepared = model.prepare_data(features)
    saved = model.input_statistics(prepared)
    tables.write_table(saved, str(tmp_path / "statistics"))
    row = spark.read.parquet(str(tmp_path / "statistics")).first()
    lookup = spark.createDataFrame([("a001", "a000", 0.9), ("a002", "a002", 0.1)], "account_id string, ring_membership string, ring_score double")
    clusters = spark.createDataFrame(
        [("a000", 3, ["device"], ["dense_identifier_sharing"], 0.9), ("a002", 1, [], [], 0.1)],
        "cluster_id string, size long, shared_signals array<string>, flags array<string>, ring_score double",
    )
    importances = [float(x) for x in fitted.stages[-1].featureImportances.toArray()]
    layer1 = model.layer1_output(model.with_probability(features, fitted), stream.saved_statistics(row), importances, cfg)
    want = audit.log_entries(fusion.fuse_scores(layer1, t, lookup, cfg, evidence=True), layer1, clusters).drop("timestamp")

    path = str(tmp_path / "in")
    tables.write_table(t.coalesce(1), path)
    tables.write_table(a, str(tmp_path / "accounts"))
    for k in range(2):
        if k:
            tables.write_table(transactions_frame(spark, [LAST]), path, "append")
        ruled = stream.rule_stream(stream.feature_stream(live.tail_transactions(spark, path), tables.read_accounts(spark, str(tmp_path / "accounts")), "400 days"), cfg)
        entries = stream.decision_stream(ruled, fitted, stream.saved_statistics(row), lookup, clusters, cfg)
        live.run_available(entries, str(tmp_path / "log"), str(tmp_path / "state")).awaitTermination()
    got = spark.read.schema(entries.schema).parquet(str(tmp_path / "log")).drop("timestamp")
    assert got.count() == len(transactions)
    key = [F.to_json(F.struct(*want.columns)).alias("row")]
    assert sorted(r.row for r in got.select(*key).collect()) == sorted(r.row for r in want.select(*key).collect())
