import random
import re
from datetime import timedelta

import pytest
from samples import (
    START,
    account,
    accounts_frame,
    expected_features,
    random_tables,
    transaction,
    transactions_frame,
)

from ringsight.config import Settings
from ringsight.operators.features import FEATURES, LOOKBACKS, extract_features
from ringsight.operators import long_accounts
from ringsight.operators.rules import RULES, Rule, evaluate_rules

ONE_TASK = Settings()
# so small that nearly every account is cut into segments
SEGMENTS = Settings(account_rows_per_task=3)
SEGMENTS_BY_SHUFFLE = Settings(account_rows_per_task=10, broadcast_rows=0)


def scored(spark, accounts, transactions, cfg=ONE_TASK):
    return extract_features(transactions_frame(spark, transactions), accounts_frame(spark, accounts), cfg)


@pytest.mark.parametrize("cfg", [ONE_TASK, SEGMENTS, SEGMENTS_BY_SHUFFLE], ids=["whole", "segments", "shuffled"])
@pytest.mark.parametrize("seed", [1, 2])
def test_features_match_a_row_by_row_walk(spark, cfg, seed):
    accounts, transactions = random_tables(seed)
    want = expected_features(accounts, transactions)
    got = {r["txn_id"]: r for r in scored(spark, accounts, transactions, cfg).collect()}
    assert got.keys() == want.keys()
    for txn_id, features in want.items():
        for name in FEATURES:
            value = features[name] if features[name] is None else pytest.approx(features[name], rel=1e-9)
            assert got[txn_id][name] == value, (txn_id, name)


def test_segments_keep_the_input_columns(spark):
    accounts, transactions = random_tables(3, n_transactions=60)
    whole = scored(spark, accounts, transactions)
    cut = scored(spark, accounts, transactions, SEGMENTS)
    assert whole.columns == cut.columns
    columns = [c for c in whole.columns if c not in ("amount_zscore", "failure_retry_ratio")]
    assert whole.select(columns).exceptAll(cut.select(columns)).isEmpty()
    assert cut.select(columns).exceptAll(whole.select(columns)).isEmpty()


def test_same_instant_counts_only_up_to_the_row(spark):
    times = [0, 0, 60, 60, 90]
    rows = [transaction(f"t{i}", "a", START + timedelta(seconds=s)) for i, s in enumerate(times)]
    got = {r["txn_id"]: r["velocity_1min"] for r in scored(spark, [account("a")], rows).collect()}
    assert [got[f"t{i}"] for i in range(5)] == [1, 2, 1, 2, 3]


@pytest.mark.parametrize("cfg", [ONE_TASK, SEGMENTS], ids=["whole", "segments"])
def test_slow_customer_and_card_testing(spark, cfg):
    slow = [transaction(f"n{i}", "acc_normal", START + timedelta(hours=i), 100.0 + 5 * i) for i in range(5)]
    fast = [
        transaction(f"x{i}", "acc_attack", START + timedelta(seconds=5 * i), 5.0, status="success" if i % 2 else "failed")
        for i in range(10)
    ]
    accounts = [account("acc_normal"), account("acc_attack", historical_avg_amount=200.0)]
    rows = evaluate_rules(scored(spark, accounts, slow + fast, cfg), cfg).collect()
    normal = [r for r in rows if r["account_id"] == "acc_normal"]
    attack = [r for r in rows if r["account_id"] == "acc_attack"]
    assert max(r["velocity_1min"] for r in normal) == 1
    assert all(r["rule_score"] == 0.0 and r["triggered_rules"] == [] for r in normal)
    assert max(r["velocity_1min"] for r in attack) == 10
    assert max(r["failure_retry_ratio"] for r in attack) > 0
    flagged = [r for r in attack if "card_testing_flag" in r["triggered_rules"]]
    assert len(flagged) == 5 and all(r["rule_score"] == 1.0 for r in flagged)


@pytest.mark.parametrize("cfg", [ONE_TASK, SEGMENTS], ids=["whole", "segments"])
def test_large_amount_on_a_new_device_after_constant_amounts(spark, cfg):
    rows = [transaction(f"t{i}", "a", START + timedelta(days=i), 33.3) for i in range(5)]
    rows.append(transaction("big", "a", START + timedelta(days=6), 5000.0, device_id="new", geo_location="Lima"))
    got = {r["txn_id"]: r for r in evaluate_rules(scored(spark, [account("a")], rows, cfg), cfg).collect()}
    assert got["big"]["amount_zscore"] == pytest.approx(4900.0)  # no spread counts as 1
    assert got["big"]["triggered_rules"] == ["high_deviation_flag"]
    assert got["big"]["rule_score"] == 0.8


def test_unknown_account_fires_no_deviation(spark):
    row = scored(spark, [account("a")], [transaction("t", "nobody", START, 1e6)])
    got = evaluate_rules(row).first()
    assert got["amount_zscore"] is None and got["triggered_rules"] == []


def test_rules_add_up_cap_and_extend(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame(
        [(0.0, 10.0, 9.0, False, True, True), (0.0, 10.0, 0.0, True, True, True), (9.0, 10.0, None, None, False, False)],
        "velocity_1min double, amount double, amount_zscore double, geo_device_consistency boolean,"
        " is_unusual_hour boolean, is_new_merchant_category boolean",
    )
    got = [(r["rule_score"], r["triggered_rules"]) for r in evaluate_rules(rows).collect()]
    assert got == [
        (1.0, ["high_deviation_flag", "odd_hour_new_category_flag"]),
        (0.6, ["odd_hour_new_category_flag"]),
        (1.0, ["card_testing_flag"]),
    ]
    extra = (*RULES, Rule("tiny", lambda cfg: F.col("amount") < 11))
    assert all("tiny" in r["triggered_rules"] for r in evaluate_rules(rows, ONE_TASK, extra).collect())
    empty = evaluate_rules(rows.limit(0))
    assert empty.count() == 0 and {"rule_score", "triggered_rules"} <= set(empty.columns)


@pytest.mark.parametrize("threshold", ["-1", "10MB"], ids=["sort-merge", "broadcast"])
def test_plan_shuffles_transactions_once(spark, threshold):
    accounts, transactions = random_tables(1, n_transactions=50)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        plan = scored(spark, accounts, transactions)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert 1 <= len(exchanges) <= 2  # transactions, and accounts unless they are broadcast
    assert all(re.search(r"hashpartitioning\(account_id#\d+, \d+\)", line) for line in exchanges)
    assert "SinglePartition" not in plan


@pytest.mark.parametrize("cfg", [ONE_TASK, SEGMENTS], ids=["whole", "segments"])
def test_unknown_amounts_do_not_hide_the_spread(spark, cfg):
    amounts = [None, 10.0, 20.0, 40.0, 80.0, 160.0]
    rows = [transaction(f"t{i}", "a", START + timedelta(hours=i), x) for i, x in enumerate(amounts)]
    got = {r["txn_id"]: r["amount_zscore"] for r in scored(spark, [account("a")], rows, cfg).collect()}
    assert [round(got[f"t{i}"], 4) for i in (3, 4, 5)] == [-8.4853, -1.3093, 1.9382]


def burst(n_moment=10_000, n_dense=3_000, n_sparse=301):
    """One account: many rows in one millisecond, a dense hour, a sparse year around them, and amounts that are unknown."""
    rng = random.Random(17)
    when = [START + timedelta(milliseconds=7)] * n_moment
    when += [START + timedelta(days=3, microseconds=rng.randrange(3_600_000_000)) for _ in range(n_dense)]
    when += [START + timedelta(minutes=rng.randrange(525_600)) for _ in range(n_sparse)]
    return [
        transaction(
            f"t{k:06d}", "a", at, rng.choice([None, 5.0, 37.21, 1e6 + 0.1]), merchant_category=rng.choice(["a", "b", None]),
            device_id=rng.choice(["d1", "d2", None]), status=rng.choice(["failed", "success"]),
        )
        for k, at in enumerate(when)
    ]


def test_bursts_are_cut_into_equal_segments(spark):
    rows = burst()
    cfg = Settings(account_rows_per_task=700)
    t, a = transactions_frame(spark, rows), accounts_frame(spark, [account("a")])
    long = long_accounts.find(t, cfg)
    tagged = long_accounts.tag(t, long, a.select("account_id", "historical_avg_amount"), cfg)
    sizes = [r["count"] for r in tagged.groupBy("seg").count().orderBy("seg").collect()]
    assert sizes[:-1] == [700] * (len(rows) // 700) and sum(sizes) == len(rows)
    got = {r["txn_id"]: r for r in extract_features(t, a, cfg).collect()}
    want = extract_features(t, a, ONE_TASK).collect()
    assert len(got) == len(want) == len(rows)
    for r in want:
        for name in FEATURES:
            value = r[name] if r[name] is None else pytest.approx(r[name], rel=1e-6, abs=1e-9)
            assert got[r["txn_id"]][name] == value, (r["txn_id"], name)


def test_equal_amounts_in_many_segments_have_no_spread(spark):
    rows = [transaction(f"t{k:03d}", "a", START + timedelta(hours=k), 37.21) for k in range(40)]
    got = scored(spark, [account("a", historical_avg_amount=30.0)], rows, SEGMENTS).collect()
    assert all(r["amount_zscore"] == pytest.approx(7.21) for r in got)


def test_no_window_over_rows_is_by_account_alone(spark):
    t, a = transactions_frame(spark, burst(60, 40, 10)), accounts_frame(spark, [account("a")])
    cfg = Settings(account_rows_per_task=10)
    tagged = long_accounts.tag(t, long_accounts.find(t, cfg), a.select("account_id", "historical_avg_amount"), cfg)
    found = long_accounts.features(tagged, t.columns, LOOKBACKS, cfg)
    windows = [x for x in found._jdf.queryExecution().executedPlan().toString().splitlines() if "Window [" in x]
    # windows over segments (one row each) hold peaks; those over rows are within a segment
    rows = [x for x in windows if "txn_id" in x]
    assert rows and all(re.search(r"\[account_id#\d+, seg#", x) for x in rows)


def test_more_rows_are_more_tasks(spark):
    """The rows of a task are bounded, and the features are those of fewer, longer tasks."""
    rows = [transaction(f"t{i}", f"a{i % 60}", START + timedelta(minutes=7 * i), amount=float(i % 13)) for i in range(600)]
    t, a = transactions_frame(spark, rows), accounts_frame(spark, [account(f"a{i}", START) for i in range(60)])
    few = extract_features(t, a, ONE_TASK)
    many = extract_features(t, a, Settings(feature_rows_per_task=20))
    assert many.rdd.getNumPartitions() >= 30
    assert sorted(map(str, many.collect())) == sorted(map(str, few.collect()))
