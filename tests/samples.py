"""Small literal tables, and plain-Python definitions to compare with."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta
from itertools import combinations
from statistics import stdev

from ringsight.schemas import ACCOUNTS, TRANSACTIONS

START = datetime(2023, 6, 1, 12)
LINK_WEIGHT = {"device": 1.0, "payment_instrument": 1.0, "subnet": 1.0, "reg_proximity": 0.1}


def account(account_id, created_at=START, **values):
    row = {
        "account_id": account_id,
        "created_at": created_at,
        "kyc_verified": True,
        "registration_device_id": f"dev_{account_id}",
        "registration_ip": None,
        "historical_avg_amount": 100.0,
        "label_ring_member": False,
        "ring_id": None,
        "is_ambiguous": False,
    }
    row.update(values)
    return row


def transaction(txn_id, account_id, timestamp, amount=100.0, **values):
    row = {
        "txn_id": txn_id,
        "account_id": account_id,
        "timestamp": timestamp,
        "amount": amount,
        "merchant_id": "m1",
        "merchant_category": "retail",
        "payment_instrument_id": f"card_{account_id}",
        "device_id": f"dev_{account_id}",
        "ip_address": None,
        "geo_location": "Oslo",
        "status": "success",
        "label_fraud": False,
    }
    row.update(values)
    return row


def frame(spark, rows, schema):
    return spark.createDataFrame([tuple(r[f.name] for f in schema) for r in rows], schema)


def accounts_frame(spark, rows):
    return frame(spark, rows, ACCOUNTS)


def transactions_frame(spark, rows):
    return frame(spark, rows, TRANSACTIONS)


def random_tables(seed=7, n_accounts=24, n_transactions=400):
    """Ties, nulls, a null device, an odd address, an unknown account, and one account with a third of all rows."""
    rng = random.Random(seed)
    accounts = [
        account(
            f"a{i:03d}",
            START - timedelta(days=rng.randint(0, 20), minutes=rng.choice([0, 0, 90, 361])),
            kyc_verified=rng.random() < 0.5,
            registration_device_id=rng.choice([None, f"d{rng.randint(0, 9)}"]),
            registration_ip=rng.choice([f"10.0.{rng.randint(0, 9)}.{i}", "not-an-address"]) if i % 3 else f"10.9.{i}.1",
            historical_avg_amount=float(rng.randint(20, 60)),
            label_ring_member=i % 4 == 0,
            ring_id=f"ring_{i // 8}" if i % 4 == 0 else None,
            is_ambiguous=i % 5 == 1,
        )
        for i in range(n_accounts)
    ]
    transactions = []
    for i in range(n_transactions):
        who = "a001" if i % 3 == 0 else rng.choice([f"a{rng.randrange(n_accounts):03d}", "stranger"])
        when = START + timedelta(seconds=rng.choice([0, 5, 60, 300, 301]) + 60 * rng.randint(0, 4000))
        transactions.append(
            transaction(
                f"t{i:04d}",
                who,
                when,
                rng.choice([5.0, 5.0, 20.0, 37.21, 900.0]),
                merchant_category=rng.choice(["a", "b", "c", None]),
                payment_instrument_id=rng.choice([None, f"c{rng.randint(0, 60)}"]),
                device_id=rng.choice([None, f"d{rng.randint(0, 30)}"]),
                ip_address=rng.choice([None, f"10.0.{rng.randint(0, 60)}.5", "x.y"]),
                geo_location=rng.choice(["Oslo", "Rome", None]),
                status=rng.choice(["success", "failed", "failed", "refunded", "disputed"]),
                label_fraud=rng.random() < 0.2,
            )
        )
    return accounts, transactions


def expected_features(accounts, transactions):
    """txn_id -> features, by walking each account's rows in (timestamp, txn_id) order."""
    average = {a["account_id"]: a["historical_avg_amount"] for a in accounts}
    by_account: dict = {}
    for t in sorted(transactions, key=lambda t: (t["timestamp"], t["txn_id"])):
        by_account.setdefault(t["account_id"], []).append(t)
    out = {}
    for who, rows in by_account.items():
        pairs, usual, most = Counter(), None, 0
        retried = []
        for i, t in enumerate(rows):
            earlier, now = rows[:i], t["timestamp"]
            last = earlier[-1] if earlier else None
            retried.append(bool(last and last["status"] == "failed" and (now - last["timestamp"]).total_seconds() <= 300))
            inside = {s: [j for j in range(i + 1) if (now - rows[j]["timestamp"]).total_seconds() < s] for s in (60, 3600, 86400)}
            amounts = [r["amount"] for r in earlier]
            spread = stdev(amounts) if len(amounts) > 1 and min(amounts) < max(amounts) else 1.0
            pair = (t["geo_location"], t["device_id"])
            pairs[pair] += 1
            if pairs[pair] > most:
                most, usual = pairs[pair], pair
            hours = sum(r["timestamp"].hour == now.hour for r in earlier)
            out[t["txn_id"]] = {
                "velocity_1min": len(inside[60]),
                "velocity_1hr": len(inside[3600]),
                "velocity_24hr": len(inside[86400]),
                "amount_zscore": (t["amount"] - average[who]) / spread if who in average else None,
                "is_new_merchant_category": all(r["merchant_category"] != t["merchant_category"] for r in earlier),
                "geo_device_consistency": pair == usual,
                "is_unusual_hour": bool(earlier) and hours / len(earlier) < 0.05,
                "failure_retry_ratio": sum(retried[j] for j in inside[86400]) / len(inside[86400]),
            }
    return out


def subnet(ip):
    parts = ip.split(".") if ip else []
    return ".".join(parts[:3]) + ".0/24" if len(parts) == 4 else ip


def expected_links(accounts, transactions, minutes=360):
    """(src, dst) -> (types, latest time), by listing every two accounts of every group."""
    groups: dict = {}

    def put(kind, origin, value, who, when):
        if value is not None:
            groups.setdefault((origin, kind, value), []).append((who, when))

    for a in accounts:
        put("device", "r", a["registration_device_id"], a["account_id"], a["created_at"])
        put("subnet", "r", subnet(a["registration_ip"]), a["account_id"], a["created_at"])
    for t in transactions:
        put("device", "t", t["device_id"], t["account_id"], t["timestamp"])
        put("subnet", "t", subnet(t["ip_address"]), t["account_id"], t["timestamp"])
        put("payment_instrument", "t", t["payment_instrument_id"], t["account_id"], t["timestamp"])
    links: dict = {}

    def link(a, b, kind, when):
        types, latest = links.get((a, b), (set(), when))
        links[(a, b)] = (types | {kind}, max(latest, when))

    for (_, kind, _), rows in groups.items():
        latest = max(when for _, when in rows)
        for a, b in combinations(sorted({who for who, _ in rows}), 2):
            link(a, b, kind, latest)
    for x, y in combinations(sorted(accounts, key=lambda a: a["account_id"]), 2):
        if abs((x["created_at"] - y["created_at"]).total_seconds()) <= minutes * 60:
            link(x["account_id"], y["account_id"], "reg_proximity", max(x["created_at"], y["created_at"]))
    return links


def expected_weight(types, days):
    return sum(LINK_WEIGHT[t] for t in types) + max(0.0, 0.5 * (1 - days / 30))


def expected_components(vertices, pairs):
    parent = {v: v for v in vertices}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in pairs:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    return {v: root(v) for v in vertices}
