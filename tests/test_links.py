from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from samples import (
    START,
    account,
    accounts_frame,
    expected_components,
    expected_links,
    expected_weight,
    random_tables,
    transactions_frame,
)

from ringsight.config import Settings
from ringsight.functions import subnet24
from ringsight.operators import components, links

# every group of more than two accounts, and every slot of more than two registrations, is cut into blocks
BLOCKS = Settings(block_members=2, group_rows=2)


@pytest.fixture(scope="module", params=[1, 2])
def tables(request, spark):
    accounts, transactions = random_tables(request.param)
    transactions = [t for t in transactions if t["account_id"] != "stranger"]
    return accounts, transactions, accounts_frame(spark, accounts), transactions_frame(spark, transactions)


def test_subnets(spark):
    ips = ["192.168.1.55", "10.0.0.1", "invalid_ip", "1.2.3", "1.2.3.4.5", "", None]
    df = spark.createDataFrame([(i,) for i in ips], "ip string").select(subnet24(F.col("ip")).alias("s"))
    assert [r.s for r in df.collect()] == ["192.168.1.0/24", "10.0.0.0/24", "invalid_ip", "1.2.3", "1.2.3.4.5", "", None]


def test_edge_weights(spark):
    df = spark.createDataFrame([(["reg_proximity"], 0.0), (["device", "reg_proximity"], 30.0)], "t array<string>, d double")
    got = [r.w for r in df.select(links.edge_weight(F.col("t"), F.col("d")).alias("w")).collect()]
    assert got == [pytest.approx(0.6), pytest.approx(1.1)]


def test_edges_match_all_pairs(spark, tables):
    accounts, transactions, a, t = tables
    want = expected_links(accounts, transactions)
    now = max([x["created_at"] for x in accounts] + [x["timestamp"] for x in transactions])
    got = {(r.src, r.dst): r for r in links.weighted_edges(a, t).collect()}
    assert got.keys() == want.keys()
    for pair, (types, latest) in want.items():
        assert got[pair].shared_types == sorted(types)
        days = (now - latest).total_seconds() / 86400
        assert got[pair].weight == pytest.approx(expected_weight(types, days))


def test_blocks_give_every_pair_once(spark, tables):
    accounts, transactions, a, t = tables
    members = links.memberships(a, t)
    listed = [(r.src, r.dst, r.link_type) for r in links.identifier_pairs(members, BLOCKS).collect()]
    plain = [(r.src, r.dst, r.link_type) for r in links.identifier_pairs(members).collect()]
    assert sorted(listed) == sorted(plain)
    want = {(x, y, kind) for (x, y), (types, _) in expected_links(accounts, transactions).items() for kind in types if kind != "reg_proximity"}
    assert set(listed) == want


@pytest.mark.parametrize("cfg", [Settings(), BLOCKS, Settings(block_members=1)])
def test_every_close_pair_is_found_once(spark, cfg):
    minutes = [0, 0, 3, 100, 300, 359, 360, 361, 500, 719, 720, 720, 725, 1081, 1500, 1860, 2221, 9000]
    accounts = [account(f"a{i:02d}", START + timedelta(minutes=m, seconds=i % 3)) for i, m in enumerate(minutes)]
    links_ = {p: latest for p, (types, latest) in expected_links(accounts, []).items() if "reg_proximity" in types}
    rows = links.proximity_pairs(accounts_frame(spark, accounts), cfg).collect()
    assert sorted((r.src, r.dst) for r in rows) == sorted(links_)
    us = {p: int((when - datetime(1970, 1, 1)).total_seconds()) * 1_000_000 for p, when in links_.items()}
    assert {(r.src, r.dst): r.us for r in rows} == us


def test_edges_are_the_same_in_blocks(spark, tables):
    _, _, a, t = tables
    rows = lambda cfg: sorted((r.src, r.dst, round(r.weight, 9), tuple(r.shared_types)) for r in links.weighted_edges(a, t, cfg=cfg).collect())
    assert rows(Settings()) == rows(BLOCKS)


@pytest.mark.parametrize("n", [3, 1500])
def test_a_popular_value_lists_all_its_pairs(spark, n):
    """A device that n accounts share, and their registrations one second apart."""
    accounts = [account(f"a{i:05d}", START + timedelta(seconds=i), registration_device_id="same") for i in range(n)]
    a, t = accounts_frame(spark, accounts), transactions_frame(spark, [])
    members = links.memberships(a, t)
    a.createOrReplaceTempView("popular")
    want = spark.sql("SELECT a.account_id AS src, b.account_id AS dst FROM popular a JOIN popular b ON a.account_id < b.account_id")
    pairs = links.identifier_pairs(members)
    assert pairs.count() == n * (n - 1) // 2 == links.proximity_pairs(a).count()
    assert pairs.select("src", "dst").exceptAll(want).isEmpty() and want.exceptAll(links.proximity_pairs(a).select("src", "dst")).isEmpty()
    edges = links.weighted_edges(a, t, members)
    assert edges.count() == n * (n - 1) // 2
    assert edges.select("shared_types").distinct().collect()[0].shared_types == ["device", "reg_proximity"]
    # a key of the join holds two blocks at most, by the hash that deals them
    sized = members.withColumn("own", F.pmod(F.xxhash64("account_id"), F.lit(-(-n // 256))))
    assert sized.groupBy("own").count().agg(F.max("count")).first()[0] <= 2 * 256


@pytest.mark.parametrize("cfg", [Settings(), BLOCKS])
def test_components_match_union_find(spark, tables, cfg):
    accounts, transactions, a, t = tables
    want = expected_components([x["account_id"] for x in accounts], expected_links(accounts, transactions))
    found = components.account_components(a, links.memberships(a, t), cfg)
    assert {r.account_id: r.cluster_id for r in found.collect()} == want


def test_components_of_paths_stars_and_loops(spark):
    path = [(f"p{i:03d}", f"p{i + 1:03d}") for i in range(60)]
    star = [("s000", f"s{i:03d}") for i in range(1, 40)]
    pairs = path + star + [("z1", "z1"), ("y2", "y1"), ("y1", "y2")]
    names = sorted({n for p in pairs for n in p} | {"alone"})
    edges = spark.createDataFrame(pairs, "u string, v string").repartition(7)
    found = components.connected_components(edges, spark.createDataFrame([(n,) for n in names], "account_id string"))
    assert {r.account_id: r.cluster_id for r in found.collect()} == expected_components(names, pairs)


def test_summary_lists_types_of_links_inside_a_cluster(spark, tables):
    accounts, transactions, a, t = tables
    # any grouping, not only components: by the last digit of the account
    mapping = a.select("account_id", F.concat(F.lit("g"), F.substring("account_id", -1, 1)).alias("cluster_id"))
    want: dict = {}
    for (x, y), (types, _) in expected_links(accounts, transactions).items():
        if x[-1] == y[-1]:
            want.setdefault(f"g{x[-1]}", set()).update(types)
    signals = components.shared_signals(mapping, a, links.memberships(a, t))
    got = {r.cluster_id: r for r in components.cluster_summary(mapping, signals).collect()}
    assert {c: set(r.shared_types) for c, r in got.items() if r.shared_types} == want
    assert sum(r["size"] for r in got.values()) == len(accounts)


def test_a_group_of_all_accounts_is_combined_before_the_shuffle(spark):
    accounts = [account(f"a{i:04d}", START + timedelta(days=i), registration_device_id="same") for i in range(300)]
    a, t = accounts_frame(spark, accounts), transactions_frame(spark, [])
    members = links.memberships(a, t)
    ids = components.numbered(links.nodes(a).select(F.col("account_id").alias("name")))
    found = components.star_links(members, ids, BLOCKS)
    assert found.count() == 299 and found.select("v").distinct().count() == 1
    # members of a large group meet its head by a broadcast, so no task gathers them
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [origin" in plan


def test_member_lists_are_one_row_per_cluster(spark):
    mapping = spark.range(100).select(F.concat(F.lit("a"), "id").alias("account_id"), F.when(F.col("id") < 5, "s").otherwise("l").alias("cluster_id"))
    rows = {r.cluster_id: r.member_accounts for r in components.member_lists(mapping).collect()}
    assert rows["s"] == ["a0", "a1", "a2", "a3", "a4"] and len(rows["l"]) == 95 and rows["l"] == sorted(rows["l"])
    assert components.cluster_of(mapping, "a3").first().cluster_id == "s"
