import random
from datetime import timedelta
from itertools import combinations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from samples import START, account, accounts_frame, random_tables, transaction, transactions_frame

from ringsight.config import Settings
from ringsight.operators import communities, components, links, scoring


def edge_frame(spark, edges):
    rows = [(min(a, b), max(a, b), float(w)) for a, b, w in edges]
    return spark.createDataFrame(rows, "src string, dst string, weight double")


def clique(names, weight=1.0):
    return [(a, b, weight) for a, b in combinations(names, 2)]


def groups(mapping):
    out: dict = {}
    for r in mapping.collect():
        out.setdefault(r.cluster_id, set()).add(r.account_id)
    return out


A, B, C = [f"a{i}" for i in range(6)], [f"b{i}" for i in range(5)], [f"c{i}" for i in range(4)]


@pytest.fixture(scope="module")
def cliques(spark):
    """Two cliques on a weak bridge, and a small component that must stay whole."""
    edges = edge_frame(spark, clique(A) + clique(B) + [("a0", "b0", 0.1)] + clique(C[:2]) + clique(C[2:]) + [("c1", "c2", 0.01)])
    mapping = [(n, "a0") for n in A + B] + [(n, "c0") for n in C]
    return edges, spark.createDataFrame(mapping, "account_id string, cluster_id string")


def test_cliques_are_recovered_and_small_components_kept(cliques):
    edges, comps = cliques
    assert groups(communities.refine(edges, comps)) == {"a0": set(A), "b0": set(B), "c0": set(C)}


def test_same_communities_for_any_partitioning(spark, cliques):
    edges, comps = cliques
    want = groups(communities.refine(edges, comps))
    assert groups(communities.refine(edges.repartition(13), comps.repartition(5))) == want


def test_communities_depend_on_neither_layout_nor_other_components(spark):
    rng = random.Random(11)
    names = [f"n{k:03d}" for k in rng.sample(range(1000), 150)]
    links_ = {(min(a, b), max(a, b)): rng.choice([1.0, 1.5, 2.0]) for a, b in (rng.sample(names[:90], 2) for _ in range(260))}
    links_ |= {(min(a, b), max(a, b)): 1.0 for a, b in (rng.sample(names[90:], 2) for _ in range(150))}
    edges = edge_frame(spark, [(a, b, w) for (a, b), w in links_.items()])
    first, second = min(names[:90]), min(names[90:])  # a component is named by its smallest account
    mapping = [(n, first) for n in names[:90]] + [(n, second) for n in names[90:]]
    comps = spark.createDataFrame(mapping, "account_id string, cluster_id string")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        found = []
        for n in (1, 4, 13):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            found.append(groups(communities.refine(edges.repartition(n), comps.repartition(n))))
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert found[0] == found[1] == found[2] and len(found[0]) > 4
    alone = groups(communities.refine(edges, comps.where(F.col("cluster_id") == first)))
    assert alone == {k: v for k, v in found[0].items() if v <= set(names[:90])}


def test_a_clique_stays_one_group(spark):
    comps = spark.createDataFrame([(n, "a0") for n in A], "account_id string, cluster_id string")
    assert groups(communities.refine(edge_frame(spark, clique(A)), comps)) == {"a0": set(A)}


def test_random_graph_is_refined_and_modularity_never_below_one_group(spark):
    accounts, transactions = random_tables(5)
    a = accounts_frame(spark, accounts)
    t = transactions_frame(spark, [x for x in transactions if x["account_id"] != "stranger"])
    members = links.memberships(a, t)
    edges = links.weighted_edges(a, t, members)
    comps = components.account_components(a, members)
    found = communities.refine(edges, comps)
    assert found.count() == len(accounts) == found.select("account_id").distinct().count()
    spanning = found.join(comps.withColumnRenamed("cluster_id", "comp"), "account_id").groupBy("cluster_id").agg(F.count_distinct("comp").alias("n"))
    assert spanning.where("n > 1").isEmpty()
    assert all(r.modularity >= -1e-9 for r in communities.modularity(edges, found, comps).collect())


ROUNDS = Settings(community_links_per_task=0)


def random_edges(seed, n, links_):
    rng = random.Random(seed)
    names = [f"n{k:03d}" for k in rng.sample(range(1000), n)]
    found = {tuple(sorted(rng.sample(names, 2))): rng.choice([0.6, 1.0, 1.1, 1.5, 2.2]) for _ in range(links_)}
    for group in range(4):  # cliques, as shared values make them
        found |= {(a, b): 1.3 for a, b in combinations(sorted(rng.sample(names, 7)), 2)}
    return names, [(a, b, w) for (a, b), w in found.items()]


@pytest.mark.parametrize("seed,n,links_", [(1, 40, 60), (2, 200, 420)])
def test_rounds_and_tasks_find_the_same_communities(spark, seed, n, links_):
    names, edges = random_edges(seed, n, links_)
    comps = spark.createDataFrame([(name, min(names)) for name in names], "account_id string, cluster_id string")
    frame = edge_frame(spark, edges)
    in_tasks = groups(communities.refine(frame, comps))
    assert groups(communities.refine(frame.repartition(5), comps, ROUNDS)) == in_tasks
    assert 1 < len(in_tasks) < n


def test_blocks_of_links_and_joins_find_the_same_communities(spark, monkeypatch):
    """Rounds over packed blocks write no table a round; two components in one run, and beyond `broadcast_rows` joins do the same."""
    parts = [random_edges(seed, 24, 20) for seed in (3, 4)]
    names = [f"{k}{name}" for k, (part, _) in enumerate(parts) for name in part]
    frame = edge_frame(spark, [(f"{k}{a}", f"{k}{b}", w) for k, (_, edges) in enumerate(parts) for a, b, w in edges])
    comps = spark.createDataFrame([(name, min(x for x in names if x[0] == name[0])) for name in names], "account_id string, cluster_id string")
    in_tasks = groups(communities.refine(frame, comps))
    tables, write = [], communities.materialize
    monkeypatch.setattr(communities, "materialize", lambda df, label: tables.append(label) or write(df, label))
    blocks = Settings(community_links_per_task=0, community_block_links=50)
    assert groups(communities.refine(frame.repartition(3), comps, blocks)) == in_tasks
    assert "community-wishes" not in tables and "community-blocks" in tables
    joins = Settings(community_links_per_task=0, broadcast_rows=0)
    assert groups(communities.refine(frame, comps, joins)) == in_tasks


def test_five_nodes_count_as_one_broadcast_row(spark, monkeypatch):
    """A few times more nodes than `broadcast_rows` still take no table a round."""
    names, edges = random_edges(6, 40, 60)
    comps = spark.createDataFrame([(name, min(names)) for name in names], "account_id string, cluster_id string")
    frame, tables, write = edge_frame(spark, edges), [], communities.materialize
    in_tasks = groups(communities.refine(frame, comps))
    monkeypatch.setattr(communities, "materialize", lambda df, label: tables.append(label) or write(df, label))
    assert groups(communities.refine(frame, comps, Settings(community_links_per_task=0, broadcast_rows=10))) == in_tasks
    assert "community-wishes" not in tables and "community-blocks" in tables


def test_rounds_end_in_tasks_once_levels_are_small(spark, monkeypatch):
    """The later levels of a large component take no table a round, and its communities stay the same."""
    names, edges = random_edges(2, 200, 420)
    comps = spark.createDataFrame([(name, min(names)) for name in names], "account_id string, cluster_id string")
    frame, levels, settle = edge_frame(spark, edges), [], communities._settle
    monkeypatch.setattr(communities, "_settle", lambda *given: levels.append(1) or settle(*given))
    in_tasks = groups(communities.refine(frame, comps))
    assert not levels
    assert groups(communities.refine(frame, comps, Settings(community_links_per_task=len(edges) - 1))) == in_tasks
    assert len(levels) == 1


def modularity_of(group, u, v, w):
    total = 2 * w.sum()
    inside = 2 * w[group[u] == group[v]].sum()
    volume = np.bincount(group, np.bincount(u, w, len(group)) + np.bincount(v, w, len(group)))
    return inside / total - (volume**2).sum() / total**2


@pytest.mark.parametrize("seed", range(25))
def test_no_single_move_improves_a_split(seed):
    """Of random graphs: the split is at least as good as one group, and no node wants to leave its community for another."""
    names, edges = random_edges(seed, 30 + 5 * seed, 40 + 9 * seed)
    at = {name: k for k, name in enumerate(sorted(names))}
    u, v = (np.array([at[e[k]] for e in edges]) for k in (0, 1))
    w = np.array([e[2] for e in edges])
    h = np.random.default_rng(seed).integers(-(2**63), 2**63, len(names))
    group = np.unique(communities.split_component(u, v, w, h), return_inverse=True)[1]
    best = modularity_of(group, u, v, w)
    assert best >= -1e-12
    one_level = communities._Local(np.concatenate((u, v)), np.concatenate((v, u)), np.concatenate((w, w)), np.zeros(len(h)), h, Settings())
    c, q = one_level.settle()
    top, gain, stay, now = one_level.wishes(c)
    assert (gain <= stay).all() and q == now and best * 1e9 >= q - 2


def test_popular_values_split_like_any_other(spark):
    """Two devices that many accounts share, joined by one account of both: the communities of the full pair list."""
    accounts = [account(f"a{i:03d}", START + timedelta(days=i), registration_device_id="one" if i < 60 else "two") for i in range(110)]
    bridge = [transaction("t1", "a003", START, device_id="card"), transaction("t2", "a090", START, device_id="card")]
    a, t = accounts_frame(spark, accounts), transactions_frame(spark, bridge)
    members = links.memberships(a, t)
    comps = components.account_components(a, members)
    assert comps.select("cluster_id").distinct().count() == 1
    for cfg in (Settings(), Settings(block_members=8), Settings(community_links_per_task=0)):
        found = groups(communities.refine(links.weighted_edges(a, t, members, cfg), comps, cfg))
        assert found == {"a000": {f"a{i:03d}" for i in range(60)}, "a060": {f"a{i:03d}" for i in range(60, 110)}}


def correlation_of_members(rows, members):
    df = pd.DataFrame([(r["account_id"], r["timestamp"].replace(minute=0, second=0)) for r in rows if r["account_id"] in members])
    if df.empty or len(members) < 2:
        return 0.0
    grid = pd.crosstab(df[1], df[0]).reindex(columns=sorted(members), fill_value=0)
    values = grid.corr().values[np.triu_indices(len(members), 1)]
    values = values[~np.isnan(values)]
    return float(np.clip(values.mean(), 0, 1)) if len(values) else 0.0


def test_cluster_scores(spark):
    hours = {"s1": [0, 0, 1, 5], "s2": [0, 1, 1, 5], "flat": [0, 1, 2, 3, 5], "quiet": [], "lone": [1], "q1": [], "q2": []}
    rows = [
        transaction(f"{who}{i}", who, START + timedelta(hours=h), status="disputed" if who == "s1" else "success")
        for who, list_ in hours.items()
        for i, h in enumerate(list_)
    ]
    accounts = [account(who, START + timedelta(minutes=i), kyc_verified=who != "s1") for i, who in enumerate(hours)]
    cluster = {"s1": "s", "s2": "s", "flat": "s", "quiet": "s", "lone": "lone", "q1": "q", "q2": "q"}
    a, t = accounts_frame(spark, accounts), transactions_frame(spark, rows)
    mapping = spark.createDataFrame(list(cluster.items()), "account_id string, cluster_id string")
    signals = spark.createDataFrame([("s", "device"), ("s", "subnet"), ("s", "reg_proximity")], "cluster_id string, link_type string")
    got = {r.cluster_id: r for r in scoring.score_clusters(mapping, components.cluster_summary(mapping, signals), a, t).collect()}

    assert got["s"].synchrony == pytest.approx(correlation_of_members(rows, {"s1", "s2", "flat", "quiet"}))
    assert got["q"].synchrony == got["lone"].synchrony == 0.0
    created = [x["created_at"].timestamp() / 3600 for x in accounts[:4]]
    assert got["s"].age_homogeneity == pytest.approx(np.exp(-np.std(created, ddof=1) / 12))
    assert got["lone"].age_homogeneity == 0.0
    assert got["s"].kyc_lack == 0.25 and got["s"].identifier_density == 0.75
    assert got["q"].financial_behavior == 0.0
    share, everyone = 4 / 13, 4 / 14
    assert got["s"].financial_behavior == pytest.approx(max(0, (share / everyone - 1) / 4))
    assert got["s"].flags == ["synchronized_registration", "dense_identifier_sharing"]
    weights = {"age_homogeneity": 0.2, "synchrony": 0.3, "identifier_density": 0.2, "kyc_lack": 0.15, "financial_behavior": 0.15}
    assert got["s"].ring_score == pytest.approx(sum(got["s"][k] * w for k, w in weights.items()), abs=5.1e-5)


def test_synchrony_equals_all_pair_correlations(spark):
    _, transactions = random_tables(9)
    t = transactions_frame(spark, transactions)
    who = sorted({x["account_id"] for x in transactions})
    cluster = {w: f"g{i % 3}" for i, w in enumerate(who)}
    mapping = spark.createDataFrame(list(cluster.items()), "account_id string, cluster_id string")
    got = {r.cluster_id: r.synchrony for r in scoring.synchrony(mapping, scoring.hourly_activity(t)).collect()}
    for g in ("g0", "g1", "g2"):
        assert got[g] == pytest.approx(correlation_of_members(transactions, {w for w in who if cluster[w] == g}), abs=1e-9)


def test_no_bad_outcome_anywhere(spark):
    rows = [transaction(f"t{i}", f"a{i % 2}", START + timedelta(hours=i)) for i in range(4)]
    mapping = spark.createDataFrame([("a0", "c"), ("a1", "c")], "account_id string, cluster_id string")
    activity = scoring.hourly_activity(transactions_frame(spark, rows))
    assert scoring.financial_behavior(mapping, activity).first().financial_behavior == 0.0
