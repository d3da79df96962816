"""Connected components of the account graph, and summaries of any account grouping.

Neither needs pairs of accounts. Components start from stars over the memberships (each member points to the smallest
account of its group), then alternate the large-star and small-star steps of Kiveris et al., "Connected Components in
MapReduce and Beyond" (2014). Every round is written out, which cuts the lineage. A component is named by its smallest
account.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ringsight.config import DEFAULT, Settings
from ringsight.operators.links import GROUP, PROXIMITY, nodes, proximity_chains, registrations
from ringsight.session import exceeds, hint, materialize


def star_links(members: DataFrame, ids: DataFrame, cfg: Settings = DEFAULT) -> DataFrame:
    """(u, v) with u > v, as numbers of `ids`: each member linked to the smallest of its group.

    The smallest is a grouped minimum over longs, combined before the shuffle, so a group of all accounts reaches it as one row
    per task. Members meet the heads of groups above `group_rows` by a broadcast (at most rows / `group_rows` of them, counted),
    so they stay where they are; the others by a shuffle.
    """
    rows = members.select(*GROUP, F.col("account_id").alias("name")).join(ids, "name").select(*GROUP, "id")
    heads = materialize(
        rows.groupBy(*GROUP).agg(F.min("id").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1"), "group-heads"
    )
    large = hint(heads.where(F.col("n") > cfg.group_rows), cfg.broadcast_rows)
    small = heads.where(F.col("n") <= cfg.group_rows)
    met = rows.join(large, GROUP).unionByName(rows.join(large.select(*GROUP), GROUP, "left_anti").join(small, GROUP))
    return met.where(F.col("id") > F.col("head")).select(F.col("id").alias("u"), F.col("head").alias("v"))


def numbered(names: DataFrame) -> DataFrame:
    """(name, id) for distinct names, ids in name order.

    Graph rounds run on longs: they shuffle less than strings, and min() over them is a hash aggregate instead of a sort.
    A range partitioning keeps the order across partitions, and the table is written once, so ids never change afterwards.
    """
    ordered = names.distinct().repartitionByRange("name").sortWithinPartitions("name")
    return materialize(ordered.withColumn("id", F.monotonically_increasing_id()), "numbered")


def connected_components(edges: DataFrame, vertices: DataFrame) -> DataFrame:
    """(account_id, cluster_id) for every vertex; `edges` has columns u, v in any direction, both of them vertices."""
    ids = numbered(vertices.select(F.col("account_id").alias("name")))
    ends = edges.where(F.col("u") != F.col("v"))
    for end in ("u", "v"):
        ends = ends.join(ids.withColumnRenamed("name", end), end).drop(end).withColumnRenamed("id", end)
    return _closed(ends.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), ids)


def _closed(links: DataFrame, ids: DataFrame) -> DataFrame:
    """(account_id, cluster_id) from links (u, v) with u > v between the numbers of `ids`."""
    current = materialize(links, "component-links")
    while True:
        current = materialize(_small_star(_large_star(current)), "component-links")
        if _is_star_forest(current):
            break
    names = ids.select(F.col("id").alias("v"), F.col("name").alias("head"))
    heads = current.join(names, "v").select(F.col("u").alias("id"), "head")
    return ids.join(heads, "id", "left").select(
        F.col("name").alias("account_id"), F.coalesce("head", "name").alias("cluster_id")
    )


def _is_star_forest(links: DataFrame) -> bool:
    """Done when every node has one smaller neighbour and that neighbour has none."""
    parents = links.select(F.col("v").alias("u"), F.lit(2).alias("role")).distinct()
    roles = links.select("u", F.lit(1).alias("role")).unionByName(parents)
    return not exceeds(roles.groupBy("u").agg(F.count(F.lit(1)).alias("n")), "n", 1)


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour (or the node)."""
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
    return both.where(F.col("v") > F.col("u")).join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is linked to the smallest of them."""
    low = links.groupBy("u").agg(F.min("v").alias("low"))
    moved = links.join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return moved.unionByName(low.select("u", F.col("low").alias("v"))).where(F.col("u") != F.col("v")).distinct()


def account_components(
    accounts: DataFrame, members: DataFrame, cfg: Settings = DEFAULT
) -> DataFrame:
    """Components of the graph in which accounts sharing an identifier, or registered close in time, are linked."""
    linked = members.unionByName(proximity_chains(accounts, cfg))
    ids = numbered(nodes(accounts).select(F.col("account_id").alias("name")))
    return _closed(star_links(linked, ids, cfg), ids)


def shared_signals(mapping: DataFrame, accounts: DataFrame, members: DataFrame, cfg: Settings = DEFAULT) -> DataFrame:
    """(cluster_id, link_type) for every type present on a link between two members of one cluster.

    A type is present iff one of its values has two accounts in the cluster; for registration times, iff a cluster has two
    accounts in one slot, or its last of a slot and its first of the next are close.
    """
    by_value = (
        members.join(mapping, "account_id")
        .groupBy("cluster_id", *GROUP)
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
        .select("cluster_id", "link_type")
    )
    slots = (
        registrations(accounts, cfg)
        .join(mapping, "account_id")
        .groupBy("cluster_id", "slot")
        .agg(F.count(F.lit(1)).alias("n"), F.min("us").alias("first"), F.max("us").alias("last"))
    )
    next_first = F.lead("first").over(Window.partitionBy("cluster_id").orderBy("slot"))
    by_time = (
        slots.withColumn("gap", next_first - F.col("last"))
        .where((F.col("n") > 1) | (F.col("gap") <= cfg.proximity_micros))
        .select("cluster_id", F.lit(PROXIMITY).alias("link_type"))
    )
    return by_value.unionByName(by_time).distinct()


def cluster_summary(mapping: DataFrame, signals: DataFrame) -> DataFrame:
    """(cluster_id, size, shared_types): one bounded row per cluster; the members stay rows of `mapping`."""
    sizes = mapping.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("size"))
    types = signals.groupBy("cluster_id").agg(F.sort_array(F.collect_set("link_type")).alias("shared_types"))
    return sizes.join(types, "cluster_id", "left").select(
        "cluster_id", "size", F.coalesce("shared_types", F.array().cast("array<string>")).alias("shared_types")
    )


def member_lists(mapping: DataFrame) -> DataFrame:
    """(cluster_id, member_accounts): one row per cluster, for the published format.

    A list is as long as its cluster. Nothing else in the library reads lists; members are the rows of `mapping` at every size.
    """
    return mapping.groupBy("cluster_id").agg(F.sort_array(F.collect_list("account_id")).alias("member_accounts"))


def cluster_of(mapping: DataFrame, account_id: str) -> DataFrame:
    """Point lookup in the published mapping."""
    return mapping.where(F.col("account_id") == account_id).select("account_id", "cluster_id")
