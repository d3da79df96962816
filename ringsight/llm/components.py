"""Connected components of links between rows numbered by longs (large-star / small-star rounds, each written out)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringsight.session import materialize


def star_links(members: DataFrame, group: list[str], node: str) -> DataFrame:
    """(u, v), u > v: every member of a group linked to its smallest member. Grouped minima only, so any size is fine."""
    heads = members.groupBy(*group).agg(F.min(node).alias("v"), F.count("*").alias("n")).where("n > 1").drop("n")
    return members.join(heads, group).where(F.col(node) > F.col("v")).select(F.col(node).alias("u"), "v")


def components(links: DataFrame, label: str) -> DataFrame:
    """(node, root) for every node that has a link; the root is the smallest node of its component."""
    links = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct()
    now = materialize(links, label)
    while not _settled(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
        large = now.select(F.col("u").alias("larger"), F.col("v").alias("u")).unionByName(
            now.select(F.col("u").alias("larger"), F.col("u"))
        )
        # larger neighbours of a node go to its smallest neighbour; then so do the smaller ones
        large = large.join(low, "u").select(F.col("larger").alias("u"), F.col("low").alias("v")).where("u > v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).where("u > v")
        now = materialize(small.unionByName(least.select("u", F.col("low").alias("v"))).distinct(), label)
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _settled(links: DataFrame) -> bool:
    """Whether every node has one smaller neighbour, and that one has none."""
    up = links.groupBy("u").agg(F.count("*").alias("n"))
    heads = links.select(F.col("v").alias("u"), F.lit(2).alias("n"))
    worst = up.unionByName(heads.distinct()).groupBy("u").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0]
    return worst is None or worst <= 2
