"""Split large components into communities by modularity, for all of them at once.

A synchronous Louvain. In a round every node weighs the neighbouring communities; nodes that would gain move, but not all at a time,
lest neighbours swap places for ever:

- while rounds bring gains, about half of the nodes may move, chosen by a bit of the hash of the node's name (all of them while
  only few of the component want to);
- after two rounds without a gain, of the nodes that want to move only those go whose two communities, the old and the new one, no
  node with a smaller hash wants to leave or to enter. Such moves do not touch each other, so together they never lose.

An assignment that lost modularity is taken back. A component is settled when no node wants to move; its communities are then the
nodes of the next level, and levels end when nothing merges. There is no cap on rounds or levels. Gains are compared in whole units
of 1e-9 and ids keep the order of names, so the result depends neither on the order of additions, nor on the partitions, nor on
the other components.

Components of at most `community_links_per_task` links run these rounds in one task each, on arrays (`_Local`); larger ones in rounds
over all tasks, until the levels have made them as small. While the nodes are at most five times `broadcast_rows` (counted), a round is one pass
over blocks of packed links with the assignment broadcast; beyond that it is joins, one written table a round. All of them follow the
same rules and give the same communities, which tests compare.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringsight.config import DEFAULT, Settings
from ringsight.operators.components import numbered
from ringsight.session import exceeds, materialize

UNITS = 1e9
#: rounds without a gain after which moves must not touch each other
PATIENCE = 2
_NONE = -(1 << 62)
#: nodes of a packed assignment (17 bytes each when it is sent) that count as one broadcast row of a table
NODES_PER_ROW = 5


def refine(edges: DataFrame, components: DataFrame, cfg: Settings = DEFAULT) -> DataFrame:
    """(account_id, cluster_id): components below the size limit unchanged, larger ones split into communities."""
    sizes = components.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("size"))
    large_ids = sizes.where(F.col("size") >= cfg.community_min_size).select("cluster_id")
    large = materialize(components.join(large_ids, "cluster_id", "left_semi"), "large-components")
    found = communities(edges, large, cfg)
    kept = components.join(large_ids, "cluster_id", "left_anti").select("account_id", "cluster_id")
    return kept.unionByName(found)


def communities(edges: DataFrame, members: DataFrame, cfg: Settings = DEFAULT) -> DataFrame:
    """(account_id, cluster_id) for the accounts of `members` (account_id, cluster_id = component)."""
    place = members.select(F.col("account_id").alias("src"), F.col("cluster_id").alias("comp"))
    # both ends are accounts of the table; a transaction of an unknown account links nobody here
    other = place.select(F.col("src").alias("dst"), F.col("comp").alias("comp2"))
    both = edges.join(place, "src").join(other, "dst").where(F.col("comp") == F.col("comp2"))
    inside = materialize(both.select("comp", "src", "dst", "weight"), "component-edges")
    counts = inside.groupBy("comp").agg(F.count(F.lit(1)).alias("n"))
    huge = materialize(counts.where(F.col("n") > cfg.community_links_per_task).select("comp"), "huge-components")
    rows = members.select(F.col("cluster_id").alias("comp"), "account_id", F.xxhash64("account_id").alias("h"))
    if huge.isEmpty():
        return _in_tasks(inside, rows, cfg)
    found = _in_rounds(inside.join(huge, "comp", "left_semi"), rows.join(huge, "comp", "left_semi"), cfg)
    small = rows.join(huge, "comp", "left_anti")
    return found.unionByName(_in_tasks(inside.join(huge, "comp", "left_anti"), small, cfg))


def _choices(nodes: np.ndarray, u: np.ndarray, v: np.ndarray, w: np.ndarray, c: np.ndarray, total: np.ndarray, k: np.ndarray, m2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of nodes (in order) with all their links: the best community, its gain, the gain of staying and the weight into the own one.

    c, total, k, m2: community, degrees in a community of that number, degree and twice the weight of the component, by node.
    """
    n = len(c)
    pairs, at = np.unique(np.concatenate((u * n + c[v], nodes * n + c[nodes])), return_inverse=True)
    weight = np.bincount(at, np.concatenate((w, np.zeros(len(nodes)))), len(pairs))
    who, where = pairs // n, pairs % n
    mine = where == c[who]
    gain = np.floor((weight - k[who] * (total[where] - np.where(mine, k[who], 0.0)) / m2[who]) * UNITS + 0.5).astype(np.int64)
    # pairs are in order of node and community: of the communities with the most gain the first one counts
    starts = np.searchsorted(who, nodes)
    most = np.maximum.reduceat(gain, starts)
    top = np.flatnonzero(gain == np.repeat(most, np.diff(np.append(starts, len(who)))))
    first = top[np.searchsorted(who[top], nodes)]
    return where[first], gain[first], gain[mine], weight[mine]


# one task per component


class _Local:
    """One level of one component, on arrays: links both ways, loops, hashes; nodes are numbered in order of names."""

    def __init__(self, u: np.ndarray, v: np.ndarray, w: np.ndarray, loop: np.ndarray, h: np.ndarray, cfg: Settings):
        self.u, self.v, self.w, self.loop, self.h, self.cfg = u, v, w, loop, h, cfg
        self.n = len(loop)
        self.k = np.bincount(u, w, self.n) + 2 * loop
        self.m2 = self.k.sum()

    def wishes(self, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """(the best community, its gain, the gain of staying, units of modularity) of an assignment."""
        total = np.bincount(c, self.k, self.n)
        top, gain, stay, own = _choices(np.arange(self.n), self.u, self.v, self.w, c, total, self.k, np.broadcast_to(self.m2, self.n))
        within = own.sum() + 2 * self.loop.sum()
        quality = int(np.floor((within / self.m2 - (total * total).sum() / (self.m2 * self.m2)) * UNITS + 0.5))
        return top, gain, stay, quality

    def settle(self) -> tuple[np.ndarray, int]:
        c = best = np.arange(self.n)
        q, idle, few, number = _NONE, 0, False, 0
        while True:
            top, gain, stay, now = self.wishes(c)
            wants, fell = gain > stay, now < q and idle <= PATIENCE
            if not fell and not wants.any():
                return c, now
            gained = q == _NONE or now - q > self.cfg.community_tolerance * UNITS
            if fell:
                c = best
            else:
                best, q = c, now
                c = np.where(wants & self._awake(c, top, wants, idle, few, number), top, c)
            few = bool((self.n if fell else wants.sum()) * 10 < self.n)
            idle, number = 0 if gained else idle + 1, number + 1

    def _awake(self, c: np.ndarray, top: np.ndarray, wants: np.ndarray, idle: int, few: bool, number: int) -> np.ndarray:
        if idle >= PATIENCE:
            least = np.full(self.n, np.iinfo(np.int64).max)
            for side in (c, top):
                np.minimum.at(least, side[wants], self.h[wants])
            return (least[c] == self.h) & (least[top] == self.h)
        if few and not idle:
            return np.ones(self.n, bool)
        return (self.h >> (number % 61)) & 1 == 0

    def merged(self, c: np.ndarray) -> tuple[_Local, np.ndarray]:
        """(the next level, the number of each community in it)."""
        names, at = np.unique(c, return_inverse=True)
        n = len(names)
        pairs, into = np.unique(at[self.u] * n + at[self.v], return_inverse=True)
        w = np.bincount(into, self.w, len(pairs))
        u, v = pairs // n, pairs % n
        loop = np.bincount(at, self.loop, n) + np.bincount(u[u == v], w[u == v] / 2, n)
        apart = u != v
        return _Local(u[apart], v[apart], w[apart], loop, self.h[names], self.cfg), at


def split_component(u: np.ndarray, v: np.ndarray, w: np.ndarray, h: np.ndarray, cfg: Settings = DEFAULT) -> np.ndarray:
    """A community number per node of one component; links once, nodes numbered in order of names."""
    return _levels(_Local(np.concatenate((u, v)), np.concatenate((v, u)), np.concatenate((w, w)), np.zeros(len(h)), h, cfg))


def _levels(level: _Local) -> np.ndarray:
    """A community number per node of a level, after all levels from there."""
    place = np.arange(level.n)
    while len(level.u):
        c, q = level.settle()
        if q < 0:  # no split beats one single group
            return np.zeros(len(place), np.int64)
        if (c == np.arange(level.n)).all():
            break
        level, at = level.merged(c)
        place = at[place]
    return place


def _in_tasks(inside: DataFrame, rows: DataFrame, cfg: Settings) -> DataFrame:
    def split(links: pd.DataFrame, nodes: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("account_id", ignore_index=True)
        names = nodes["account_id"].to_numpy(object)
        number = pd.Series(np.arange(len(names)), index=names)
        u, v = (number.loc[links[end]].to_numpy(np.int64) for end in ("src", "dst"))
        # links in order, so that sums do not depend on how rows arrived
        order = np.lexsort((v, u))
        group = split_component(u[order], v[order], links["weight"].to_numpy(float)[order], nodes["h"].to_numpy(np.int64), cfg)
        _, first, at = np.unique(group, return_index=True, return_inverse=True)
        return pd.DataFrame({"account_id": names, "cluster_id": names[first][at]})

    return inside.groupBy("comp").cogroup(rows.groupBy("comp")).applyInPandas(split, "account_id string, cluster_id string")


# rounds over all components that one task should not hold


def _in_rounds(inside: DataFrame, rows: DataFrame, cfg: Settings) -> DataFrame:
    ids = numbered(rows.select(F.col("account_id").alias("name")))
    one_way = inside.select("comp", F.col("src").alias("u"), F.col("dst").alias("v"), F.col("weight").alias("w"))
    place = rows.select("comp", "account_id", F.col("account_id").alias("node"), "h")
    for end in ("comp", "u", "v"):
        one_way = one_way.join(ids.withColumnRenamed("name", end), end).drop(end).withColumnRenamed("id", end)
    for end in ("comp", "node"):
        place = place.join(ids.withColumnRenamed("name", end), end).drop(end).withColumnRenamed("id", end)
    both = one_way.select("comp", "u", "v", "w").unionByName(one_way.select("comp", F.col("v").alias("u"), F.col("u").alias("v"), "w"))
    links = _laid(both)
    place = materialize(place, "community-members")
    loops = links.sparkSession.createDataFrame([], "u long, loop double")
    hashes = place.select(F.col("node").alias("u"), "h")
    place = place.drop("h")
    while True:
        settled = _settle(links, loops, hashes, cfg)
        moved = settled.select("u", "c", "q")
        # a component in which no split beats one single group stays one group
        target = F.when(F.col("q") < 0, F.col("comp")).otherwise(F.coalesce("c", "node"))
        place = materialize(
            place.join(moved.withColumnRenamed("u", "node"), "node", "left").select("account_id", "comp", target.alias("node")),
            "community-members",
        )
        left = settled.where("q >= 0")
        if left.where(F.col("c") != F.col("u")).isEmpty():
            break
        links, loops = _contract(links, loops, left.select("u", "c"))
        if links.isEmpty():
            break
        sizes = links.groupBy("comp").agg((F.count(F.lit(1)) / 2).alias("n"))
        if not exceeds(sizes, "n", cfg.community_links_per_task):
            return _names(_ended_in_tasks(links, loops, hashes, place, cfg))
    return _names(place)


def _laid(links: DataFrame) -> DataFrame:
    """Links written node by node, so that a task adds up nearly all of a node's weights before the shuffle."""
    return materialize(links.repartition("u").sortWithinPartitions("u"), "community-links")


def _names(place: DataFrame) -> DataFrame:
    """(account_id, cluster_id): every community named by its smallest account."""
    names = place.groupBy("comp", "node").agg(F.min("account_id").alias("cluster_id"))
    return place.join(names, ["comp", "node"]).select("account_id", "cluster_id")


def _ended_in_tasks(links: DataFrame, loops: DataFrame, hashes: DataFrame, place: DataFrame, cfg: Settings) -> DataFrame:
    """`place` after all further levels, once what is left of every component fits one task."""

    def split(links: pd.DataFrame, nodes: pd.DataFrame) -> pd.DataFrame:
        if not len(links):
            return nodes[["comp", "node"]].assign(into=nodes["node"])
        links = links.sort_values(["u", "v"], ignore_index=True)
        nodes = nodes.sort_values("node", ignore_index=True)
        number = pd.Series(np.arange(len(nodes)), index=nodes["node"])
        u, v = (number.loc[links[end]].to_numpy(np.int64) for end in ("u", "v"))
        level = _Local(u, v, links["w"].to_numpy(float), nodes["loop"].to_numpy(float), nodes["h"].to_numpy(np.int64), cfg)
        _, first, at = np.unique(_levels(level), return_index=True, return_inverse=True)
        names = nodes["node"].to_numpy(np.int64)
        return pd.DataFrame({"comp": nodes["comp"], "node": names, "into": names[first][at]})

    loop = F.coalesce("loop", F.lit(0.0)).alias("loop")
    left = place.join(links.select("comp").distinct(), "comp", "left_semi").select("comp", F.col("node").alias("u")).distinct()
    nodes = left.join(hashes, "u").join(loops, "u", "left").select("comp", F.col("u").alias("node"), "h", loop)
    moved = links.groupBy("comp").cogroup(nodes.groupBy("comp")).applyInPandas(split, "comp long, node long, into long")
    into = F.coalesce("into", "node").alias("node")
    return materialize(place.join(moved, ["comp", "node"], "left").select("account_id", "comp", into), "community-members")


def _units(value: Column) -> Column:
    return F.floor(value * UNITS + 0.5)


def _settle(links: DataFrame, loops: DataFrame, hashes: DataFrame, cfg: Settings) -> DataFrame:
    """(comp, u, c, q): the settled assignment of the nodes of one level, and its modularity per component."""
    degrees = links.groupBy("comp", "u").agg(F.sum("w").alias("k")).join(loops, "u", "left").join(hashes, "u")
    loop = F.coalesce("loop", F.lit(0.0))
    nodes = degrees.select("comp", "u", "h", (F.col("k") + 2 * loop).alias("k"), loop.alias("loop"))
    few = nodes.agg(F.count(F.lit(1)).alias("n"))
    if not exceeds(few, "n", NODES_PER_ROW * cfg.broadcast_rows):
        return _settle_in_blocks(links, nodes, cfg)
    start = {
        "c": F.col("u"), "best": F.col("u"), "q": F.lit(_NONE).cast("long"), "idle": F.lit(0), "few": F.lit(False), "m2": F.col("m2"),
    }
    state = materialize(nodes.join(nodes.groupBy("comp").agg(F.sum("k").alias("m2")), "comp").withColumns(start), "community-state")
    ended, number = None, 0
    while True:
        wishes = materialize(_wishes(links, state), "community-wishes")
        told = _status(wishes, cfg)
        left, idle, every = told.agg(F.count_if(~F.col("done")), F.max(F.when(~F.col("done"), F.col("old_idle"))), F.count(F.lit(1))).first()
        if left < every:
            now = wishes.join(told.where("done").select("comp", "q_now"), "comp").select("comp", "u", F.col("own").alias("c"), F.col("q_now").alias("q"))
            ended = now if ended is None else ended.unionByName(now)
        if not left:
            return ended
        state, number = _moved(wishes, told.where("not done"), number, idle >= PATIENCE), number + 1


def _blocks(links: DataFrame, ids: np.ndarray, cfg: Settings) -> DataFrame:
    """(u, v, w): rows of packed links, about `community_block_links` each, all links of a node in one; nodes by their place in `ids`."""
    parts = max(1, -(-links.count() // cfg.community_block_links))
    known = links.sparkSession.sparkContext.broadcast(ids)

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        u, v = (np.searchsorted(known.value, rows[end].to_numpy(np.int64)) for end in ("u", "v"))
        order = np.lexsort((v, u))  # so that sums do not depend on how rows arrived
        w = rows["w"].to_numpy(float)[order]
        return pd.DataFrame({"u": [u[order].astype(np.int32).tobytes()], "v": [v[order].astype(np.int32).tobytes()], "w": [w.tobytes()]})

    dealt = links.select("u", "v", "w", F.pmod(F.xxhash64("u"), F.lit(parts)).alias("part")).repartition(parts, "part")
    return materialize(dealt.groupBy("part").applyInPandas(pack, "u binary, v binary, w binary"), "community-blocks")


def _settle_in_blocks(links: DataFrame, nodes: DataFrame, cfg: Settings) -> DataFrame:
    """`_settle` for at most five times `broadcast_rows` nodes: each round one pass of numpy over the packed links, with the assignment broadcast.

    Links never leave their tasks. The driver holds the assignment and what each node wishes, a few numbers a node.
    """
    spark = links.sparkSession
    known = nodes.toArrow().to_pandas().sort_values("u", ignore_index=True)
    ids, h, k, loop = (known[x].to_numpy() for x in ("u", "h", "k", "loop"))
    comps, comp = np.unique(known["comp"].to_numpy(), return_inverse=True)
    blocks, n = _blocks(links, ids, cfg), len(ids)
    size, m2 = np.bincount(comp), np.bincount(comp, k)
    fixed = spark.sparkContext.broadcast((k, m2[comp]))

    def wishes(c: np.ndarray, active: np.ndarray) -> list[np.ndarray]:
        total = np.bincount(c, k, n)
        sent = spark.sparkContext.broadcast((c, total, active))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            c, total, active = sent.value
            k, m2 = fixed.value
            for batch in batches:
                for row in zip(*batch.columns, strict=True):
                    u, v = (np.frombuffer(x.as_buffer(), np.int32).astype(np.int64) for x in row[:2])
                    w, of = np.frombuffer(row[2].as_buffer()), active[u]
                    if not of.all():
                        u, v, w = u[of], v[of], w[of]
                    if len(u):
                        own = u[np.concatenate(([True], u[1:] != u[:-1]))]
                        found = (own, *_choices(own, u, v, w, c, total, k, m2))
                        yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in found], names)

        names = ["node", "top", "gain", "stay", "own"]
        rows = blocks.mapInArrow(run, ", ".join(f"{x} binary" for x in names)).collect()
        sent.destroy()
        node = np.concatenate([np.frombuffer(r["node"], np.int64) for r in rows])
        out = [c.copy(), np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n)]
        for to, name in zip(out, names[1:], strict=True):
            to[node] = np.concatenate([np.frombuffer(r[name], to.dtype) for r in rows])
        squares = np.bincount(comp, k * total[c], len(comps))  # a community's total once per node, by its share of it
        within = np.bincount(comp, out[3] + 2 * loop, len(comps))
        return [*out[:3], np.floor((within / m2 - squares / (m2 * m2)) * UNITS + 0.5).astype(np.int64)]

    c = best = np.arange(n)
    q, idle, few = np.full(len(comps), _NONE), np.zeros(len(comps), np.int64), np.zeros(len(comps), bool)
    done, number = np.zeros(len(comps), bool), 0
    while not done.all():
        top, gain, stay, now = wishes(c, ~done[comp])
        wants = (gain > stay) & ~done[comp]
        restless = np.bincount(comp, wants, len(comps))
        fell = (now < q) & (idle <= PATIENCE) & ~done
        ended = ~fell & (restless == 0) & ~done
        q = np.where(ended, now, q)
        done |= ended
        least = np.full(n, np.iinfo(np.int64).max)
        for side in (c, top):
            np.minimum.at(least, side[wants], h[wants])
        alone = (least[c] == h) & (least[top] == h)
        awake = np.where((idle >= PATIENCE)[comp], alone, (few & (idle == 0))[comp] | ((h >> (number % 61)) & 1 == 0))
        moved = np.where(wants & awake, top, c)
        gained = (q == _NONE) | (now - q > cfg.community_tolerance * UNITS)
        c, best = np.where(fell[comp], best, np.where(done[comp], c, moved)), np.where(fell[comp], best, c)
        q = np.where(fell | done, q, now)
        few = np.where(fell, size, restless) * 10 < size
        idle, number = np.where(gained, 0, idle + 1), number + 1
    fixed.destroy()
    return materialize(spark.createDataFrame(pa.table({"comp": comps[comp], "u": ids, "c": ids[c], "q": q[comp]})), "community-settled")


def _wishes(links: DataFrame, state: DataFrame) -> DataFrame:
    """Per node: the best community and its gain, the gain and weight of staying; per community the sum that modularity needs."""
    k = F.col("k")
    totals = state.groupBy("comp", "c").agg(F.sum("k").alias("total"))
    # what every node would gain in every neighbouring community, and in its own with itself taken out
    neighbours = links.join(state.select(F.col("u").alias("v"), "c"), "v").select("u", "c", "w")
    toward = neighbours.unionByName(state.select("u", "c", F.lit(0.0).alias("w"))).groupBy("u", "c").agg(F.sum("w").alias("w"))
    mine = F.col("c") == F.col("own")
    gain = _units(F.col("w") - k * (F.col("total") - F.when(mine, k).otherwise(0.0)) / F.col("m2"))
    best = (
        toward.join(state.select("u", F.col("c").alias("own"), "k", "m2"), "u")
        .join(totals.select("c", "total"), "c")
        .withColumn("gain", gain)
        .groupBy("u")
        .agg(
            F.min(F.struct((-F.col("gain")).alias("loss"), "c")).alias("top"),
            F.max(F.when(mine, F.col("gain"))).alias("own_gain"),
            F.max(F.when(mine, F.col("w"))).alias("own_w"),
            F.max(F.when(mine, F.col("total"))).alias("total"),
        )
    )
    return best.join(state.withColumnRenamed("c", "own"), "u").withColumn("wants", -F.col("top.loss") > F.col("own_gain"))


def _status(wishes: DataFrame, cfg: Settings) -> DataFrame:
    """One row per component: its modularity now, whether it fell, and how it goes on."""
    per = wishes.groupBy("comp", "m2", "q", "idle", "few").agg(
        F.sum(F.col("own_w") + 2 * F.col("loop")).alias("within"),
        F.sum(F.col("k") * F.col("total")).alias("squares"),  # a community's total once per node, by its share of it
        F.count_if("wants").alias("restless"), F.count(F.lit(1)).alias("n"),
    )
    m2 = F.col("m2")
    now = per.withColumn("q_now", _units(F.col("within") / m2 - F.col("squares") / (m2 * m2)))
    # moves that do not touch each other never lose, whatever rounding says
    fell = (F.col("q_now") < F.col("q")) & (F.col("idle") <= PATIENCE)
    gained = (F.col("q") == _NONE) | (F.col("q_now") - F.col("q") > cfg.community_tolerance * UNITS)
    return now.select(
        "comp", "q_now", fell.alias("fell"), F.col("idle").alias("old_idle"), F.col("few").alias("old_few"),
        F.when(gained, 0).otherwise(F.col("idle") + 1).alias("idle"),
        (F.when(fell, F.col("n")).otherwise(F.col("restless")) * 10 < F.col("n")).alias("few"),
        (~fell & (F.col("restless") == 0)).alias("done"),
    )


def _moved(wishes: DataFrame, told: DataFrame, number: int, apart: bool) -> DataFrame:
    """The next assignment of the components of `told`; apart: for some of them moves must not touch each other."""
    rows = wishes.drop("idle", "few").join(told, "comp")
    bit = F.shiftright("h", number % 61).bitwiseAND(F.lit(1)) == 0
    awake = F.when(F.col("old_few") & (F.col("old_idle") == 0), F.lit(True)).otherwise(bit)
    if apart:
        touched = rows.where("wants").select("comp", "h", F.explode(F.array("own", "top.c")).alias("c"))
        least = touched.groupBy("comp", "c").agg(F.min("h").alias("least"))
        for side, column in (("own", F.col("own")), ("new", F.col("top.c"))):
            found = least.select(F.col("c").alias(f"{side}_c"), F.col("least").alias(f"{side}_least"))
            rows = rows.join(found, column == F.col(f"{side}_c"), "left")
        alone = (F.col("h") == F.col("own_least")) & (F.col("h") == F.col("new_least"))
        awake = F.when(F.col("old_idle") >= PATIENCE, F.coalesce(alone, F.lit(False))).otherwise(awake)
    fell = F.col("fell")
    moves = F.when(F.col("wants") & awake, F.col("top.c")).otherwise(F.col("own"))
    return rows.select(
        "comp", "u", "h", "k", "loop", "m2",
        F.when(fell, F.col("best")).otherwise(moves).alias("c"), F.when(fell, F.col("best")).otherwise(F.col("own")).alias("best"),
        F.when(fell, F.col("q")).otherwise(F.col("q_now")).alias("q"), "idle", "few",
    )


def _contract(links: DataFrame, loops: DataFrame, moved: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Communities become nodes; weight inside a community becomes its loop."""
    left = moved.select("u", F.col("c").alias("cu"))
    right = moved.select(F.col("u").alias("v"), F.col("c").alias("cv"))
    merged = materialize(
        links.join(left, "u").join(right, "v").groupBy("comp", "cu", "cv").agg(F.sum("w").alias("w")), "community-merged"
    )
    between = merged.where(F.col("cu") != F.col("cv")).select("comp", F.col("cu").alias("u"), F.col("cv").alias("v"), "w")
    within = merged.where(F.col("cu") == F.col("cv")).select(F.col("cu").alias("u"), (F.col("w") / 2).alias("loop"))
    older = loops.join(left, "u").select(F.col("cu").alias("u"), "loop")
    new_loops = within.unionByName(older).groupBy("u").agg(F.sum("loop").alias("loop"))
    return _laid(between), materialize(new_loops, "community-loops")


def modularity(edges: DataFrame, mapping: DataFrame, components: DataFrame) -> DataFrame:
    """(comp, modularity) of a grouping, each component with its own total weight."""
    node = mapping.join(components.withColumnRenamed("cluster_id", "comp"), "account_id")
    left = node.select(F.col("account_id").alias("src"), F.col("cluster_id").alias("cu"), "comp")
    right = node.select(F.col("account_id").alias("dst"), F.col("cluster_id").alias("cv"))
    ends = edges.join(left, "src").join(right, "dst")
    m = ends.groupBy("comp").agg(
        F.sum("weight").alias("m"), F.sum(F.when(F.col("cu") == F.col("cv"), F.col("weight")).otherwise(0.0)).alias("inside")
    )
    volume = (
        ends.select("comp", F.col("cu").alias("c"), "weight")
        .unionByName(ends.select("comp", F.col("cv").alias("c"), "weight"))
        .groupBy("comp", "c")
        .agg(F.sum("weight").alias("k"))
        .groupBy("comp")
        .agg(F.sum(F.col("k") * F.col("k")).alias("sq"))
    )
    return m.join(volume, "comp").select(
        "comp", (F.col("inside") / F.col("m") - F.col("sq") / (4 * F.col("m") * F.col("m"))).alias("modularity")
    )
