"""Which accounts are linked, and how strongly.

The base table is `memberships`: one row per (identifier value, account). It grows with the input, never with the square of
a group. Components, cluster signals and densities are computed from it directly. The weighted edge list is the one result
that lists pairs, and it lists all of them at every size. Pairs are made by a block join: the members of a group are dealt into
blocks of about `block_members` by a hash of their names, and every two blocks meet under a key of their own. So a group of any
size is spread over all tasks, no key holds more than two blocks, and a group of one block is an ordinary join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringsight.config import DEFAULT, Settings
from ringsight.functions import days_between, micros, subnet24
from ringsight.session import materialize

PROXIMITY = "reg_proximity"
GROUP = ["origin", "link_type", "value"]


def nodes(accounts: DataFrame) -> DataFrame:
    """Every account once, linked or not."""
    return accounts.select("account_id").distinct()


def memberships(accounts: DataFrame, transactions: DataFrame) -> DataFrame:
    """(origin, link_type, value, account_id, us): who used which identifier, and when last.

    Registration and transaction identifiers are separate name spaces. One pass over each table; the distinct rows are made
    by map-side aggregation, so a value seen in a third of all transactions reaches the shuffle as one row per account.
    """
    registered = _unpivot(
        accounts,
        "registration",
        "created_at",
        {"device": [F.col("registration_device_id")], "subnet": [subnet24(F.col("registration_ip"))]},
    )
    used = _unpivot(
        transactions,
        "transaction",
        "timestamp",
        {
            "device": [F.col("device_id")],
            "subnet": [subnet24(F.col("ip_address"))],
            "payment_instrument": [F.col("payment_instrument_id")],
        },
    )
    return registered.unionByName(used)


def _unpivot(table: DataFrame, origin: str, time: str, identifiers: dict[str, list[Column]]) -> DataFrame:
    each = F.array(
        *[F.struct(F.lit(kind).alias("link_type"), c.alias("value")) for kind, cols in identifiers.items() for c in cols]
    )
    return (
        table.select("account_id", micros(F.col(time)).alias("us"), F.explode(each).alias("id"))
        .select(F.lit(origin).alias("origin"), "id.link_type", "id.value", "account_id", "us")
        .where(F.col("value").isNotNull() & F.col("account_id").isNotNull())
        .groupBy(*GROUP, "account_id")
        .agg(F.max("us").alias("us"))
    )


def shared_groups(members: DataFrame) -> DataFrame:
    """Values used by two accounts or more: count and the group's latest time."""
    return (
        members.groupBy(*GROUP)
        .agg(F.count(F.lit(1)).alias("n"), F.max("us").alias("group_us"))
        .where(F.col("n") > 1)
    )


def _block(blocks: Column) -> Column:
    return F.pmod(F.xxhash64("account_id"), blocks).cast("int")


def _count(n: Column, cfg: Settings) -> Column:
    return F.ceil(n / cfg.block_members).cast("int")


def identifier_pairs(members: DataFrame, cfg: Settings = DEFAULT) -> DataFrame:
    """(src, dst, origin, link_type, us) for every two accounts that share a value, src < dst; us: the group's latest time."""
    sized = members.select(*GROUP, "account_id").join(shared_groups(members), GROUP).withColumn("blocks", _count(F.col("n"), cfg))
    rows = materialize(sized.select(*GROUP, "account_id", "group_us", "blocks", _block(F.col("blocks")).alias("own")), "group-members")
    left = rows.select(
        *GROUP, F.col("account_id").alias("a"), "group_us", F.col("own").alias("i"), F.explode(F.sequence("own", F.col("blocks") - 1)).alias("j")
    )
    right = rows.select(*GROUP, F.col("account_id").alias("b"), F.explode(F.sequence(F.lit(0), "own")).alias("i"), F.col("own").alias("j"))
    return (
        left.join(right, [*GROUP, "i", "j"])
        .where((F.col("i") < F.col("j")) | (F.col("a") < F.col("b")))
        .select(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst"), "origin", "link_type", F.col("group_us").alias("us"))
    )


def registrations(accounts: DataFrame, cfg: Settings = DEFAULT) -> DataFrame:
    """(account_id, us, slot): slots are as wide as the proximity window, so close accounts share or neighbour one."""
    us = micros(F.col("created_at"))
    return (
        accounts.where(us.isNotNull() & F.col("account_id").isNotNull())
        .groupBy("account_id")
        .agg(F.max(us).alias("us"))
        .withColumn("slot", F.floor(F.col("us") / cfg.proximity_micros))
    )


def proximity_pairs(accounts: DataFrame, cfg: Settings = DEFAULT) -> DataFrame:
    """(src, dst, link_type, us) for registrations at most the window apart; the pair's time is the later one.

    A range join written as an equi-join: two accounts of one slot are always close, and an account is compared with those of
    the next slot. Slots are cut into blocks like the groups of `identifier_pairs`, so a crowded one is many keys.
    """
    reg = registrations(accounts, cfg)
    slots = materialize(reg.groupBy("slot").agg(_count(F.count(F.lit(1)), cfg).alias("blocks")), "slots")
    ahead = slots.select((F.col("slot") - 1).alias("slot"), F.col("blocks").alias("next_blocks"))
    behind = slots.select((F.col("slot") + 1).alias("slot"), F.col("blocks").alias("last_blocks"))
    known = slots.join(ahead, "slot", "left").join(behind, "slot", "left")
    rows = materialize(reg.join(known, "slot").withColumn("own", _block(F.col("blocks"))), "slot-members")

    def keys(slot: Column, step: int, i: Column | None, j: Column | None, first: Column, last: Column) -> Column:
        """(slot of the left side, 0 within it or 1 to the next, the two blocks); the one not given runs from first to last."""
        made = F.transform(
            F.sequence(first, last),
            lambda x: F.struct(slot.alias("slot"), F.lit(step).alias("step"), (x if i is None else i).alias("i"), (x if j is None else j).alias("j")),
        )
        return F.when(last.isNotNull(), made).otherwise(F.array().cast("array<struct<slot:bigint,step:int,i:int,j:int>>"))

    own, none = F.col("own"), F.lit(0)
    left = F.concat(
        keys(F.col("slot"), 0, own, None, own, F.col("blocks") - 1), keys(F.col("slot"), 1, own, None, none, F.col("next_blocks") - 1)
    )
    right = F.concat(
        keys(F.col("slot"), 0, None, own, none, own), keys(F.col("slot") - 1, 1, None, own, none, F.col("last_blocks") - 1)
    )
    at = ["k.slot", "k.step", "k.i", "k.j"]
    lefts = rows.select(F.col("account_id").alias("a"), F.col("us").alias("a_us"), F.explode(left).alias("k")).select("a", "a_us", *at)
    rights = rows.select(F.col("account_id").alias("b"), F.col("us").alias("b_us"), F.explode(right).alias("k")).select("b", "b_us", *at)
    within = (F.col("step") == 0) & ((F.col("i") < F.col("j")) | (F.col("a") < F.col("b")))
    across = (F.col("step") == 1) & (F.col("b_us") - F.col("a_us") <= cfg.proximity_micros)
    return (
        lefts.join(rights, ["slot", "step", "i", "j"])
        .where(within | across)
        .select(
            F.least("a", "b").alias("src"),
            F.greatest("a", "b").alias("dst"),
            F.lit(PROXIMITY).alias("link_type"),
            F.greatest("a_us", "b_us").alias("us"),
        )
    )


def edge_weight(types: Column, days: Column, cfg: Settings = DEFAULT) -> Column:
    """Sum of the weights of the shared types plus a bonus that fades over `recency_days`."""
    base = F.lit(0.0)
    for kind in ("device", "payment_instrument", "subnet", PROXIMITY):
        base = base + F.when(F.array_contains(types, kind), cfg.link_weights[kind]).otherwise(0.0)
    bonus = F.greatest(F.lit(0.0), cfg.recency_bonus * (1.0 - days / cfg.recency_days))
    return base + bonus


def latest_time(accounts: DataFrame, transactions: DataFrame) -> DataFrame:
    """One row: the last moment in the data, which stands for "now"."""
    times = accounts.select(micros(F.col("created_at")).alias("us")).unionByName(
        transactions.select(micros(F.col("timestamp")).alias("us"))
    )
    return times.agg(F.max("us").alias("us"))


def weighted_edges(
    accounts: DataFrame, transactions: DataFrame, members: DataFrame | None = None, cfg: Settings = DEFAULT
) -> DataFrame:
    """(src, dst, weight, shared_types): one row per linked pair."""
    if members is None:
        members = memberships(accounts, transactions)
    pairs = identifier_pairs(members, cfg).drop("origin").unionByName(proximity_pairs(accounts, cfg))
    merged = pairs.groupBy("src", "dst").agg(
        F.sort_array(F.collect_set("link_type")).alias("shared_types"), F.max("us").alias("us")
    )
    now = latest_time(accounts, transactions).scalar()
    weight = edge_weight(F.col("shared_types"), days_between(now, F.col("us")), cfg)
    return merged.select("src", "dst", weight.alias("weight"), "shared_types")


def proximity_chains(accounts: DataFrame, cfg: Settings = DEFAULT) -> DataFrame:
    """Membership rows whose value is a run of registrations with no gap above the window.

    Accounts are first reduced to one row per slot; the window over slots is as long as the time span, however many
    accounts there are.
    """
    reg = registrations(accounts, cfg)
    slots = reg.groupBy("slot").agg(F.min("us").alias("first"), F.max("us").alias("last"))
    in_time = Window.orderBy("slot")
    breaks = F.coalesce(F.col("first") - F.lag("last").over(in_time) > cfg.proximity_micros, F.lit(True))
    runs = slots.withColumn("opens", breaks.cast("long")).select("slot", F.sum("opens").over(in_time).alias("run"))
    return reg.join(runs, "slot").select(
        F.lit("registration").alias("origin"),
        F.lit(PROXIMITY).alias("link_type"),
        F.col("run").cast("string").alias("value"),
        "account_id",
        "us",
    )
