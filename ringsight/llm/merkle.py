"""A Merkle manifest of a table: one leaf per row, a tree per group, a tree over the groups, and a proof for every row.

1. `leaf_digest` hashes the fields of a row. Leaves are sorted over the whole table by (group, key, digest); each partition of the
   sorted table numbers its own rows, and one line per partition reaches the driver to add the offsets.
2. `_levels` hashes runs of `fan` nodes upwards. One shuffle climbs `LEVELS` levels, because fan**LEVELS consecutive nodes meet in one
   task; every node keeps the digests of its siblings. The roots of the groups are the leaves of the tree over the groups.
3. `_jump` is pointer jumping. Every node holds the segment of siblings on its way to the ancestor `distance` hops above. A
   self-join hangs the ancestor's segment on and doubles the distance, until every leaf holds its whole path: about log2(height)
   joins. After a join with distance d only nodes whose level is a multiple of 2d are met again, so the rounds shrink to the leaves.
   Near the root many nodes point to few ancestors; there the ancestors' side is small, and adaptive execution broadcasts it or
   splits the skewed join.
4. `fold` recomputes the root from a leaf and its path, `proof` hashes the path.

Defined cases: a null field is `-`. Null keys and null groups come first. Rows of one key are ordered by digest; rows equal in all
fields are equal leaves. An empty table gives an empty result. Columns that are not fields are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringsight.session import materialize

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN = 2
LEVELS = 10
TOP = -1
_NODE = "kind int, tree long, level int, idx long, digest binary, siblings binary"


def leaf_digest(values: list[Column]) -> Column:
    """Lowercase hex sha256 of the values as text, each with its byte count before it."""
    parts = []
    for value in values:
        text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def parent_digest(nodes: list[bytes]) -> bytes:
    return hashlib.sha256("".join(x.hex() for x in nodes).encode()).digest()


def _siblings(run: list[bytes], i: int) -> bytes:
    """How many siblings stand before and after, and their digests: the unit that paths are made of."""
    return bytes((i, len(run) - 1 - i)) + b"".join(run[:i] + run[i + 1 :])


def steps(path: bytes) -> Iterator[tuple[list[bytes], list[bytes]]]:
    """The siblings before and after, level by level."""
    at = 0
    while at < len(path):
        before, after = path[at], path[at + 1]
        run = [path[k : k + 32] for k in range(at + 2, at + 2 + 32 * (before + after), 32)]
        yield run[:before], run[before:]
        at += 2 + 32 * (before + after)


def fold(leaf: bytes, path: bytes) -> bytes:
    """The root that a leaf and its siblings lead to."""
    for before, after in steps(path):
        leaf = parent_digest([*before, leaf, *after])
    return leaf


def proof(path: bytes) -> str:
    """Hash of all siblings on the path, from the leaf upwards, left to right."""
    return hashlib.sha256("".join(x.hex() for run in steps(path) for side in run for x in side).encode()).hexdigest()


def _numbered(leaves: DataFrame) -> DataFrame:
    """(tree, idx, key, leaf, other): trees number the groups in order, idx the leaves of a group."""
    order = ["grp", "key", "leaf", "salt"]
    kinds = {f.name: f.dataType.simpleString() for f in leaves.schema}

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, tree, idx, last = TaskContext.get().partitionId(), -1, 0, None
        for batch in batches:
            trees, places = [], []
            for group in batch.column(0).to_pylist():
                if tree < 0 or group != last:
                    tree, idx, last = tree + 1, 0, group
                trees.append(tree)
                places.append(idx)
                idx += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(trees), pa.int32()), pa.array(trees, pa.int64()), pa.array(places, pa.int64()), *batch.columns],
                ["part", "tree", "idx", *batch.schema.names],
            )

    laid = leaves.select("grp", "key", "leaf", "other", "salt").repartitionByRange(*order).sortWithinPartitions(*order)
    types = ", ".join(f"{c} {kinds[c]}" for c in ("grp", "key", "leaf", "other", "salt"))
    rows = materialize(laid.mapInArrow(number, f"part int, tree long, idx long, {types}"), "merkle-leaves")
    ends = rows.groupBy("part").agg(
        F.min_by(F.struct("grp"), "tree").alias("first"), F.max_by(F.struct("grp"), "tree").alias("last"), F.max("tree").alias("trees"),
        F.max(F.struct("tree", "idx")).alias("end"),
    ).orderBy("part").collect()
    # only the first group of a partition can have begun in an earlier one
    offsets, trees, previous, count = [], 0, None, 0
    for end in ends:
        goes_on = previous is not None and previous == end["first"]
        trees -= goes_on
        offsets.append((end["part"], trees, count if goes_on else 0))
        count = end["end"]["idx"] + 1 + (count if goes_on and not end["trees"] else 0)
        trees += end["trees"] + 1
        previous = end["last"]
    known = rows.sparkSession.createDataFrame(offsets, "part int, trees long, off long")  # one row per partition
    idx = F.col("idx") + F.when(F.col("tree") == 0, F.col("off")).otherwise(0)
    return rows.join(F.broadcast(known), "part").select((F.col("tree") + F.col("trees")).alias("tree"), idx.alias("idx"), "key", "leaf", "other")


def _levels(nodes: DataFrame, fan: int, levels: int) -> tuple[DataFrame, DataFrame]:
    """(nodes with their siblings, roots) of the trees over `nodes` (tree, level, idx, digest)."""
    size = fan**levels

    def climb(table: pa.Table) -> pa.Table:
        table = table.sort_by("idx")
        tree, level, at = table.column("tree")[0].as_py(), table.column("level")[0].as_py(), table.column("idx")[0].as_py()
        run, out = table.column("digest").to_pylist(), ([], [], [], [], [], [])
        alone = at < size and len(run) < size  # the whole tree from this level on
        add = lambda *row: [column.append(x) for column, x in zip(out, row, strict=True)]
        for _ in range(levels):
            if alone and len(run) == 1:
                break
            above = []
            for k in range(0, len(run), fan):
                few = run[k : k + fan]
                for i, digest in enumerate(few):
                    add(0, tree, level, at + k + i, digest, _siblings(few, i))
                above.append(parent_digest(few))
            run, level, at = above, level + 1, at // fan
        add(2 if alone else 1, tree, level, at, run[0], None)
        kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
        return pa.table([pa.array(x, kind) for x, kind in zip(out, kinds, strict=True)], ["kind", "tree", "level", "idx", "digest", "siblings"])

    parts = []
    while True:
        tile = F.floor(F.col("idx") / size).alias("tile")
        parts.append(materialize(nodes.groupBy("tree", tile).applyInArrow(climb, _NODE), "merkle-nodes"))
        nodes = parts[-1].where("kind = 1").select("tree", "level", "idx", "digest")
        if nodes.isEmpty():
            every = reduce(DataFrame.unionByName, parts)
            return every.where("kind = 0").drop("kind"), every.where("kind = 2").drop("kind")


def _jump(state: DataFrame, hops: int) -> DataFrame:
    """(tree, idx, path, subroot) of the leaves, by doubling the distance to the ancestors."""
    distance = 1
    while distance < hops:
        met = state.where((F.col("tree") == TOP) | (F.col("level") % distance == 0)).select(
            F.col("tree").alias("up_tree"), F.col("level").alias("up_level"), F.col("idx").alias("up_idx"),
            F.struct("up_tree", "up_level", "up_idx", "path", "subroot").alias("far"),
        )
        wanted = state.where((F.col("tree") == TOP) | (F.col("level") % (2 * distance) == 0))
        moved = wanted.join(met, ["up_tree", "up_level", "up_idx"]).select(
            "tree", "level", "idx", "far.up_tree", "far.up_level", "far.up_idx",
            F.concat("path", "far.path").alias("path"), F.coalesce("subroot", "far.subroot").alias("subroot"),
        )
        distance *= 2
        state = wanted.where("up_tree is null").select(*moved.columns).unionByName(moved)
        if distance < hops:
            state = materialize(state, "merkle-paths")
    return state.where((F.col("tree") != TOP) & (F.col("level") == 0)).select("tree", "idx", "path", "subroot")


def merkle_manifest(
    docs: DataFrame, key: str = "doc_id", group: str = "lang", fields: tuple[str, ...] = FIELDS,
    other: Column | None = None, fan: int = FAN, levels: int = LEVELS,
) -> DataFrame:
    """(key, leaf, other, subroot, root, path, proof_sha256, folded_root) per row; digests in lowercase hex.

    other: the digest of a row as it is found now (null: unchanged). folded_root: from `other`, else the leaf, and the siblings;
    it equals the root if and only if the row is as it was. path: the siblings, as `steps` reads them.
    """
    if not 2 <= fan <= 128:
        raise ValueError("runs of 2 to 128 nodes")
    kind = docs.schema[key].dataType.simpleString()
    leaf = F.unhex(leaf_digest([F.col(c) for c in fields]))
    now = F.lit(None) if other is None else F.unhex(other)
    source = docs.select(
        F.col(group).alias("grp"), F.col(key).alias("key"), leaf.alias("leaf"), now.cast("binary").alias("other"), F.monotonically_increasing_id().alias("salt")
    )
    leaves = _numbered(materialize(source, "merkle-digests"))
    nodes, roots = _levels(leaves.select("tree", F.lit(0).alias("level"), "idx", F.col("leaf").alias("digest")), fan, levels)
    upper, root = _levels(roots.select(F.lit(TOP).cast("long").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("idx"), "digest"), fan, levels)
    top = root.first()
    if top is None:  # an empty table
        digest, height, hops = None, 0, 0
    else:
        digest, height = top["digest"], top["level"]
        hops = roots.agg(F.max("level")).first()[0] + 1 + height
    above = (F.col("level") + 1).cast("int")
    ends = (F.col("tree") == TOP) & (above == height)  # the way ends below the root, where all siblings are known
    state = nodes.unionByName(upper).select(
        "tree", "level", "idx",
        F.when(~ends, F.col("tree")).alias("up_tree"), F.when(~ends, above).alias("up_level"), F.when(~ends, F.floor(F.col("idx") / fan)).alias("up_idx"),
        F.col("siblings").alias("path"), F.lit(None).cast("binary").alias("subroot"),
    )
    over = F.lit(height > 0)
    links = roots.select(
        "tree", "level", "idx",
        F.when(over, F.lit(TOP).cast("long")).alias("up_tree"), F.when(over, F.lit(0)).alias("up_level"), F.when(over, F.col("tree")).alias("up_idx"),
        F.lit(b"").alias("path"), F.col("digest").alias("subroot"),
    )
    paths = _jump(state.unionByName(links), hops)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, leaf_, other_, path_, _ = (c.to_pylist() for c in batch.columns)
            proofs = [proof(p) for p in path_]
            folded = [fold(a if b is None else b, p).hex() for a, b, p in zip(leaf_, other_, path_, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(proofs, pa.string()), pa.array(folded, pa.string())], [*batch.schema.names, "proof", "folded"])

    joined = leaves.join(paths, ["tree", "idx"]).select("key", "leaf", "other", "path", "subroot")
    done = joined.mapInArrow(finish, f"key {kind}, leaf binary, other binary, path binary, subroot binary, proof string, folded string")
    text = lambda c: F.lower(F.hex(c))
    return done.select(
        F.col("key").alias(key), text("leaf").alias("leaf"), text("other").alias("other"), text("subroot").alias("subroot"),
        F.lit(digest.hex() if digest else None).cast("string").alias("root"), "path", F.col("proof").alias("proof_sha256"), F.col("folded").alias("folded_root"),
    )
