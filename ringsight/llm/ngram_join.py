"""Near copies: a Jaccard join of n-gram sets by MinHash banding.

1. Every text becomes its set of hashed word n-grams (words: runs without white space, A-Z as a-z; a text of fewer than n words
   is one n-gram). Texts with one and the same set are one row from here on.
2. `rows` hash minima make a band; the number of bands is chosen so that a pair at the threshold shares one with probability
   `recall`. Rows meet by band hash. A bucket is a star (members to its smallest member), so it costs as many links as it has
   members, and the components of all stars are the candidate groups.
3. Within a candidate group all pairs are verified on the full n-gram sets, so a pair that shares no band but a group is found
   too. A large group is cut into blocks; a task compares two blocks by products of 0/1 matrices and returns one row per member
   (its number of links, and the root of its links), never pairs.
4. Classes are the components of verified links. The number of links counts all other documents, copies included.

Null texts count as empty. Texts without words link to nothing. Rows are told apart by number, so null or repeated ids are
safe (the class id is the smallest id of the class, null if it has none). An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringsight.llm.common import mix, shingle_hashes, word_hashes
from ringsight.llm.components import components, star_links
from ringsight.session import materialize

NGRAM, THRESHOLD, ROWS, RECALL = 5, 0.8, 5, 0.9999
#: Members and n-grams in a block of a candidate group.
BLOCK_ROWS, BLOCK_GRAMS = 1024, 1 << 21
#: About so many members of small groups are verified in one call.
BATCH_ROWS = 4096


def bands_for(threshold: float, rows: int, recall: float) -> int:
    """Bands needed so that a pair at the threshold meets in one of them with probability `recall`."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))


def gram_set(text: str | None, n: int) -> np.ndarray:
    return np.unique(shingle_hashes(word_hashes(text or ""), n))


def _signer(rows: int, bands: int):
    random = np.random.Generator(np.random.PCG64(8))
    a = random.integers(1, 1 << 32, rows * bands, dtype=np.uint32) | np.uint32(1)
    b = random.integers(0, 1 << 32, rows * bands, dtype=np.uint32)
    weight = random.integers(1, 1 << 63, (bands, rows), dtype=np.uint64) | np.uint64(1)

    def sign(grams: np.ndarray) -> np.ndarray:
        """One hash per band."""
        short = (grams >> np.uint64(32)).astype(np.uint32) ^ grams.astype(np.uint32)
        low = np.full(rows * bands, np.uint32(0xFFFFFFFF))
        with np.errstate(over="ignore"):
            for i in range(0, len(short), 2048):
                x = short[i : i + 2048][None, :] * a[:, None] + b[:, None]
                x ^= x >> np.uint32(15)
                x *= np.uint32(0x2C1B3C6D)
                low = np.minimum(low, x.min(axis=1))
            return mix((low.reshape(bands, rows).astype(np.uint64) * weight).sum(axis=1, dtype=np.uint64))

    return sign


def _signatures(docs: DataFrame, key: str, text: str, n: int, rows: int, bands: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sign, slot = _signer(rows, bands), TaskContext.get().partitionId() << 40
        for batch in batches:
            out = {k: [] for k in ("slot", "n", "fp1", "fp2", "bands")}
            for value in batch.column(1):
                grams = gram_set(value.as_py(), n)
                with np.errstate(over="ignore"):
                    prints = (int(grams.sum(dtype=np.uint64)), int(mix(grams).sum(dtype=np.uint64))) if len(grams) else (0, 0)
                out["slot"].append(slot)
                out["n"].append(len(grams))
                out["fp1"].append(prints[0] - (1 << 63))
                out["fp2"].append(prints[1] - (1 << 63))
                out["bands"].append(sign(grams).view(np.int64) if len(grams) else [])
                slot += 1
            types = {"slot": pa.int64(), "n": pa.int64(), "fp1": pa.int64(), "fp2": pa.int64(), "bands": pa.list_(pa.int64())}
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *(pa.array(v, types[k]) for k, v in out.items())], ["key", "th", *out])

    kind = docs.schema[key].dataType.simpleString()
    source = docs.select(F.col(key).alias("key"), F.coalesce(text, F.lit("")).alias("text"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("th"))
    return source.mapInArrow(run, f"key {kind}, th long, slot long, n long, fp1 long, fp2 long, bands array<long>")


def verify(sets: list[np.ndarray], weights: np.ndarray, split: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(weighted links, root) of each set. If `split` is above 0, only pairs across that place count, else all pairs."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.float64)
    owner = np.repeat(np.arange(n), sizes.astype(int))
    values, column, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.cumsum(seen > 1) - 1
    use = seen[column] > 1
    owner, column = owner[use], shared[column[use]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((n, n), np.float32)
    width = max(64, (1 << 22) // n)
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, (low, low + width))
        part = np.zeros((n, width), np.float32)
        part[owner[a:b], column[a:b] - low] = 1
        common += part @ part.T
    union = sizes[:, None] + sizes[None, :] - common
    linked = common >= threshold * union - 1e-9
    np.fill_diagonal(linked, False)
    if split:
        linked[:split, :split] = False
        linked[split:, split:] = False
    root = np.arange(n)
    while True:
        low = np.minimum(np.where(linked, root[None, :], n).min(axis=1), root)
        low = low[low]
        if (low == root).all():
            return linked @ weights, root
        root = low


def ngram_join(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = NGRAM, threshold: float = THRESHOLD, rows: int = ROWS, recall: float = RECALL) -> DataFrame:
    """(key, class_id, class_size, n_links, n_grams, kept, th) for every row.

    kept marks one row of each class, th is the xxhash64 of the text.
    """
    bands = bands_for(threshold, rows, recall)
    signed = materialize(_signatures(docs, key, text, n, rows, bands), "ngram-signatures")
    same = materialize(
        signed.groupBy("n", "fp1", "fp2").agg(F.min("slot").alias("rep"), F.count("*").alias("copies")), "ngram-same"
    )
    reps = signed.join(same.select(F.col("rep").alias("slot"), "copies"), "slot")
    buckets = reps.where("n > 0").select("slot", F.posexplode("bands").alias("band", "h"))
    groups = components(star_links(buckets, ["band", "h"], "slot"), "ngram-candidates")

    members = groups.join(reps.select("key", "th", F.col("slot").alias("node"), "copies", "n"), "node")
    total = members.groupBy("root").agg(F.count("*").alias("members"), F.sum("n").alias("grams"))
    blocks = F.greatest(F.ceil(F.col("members") / BLOCK_ROWS), F.ceil(F.col("grams") / BLOCK_GRAMS), F.lit(1)).cast("int")
    whole = docs.select(F.col(key).alias("key"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("th"), F.coalesce(text, F.lit("")).alias("text"))
    texts = (
        whole.join(members.select("key", "th", "node", "root", "copies"), (whole["key"].eqNullSafe(members["key"])) & (whole["th"] == members["th"]))
        .select("node", "root", "copies", "text")
        .dropDuplicates(["node"])
    )

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [gram_set(x.as_py(), n).tobytes() for x in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sets, pa.binary())], ["node", "root", "copies", "grams"])

    sets = texts.mapInArrow(grams, "node long, root long, copies long, grams binary")
    count = max(1, (members.count() // BATCH_ROWS) * 2)
    placed = sets.join(total.select("root", blocks.alias("blocks")), "root").withColumn("own", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    pair = F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: F.struct(F.least(b, "own").alias("i"), F.greatest(b, "own").alias("j"))))
    dealt = placed.select("*", pair.alias("pair")).select(
        "node", "root", "copies", "grams", "own", "pair.i", "pair.j",
        F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("root"), F.lit(count))).otherwise(F.xxhash64("root", "pair")).alias("batch"),
        (F.col("blocks") > 1).alias("large"),
    )

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (_, i, j), own in group.groupby(["root", "i", "j"], sort=False):
            own = own.sort_values(["own", "node"])
            split = int((own["own"] == i).sum()) if i != j else 0
            nodes = own["node"].to_numpy()
            links, root = verify([np.frombuffer(g, np.uint64) for g in own["grams"]], own["copies"].to_numpy(), split, threshold)
            out.append(pd.DataFrame({"node": nodes, "head": nodes[root], "links": links}))
        return pd.concat(out)

    found = materialize(dealt.groupBy("large", "batch").applyInPandas(compare, "node long, head long, links long"), "ngram-links")
    classes = components(found.select(F.col("node").alias("u"), F.col("head").alias("v")), "ngram-classes")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    by_rep = (
        same.join(links.withColumnRenamed("node", "rep"), "rep", "left")
        .join(classes.withColumnRenamed("node", "rep"), "rep", "left")
        .select("n", "fp1", "fp2", F.when(F.col("n") > 0, F.coalesce("links", F.lit(0)) + F.col("copies") - 1).otherwise(0).alias("n_links"), F.coalesce("root", "rep").alias("root"))
    )
    rows_ = signed.select("key", "th", "slot", "n", "fp1", "fp2").join(by_rep, ["n", "fp1", "fp2"])
    rows_ = rows_.withColumn("root", F.when(F.col("n") == 0, F.col("slot")).otherwise(F.col("root")))
    sizes = rows_.groupBy("root").agg(F.min("key").alias("class_id"), F.count("*").alias("class_size"), F.min(F.struct(F.col("key").isNull(), "key", "slot")).alias("first"))
    return rows_.join(sizes, "root").select(
        F.col("key").alias(key), "class_id", "class_size", "n_links", F.col("n").alias("n_grams"),
        (F.col("slot") == F.col("first.slot")).alias("kept"), "th",
    )
