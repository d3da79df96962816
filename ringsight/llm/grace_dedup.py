"""Exact dedup by Grace hashing: records are partitioned to spill tables until every bucket fits a hash table.

1. Each scan task streams its rows, largest id first, through an open-addressing table that compares complete texts. The
   first row of a text stays with its text; later copies keep only a pointer to it. Copies are thereby combined before
   anything is shuffled, so a text with any number of copies sends one row per task.
2. The rows left are dealt to buckets by digits of their text's hash. A bucket above `table_bytes` is streamed through the same
   table again, spread over fewer tasks each time, written to a new spill table and dealt by the next digits.
3. A bucket that fits is read by one task, which compares complete texts in an open-addressing table.

Spill tables are written to the folder all executors share, so a lost executor repeats its own tasks only.

Null texts count as empty. Of equal texts the row with the largest id stays (null ids are lowest; of rows with equal ids one
stays). Rows are told apart by a slot number, so repeated or null ids are safe; other columns are carried along unchanged.
An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringsight.session import materialize



class ContentTable:
    """An open-addressing table (linear probing) from complete contents to numbers."""

    def __init__(self, bits: int = 10) -> None:
        self.mask = (1 << bits) - 1
        self.entry = [-1] * (1 << bits)
        self.keys: list[int] = []
        self.contents: list[bytes] = []
        self.values: list[int] = []
        self.bytes = 0

    def put(self, key: int, content: bytes, value: int) -> int:
        """The value stored with an equal content, or `value`, which is then stored."""
        at = key & self.mask
        while (i := self.entry[at]) >= 0:
            if self.keys[i] == key and self.contents[i] == content:
                return self.values[i]
            at = (at + 1) & self.mask
        self.entry[at] = len(self.keys)
        self.keys.append(key)
        self.contents.append(content)
        self.values.append(value)
        self.bytes += len(content) + 200
        if 2 * len(self.keys) > self.mask:
            self._grow()
        return value

    def _grow(self) -> None:
        self.mask = 2 * self.mask + 1
        self.entry = [-1] * (self.mask + 1)
        for i, key in enumerate(self.keys):
            at = key & self.mask
            while self.entry[at] >= 0:
                at = (at + 1) & self.mask
            self.entry[at] = i


def _collapse(rows: DataFrame, text: str, table_bytes: int, slots: bool) -> DataFrame:
    """Rows with slot, rep (slot of the equal row that keeps the text), sha and n_bytes; one pass over each partition."""
    fields = [T.StructField(f.name, f.dataType) for f in rows.schema.fields if f.name not in ("__rep", "__sha", "__bytes")]
    fields += [T.StructField("__slot", T.LongType())] * slots
    fields += [T.StructField("__rep", T.LongType()), T.StructField("__sha", T.BinaryType()), T.StructField("__bytes", T.LongType())]
    fields += [T.StructField("__null", T.BooleanType())] * slots
    schema = T.StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, n = ContentTable(), 0
        first = TaskContext.get().partitionId() << 40
        for batch in batches:
            names = batch.schema.names
            texts = batch.column(names.index(text))
            own = list(range(first + n, first + n + len(texts))) if slots else batch.column(names.index("__slot")).to_pylist()
            n += len(texts)
            reps, shas, sizes = [], [], []
            for slot, value in zip(own, texts, strict=True):
                content = (value.as_py() or "").encode("utf-8", "surrogatepass")
                digest = hashlib.sha256(content).digest()
                reps.append(table.put(int.from_bytes(digest[:8], "little"), content, slot))
                shas.append(digest)
                sizes.append(len(content))
                if table.bytes > table_bytes:
                    table = ContentTable()  # what it forgets is found in the buckets
            alone = pa.array([r == s for r, s in zip(reps, own, strict=True)])
            kept = pa.compute.if_else(alone, texts, pa.scalar(None, texts.type))
            columns = {name: batch.column(i) for i, name in enumerate(names)} | {text: kept}
            columns |= {"__slot": pa.array(own, pa.int64()), "__rep": pa.array(reps, pa.int64()), "__sha": pa.array(shas, pa.binary())}
            columns |= {"__bytes": pa.array(sizes, pa.int64())}
            if slots:
                columns["__null"] = texts.is_null()
            yield pa.RecordBatch.from_arrays([columns[f.name] for f in schema.fields], schema.names)

    return rows.mapInArrow(run, schema)


def _digits(level: int, buckets: int):
    """Bucket of a row at a level, from eight hexadecimal digits of its hash that no other of four levels uses."""
    part = F.substring(F.hex("__sha"), 17 + 8 * (level % 4), 8)
    return F.pmod(F.xxhash64(F.lit(level), part), F.lit(buckets)).cast("int")


def _resolve(rows: DataFrame) -> DataFrame:
    """(rep, keep_slot, keep_id) for rows whose buckets fit a table."""

    def table(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["has_id", "key", "__slot"], ascending=[False, False, True], kind="stable")
        seen = ContentTable()
        first = [
            seen.put(int.from_bytes(sha[:8], "little"), text.encode("utf-8", "surrogatepass"), i)
            for i, (sha, text) in enumerate(zip(group["__sha"], group["text"], strict=True))
        ]
        slots = group["__slot"].to_numpy()
        return pd.DataFrame({"__rep": slots, "__keep": slots[np.array(first, int)]})

    return rows.groupBy("__bucket").applyInPandas(table, "__rep long, __keep long")


def _buckets(rows: DataFrame, table_bytes: int, level: int, label: str) -> DataFrame:
    """(rep, keep) of spilled rows (slot, key, has_id, text, sha, bytes), by recursive partitioning."""
    total = rows.agg(F.sum(F.col("__bytes") + 200)).first()[0] or 0
    count = max(1, 2 * -(-total // table_bytes))
    dealt = rows.withColumn("__bucket", _digits(level, count))
    sizes = dealt.groupBy("__bucket").agg(F.sum(F.col("__bytes") + 200).alias("size"), F.count("*").alias("n"))
    over = materialize(sizes.where((F.col("size") > table_bytes) & (F.col("n") > 1)), f"{label}-over")
    size = over.agg(F.sum("size")).first()[0]
    if not size:
        return _resolve(dealt)
    tasks = max(1, (-(-size // table_bytes)) >> level)
    large = dealt.join(over.select("__bucket"), "__bucket", "left_semi").drop("__bucket")
    spread = large.repartition(tasks) if tasks > 1 and level < 2 else large.repartition(tasks, "__sha")
    ordered = spread.sortWithinPartitions(F.desc("has_id"), F.desc("key"), "__slot")
    spill = materialize(_collapse(ordered, "text", table_bytes, slots=False), f"{label}-spill")
    below = _buckets(spill.where("__rep = __slot").drop("__rep"), table_bytes, level + 1, label)
    pointers = spill.select(F.col("__slot").alias("s"), "__rep").join(below, "__rep").select(F.col("s").alias("__rep"), "__keep")
    return _resolve(dealt.join(over.select("__bucket"), "__bucket", "left_anti")).unionByName(pointers)


def grace_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", table_bytes: int = 64 << 20) -> tuple[DataFrame, DataFrame]:
    """(decisions, kept rows). Decisions: key, keep_id, group_size, kept, text_sha256 for every row; kept: rows as they came."""
    ordered = docs.sortWithinPartitions(F.desc_nulls_last(key))
    spill = materialize(_collapse(ordered, text, table_bytes, slots=True), "grace")
    left = spill.where("__rep = __slot").select(
        "__slot", F.coalesce(key, F.lit(0)).alias("key"), F.col(key).isNotNull().alias("has_id"), F.coalesce(text, F.lit("")).alias("text"), "__sha", "__bytes"
    )
    keep = materialize(_buckets(left, table_bytes, 0, "grace"), "grace-keep")
    local = spill.groupBy("__rep").agg(F.count("*").alias("n"))
    sizes = local.join(keep, "__rep").groupBy("__keep").agg(F.sum("n").alias("group_size"))
    ids = spill.where("__rep = __slot").select(F.col("__slot").alias("__keep"), F.col(key).alias("keep_id"))
    groups = keep.join(sizes.join(ids, "__keep"), "__keep")
    decisions = (
        spill.select(key, "__slot", "__rep", "__sha")
        .join(groups, "__rep")
        .select(
            key,
            "keep_id",
            "group_size",
            (F.col("__slot") == F.col("__keep")).alias("kept"),
            F.lower(F.hex("__sha")).alias("text_sha256"),
        )
    )
    stays = keep.where("__rep = __keep").select(F.col("__keep").alias("__slot"))
    rows = spill.join(stays, "__slot", "left_semi")
    whole = F.when(F.col("__null"), F.lit(None).cast("string")).otherwise(F.col(text)).alias(text)
    return decisions, rows.select(*[whole if c == text else F.col(c) for c in docs.columns])
