"""Repeated word windows: Rabin-Karp hashes of every window of a fixed length, counted in Spark, merged into removal intervals.

1. `_cuts` sorts (key, text hash) over all rows and cuts the order into blocks of about `BLOCK_BYTES` bytes of text, so block
   numbers follow the order of the keys. Rows equal in key and text are interchangeable; a running number spreads them.
2. Each block (`_emit`) hashes all windows of its documents. Inside a block only the first of equal windows can be the first of
   all; the others are repeats already. The hashes of the firsts go out as 8 bytes each, packed by bucket.
3. Each bucket (`_count`) counts its hashes over all blocks. The least block keeps a window; for every other block one bit per
   window says that it starts earlier elsewhere. A window that a third of all documents hold is one hash per block here, and
   packed rows are never more than windows, so no bucket grows with a hot window.
4. The blocks meet their bits again (`_remove`), overlapping repeats merge into maximal intervals, and the other words stay.

Window equality is decided by the 64-bit hash and by the bucket, which is cut from a second, independent hash.

Defined cases: null and empty texts have no words. Null keys come first; rows of one key count in the order of their texts'
hashes, so of rows that are equal throughout one keeps its words. Texts below the window length stay whole. An empty table gives
an empty result. Other columns are not read.
"""

from __future__ import annotations

import bisect
from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringsight.llm.common import mix, word_hashes
from ringsight.llm.repeats import run_hashes

WINDOW = 20
BLOCK_BYTES = 8 << 20
BUCKET_WINDOWS = 1 << 20
_OTHER = np.uint64(0xD6E8FEB86659FD93)


def _cuts(source: DataFrame, block_bytes: int) -> tuple[list[tuple], int]:
    """The first (key is not null, key, th, salt) of every block but the first, in order, and the bytes of all texts.

    About one cut per `block_bytes` of text reaches the driver, and goes to the tasks inside the block function.
    """
    kind = source.schema["key"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, out = 0, 0, ([], [], [])
        for batch in batches:
            for key, th, salt, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if total == 0 or held and held + size > block_bytes:
                    for column, x in zip(out, (key, th, salt), strict=True):
                        column.append(x)
                    held = 0
                held += size + 1
                total += size + 1
        if total:
            bytes_ = [0] * (len(out[0]) - 1) + [total]
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], batch.column(0).type), *(pa.array(x, pa.int64()) for x in (*out[1:], bytes_))], ["key", "th", "salt", "bytes"]
            )

    order = ["key", "th", "salt"]
    keys = source.select(*order, F.octet_length("data").cast("long").alias("size"))
    rows = keys.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(cut, f"key {kind}, th long, salt long, bytes long").collect()
    firsts = sorted((r["key"] is not None, r["key"] if r["key"] is not None else 0, r["th"], r["salt"]) for r in rows)
    return firsts[1:], sum(r["bytes"] for r in rows)


def _block_of(cuts: list[tuple]) -> Callable[..., Column]:
    @F.arrow_udf("long")
    def block(key: pa.Array, th: pa.Array, salt: pa.Array) -> pa.Array:
        places = zip(key.to_pylist(), th.to_pylist(), salt.to_pylist(), strict=True)
        found = [bisect.bisect_right(cuts, (k is not None, k if k is not None else 0, h, s)) for k, h, s in places]
        return pa.array(found, pa.int64())

    return block


class _Block:
    """The windows of a block: documents in order, and of equal windows the first, ordered by bucket and hash."""

    def __init__(self, table: pa.Table, window: int, bits: int):
        keys, hashes = table.column("key").to_pylist(), table.column("th").to_pylist()
        self.order = sorted(range(len(keys)), key=lambda i: (keys[i] is not None, keys[i] if keys[i] is not None else 0, hashes[i]))
        texts = table.column("data")
        self.words = [word_hashes(texts[i].as_py(), fold=False) for i in self.order]
        starts = [np.arange(max(0, len(w) - window + 1)) for w in self.words]
        self.ends = np.cumsum([len(s) for s in starts])
        none = [np.empty(0, np.uint64)]
        first = np.concatenate([run_hashes(w, s, window) for w, s in zip(self.words, starts, strict=True)] + none)
        other = np.concatenate([run_hashes(mix(w ^ _OTHER), s, window) for w, s in zip(self.words, starts, strict=True)] + none)
        bucket = (other >> np.uint64(64 - bits)).astype(np.uint16 if bits <= 16 else np.uint32) if bits else np.zeros(len(other), np.uint16)
        places = np.argsort(first, kind="stable")
        places = places[np.argsort(bucket[places], kind="stable")]
        first, bucket = first[places], bucket[places]
        new = np.ones(len(places), bool)
        new[1:] = (first[1:] != first[:-1]) | (bucket[1:] != bucket[:-1])
        #: whether a window repeats an earlier one of this block; places, hashes and buckets of the others
        self.repeats = np.ones(len(places), bool)
        self.places = places[new]
        self.repeats[self.places] = False
        self.hashes, self.buckets = first[new], bucket[new]


def _packed(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Binary values of the given sizes, laid one after the other in `data`."""
    offsets = np.concatenate((np.zeros(1, np.int32), np.cumsum(sizes, dtype=np.int32)))
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def intervals(removed: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of marked words, as (start, end)."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], removed.view(np.int8), [0]))))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def remove_repeated_windows(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES, bucket_windows: int = BUCKET_WINDOWS,
) -> DataFrame:
    """(key, n_words, n_removed, spans, kept) per row: words (no ASCII white space) outside windows that start earlier.

    spans: the removed intervals as start:end in words, comma-joined; kept: the other words, joined by one space.
    """
    kind = docs.schema[key].dataType.simpleString()
    body = F.coalesce(F.col(text), F.lit(""))
    source = docs.select(
        F.col(key).alias("key"), F.xxhash64(body).alias("th"), F.monotonically_increasing_id().alias("salt"), body.cast("binary").alias("data")
    )
    cuts, total = _cuts(source, block_bytes)
    bits = max(0, (total // 6 // bucket_windows).bit_length())
    blocks = source.withColumn("block", _block_of(cuts)("key", "th", "salt")).select("block", "key", "th", "data")

    def emit(table: pa.Table) -> pa.Table:
        own = _Block(table, window, bits)
        buckets, sizes = np.unique(own.buckets, return_counts=True)
        block = np.full(len(buckets), table.column("block")[0].as_py(), np.int64)
        return pa.table({"bucket": buckets.astype(np.int64), "block": block, "hashes": _packed(own.hashes.view(np.uint8), 8 * sizes)})

    def count(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        parts = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("hashes")]
        hashes = np.concatenate(parts)
        order = np.argsort(hashes, kind="stable")  # equal hashes stay in the order of their blocks
        later = np.zeros(len(hashes), bool)
        sorted_ = hashes[order]
        later[order[1:]] = sorted_[1:] == sorted_[:-1]
        flags = [np.packbits(x) for x in np.split(later, np.cumsum([len(p) for p in parts])[:-1])]
        packed = _packed(np.concatenate(flags), np.array([len(f) for f in flags]))
        return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "flags": packed})

    def remove(table: pa.Table, found: pa.Table) -> pa.Table:
        own = _Block(table, window, bits)
        flags = dict(zip(found.column("bucket").to_pylist(), found.column("flags"), strict=True))
        at = 0
        for bucket, size in zip(*np.unique(own.buckets, return_counts=True), strict=True):
            bit = np.unpackbits(np.frombuffer(flags[int(bucket)].as_buffer(), np.uint8), count=size)
            own.repeats[own.places[at : at + size]] = bit.view(bool)
            at += size
        out, start = {"key": [], "n_words": [], "n_removed": [], "spans": [], "kept": []}, 0
        texts, keys = table.column("data"), table.column("key")
        for i, words, end in zip(own.order, own.words, own.ends.tolist(), strict=True):
            # a word goes if one of the last `window` starts up to it repeats
            begun = np.zeros(len(words) + 1, np.int32)
            hits = np.flatnonzero(own.repeats[start:end])
            start = end
            np.add.at(begun, hits, 1)
            np.add.at(begun, hits + window, -1)
            gone = np.cumsum(begun[:-1]) > 0
            split = texts[i].as_py().split()
            out["key"].append(keys[i].as_py())
            out["n_words"].append(len(words))
            out["n_removed"].append(int(gone.sum()))
            out["spans"].append(",".join(f"{a}:{b}" for a, b in intervals(gone)))
            out["kept"].append(b" ".join(compress(split, (~gone).tolist()) if len(hits) else split))
        kinds = {"key": keys.type, "n_words": pa.int64(), "n_removed": pa.int64(), "spans": pa.string(), "kept": pa.binary()}
        return pa.table({name: pa.array(values, kinds[name]) for name, values in out.items()})

    sent = blocks.groupBy("block").applyInArrow(emit, "bucket long, block long, hashes binary")
    flagged = sent.groupBy("bucket").applyInArrow(count, "block long, bucket long, flags binary")
    result = blocks.groupBy("block").cogroup(flagged.groupBy("block")).applyInArrow(
        remove, f"key {kind}, n_words long, n_removed long, spans string, kept binary"
    )
    return result.select(F.col("key").alias(key), "n_words", "n_removed", "spans", F.col("kept").cast("string").alias("kept"))
