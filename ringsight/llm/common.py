"""Helpers that several text operators share: the documents table, word hashes, and sums of arrays over partitions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Multiplier of the polynomial hash (odd, so it has an inverse modulo 2**64) and a second one for mixing.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_BYTES = np.random.Generator(np.random.PCG64(20)).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
#: ASCII white space, as in the contracts of the queries.
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: ... and everything in ASCII but letters and digits.
_GAP = np.ones(256, bool)
_GAP[48:58] = _GAP[65:91] = _GAP[97:123] = _GAP[128:] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def held(column: str, parts: int, part: int) -> Column:
    """Whether crc32 of an id as text falls on `part` modulo `parts`; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(parts)) == part


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values, so that their order is as good as random."""
    values = (values ^ (values >> np.uint64(31))) * _MIX
    values = (values ^ (values >> np.uint64(29))) * _BASE
    return values ^ (values >> np.uint64(32))


def word_spans(data: np.ndarray, alnum: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts and ends of the runs without ASCII white space (alnum: or ASCII marks) in a text given as bytes."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    inside = np.concatenate(([False], ~(_GAP if alnum else _SPACE)[data], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


_POWERS = np.ones(1, np.uint64)
_INVERSES = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POWERS, _INVERSES
    if len(_POWERS) < n:
        size = 1 << (n - 1).bit_length()
        inverse = np.uint64(pow(int(_BASE), -1, 2**64))
        with np.errstate(over="ignore"):
            _POWERS = np.concatenate((np.ones(1, np.uint64), np.multiply.accumulate(np.full(size - 1, _BASE))))
            _INVERSES = np.concatenate((np.ones(1, np.uint64), np.multiply.accumulate(np.full(size - 1, inverse))))
    return _POWERS[:n], _INVERSES[:n]


def word_hashes(text: str | bytes, alnum: bool = False, fold: bool = True) -> np.ndarray:
    """A 64-bit hash for every word of a text (words as in `word_spans`; fold: A-Z counts as a-z)."""
    data = np.frombuffer(text if isinstance(text, bytes) else text.encode("utf-8", "surrogatepass"), np.uint8)
    starts, ends = word_spans(data, alnum)
    if not len(starts):
        return np.empty(0, np.uint64)
    parts = []
    # pieces of about a megabyte keep the temporary arrays small for very long texts
    cuts = np.unique(np.concatenate((np.arange(0, len(starts), 1 << 17), [len(starts)])))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        low, high = starts[a], ends[b - 1]
        piece = data[low:high]
        power, inverse = _powers(len(piece) + 1)
        with np.errstate(over="ignore"):
            sums = np.concatenate(
                (np.zeros(1, np.uint64), np.cumsum(_BYTES[_LOWER[piece] if fold else piece] * power[:-1], dtype=np.uint64))
            )
            parts.append(mix((sums[ends[a:b] - low] - sums[starts[a:b] - low]) * inverse[starts[a:b] - low]))
    return np.concatenate(parts)


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n words, in order; a text of fewer words gives one run of all of them, an empty one none."""
    if not len(words):
        return words
    n = min(n, len(words))
    out = np.zeros(len(words) - n + 1, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            out = out * _BASE + words[k : len(words) - n + 1 + k]
    return mix(out + np.uint64(n))


def sum_arrays(parts: DataFrame, dtype: str = "float64", fan: int = 64) -> np.ndarray | None:
    """The sum of arrays, one per partition in a binary column `data`, added up in a tree: `fan` arrays reach the driver."""

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(len(group["data"].iloc[0]) // np.dtype(dtype).itemsize, dtype)
        for x in group["data"]:
            total += np.frombuffer(x, dtype)
        return pd.DataFrame({"data": [total.tobytes()]})

    groups = parts.withColumn("part", F.pmod(F.xxhash64("data"), F.lit(fan * fan)))
    once = groups.groupBy("part").applyInPandas(add, "data binary")
    twice = once.withColumn("part", F.pmod(F.xxhash64("data"), F.lit(fan))).groupBy("part").applyInPandas(add, "data binary")
    rows = twice.collect()
    return np.sum([np.frombuffer(r[0], dtype) for r in rows], axis=0) if rows else None
