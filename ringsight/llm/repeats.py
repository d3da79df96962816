"""Passages that repeat across documents, by hashes at minimisers (in place of a sorted suffix array).

1. Words (runs without white space, A-Z as a-z) are hashed; a run of `SEED` words is a minimiser if its hash is the least of
   some `SPREAD` consecutive runs. Minimisers are chosen by content, so a passage has the same ones in every text, and the first
   starts within `SPREAD` words of the passage's start. Only the suffixes that start there are kept.
2. Suffixes are grouped by the hash of their first `min_words - SPREAD + 1` words, which any shared passage of `min_words` words
   leaves to its first minimiser. Equal keys of different documents show that a suffix repeats. The comparison takes the
   least and greatest document of each key; nothing is sorted, and partial sums spread a key of any size.
3. Matches are extended: each suffix that repeats is extended to the left, word by word, over all starts whose passages have it
   as their first minimiser, and to the right to `min_words` words in all. The extended suffixes are grouped by hash in
   the same way. Those that repeat are joined to maximal spans.

So a word lies in a span if and only if it is part of `min_words` consecutive words that another document holds too (documents:
distinct word sequences; a document with copies repeats as a whole if it is long enough). Null texts count as empty; null or
repeated ids are fine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringsight.llm.common import _BASE, _powers, mix, shingle_hashes, word_hashes
from ringsight.session import materialize

MIN_WORDS, SEED, SPREAD = 50, 4, 14


def _least(values: np.ndarray, n: int) -> np.ndarray:
    """Least of each n consecutive values."""
    step = 1
    while step < n:
        take = min(step, n - step)
        values = np.minimum(values[:-take], values[take:])
        step += take
    return values


def minimisers(words: np.ndarray, seed: int = SEED, spread: int = SPREAD) -> np.ndarray:
    """Places whose run of `seed` words has the least hash of some `spread` consecutive runs."""
    runs = shingle_hashes(words, seed) if len(words) >= seed else words[:0]
    if not len(runs):
        return np.empty(0, np.int64)
    least = _least(runs, min(spread, len(runs)))
    # the greatest of the minima over all windows that hold a place is its own hash iff it is chosen
    n = min(spread, len(runs))
    padded = np.concatenate((np.zeros(n - 1, np.uint64), least, np.zeros(n - 1, np.uint64)))
    return np.flatnonzero(~_least(~padded, n) == runs)


def run_hashes(words: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n words from each start, from sums over all words before."""
    power, inverse = _powers(len(words) + 1)
    with np.errstate(over="ignore"):
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * power[:-1], dtype=np.uint64)))
        return mix((sums[starts + n] - sums[starts]) * inverse[starts] + _BASE)


def suffixes(words: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes of their first words) of the minimisers with enough words after them."""
    keep = min_words - SPREAD + 1
    places = minimisers(words)
    places = places[places + keep <= len(words)]
    return places, run_hashes(words, places, keep)


def extended(words: np.ndarray, places: np.ndarray, repeat: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, hashes of min_words words) of the passages whose own minimiser is one of those that repeat.

    A passage's own minimiser is the first least of the `SPREAD` runs from its start, which depends on its own words only.
    """
    count = len(words) - min_words + 1
    if count <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    runs = shingle_hashes(words, SEED)
    least = _least(runs, SPREAD)[:count]
    own = np.zeros(count, np.int64)
    for k in range(SPREAD - 1, -1, -1):
        own = np.where(runs[k : k + count] == least, k, own)
    marked = np.zeros(len(words), bool)
    marked[places[repeat]] = True
    starts = np.flatnonzero(marked[np.arange(count) + own])
    return starts, run_hashes(words, starts, min_words)


def _whole(words: np.ndarray) -> int:
    return int(run_hashes(words, np.zeros(1, np.int64), len(words)).view(np.int64)[0])


def _spans(starts: list[int], min_words: int) -> list[tuple[int, int]]:
    """Maximal spans covered by runs of min_words words from the starts."""
    out: list[list[int]] = []
    for start in starts:
        if out and start <= out[-1][1]:
            out[-1][1] = start + min_words
        else:
            out.append([start, start + min_words])
    return [(a, b) for a, b in out]


def find_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(key, n_words, n_spans, repeated_words, spans) of the rows with a repeat; spans: start:end in words, comma-joined."""
    if min_words < SPREAD + SEED:
        raise ValueError(f"passages of at least {SPREAD + SEED} words")
    kind = docs.schema[key].dataType.simpleString()
    source = docs.select(F.col(key).alias("key"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("th"), F.coalesce(text, F.lit("")).alias("text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One numbered row per text, with the keys of its suffixes and the hash of all its words."""
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            n, whole, keys = [], [], []
            for value in batch.column(2):
                words = word_hashes(value.as_py())
                n.append(len(words))
                whole.append(_whole(words))
                keys.append(suffixes(words, min_words)[1].view(np.int64))
            rows = pa.array(range(row, row + len(n)), pa.int64())
            row += len(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), rows, pa.array(n, pa.int64()), pa.array(whole, pa.int64()), pa.array(keys, pa.list_(pa.int64()))], ["key", "th", "row", "n_words", "whole", "keys"]
            )

    scanned = materialize(
        source.mapInArrow(scan, f"key {kind}, th long, row long, n_words long, whole long, keys array<long>"), "repeat-suffixes"
    )
    # equal texts are one document from here on
    same = materialize(
        scanned.groupBy("whole", "n_words").agg(F.min("row").alias("first"), F.count("*").alias("copies")), "repeat-same"
    )
    firsts = scanned.join(same.select(F.col("first").alias("row")), "row", "left_semi")
    listed = firsts.select("row", F.posexplode("keys").alias("i", "k"))
    repeated = listed.groupBy("k").agg(F.min("row").alias("low"), F.max("row").alias("high")).where("low < high").select("k")
    hits = listed.join(repeated, "k").groupBy("row").agg(F.collect_list("i").alias("hits"))
    chosen = firsts.select("key", "th", "row").join(hits, "row")
    texts = (
        source.withColumnRenamed("key", "key2")
        .withColumnRenamed("th", "th2")
        .join(chosen, F.col("key").eqNullSafe(F.col("key2")) & (F.col("th") == F.col("th2")))
        .select("row", "hits", "text")
    )

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts, keys = [], []
            for found, value in zip(batch.column(1), batch.column(2), strict=True):
                words = word_hashes(value.as_py())
                places, _ = suffixes(words, min_words)
                repeat = np.zeros(len(places), bool)
                repeat[np.array(found.as_py(), np.int64)] = True
                own, hashes = extended(words, places, repeat, min_words)
                starts.append(own.astype(np.int32))
                keys.append(hashes.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(starts, pa.list_(pa.int32())), pa.array(keys, pa.list_(pa.int64()))], ["row", "starts", "keys"]
            )

    longer = materialize(texts.mapInArrow(extend, "row long, starts array<int>, keys array<long>"), "repeat-extended")
    passages = longer.dropDuplicates(["row"]).select("row", F.explode(F.arrays_zip("starts", "keys")).alias("p")).select("row", "p.starts", "p.keys")
    again = passages.groupBy("keys").agg(F.min("row").alias("low"), F.max("row").alias("high")).where("low < high").select("keys")
    places_ = passages.join(again, "keys").groupBy("row").agg(F.collect_list("starts").alias("starts"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_spans(sorted(x.as_py()), min_words) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(f) for f in found], pa.int64()),
                    pa.array([sum(b - a for a, b in f) for f in found], pa.int64()),
                    pa.array([",".join(f"{a}:{b}" for a, b in f) for f in found], pa.string()),
                ],
                ["first", "n_spans", "repeated_words", "spans"],
            )

    merged = places_.mapInArrow(merge, "first long, n_spans long, repeated_words long, spans string")
    classes = same.join(merged, "first", "left").where((F.col("n_spans") > 0) | (F.col("copies") > 1) & (F.col("n_words") >= min_words))
    copied = F.col("copies") > 1
    result = classes.select(
        "whole",
        "n_words",
        F.when(copied, F.lit(1)).otherwise(F.col("n_spans")).cast("long").alias("n_spans"),
        F.when(copied, F.col("n_words")).otherwise(F.col("repeated_words")).alias("repeated_words"),
        F.when(copied, F.concat(F.lit("0:"), F.col("n_words"))).otherwise(F.col("spans")).alias("spans"),
    )
    return scanned.select(F.col("key").alias(key), "whole", "n_words").join(result, ["whole", "n_words"]).drop("whole")
