"""Log-likelihoods of whole documents under a recurrent language model trained on the corpus.

1. Each block of text numbers its distinct words (A-Z as a-z, runs without ASCII white space; an end after the last). Training
   counts per block and word are shuffled by word and summed, so counts, N and V are exact over all training documents, and each
   block gets the counts of its own words back. Tokens are never shuffled with their words.
2. The `HEAD` most frequent words are symbols of their own, in classes of about equal mass; other words fall into bands by count
   (0, 1, 2, 3, 4, up to 8, up to 16, ...). Every document becomes an array of symbols, written once. A rare word's probability is
   its band's, times its share of the band's count. All unknown words are one word, as in the base.
3. Training: in each of `ROUNDS` rounds every partition trains the model on its training documents of the round, starting from the
   common weights; the weights are averaged by tokens, in a tree. The rounds share out the training documents (by hash), so each
   one is used exactly once. A rare word counts as one less (leave-one-out), so words met once teach what an unknown word looks like.
4. Scoring: every document from its first to its last token, with the state carried across windows.

Null texts count as empty (only the end). Null or repeated ids are fine. Without training documents all words are unknown.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringsight.llm.common import held, sum_arrays
from ringsight.llm.gru import Gru, score, train
from ringsight.llm.pieces import _scan
from ringsight.session import materialize

HEAD, CLASSES = 1000, 28
BLOCK_CHARS = 1 << 24
#: Rounds of training; each training document belongs to one of them, by a hash.
ROUNDS = 2
#: Bands below this are single counts, so leaving one out moves a word to the band before. The last of them, 4, is told apart for
#: that only: as the model sees it, a word met four times is in the band up to 8.
EXACT = 5


def band(counts: np.ndarray) -> np.ndarray:
    bits = np.ceil(np.log2(np.maximum(counts, 1))).astype(np.int64)
    return np.where(counts < EXACT, counts, EXACT + bits - 3)


def _blocks(batches: Iterator[pa.RecordBatch], words: bool) -> Iterator[pa.RecordBatch]:
    """Number the words of each block in order of appearance; yield them with training counts, or the documents as numbers."""
    here, block, chars, part, numbers, kept = None, 0, 0, 0, {}, []

    def listed() -> Iterator[pa.RecordBatch]:
        names = list(numbers)
        counts = np.bincount(np.concatenate([*kept, np.empty(0, np.uint32)]), minlength=len(names))
        for i in range(0, len(names), 50_000):
            n = len(names[i : i + 50_000])
            yield pa.RecordBatch.from_arrays(
                [pa.array([block] * n, pa.int64()), pa.array(range(i, i + n), pa.int32()), pa.array(names[i : i + n], pa.binary()), pa.array(counts[i : i + n], pa.int64())], ["block", "number", "word", "n"]
            )

    for batch in batches:
        out = ([], [])
        for value, path, at, is_held in zip(batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
            data = value.as_py().encode("utf-8", "surrogatepass")
            if here != (path, at) or chars > BLOCK_CHARS:
                if words and numbers:
                    yield from listed()
                part = part + 1 if here == (path, at) else 0
                here, chars, numbers, kept = (path, at), 0, {}, []
                block = int.from_bytes(hashlib.blake2b(f"{path}\n{at}\n{part}".encode(), digest_size=8).digest(), "little", signed=True)
            chars += len(data) + 1
            tokens = data.lower().split()
            tokens.append(b"")
            order = np.fromiter((numbers.setdefault(w, len(numbers)) for w in tokens), np.uint32, len(tokens))
            if words and not is_held:
                kept.append(order)
            elif not words:
                out[0].append(block)
                out[1].append(zlib.compress(order.view(np.uint8).reshape(-1, 4).T.tobytes(), 1))
        if not words:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(4), pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary())], ["key", "held_out", "block", "numbers"])
    if words and numbers:
        yield from listed()


def _unpack(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1).T
    return np.ascontiguousarray(raw).view(np.uint32).ravel().astype(np.int64)


def symbol_table(counts: DataFrame) -> tuple[DataFrame, np.ndarray, np.ndarray, np.ndarray]:
    """(word, symbol) of the most frequent words; of all symbols counts, one left out, and classes; the counts of the bands."""
    head = [(bytes(r["word"]), r["c"]) for r in counts.orderBy(F.desc("c"), "word").limit(HEAD).collect()]
    c = F.col("c")
    which = F.when(c < EXACT, c).otherwise(F.ceil(F.log2(c)) + EXACT - 3).cast("int")
    rows = counts.groupBy(which.alias("b")).agg(F.sum("c").alias("c")).collect()
    bands = np.zeros(max([EXACT + 1, *(r["b"] + 1 for r in rows)]))
    for r in rows:
        bands[r["b"]] = r["c"]
    for _, n in head:
        bands[band(np.array([n]))[0]] -= n
    tail = bands.copy()
    tail[: EXACT - 1] = bands[1:EXACT]  # one left out
    tail[EXACT - 1] = 0
    bands[EXACT - 1 : EXACT + 1] = bands[EXACT - 1 : EXACT + 1].sum()
    total = np.array([n for _, n in head], float)
    share = np.cumsum(total) / max(total.sum(), 1)
    classes = np.minimum((share * CLASSES * 0.999).astype(int), CLASSES - 1)
    classes = np.unique(classes, return_inverse=True)[1] if len(classes) else classes.astype(int)
    first = int(classes.max()) + 1 if len(classes) else 0
    table = counts.sparkSession.createDataFrame([(w, k) for k, (w, _) in enumerate(head)], "word binary, symbol int")
    return table, np.concatenate((total, np.maximum(tail, 0))), np.concatenate((classes, first + np.arange(len(bands)))), bands


def score_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    kind = docs.schema[key].dataType.simpleString()
    scan = _scan(docs, key, text).select("key", "text", "path", "at", held("key", 7, 2).alias("held_out"))
    words = materialize(scan.mapInArrow(lambda x: _blocks(x, True), "block long, number int, word binary, n long"), "lm-words")
    counts = materialize(words.groupBy("word").agg(F.sum("n").alias("c")), "lm-counts")
    known = counts.where("c > 0")
    n_total, v_total = known.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    head, frequency, class_of, in_band = symbol_table(known)
    first = len(class_of) - len(in_band)
    marked = words.select("block", "number", "word").join(counts.join(F.broadcast(head), "word", "left"), "word")  # HEAD rows
    numbered = scan.mapInArrow(lambda x: _blocks(x, False), f"key {kind}, held_out boolean, block long, numbers binary")
    scale = np.log10(n_total + v_total + 1)

    def encode(rows: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("number")
        c = own["c"].to_numpy(np.int64)
        rare = own["symbol"].isna().to_numpy()
        of = band(c)
        symbols = np.where(rare, first + of, own["symbol"].fillna(0).to_numpy()).astype(np.uint16)
        base = np.log10(c + 1) - scale
        with np.errstate(divide="ignore", invalid="ignore"):
            inside = np.where(rare & (c > 0), np.log10(c / in_band[of]), 0.0)
        out = {"n_tokens": [], "n_known": [], "base_score": [], "inside": [], "symbols": []}
        for data in rows["numbers"]:
            order = _unpack(data)
            out["n_tokens"].append(len(order))
            out["n_known"].append(int((c[order] > 0).sum()))
            out["base_score"].append(float(base[order].sum()))
            out["inside"].append(float(inside[order].sum()))
            out["symbols"].append(zlib.compress(symbols[order].astype("<u2").tobytes(), 1))
        return pd.DataFrame({"key": rows["key"], "held_out": rows["held_out"], **out})

    schema = f"key {kind}, held_out boolean, n_tokens long, n_known long, base_score double, inside double, symbols binary"
    encoded = materialize(numbered.groupBy("block").cogroup(marked.groupBy("block")).applyInPandas(encode, schema), "lm-symbols")

    model = Gru(frequency, class_of)
    model.start_at_frequencies()
    left_out = np.arange(len(class_of))
    left_out[first + 1 : first + EXACT] -= 1
    as_seen = np.arange(len(class_of))
    as_seen[first + EXACT - 1] += 1
    for turn in range(ROUNDS):
        share = encoded.where(~F.col("held_out") & (F.pmod(F.xxhash64("key", "n_tokens"), F.lit(ROUNDS)) == turn))
        model.flat = _round(share.select("symbols"), model.flat, frequency, class_of, left_out)
        model.view(model.flat, model)

    final = docs.sparkSession.sparkContext.broadcast(model.flat)  # its size depends on HEAD alone

    def likelihood(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trained = Gru(frequency, class_of, flat=final.value)
        for batch in batches:
            texts = [as_seen[np.frombuffer(zlib.decompress(x), "<u2")] for x in batch.column(6).to_pylist()]
            found = score(trained, texts) / np.log(10) + batch.column(5).to_numpy()
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(found)], ["key", "held_out", "n_tokens", "n_known", "base_score", "score"])

    scored = encoded.mapInArrow(likelihood, f"key {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.select(F.col("key").alias(key), "held_out", "n_tokens", "n_known", F.lit(int(n_total)).cast("long").alias("train_tokens"), "base_score", "score")


def _round(rows: DataFrame, flat: np.ndarray, frequency: np.ndarray, class_of: np.ndarray, left_out: np.ndarray) -> np.ndarray:
    """Train on each partition from the same weights; the mean of the results, by tokens."""
    start = rows.sparkSession.sparkContext.broadcast(flat)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Gru(frequency, class_of, flat=start.value.copy())
        texts = (left_out[np.frombuffer(zlib.decompress(x), "<u2")] for batch in batches for x in batch.column(0).to_pylist())
        seen = train(model, texts)
        yield pa.RecordBatch.from_arrays([pa.array([np.append(model.flat.astype(np.float64) * seen, seen).tobytes()], pa.binary())], ["data"])

    total = sum_arrays(rows.mapInArrow(run, "data binary"), fan=4)
    return flat if total is None or total[-1] == 0 else (total[:-1] / total[-1]).astype(np.float32)
