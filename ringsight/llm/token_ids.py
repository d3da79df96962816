"""Token ids in binary shards, packed word by word with Simple-8b.

A shard holds whole documents in order: a header, document ids and lengths, the word offset of every block, the 64-bit words,
and the escaped values. A word has a 4-bit selector and 60 bits of payload: the selector says how many ids are packed at how
many bits. A block is `BLOCK` consecutive ids and starts on a word, so blocks are packed and unpacked side by side, and a
reader can start at any of them. A value of more than 60 bits is replaced by an escape word holding its place in the list of
escaped values.

Documents are ordered by id (null first; equal ids by a hash of the text, then the text), range-partitioned, and encoded where
they land. Null texts count as empty and hold only the end id. Equal word runs have equal ids in this tokenizer, which drops
white space, so each task encodes a run once and remembers it, up to a bound.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from itertools import filterfalse

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ringsight.session import hint

BLOCK = 4096
SHARD_IDS = 2_000_000
#: Words that a worker remembers.
MEMO = 800_000
#: Ids in a word and bits for each, by selector; 15 is the escape.
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = 60 // COUNTS
ESCAPE = 15
_MAGIC = b"S8BT"
_HEAD = struct.Struct("<4sIQQQQQ")
_BITS = np.array([i.bit_length() for i in range(1 << 16)], np.uint8)
_LIMITS = np.array([1 << i for i in range(64)], np.uint64)


def _bit_lengths(values: np.ndarray) -> np.ndarray:
    if len(values) and values.max() < 1 << 16:
        return _BITS[values.astype(np.int64)]
    return np.searchsorted(_LIMITS, values, side="right").astype(np.uint8)


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, word offset of each block and the end, escaped values) of unsigned 64-bit values."""
    blocks = -(-len(values) // BLOCK)
    padded = np.zeros(blocks * BLOCK, np.uint64)
    padded[: len(values)] = values
    bits = np.zeros((blocks, BLOCK + 64), np.uint8)
    bits[:, :BLOCK] = _bit_lengths(padded).reshape(blocks, BLOCK)
    spans = {1: bits}
    for n in (2, 4, 8, 16, 32):
        half = spans[n // 2]
        spans[n] = np.maximum(half, np.pad(half[:, n // 2 :], ((0, 0), (0, n // 2))))
    # the selector that packs most ids from each place on
    chosen = np.full((blocks, BLOCK), ESCAPE, np.uint8)
    for s in range(len(COUNTS) - 1, -1, -1):
        n = int(COUNTS[s])
        power = 1 << (n.bit_length() - 1)
        most = np.maximum(spans[power][:, :BLOCK], spans[power][:, n - power : n - power + BLOCK])
        chosen[most <= WIDTHS[s]] = s
    steps = np.concatenate((COUNTS, [1, 1])).astype(np.int64)
    rows, at, seen = np.arange(blocks), np.zeros(blocks, np.int64), []
    while len(rows):
        which = chosen[rows, at]
        seen.append((rows, at, which))
        at = at + steps[which]
        more = at < BLOCK
        rows, at = rows[more], at[more]
    if not seen:
        return np.empty(0, np.uint64), np.zeros(1, np.int64), np.empty(0, np.uint64)
    place = np.concatenate([r * BLOCK + a for r, a, _ in seen])
    which = np.concatenate([w for _, _, w in seen])
    order = np.argsort(place, kind="stable")
    place, which = place[order], which[order]
    # words that hold nothing but padding are not written
    real = place < len(values)
    place, which = place[real], which[real]
    words = which.astype(np.uint64) << np.uint64(60)
    tail = np.concatenate((padded, np.zeros(64, np.uint64)))
    ends = (place // BLOCK + 1) * BLOCK
    for s in range(len(COUNTS)):
        own = np.flatnonzero(which == s)
        first, end, width = place[own], ends[own], int(WIDTHS[s])
        for k in range(int(COUNTS[s])):
            value = np.where(first + k < end, tail[first + k], np.uint64(0))
            words[own] |= value << np.uint64(k * width)
    escaped = np.flatnonzero(which == ESCAPE)
    words[escaped] |= np.arange(len(escaped), dtype=np.uint64)
    offsets = np.searchsorted(place, np.arange(blocks + 1) * BLOCK)
    return words, offsets.astype(np.int64), padded[place[escaped]]


def unpack(words: np.ndarray, offsets: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The values packed into words; all words at once."""
    which = (words >> np.uint64(60)).astype(np.int64)
    counts = np.concatenate((COUNTS, [1, 1]))[which]
    before = np.concatenate(([0], np.cumsum(counts)))
    # ids of a word start where the block's earlier words end
    block = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    start = block * BLOCK + before[:-1] - before[offsets[:-1]][block]
    out = np.zeros((len(offsets) - 1) * BLOCK + 64, np.uint64)
    ends = (block + 1) * BLOCK
    for s in range(len(COUNTS)):
        own = np.flatnonzero(which == s)
        mask, width = np.uint64((1 << int(WIDTHS[s])) - 1), int(WIDTHS[s])
        for k in range(int(COUNTS[s])):
            inside = start[own] + k < ends[own]
            out[start[own][inside] + k] = (words[own][inside] >> np.uint64(k * width)) & mask
    own = np.flatnonzero(which == ESCAPE)
    out[start[own]] = escapes[(words[own] & np.uint64((1 << 60) - 1)).astype(np.int64)]
    return out[:n]


def write_shard(doc_ids: list[int | None], lengths: list[int], values: np.ndarray) -> bytes:
    words, offsets, escapes = pack(values)
    parts = (
        np.array([x is not None for x in doc_ids], np.uint8).tobytes(),
        np.array([x or 0 for x in doc_ids], "<i8").tobytes(),
        np.array(lengths, "<i8").tobytes(),
        offsets.astype("<i8").tobytes(),
        words.astype("<u8").tobytes(),
        escapes.astype("<u8").tobytes(),
    )
    head = _HEAD.pack(_MAGIC, BLOCK, len(doc_ids), len(values), len(offsets), len(words), len(escapes))
    return b"".join((head, *parts))


def read_shard(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(document ids, lengths, all ids) of a shard."""
    magic, block, docs, n, n_offsets, n_words, n_escapes = _HEAD.unpack_from(data)
    if magic != _MAGIC or block != BLOCK:
        raise ValueError("not a shard of token ids")
    at, parts = _HEAD.size, []
    for kind, count in (("u1", docs), ("<i8", docs), ("<i8", docs), ("<i8", n_offsets), ("<u8", n_words), ("<u8", n_escapes)):
        parts.append(np.frombuffer(data, kind, count, at))
        at += parts[-1].nbytes
    valid, ids, lengths, offsets, words, escapes = parts
    return [int(x) if v else None for x, v in zip(ids, valid, strict=True)], lengths, unpack(words, offsets, escapes, n)


#: Letters that may make up a plain word: ASCII and Latin ones.
_LETTERS = [c for c in map(chr, range(0x41, 0x180)) if c.isalpha()]
#: The character that a byte-level tokenizer writes for each byte.
_SEEN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE = {**{b: b for b in _SEEN}, **{b: 256 + k for k, b in enumerate(sorted({*range(256)} - {*_SEEN}))}}


class RunEncoder:
    """Ids (as bytes) of white-space separated runs, each encoded by the library once while it is remembered.

    A word of plain letters is one unit of the tokenizer, in lower case, so it goes to the library's model at once, without the
    steps that look for units. With a stop or comma after it it is two units; such words are remembered apart from the runs, so
    runs can be forgotten and put together again without the library. Plain are the letters for which the model alone gives what
    the whole tokenizer gives.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        whole = self.tokenizer.encode_batch_fast(_LETTERS, add_special_tokens=False)
        plain = [c for c, e in zip(_LETTERS, whole, strict=True) if array("I", e.ids).tobytes() == self._direct(c.lower())]
        self.plain = re.compile(f"[{''.join(plain)}]+" if plain else r"(?!)").fullmatch
        self.words: dict[str, bytes] = {}
        self.runs: dict[str, bytes] = {}

    def _direct(self, word: str) -> bytes:
        """The ids of a word of plain lower-case letters."""
        units = word if word.isascii() else word.encode().decode("latin-1").translate(_BYTE)
        return array("I", [t.id for t in self.model.tokenize(units)]).tobytes()

    def _add(self, runs: list[str]) -> None:
        stems = [r[:-1] if r[-1:] in (".", ",") else r for r in runs]
        plain = [self.plain(x) is not None for x in stems]
        keys = [x.lower() if p else r for r, x, p in zip(runs, stems, plain, strict=True)]
        new = {k for k in (*keys, ".", ",") if k not in self.words}
        if len(self.words) + len(new) > MEMO:
            self.words.clear()
            new = {*keys, ".", ","}
        letters = {k for k, p in zip(keys, plain, strict=True) if p and k in new}
        for k in letters:
            self.words[k] = self._direct(k)
        rest = list(new - letters)
        for i in range(0, len(rest), 4096):
            part = rest[i : i + 4096]
            found = self.tokenizer.encode_batch_fast(part, add_special_tokens=False)
            self.words.update(zip(part, (array("I", e.ids).tobytes() for e in found), strict=True))
        words = self.words
        for r, x, k, p in zip(runs, stems, keys, plain, strict=True):
            self.runs[r] = words[k] + words[r[-1]] if p and len(x) < len(r) else words[k]

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text, piece by piece if it is very long."""
        split = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        parts = []
        for i in range(0, len(split), 100_000):
            piece = split[i : i + 100_000]
            new = list(set(filterfalse(self.runs.__contains__, piece)))
            if len(self.runs) + len(new) > MEMO // 2:
                self.runs.clear()
                new = list(set(piece))
            self._add(new)
            parts.append(np.frombuffer(b"".join(map(self.runs.__getitem__, piece)), np.uintc))
        return np.concatenate(parts)


_ENCODERS: dict[str, RunEncoder] = {}


def encoder(path: str) -> RunEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = RunEncoder(path)
    return _ENCODERS[path]


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, key: str = "doc_id", text: str = "text") -> None:
    """Write the documents' ids in id order, as shards, to a folder (one parquet row per shard)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, seq = encoder(tokenizer), TaskContext.get().partitionId(), 0
        ids: list[int | None] = []
        arrays: list[np.ndarray] = []
        total = 0

        def shard() -> pa.RecordBatch:
            payload = write_shard(ids, [len(a) for a in arrays], np.concatenate(arrays).astype(np.uint64))
            return pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()), "n_docs": [len(ids)], "n_ids": [total], "payload": pa.array([payload], pa.binary())}
            )

        for batch in batches:
            for key_value, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids.append(key_value)
                arrays.append(np.append(encode.encode(value.as_py()), end_id))
                total += len(arrays[-1])
                if total >= SHARD_IDS:
                    yield shard()
                    ids, arrays, total, seq = [], [], 0, seq + 1
        if ids:
            yield shard()

    whole = docs.select(F.col(key).cast("long").alias("k"), F.coalesce(text, F.lit("")).alias("t"))
    dealt = whole.withColumn("h", F.xxhash64("t")).repartitionByRange("k", "h").sortWithinPartitions("k", "h", "t")
    schema = "part int, seq int, n_docs long, n_ids long, payload binary"
    dealt.select("k", "t").mapInArrow(run, schema).write.parquet(path)


def read_token_files(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of every document, from the files."""
    shards = spark.read.parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, payload in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids, lengths, values = read_shard(payload)
                ends = np.cumsum(lengths)
                data = values.astype("<u4").tobytes()
                crcs = [zlib.crc32(data[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(ends - lengths), pa.array(lengths), pa.array(crcs, pa.int64()), pa.array([part] * len(ids), pa.int32()), pa.array([seq] * len(ids), pa.int32())],
                    [key, "local", "n_tokens", "ids_crc32", "part", "seq"],
                )

    rows = shards.select("part", "seq", "payload").mapInArrow(
        run, f"`{key}` long, local long, n_tokens long, ids_crc32 long, part int, seq int"
    )
    # ids before a shard: a sum over parts (one row each), then over the shards of its part
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inner = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    places = shards.select("part", "seq", F.coalesce(F.sum("n_ids").over(inner), F.lit(0)).alias("inner")).join(parts, "part")
    offsets = hint(places.select("part", "seq", (F.col("before") + F.col("inner")).alias("offset")), 10_000)
    return rows.join(offsets, ["part", "seq"]).select(key, (F.col("offset") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")
