"""Benchmark decontamination by latent semantic retrieval.

1. Words are the runs of letters and digits, A-Z as a-z, hashed to `DIMS` features. Passages are windows of `WINDOW` words,
   half overlapping. Document frequencies are counted over the passages of the whole corpus.
2. Randomised SVD (Halko et al.): the TF-IDF rows of all passages of all documents and of the benchmark items are multiplied with a
   random matrix and, for each power iteration, with themselves; partial products are added in a tree. The items' rows weigh
   `ITEM_WEIGHT` times as much as the documents' in all, lest a large corpus crowds them out of the index. The orthonormal basis
   found is the latent space; every passage of every document is projected into it and searched. Words are hashed once for this:
   their features are written, two bytes a word.
3. A passage whose latent cosine to a passage of an item reaches `CANDIDATE`, and whose words weigh at least `SHARED` of that
   passage's, is a candidate. Neighbouring passages of one item are joined, and the item's longest common subsequence with the
   words there is computed.
4. A candidate is confirmed if the subsequence covers `COVER` of the item, or `COVER_ANSWER` of it and the item's answer (its
   last `ANSWER` words) stands in the passage as it is.

Items are broadcast in blocks of `ITEMS`, so a benchmark of any size is searched against all rows. Null texts count as empty;
items without words are found nowhere. Null or repeated ids are fine: a row per document row and item is returned.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringsight.llm.common import sum_arrays, word_hashes
from ringsight.session import materialize

DIMS = 1 << 14
WINDOW, STEP = 32, 16
RANK, POWER = 128, 1
CANDIDATE, SHARED, COVER, COVER_ANSWER, ANSWER = 0.45, 0.33, 0.75, 0.6, 6
ITEM_WEIGHT, ITEMS = 1.0, 1000
#: tasks that send a matrix for the index: so many, and one more for each so many tiles of `STEP` words beyond that
FIT_TASKS, FIT_TILES = 8, 1_000_000
#: words multiplied at once; longer texts are cut with one tile of overlap, which keeps their passages
CHUNK = 1 << 10


def words_of(text: str | None) -> np.ndarray:
    return word_hashes(text or "", alnum=True)


def _starts(n: int) -> np.ndarray:
    """Starts of the passages of n words; the last one may be shorter than a window."""
    return np.arange(0, max(n - STEP, min(n, 1)), STEP)


def _features(words: np.ndarray) -> np.ndarray:
    return (words & np.uint64(DIMS - 1)).astype(np.int64)


def feature_rows(texts: DataFrame, text: str) -> DataFrame:
    """A written table of the features of each text's words in order, as 16-bit numbers."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_features(words_of(value.as_py())).astype(np.uint16).tobytes() for value in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["features"])

    return materialize(texts.select(text).mapInArrow(hashed, "features binary"), "index-features")


def _stored(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    for value in batch.column(0):
        yield np.frombuffer(value.as_buffer(), np.uint16)


def document_frequencies(rows: DataFrame) -> tuple[np.ndarray, int]:
    """Passages with each feature, and all passages, over every row of `feature_rows`."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, passages = np.zeros(DIMS + 1, np.int64), 0
        for batch in batches:
            for feature in _stored(batch):
                # counted once in each run of STEP words: half passages tile the text without overlap
                place = np.arange(len(feature)) // STEP
                total[:DIMS] += np.bincount(np.unique(place * DIMS + feature) % DIMS, minlength=DIMS)
                passages += -(-len(feature) // STEP)
        total[DIMS] = passages
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["data"])

    total = sum_arrays(rows.mapInArrow(count, "data binary"), "int64")
    return (np.zeros(DIMS, np.int64), 0) if total is None else (total[:DIMS], int(total[DIMS]))


def _chunks(rows: Iterator[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """The texts in lists of about `CHUNK` words."""
    held, size = [], 0
    for feature in rows:
        for low in range(0, max(1, len(feature) - STEP), CHUNK):
            part = feature[low : low + CHUNK + STEP]
            if len(part):
                held.append(part)
                size += len(part)
            if size >= CHUNK:
                yield held
                held, size = [], 0
    if held:
        yield held


class Gram:
    """Adds up A'(A matrix) for the TF-IDF rows A of passages, each of length 1."""

    def __init__(self, matrix: np.ndarray, idf: np.ndarray) -> None:
        self.matrix, self.idf = matrix.astype(np.float32), idf.astype(np.float32)
        self.sums = np.zeros(matrix.shape)

    def add(self, texts: list[np.ndarray]) -> None:
        """The passages of a few texts as a dense matrix over the features that occur in them."""
        feature = np.concatenate(texts)
        there = np.zeros(DIMS, bool)
        there[feature] = True
        own, at = np.flatnonzero(there), (np.cumsum(there) - 1)[feature]
        sizes = np.array([len(t) for t in texts])
        tiles = -(-sizes // STEP)
        ends = np.cumsum(tiles)
        tile = (np.arange(len(at)) - np.repeat(np.cumsum(sizes) - sizes, sizes)) // STEP + np.repeat(ends - tiles, sizes)
        rows = np.bincount(tile * len(own) + at, minlength=ends[-1] * len(own)).reshape(-1, len(own)).astype(np.float32)
        rows *= self.idf[own]
        # a passage is a tile of STEP words and the next one, or the only tile of its text
        last, only = np.zeros(ends[-1], bool), np.zeros(ends[-1], bool)
        last[ends - 1] = True
        only[ends[tiles == 1] - 1] = True
        following = rows[1:].copy()
        following[last[:-1]] = 0
        rows[:-1] += following
        rows = rows[~last | only]
        rows /= np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]
        self.sums[own] += rows.T @ (rows @ self.matrix[own])


def latent_basis(rows: DataFrame, row_tiles: int, items: DataFrame, item_tiles: int, idf: np.ndarray, rank: int = RANK, power: int = POWER) -> np.ndarray:
    """Right singular vectors (DIMS x rank) of the TF-IDF matrix of all passages, by a randomised range finder on the rows.

    rows, items: `feature_rows` of the documents and of the items, with as many tiles of `STEP` words. Each task sends one matrix.
    """
    spark = rows.sparkSession
    weight = ITEM_WEIGHT * max(1.0, row_tiles / max(1, item_tiles))
    random = np.random.Generator(np.random.PCG64(5))
    basis = np.linalg.qr(random.standard_normal((DIMS, rank + 8), dtype=np.float32))[0]
    def product(matrix: np.ndarray) -> np.ndarray:
        """A'(A matrix), from partial sums, one per partition."""
        shared = spark.sparkContext.broadcast(matrix)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            gram = None
            for chunk in _chunks(x for batch in batches for x in _stored(batch)):
                gram = gram or Gram(shared.value, idf)
                gram.add(chunk)
            if gram:
                yield pa.RecordBatch.from_arrays([pa.array([gram.sums.astype(np.float32).tobytes()], pa.binary())], ["data"])

        total = np.zeros(matrix.size, np.float32)
        for table, tiles, factor in ((rows, row_tiles, 1.0), (items, item_tiles, weight)):
            tasks = max(FIT_TASKS, tiles // FIT_TILES)
            # as many matrices meet in a task on each level of the tree
            part = sum_arrays(table.coalesce(tasks).mapInArrow(run, "data binary"), "float32", fan=math.ceil(tasks ** (1 / 3)))
            if part is not None:
                total += np.float32(factor) * part
        shared.destroy()
        return total.reshape(matrix.shape)

    for _ in range(power):
        basis = np.linalg.qr(product(basis))[0]
    # singular vectors within the subspace found
    _, turn = np.linalg.eigh(basis.T @ product(basis))
    return basis @ turn[:, ::-1][:, :rank]


def common_subsequence(item: list[int], masks: dict[int, int], words: list[int]) -> int:
    """Length of the longest common subsequence; masks: the item's places of each word, as bits."""
    full = (1 << len(item)) - 1
    row = full
    for w in words:
        mask = masks.get(w)
        if mask:
            hit = row & mask
            row = ((row + hit) | (row - hit)) & full
    return len(item) - row.bit_count()


class Searcher:
    """Finds a block of benchmark items in texts."""

    def __init__(self, items: list[tuple], basis: np.ndarray, idf: np.ndarray) -> None:
        self.weight = (basis * idf[:, None]).astype(np.float32)
        self.idf = idf.astype(np.float32)
        self.ids = [i for i, _ in items]
        self.items = [words_of(t).tolist() for _, t in items]
        self.masks = []
        for words in self.items:
            masks: dict[int, int] = {}
            for k, w in enumerate(words):
                masks[w] = masks.get(w, 0) | 1 << k
            self.masks.append(masks)
        # an item is searched by each of its passages, as a passage of a document can hold only part of it
        rows, owner, own = [], [], []
        for k, words in enumerate(self.items):
            feature = _features(np.array(words, np.uint64))
            for start in _starts(len(feature)):
                own.append(np.unique(feature[start : start + WINDOW]))
                rows.append(self.weight[feature[start : start + WINDOW]].sum(axis=0))
                owner.append(k)
        self.owner = np.array(owner, np.int64)
        table = np.array(rows, np.float32).reshape(-1, basis.shape[1])
        self.table = table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-12)
        self.has = np.zeros((len(own), DIMS), bool)
        for k, feature in enumerate(own):
            self.has[k, feature] = True
        self.total = np.array([self.idf[x].sum() for x in own], np.float32)

    def find(self, text: str | None) -> list[tuple]:
        """(item id, first word, end, cosine, covered share) of the items in a text."""
        words = words_of(text)
        starts = _starts(len(words))
        if not len(starts) or not len(self.owner):
            return []
        near: dict[int, list[tuple[int, int, float]]] = {}
        feature = _features(words)
        for low in range(0, len(starts), 4096):
            own = starts[low : low + 4096]
            first, end = own[0], min(len(words), own[-1] + WINDOW)
            tiles = np.add.reduceat(self.weight[feature[first:end]], np.arange(0, end - first, STEP), axis=0)
            latent = tiles[: len(own)].copy()
            latent[: len(tiles) - 1] += tiles[1 : len(own) + 1]
            latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)
            cosine = latent @ self.table.T
            passage, at = np.nonzero(cosine >= CANDIDATE)
            if not len(passage):
                continue
            place = own[passage][:, None] + np.arange(WINDOW)
            inside = np.sort(np.where(place < len(words), feature[np.minimum(place, len(words) - 1)], DIMS), axis=1)
            fresh = np.concatenate((np.ones((len(inside), 1), bool), inside[:, 1:] != inside[:, :-1]), axis=1) & (inside < DIMS)
            inside = np.minimum(inside, DIMS - 1)
            shared = (self.idf[inside] * (fresh & self.has[at[:, None], inside])).sum(axis=1)
            for p, c in zip(*(x[shared >= SHARED * self.total[at]] for x in (passage, at)), strict=True):
                near.setdefault(int(self.owner[c]), []).append((int(own[p]), int(own[p]) + WINDOW, float(cosine[p, c])))
        found = []
        for k, places in near.items():
            item, reach = self.items[k], len(self.items[k])
            merged: list[list] = []
            for a, b, c in sorted(places):
                a, b = max(0, a - reach), min(len(words), b + reach)
                if merged and a <= merged[-1][1] and b - merged[-1][0] <= 8 * (reach + WINDOW):
                    merged[-1][1], merged[-1][2] = b, max(c, merged[-1][2])
                else:
                    merged.append([a, b, c])
            best = max((self._covered(k, words[a:b].tolist()) + (a, b, c) for a, b, c in merged), default=None)
            if best and (best[0] >= COVER * len(item) or best[0] >= COVER_ANSWER * len(item) and best[1]):
                found.append((self.ids[k], best[2], best[3], best[4], best[0] / len(item)))
        return found

    def _covered(self, k: int, words: list[int]) -> tuple[int, bool]:
        """Most words of the item, in order, in any stretch of half as many words again; and whether the answer is there."""
        item, masks = self.items[k], self.masks[k]
        size = len(item) + max(4, len(item) // 2)
        if common_subsequence(item, masks, words) < COVER_ANSWER * len(item):
            return 0, False
        step = max(1, len(item) // 4)
        best = max((common_subsequence(item, masks, words[a : a + size + step]) for a in range(0, max(1, len(words) - size + step), step)), default=0)
        answer = item[-ANSWER:]
        there = any(words[i : i + len(answer)] == answer for i, w in enumerate(words) if w == answer[0])
        return best, there


def find_items(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """(key, th, item, first_word, end_word, cosine, covered): the items found in each document; th: xxhash64 of its text."""
    kind, item_kind = (t.schema[c].dataType.simpleString() for t, c in ((docs, key), (benchmark, item)))
    schema = f"`{key}` {kind}, th long, `{item}` {item_kind}, first_word long, end_word long, cosine double, covered double"
    spark = docs.sparkSession
    items = benchmark.select(F.col(item).alias("i"), F.coalesce(item_text, F.lit("")).alias("t"))
    n_items = items.count()
    source = docs.select(F.col(key).alias("key"), F.coalesce(text, F.lit("")).alias("text"))
    if not n_items:
        return spark.createDataFrame([], schema)
    rows, wanted = feature_rows(source, "text"), feature_rows(items, "t")
    seen, passages = document_frequencies(rows)
    idf = np.log((1 + passages) / (1 + seen)) ** 2 + 0.05  # squared: frequent words say little about a passage
    basis = latent_basis(rows, passages, wanted, document_frequencies(wanted)[1], idf)
    space = spark.sparkContext.broadcast((basis, idf))  # DIMS x (RANK + 1) numbers, whatever the input
    blocks = -(-n_items // ITEMS)
    out = None
    for b in range(blocks):
        block = [(r["i"], r["t"]) for r in items.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b).collect()]

        def search(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            searcher = Searcher(block, *space.value)
            for batch in batches:
                rows = [(k, *f) for k, t in enumerate(batch.column(2)) for f in searcher.find(t.as_py())]
                at = pa.array([r[0] for r in rows], pa.int64())
                columns = [pa.array([r[i] for r in rows]) for i in range(1, 6)] if rows else [pa.array([], pa.int64())] * 5
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), *[c.cast(t) for c, t in zip(columns, kinds, strict=True)]], names)

        names = [key, "th", item, "first_word", "end_word", "cosine", "covered"]
        kinds = [_arrow_kind(benchmark, item), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        found = source.select("key", F.xxhash64("text").alias("th"), "text").mapInArrow(search, schema)
        out = found if out is None else out.unionByName(found)
    return out


def _arrow_kind(table: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(table.schema[column].dataType)
