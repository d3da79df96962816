"""SentencePiece encoding and decoding over a relational lattice.

1. Texts are cut into units that no piece can cross: between any two characters that follow each other in no piece. Each block of
   text numbers its distinct units; only those are shuffled, never the tokens of every document: by buckets of a unit's hash, a
   block's units of a bucket in one string. The one shuffle by bucket serves all steps up to the paths.
2. The distinct units are exploded into substrings of at most the longest piece's length and joined to the piece table on
   equality. That gives the edges of each unit's lattice; a character that no piece holds gets an edge of its own.
3. Edges are grouped by unit and the places of the unit folded with Spark's higher-order aggregate (Viterbi): best score up to
   each place and the edge that reached it; of equal scores the one with the longer last piece wins. A second fold walks back.
4. Only units pass through the lattice, never their places: each bucket then looks up the paths for the listings of all blocks, and
   each block spells its documents from them; unknown characters become byte pieces.

The segmentation is the one of the best total score, which the sentencepiece library gives when it treats the same piece file
as a unigram model. Units of more than `LONG` characters would make one array of edges too large, so a block's task runs the
same recursion on them in Python and notes their ids in place of numbers.

A block tells its units apart by a 64-bit hash (of 100,000 units two agree with a chance of 3 in 10^10; `lossless` would be false).

Null texts count as empty and have no ids. Rows with null or repeated ids are kept apart by their place. Decoding joins pieces,
turns the space mark into a space, and drops the space put before the text; a text that holds the mark itself does not come back.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringsight.llm.common import mix
from ringsight.session import materialize

MARK = "▁"
LONG = 512
DIRECT = 1 << 31
#: Buckets of units: at least so many for each shuffle partition, and one for so many characters of text.
SPREAD, BUCKET_CHARS = 4, 1 << 24
BLOCK_CHARS, PART = 1 << 22, 1 << 18


@dataclass(frozen=True)
class Pieces:
    names: list[str]
    ids: list[int]
    scores: list[float]
    byte_ids: list[int]
    unknown: int
    size: int

    @property
    def longest(self) -> int:
        return max(map(len, self.names))

    def table(self, spark: SparkSession) -> DataFrame:
        rows = list(zip(self.names, self.ids, self.scores, strict=True))
        return spark.createDataFrame(rows, "piece string, id int, score double")

    def cutter(self) -> Cutter:
        return Cutter(sorted({x for name in self.names for x in zip(name, name[1:], strict=False)}))

    @property
    def unknown_score(self) -> float:
        return min(self.scores) - 10

    def surfaces(self) -> list[bytes]:
        """The bytes that each id stands for."""
        out = [b""] * self.size
        for name, i in zip(self.names, self.ids, strict=True):
            out[i] = name.replace(MARK, " ").encode()
        for byte, i in enumerate(self.byte_ids):
            out[i] = bytes([byte])
        return out


def load_pieces(path: str) -> Pieces:
    """The piece table of a model file."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    names, ids, scores, byte_ids = [], [], [], [0] * 256
    for i in range(model.get_piece_size()):
        if model.is_byte(i):
            byte_ids[int(model.id_to_piece(i)[3:5], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            names.append(model.id_to_piece(i))
            ids.append(i)
            scores.append(model.get_score(i))
    return Pieces(names, ids, scores, byte_ids if any(byte_ids) else [], model.unk_id(), model.get_piece_size())


class Cutter:
    """Cuts texts between any two characters that follow each other in no piece; so no piece crosses a cut."""

    def __init__(self, pairs: list[tuple[str, str]]):
        self.pairs, self.tables = pairs, None

    def __reduce__(self):
        return Cutter, (self.pairs,)  # tasks build their own tables

    def _part(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of the units of a part of a text."""
        if self.tables is None:
            letters = sorted({x for pair in self.pairs for x in pair})
            numbers = np.zeros(0x110000, np.int32 if len(letters) < 46000 else np.int64)
            numbers[[ord(x) for x in letters]] = np.arange(1, len(letters) + 1)
            joined = np.zeros((len(letters) + 1) ** 2, bool)
            for a, b in self.pairs:
                joined[numbers[ord(a)] * (len(letters) + 1) + numbers[ord(b)]] = True
            with np.errstate(over="ignore"):
                values = mix(np.arange(1, 0x110001, dtype=np.uint64)) | np.uint64(1)
                powers = np.multiply.accumulate(np.full(LONG + 1, 0x9E3779B97F4A7C15, np.uint64))
            self.tables = numbers, joined, len(letters) + 1, values, powers
        numbers, joined, n, values, powers = self.tables
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        found = numbers[points]
        starts = np.concatenate(([0], np.flatnonzero(~joined[found[:-1] * n + found[1:]]) + 1))
        within = np.arange(len(text)) - np.repeat(starts, np.diff(starts, append=len(text)))
        with np.errstate(over="ignore"):
            return starts, mix(np.add.reduceat(values[points] * powers[np.minimum(within, LONG)], starts))

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and hashes of the units of a text; long texts go by parts, which end where a unit ends."""
        at, size, out = 0, PART, ([np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.uint64)])
        while at < len(text):
            part = text[at : at + size]
            starts, hashes = self._part(part)
            ends = np.append(starts[1:], len(part))
            if at + size < len(text):
                if len(starts) == 1:
                    size *= 2
                    continue
                starts, ends, hashes = starts[:-1], ends[:-1], hashes[:-1]
            for column, values in zip(out, (at + starts, at + ends, hashes), strict=True):
                column.append(values)
            at, size = at + int(ends[-1]), PART
        return tuple(map(np.concatenate, out))


def segment(unit: str, scores: dict[str, tuple[float, int]], longest: int, unknown: float) -> list[int]:
    """Best segmentation of one unit (negative: an unknown character's code), by the same rule as the fold."""
    best, back = [0.0] + [-np.inf] * len(unit), [(-1, 0)] * (len(unit) + 1)
    for end in range(1, len(unit) + 1):
        for start in range(max(0, end - longest), end):
            found = scores.get(unit[start:end])
            if found is None and end - start == 1:
                found = (unknown, -ord(unit[start]))
            if found and best[start] + found[0] > best[end]:
                best[end], back[end] = best[start] + found[0], (start, found[1])
    ids, at = [], len(unit)
    while at:
        at, i = back[at]
        ids.append(i)
    return ids[::-1]


def _pack(values: np.ndarray) -> bytes:
    """Compressed byte planes of an array of integers."""
    return zlib.compress(values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes(), 1)


def _unpack(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs of an array that begin at `starts`, one after the other."""
    return flat[np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())]


def _scan(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, text and the place they were read from; whatever is not a plain scan of files is written first.

    Spark resolves the place of a row behind a shuffle, a join or a union too, but there rows of one place are in many tasks.
    """
    columns = [F.col(key).alias("key"), F.coalesce(text, F.lit("")).alias("text")]
    place = [F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at")]
    if not _plain_scan(docs):
        docs = materialize(docs.select(*columns), "piece-texts")
        columns = ["key", "text"]
    return docs.select(*columns, *place)


def _few_files(scan: DataFrame, wanted: int) -> DataFrame:
    """A block ends where its file ends, and every block lists its units anew; so texts of many small files are written to fewer first."""
    if len(scan.inputFiles()) <= 2 * wanted:
        return scan
    return _scan(scan.select("key", "text").coalesce(wanted), "key", "text")


def _plain_scan(docs: DataFrame) -> bool:
    """Whether a table is a scan of files with nothing but columns and filters above it."""
    node = docs._jdf.queryExecution().analyzed()
    while node.children().size() == 1 and node.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        node = node.children().head()
    return node.children().isEmpty() and node.nodeName() == "LogicalRelation" and bool(docs.inputFiles())


def _blocks(batches: Iterator[pa.RecordBatch], cut: Cutter, words: bool, long_ids: Callable[[str], list[int]], buckets: int) -> Iterator[pa.RecordBatch]:
    """List the distinct units of each block by bucket, in order of their hashes; or give the documents as numbers of units (from
    `DIRECT` on: ids), common units first, and then, with crc -1, the places of the numbered units in that list.
    """
    here, block, chars, part, held, kind = None, 0, 0, 0, [], None

    def finish() -> pa.RecordBatch:
        ends = np.cumsum([len(x[2]) for x in held])
        of, names = pd.factorize(np.concatenate([x[2] for x in held]))
        by_hash = np.argsort(names)
        if words:
            first = np.empty(len(names), np.int64)
            first[of[::-1]] = np.arange(len(of) - 1, -1, -1)
            names, first = names[by_hash], first[by_hash]
            owner = np.searchsorted(ends, first, "right")
            first = first - (ends - [len(x[2]) for x in held])[owner]
            units = [held[d][1][held[d][3][i] : held[d][4][i]] for d, i in zip(owner.tolist(), first.tolist(), strict=True)]
            # the order of hashes is that of buckets too
            own, start = np.unique((names >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32), return_index=True)
            # units hold no spaces; long strings of them are far smaller in a shuffle than rows
            cuts = [*start.tolist(), len(units)]
            joined = [" ".join([str(block), *units[i:j]]) for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), pa.array(joined, pa.string())], ["bucket", "units"])
        common = np.argsort(-np.bincount(of, minlength=len(names)), kind="stable")
        rank, listed = np.empty(len(names), np.uint32), np.empty(len(names), np.uint32)
        rank[common] = listed[by_hash] = np.arange(len(names))
        numbers, keys, crcs = [], [x[0] for x in held], [x[1] for x in held]
        for (_, _, _, longs), own in zip(held, np.split(rank[of], ends[:-1]), strict=True):
            if longs:
                at, ids = zip(*[(i, DIRECT + j) for i, unit in longs for j in long_ids(unit)], strict=True)
                own = np.insert(own, at, np.array(ids, np.uint32))
            numbers.append(_pack(own))
        if len(names):
            keys, numbers, crcs = [*keys, None], [*numbers, _pack(listed[common])], [*crcs, -1]
        columns = [pa.array(keys, kind), pa.array([block] * len(crcs), pa.int64()), pa.array(numbers, pa.binary()), pa.array(crcs, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["key", "block", "numbers", "crc"])

    for batch in batches:
        kind = batch.column(0).type
        for name, value, path, at in zip(*batch.columns[:2], batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            text = value.as_py()
            if here != (path, at) or chars > BLOCK_CHARS:
                if held:
                    yield finish()
                part = part + 1 if here == (path, at) else 0
                here, chars, held = (path, at), 0, []
                block = int.from_bytes(hashlib.blake2b(f"{path}\n{at}\n{part}".encode(), digest_size=8).digest(), "little", signed=True)
            chars += len(text) + 1
            marked = MARK + text.replace(" ", MARK) if text else ""
            starts, ends, hashes = cut(marked)
            long = ends - starts > LONG
            if words:
                held.append((None, marked, hashes[~long], starts[~long], ends[~long]))
            else:
                # long units with the number of short ones before them
                longs = [(int(t - k), marked[starts[t] : ends[t]]) for k, t in enumerate(np.flatnonzero(long).tolist())]
                held.append((name.as_py(), zlib.crc32(text.encode("utf-8", "surrogatepass")), hashes[~long], longs))
    if held:
        yield finish()


def lattice(units: DataFrame, pieces: Pieces, keys: list[str]) -> DataFrame:
    """keys, start, end, score, id: every piece at every place of the units, by an equi-join."""
    table = F.broadcast(pieces.table(units.sparkSession))  # as large as the model file, whatever the corpus
    starts = units.select("*", F.explode(F.sequence(F.lit(0), F.char_length("unit") - 1)).alias("start"))
    starts = starts.withColumn("rest", F.substring("unit", F.col("start") + 1, F.lit(pieces.longest)))
    parts = starts.select("*", F.explode(F.sequence(F.lit(1), F.char_length("rest"))).alias("size"))
    parts = parts.withColumn("piece", F.substring("rest", F.lit(1), F.col("size")))
    edges = parts.join(table, "piece", "left").where("id is not null or size = 1")
    return edges.select(
        *keys, "start", (F.col("start") + F.col("size")).alias("end"),
        F.coalesce("score", F.lit(pieces.unknown_score)).alias("score"),
        F.coalesce("id", -F.ascii("piece")).alias("id"),
    )


def viterbi(edges: DataFrame, by: list[str]) -> DataFrame:
    """by, ids: the best path of each unit's edges."""
    found = F.sort_array(F.collect_list(F.struct("end", "start", "score", "id")))
    grouped = edges.groupBy(*by).agg(found.alias("edges"))
    state = "array<struct<score:double,back:int,id:int>>"
    every = F.col("edges")

    def step(best, end):
        """The best edge that ends here; of equal scores the one from further back."""
        here = F.filter(every, lambda e: e["end"] == end)
        reached = F.transform(
            here,
            lambda e: F.struct((best[e["start"]]["score"] + e["score"]).alias("score"), (-e["start"]).alias("back"), e["id"].alias("id")),
        )
        return F.concat(best, F.array(F.array_max(reached)))

    zero = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("back"), F.lit(0).alias("id"))).cast(state)
    ends = F.sequence(F.lit(1), F.element_at(every, -1)["end"])
    best = grouped.select(*by, F.aggregate(ends, zero, step).alias("best"))
    begin = F.struct((F.size("best") - 1).alias("at"), F.array().cast("array<int>").alias("ids"))

    def walk(path, _):
        here = F.col("best")[path["at"]]
        return F.when(path["at"] == 0, path).otherwise(
            F.struct((-here["back"]).alias("at"), F.concat(path["ids"], F.array(here["id"])).alias("ids"))
        )

    path = F.aggregate(F.sequence(F.lit(1), F.size("best") - 1), begin, walk)
    return best.select(*by, F.reverse(path["ids"]).alias("ids"))


def encode(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids, decoded, lossless) of every document."""
    pieces = load_pieces(model)
    scan, cut = _scan(docs, key, text), pieces.cutter()
    kind = docs.schema[key].dataType.simpleString()
    scores = {n: (v, i) for n, v, i in zip(pieces.names, pieces.scores, pieces.ids, strict=True)}
    longest, unknown, byte_ids, unk, surfaces = pieces.longest, pieces.unknown_score, pieces.byte_ids, pieces.unknown, pieces.surfaces()

    def known(i: int) -> list[int]:
        """A piece's id, or the byte pieces of an unknown character."""
        if i >= 0:
            return [i]
        return [byte_ids[b] for b in chr(-i).encode("utf-8", "surrogatepass")] if byte_ids else [unk]

    def long_ids(unit: str) -> list[int]:
        return [j for i in segment(unit, scores, longest, unknown) for j in known(i)]

    spark = docs.sparkSession
    chars = scan.agg(F.sum(F.char_length("text"))).first()[0] or 0
    scan = _few_files(scan, max(spark.sparkContext.defaultParallelism, -(-chars // BLOCK_CHARS)))
    buckets = max(SPREAD * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-chars // BUCKET_CHARS))
    listed = scan.mapInArrow(lambda x: _blocks(x, cut, True, long_ids, buckets), "bucket int, units string")
    listed = listed.repartition(buckets, "bucket")
    # grouping by (unit, bucket) keeps the layout by bucket; the unit is first, so that sorting seldom compares whole keys
    units = listed.select("bucket", F.expr("explode(slice(split(units, ' '), 2, 2147483647))").alias("unit")).distinct()
    paths = viterbi(lattice(units, pieces, ["unit", "bucket"]), ["unit", "bucket"])

    def look_up(rows: pa.Table, found: pa.Table) -> pa.Table:
        """The paths of each block's units, in the order of its listing."""
        where = {u: i for i, u in enumerate(found["unit"].to_pylist())}
        lists = found["ids"].combine_chunks()
        sizes, flat = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64), lists.flatten().to_numpy(zero_copy_only=False)
        starts, out = np.cumsum(sizes) - sizes, ([], [], [])
        for text in rows["units"]:
            block, *names = text.as_py().split(" ")
            at = np.fromiter((where[u] for u in names), np.int64, len(names))
            n = sizes[at]
            for column, value in zip(out, (int(block), _pack(n.astype(np.int16)), _pack(_gather(flat, starts[at], n))), strict=True):
                column.append(value)
        columns = [pa.array(out[0], pa.int64()), rows["bucket"], pa.array(out[1], pa.binary()), pa.array(out[2], pa.binary())]
        return pa.table(columns, ["block", "bucket", "sizes", "ids"])

    spelled = listed.groupBy("bucket").cogroup(paths.withColumnRenamed("bucket", "part").groupBy("part")).applyInArrow(
        look_up, "block long, bucket int, sizes binary, ids binary"
    )
    numbered = scan.mapInArrow(
        lambda x: _blocks(x, cut, False, long_ids, buckets), f"key {kind}, block long, numbers binary, crc long"
    )

    letters = np.frombuffer(b"".join(surfaces), np.uint8)
    letter_sizes = np.array([len(x) for x in surfaces], np.int64)
    letter_starts = np.cumsum(letter_sizes) - letter_sizes

    def spell(rows: pa.Table, strings: pa.Table) -> pa.Table:
        listing, rows = rows.filter(pc.less(rows["crc"], 0)), rows.filter(pc.greater_equal(rows["crc"], 0))
        strings = strings.sort_by("bucket")
        sizes = np.concatenate([*(_unpack(x.as_py(), np.int16) for x in strings["sizes"]), np.empty(0, np.int16)]).astype(np.int64)
        flat = np.concatenate([*(_unpack(x.as_py(), np.int32) for x in strings["ids"]), np.empty(0, np.int32)])
        if (flat < 0).any():  # unknown characters
            owner = np.repeat(np.arange(len(sizes)), sizes)
            spelled_out = [known(i) for i in flat.tolist()]
            owner = np.repeat(owner, [len(x) for x in spelled_out])
            sizes, flat = np.bincount(owner, minlength=len(sizes)), np.array([i for x in spelled_out for i in x], np.int32)
        place = _unpack(listing["numbers"][0].as_py(), np.uint32).astype(np.int64) if len(listing) else np.empty(0, np.int64)
        starts = np.cumsum(sizes) - sizes
        # ids noted in place of numbers follow the units in the same table
        first = np.concatenate((starts[place], len(flat) + np.arange(len(surfaces))))
        sizes, flat = np.concatenate((sizes[place], np.ones(len(surfaces), np.int64))), np.concatenate((flat, np.arange(len(surfaces), dtype=np.int32)))
        units = len(sizes) - len(surfaces)
        out = []
        for data in rows["numbers"]:
            order = _unpack(data.as_py(), np.uint32).astype(np.int64)
            order = np.where(order >= DIRECT, order - DIRECT + units, order)
            out.append(_gather(flat, first[order], sizes[order]))
        texts = []
        for ids in out:
            parts = np.split(ids, range(PART, len(ids), PART))
            spelled_bytes = b"".join([_gather(letters, letter_starts[x], letter_sizes[x]).tobytes() for x in parts])
            texts.append(spelled_bytes[1:].decode("utf-8", "replace"))
        same = [zlib.crc32(t.encode("utf-8", "surrogatepass")) == c for t, c in zip(texts, rows["crc"].to_pylist(), strict=True)]
        ends = pa.array(np.cumsum([0, *map(len, out)]), pa.int32())
        lists = pa.ListArray.from_arrays(ends, pa.array(np.concatenate([*out, np.empty(0, np.int32)]), pa.int32()))
        return pa.table([rows["key"], lists, pa.array(texts, pa.string()), pa.array(same, pa.bool_())], [key, "ids", "decoded", "lossless"])

    return numbered.groupBy("block").cogroup(spelled.groupBy("block")).applyInArrow(
        spell, f"`{key}` {kind}, ids array<int>, decoded string, lossless boolean"
    )
