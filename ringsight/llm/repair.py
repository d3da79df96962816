"""Conversation repair at least cost: rank-convergence parallel Viterbi over chunks of conversations.

A conversation is read by four states (nothing yet, after system, after user, after assistant). Edits lead from state to state; the
cheapest edits that leave roles in the order `(s?(ua)+)?` are wanted, and of those the list whose initials are least in ASCII.

1. All rows are sorted by (conversation, turn, role, text). Each partition of the sorted table cuts its rows into chunks of at most
   `CHUNK_ROWS` rows of one conversation, so a conversation that holds a third of all rows is many chunks in many tasks. One line
   per partition reaches the driver, to number the chunks and to see which conversations cross a border.
2. A conversation of one chunk (nearly all) is solved where it is. The rest goes on with the chunks of long conversations only.
3. Rows seen in an earlier chunk are found by one grouping on hashes of conversation, role and text (the least place of each).
4. Backward costs: every chunk starts from a speculative cost vector at its end; the last one knows the true vector. Fix-up passes
   hand each chunk the vector that the chunk after it found, and rerun those whose vector differs by more than a constant, until
   none does. Chunks of rows that must all go change no difference and are skipped by the links.
5. Differences are all that tracing needs. Each chunk traces from each of the four states; a forward pass of the same kind stitches
   the states together, starting with every chunk's best guess.
6. Audit strings and repaired rows are written per chunk. The hash of a long conversation is one sequential sum by its nature: one
   task streams its chunks in order and holds one of them at a time.

Defined cases: null roles and texts count as one space; null conversation ids are one conversation; null turns come first. Rows of one
turn are ordered by role, then text; equal rows are interchangeable. A row's first fault counts: blank, duplicate, truncated. An
empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringsight.session import materialize

CHUNK_ROWS = 1024
CHUNK_CHARS = 1 << 20
_SPACE = " \t\n\v\f\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
#: the state that an inserted or reroled row leads to
_NEXT = (USER, USER, ASSISTANT, USER)
_NAMES = {USER: "user", ASSISTANT: "assistant"}
#: cost vector behind the last row
END = (0, 2 * INSERT, INSERT, 0)
#: code of a row: 0 must go; else 1 + initial (0 other, 1 s, 2 u, 3 a), plus 4 if truncated
_INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
_COUNTS = ("blank", "duplicate", "truncated", "illegal", "cost")


class Repair(NamedTuple):
    summary: DataFrame
    rows: DataFrame


def _closed(d0: int, d1: int, d2: int, d3: int) -> tuple[int, int, int, int]:
    """Costs with rows inserted at this place."""
    user, assistant = min(d2, d3 + INSERT), min(d3, d2 + INSERT)
    return min(d0, user + INSERT), min(d1, user + INSERT), user, assistant


def backward(codes: bytes, end: tuple[int, ...]) -> list[tuple[int, int, int, int]]:
    """The costs of the rest from every state, before each row and behind the last one."""
    out = [tuple(end)]
    for code in reversed(codes):
        a = out[-1]
        d = [x + DELETE for x in a]
        if code:
            code -= 1
            more, kind = TRUNCATED * (code >> 2), code & 3
            user, assistant = a[USER] + more, a[ASSISTANT] + more
            into = user + (KEEP if kind == USER else REROLE)
            d[SYSTEM], d[ASSISTANT] = min(d[SYSTEM], into), min(d[ASSISTANT], into)
            d[START] = min(d[START], into, a[SYSTEM] + more if kind == SYSTEM else into)
            d[USER] = min(d[USER], assistant + (KEEP if kind == ASSISTANT else REROLE))
        out.append(_closed(*d))
    out.reverse()
    return out


def differences(vector: tuple[int, ...]) -> list[int]:
    """A cost vector without its constant."""
    least = min(vector)
    return [x - least for x in vector]


def trace(codes: bytes, costs: list[tuple[int, ...]], state: int) -> tuple[int, str]:
    """(state behind the last row, initials of the least cheapest edits) from a state; rows are inserted before rows only."""
    out = []
    for i, code in enumerate(codes):
        here, after = costs[i], costs[i + 1]
        while True:
            if after[state] + DELETE == here[state]:
                out.append("D")
                break
            if here[_NEXT[state]] + INSERT == here[state]:
                out.append("I")
                state = _NEXT[state]
                continue
            kind = code - 1 & 3
            kept = SYSTEM if kind == SYSTEM and state == START else _NEXT[state] if kind == _NEXT[state] else None
            if kept is not None and after[kept] + KEEP + TRUNCATED * (code - 1 >> 2) == here[state]:
                out.append("K")
                state = kept
            else:
                out.append("R")
                state = _NEXT[state]
            break
    return state, "".join(out)


def ending(state: int) -> str:
    """The rows to insert behind the last row."""
    return "II" if state == SYSTEM else "I" if state == USER else ""


def edited(roles: list[str], texts: list[str], audit: str, state: int) -> tuple[list[str], list[str]]:
    """The rows that the edits leave, from a state."""
    kept, bodies, i = [], [], 0
    for edit in audit:
        if edit == "I":
            state = _NEXT[state]
            kept.append(_NAMES[state])
            bodies.append("")
            continue
        if edit == "K":
            state = _INITIALS[roles[i][:1]]
            kept.append(roles[i])
            bodies.append(texts[i])
        elif edit == "R":
            state = _NEXT[state]
            kept.append(_NAMES[state])
            bodies.append(texts[i])
        i += 1
    return kept, bodies


def price(codes: bytes, audit: str) -> int:
    total, i = 0, 0
    for edit in audit:
        total += {"I": INSERT, "D": DELETE, "R": REROLE, "K": KEEP}[edit]
        if edit != "I":
            total += TRUNCATED * (edit != "D" and codes[i] > 4)
            i += 1
    return total


def classify(roles: list[str], texts: list[str], known: list[int] | None) -> tuple[bytes, list[int]]:
    """(a code for every row, counts of blank, duplicate, truncated, illegal); known: places seen in earlier chunks."""
    codes, counts, seen, earlier, last = bytearray(), [0, 0, 0, 0], set(known or ()), set(), None
    for i, (role, text) in enumerate(zip(roles, texts, strict=True)):
        body, initial = text.rstrip(_SPACE), role[:1]
        code = 0
        if not body:
            counts[0] += 1
        elif i in seen or (role, text) in earlier:
            counts[1] += 1
        else:
            short = body[-1] not in ".!?"
            counts[2] += short
            code = 1 + _INITIALS.get(initial, 0) + 4 * short
        earlier.add((role, text))
        if last is not None and last + initial not in ("su", "ua", "au"):
            counts[3] += 1
        last = initial
        codes.append(code)
    return bytes(codes), counts


def _chunks(rows: DataFrame, chunk_rows: int) -> DataFrame:
    """One row per chunk: no, conv, starts, ends (of its conversation), turns, roles, texts, h1, h2 of its rows in order."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    order = ["conv", "turn", "role", "text", "salt"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, held, chars, fresh = TaskContext.get().partitionId(), 0, [], 0, True
        kind = None

        def packed(ends: bool) -> pa.RecordBatch:
            conv = held[0][0]
            lists = [pa.array([[r[k] for r in held]], pa.list_(t)) for k, t in ((1, kind[1]), (2, pa.string()), (3, pa.string()), (4, pa.int64()), (5, pa.int64()))]
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int64()), pa.array([conv], kind[0]), pa.array([fresh]), pa.array([ends]), *lists],
                ["part", "seq", "conv", "starts", "ends", "turns", "roles", "texts", "h1", "h2"],
            )

        for batch in batches:
            kind = [c.type for c in batch.columns]
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and (row[0] != held[0][0] or len(held) >= chunk_rows or chars > CHUNK_CHARS):
                    new = row[0] != held[0][0]
                    yield packed(new)
                    seq, held, chars, fresh = seq + 1, [], 0, new
                held.append(row)
                chars += len(row[3])
        if held:
            yield packed(True)

    laid = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "turn", "role", "text", "h1", "h2")
    lists = f"turns array<{kinds['turn']}>, roles array<string>, texts array<string>, h1 array<long>, h2 array<long>"
    chunks = materialize(laid.mapInArrow(cut, f"part int, seq long, conv {kinds['conv']}, starts boolean, ends boolean, {lists}"), "repair-chunks")
    borders = chunks.groupBy("part").agg(
        F.min_by(F.struct("conv"), "seq").alias("first"), F.max_by(F.struct("conv"), "seq").alias("last"), F.count("*").alias("n")
    ).orderBy("part").collect()
    known, before = [], 0
    for k, x in enumerate(borders):
        goes_on = k + 1 < len(borders) and borders[k + 1]["first"] == x["last"]
        known.append((x["part"], before, x["n"], k > 0 and borders[k - 1]["last"] == x["first"], goes_on))
        before += x["n"]
    table = F.broadcast(chunks.sparkSession.createDataFrame(known, "part int, off long, n long, comes boolean, goes boolean"))  # a row per partition
    return chunks.join(table, "part").select(
        (F.col("seq") + F.col("off")).alias("no"), "conv",
        (F.col("starts") & ~((F.col("seq") == 0) & F.col("comes"))).alias("starts"),
        (F.col("ends") & ~((F.col("seq") == F.col("n") - 1) & F.col("goes"))).alias("ends"),
        "turns", "roles", "texts", "h1", "h2",
    )


def _mapped(df: DataFrame, made: Callable[..., list], kinds: str) -> DataFrame:
    """A row for each row, made from its values; made: the columns' values to those of `kinds`."""
    names = [x.strip().split(" ")[0] for x in kinds.split(", ")]
    schema = df.sparkSession.createDataFrame([], kinds).schema
    from pyspark.sql.pandas.types import to_arrow_type

    types = [to_arrow_type(f.dataType) for f in schema]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [made(*row) for row in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names)

    return df.mapInArrow(apply, schema)


def _joined(roles: str, texts: str) -> Column:
    return F.array_join(F.zip_with(roles, texts, lambda r, t: F.concat(r, F.lit(":"), t)), "\n")


def _short(chunks: DataFrame, conv: str) -> DataFrame:
    """Conversations of one chunk."""

    def solve(key: object, turns: list, roles: list[str], texts: list[str]) -> list:
        codes, counts = classify(roles, texts, None)
        state, audit = trace(codes, backward(codes, END), START)
        audit += ending(state)
        there = [t for t in turns if t is not None]
        gaps = max(there) - min(there) + 1 - len(set(there)) if there else 0
        return [key, gaps, *counts, price(codes, audit), audit, *edited(roles, texts, audit, START)]

    kinds = f"conv {conv}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, roles array<string>, texts array<string>"
    return _mapped(chunks.select("conv", "turns", "roles", "texts"), solve, kinds)


def _linked(heads: DataFrame) -> DataFrame:
    """Chunks that hold rows which may stay, with the numbers of such chunks around them in the conversation (or null).

    The window carries numbers only: one row per chunk of a long conversation.
    """
    live = F.when(F.col("live"), F.col("no"))
    before = Window.partitionBy("conv").orderBy("no").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("conv").orderBy(F.desc("no")).rowsBetween(Window.unboundedPreceding, -1)
    linked = heads.select("no", "live", F.max(live).over(before).alias("prev"), F.min(live).over(after).alias("next"))
    return linked.where("live").drop("live")


def _end_vectors(live: DataFrame) -> DataFrame:
    """(no, used): the costs behind each chunk, up to a constant; live: no, next, codes."""

    def run(no: int, used: list[int], codes: bytes) -> list:
        return [no, used, differences(backward(codes, tuple(used))[0])]

    kinds = "no long, used array<long>, found array<long>"
    end = F.array(*[F.lit(x).cast("long") for x in END])
    state = materialize(_mapped(live.select("no", end.alias("used"), "codes"), run, kinds), "repair-vectors")
    while True:
        handed = live.join(state, "no").join(state.select(F.col("no").alias("next"), F.col("found").alias("handed")), "next")
        wrong = materialize(handed.where("used != handed").select("no", F.col("handed").alias("used"), "codes"), "repair-wrong")
        if wrong.isEmpty():
            return state.select("no", "used")
        state = materialize(state.join(wrong.select("no"), "no", "left_anti").unionByName(_mapped(wrong, run, kinds)), "repair-vectors")


def _entered(live: DataFrame) -> DataFrame:
    """(no, enter, leave): the states before and behind each chunk; live: no, prev, codes, used."""

    def exits(no: int, prev: int | None, codes: bytes, used: list[int]) -> list:
        costs = backward(codes, tuple(used))
        return [no, prev, [trace(codes, costs, s)[0] for s in range(4)]]

    maps = materialize(_mapped(live.select("no", "prev", "codes", "used"), exits, "no long, prev long, exits array<int>"), "repair-exits")
    leave = lambda enter: F.element_at("exits", enter + 1)
    guess = F.when(F.col("prev").isNull(), F.lit(START)).otherwise(F.lit(ASSISTANT))
    state = materialize(maps.withColumn("enter", guess).withColumn("leave", leave(F.col("enter"))), "repair-states")
    while True:
        handed = state.select(F.col("no").alias("prev"), F.col("leave").alias("handed"))
        both = state.join(handed, "prev", "left").withColumn("real", F.when(F.col("prev").isNull(), F.lit(START)).otherwise(F.col("handed")))
        if both.where("enter != real").isEmpty():
            return state.select("no", "enter", "leave")
        state = materialize(both.select("no", "prev", "exits", F.col("real").alias("enter"), leave(F.col("real")).alias("leave")), "repair-states")


def _long(chunks: DataFrame, conv: str) -> tuple[DataFrame, DataFrame]:
    """(summary, pieces) of conversations of several chunks."""
    light = chunks.select("no", F.explode(F.arrays_zip("h1", "h2", F.sequence(F.lit(0), F.size("h1") - 1).alias("i"))).alias("r")).select("no", "r.h1", "r.h2", "r.i")
    place = F.struct("no", "i")
    first = light.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    again = light.join(first, ["h1", "h2"]).where(place > F.col("first")).groupBy("no").agg(F.collect_list("i").alias("known"))

    def sort(no: int, key: object, starts: bool, ends: bool, roles: list[str], texts: list[str], known: list[int] | None) -> list:
        codes, counts = classify(roles, texts, known)
        return [no, key, starts, ends, codes, any(codes), *counts, roles[0][:1], roles[-1][:1]]

    named = chunks.select("no", "conv", "starts", "ends", "roles", "texts").join(again, "no", "left")
    kinds = f"no long, conv {conv}, starts boolean, ends boolean, codes binary, live boolean, blank long, duplicate long, truncated long, illegal long, opens string, closes string"
    heads = materialize(_mapped(named, sort, kinds), "repair-heads")

    live = materialize(_linked(heads).join(heads.select("no", "codes"), "no"), "repair-live")
    vectors = _end_vectors(live.select("no", "next", "codes"))
    states = _entered(live.join(vectors, "no"))

    def write(no: int, key: object, roles: list[str], texts: list[str], codes: bytes, used: list[int] | None, enter: int | None) -> list:
        enter = START if enter is None else enter  # without rows that may stay the state passes through unseen
        audit = "D" * len(codes) if used is None else trace(codes, backward(codes, tuple(used)), enter)[1]
        return [no, key, price(codes, audit), audit, *edited(roles, texts, audit, enter)]

    kinds = f"no long, conv {conv}, cost long, audit string, roles array<string>, texts array<string>"
    full = chunks.select("no", "conv", "roles", "texts").join(heads.select("no", "codes"), "no").join(vectors.join(states.drop("leave"), "no"), "no", "left")
    pieces = _mapped(full, write, kinds)
    # behind the last chunk: what the last state still lacks
    left = states.join(heads.select("no", "conv"), "no").groupBy("conv").agg(F.max_by("leave", "no").alias("state"))
    rest = {s: ending(s) for s in range(4)}
    pick = lambda of, kind: F.element_at(F.array(*[F.lit(of(s)).cast(kind) if not isinstance(of(s), list) else F.array(*map(F.lit, of(s))).cast(kind) for s in range(4)]), F.col("state") + 1)  # noqa: E731, E501
    tails = left.select(
        F.lit(None).cast("long").alias("no"), "conv", pick(lambda s: INSERT * len(rest[s]), "long").alias("cost"), pick(lambda s: rest[s], "string").alias("audit"),
        pick(lambda s: edited([], [], rest[s], s)[0], "array<string>").alias("roles"), pick(lambda s: edited([], [], rest[s], s)[1], "array<string>").alias("texts"),
    )
    pieces = materialize(pieces.unionByName(tails), "repair-pieces")

    edges = heads.where("not starts").select("no", "conv", "opens").join(heads.select((F.col("no") + 1).alias("no"), "closes"), "no")
    crossed = edges.where(~F.concat("closes", "opens").isin("su", "ua", "au")).groupBy("conv").agg(F.count("*").alias("crossed"))
    turns = chunks.select("conv", F.explode("turns").alias("turn")).groupBy("conv").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps")
    )
    counts = heads.groupBy("conv").agg(*[F.sum(c).alias(c) for c in _COUNTS[:4]])
    last = F.coalesce("no", F.lit((1 << 63) - 1))
    told = pieces.groupBy("conv").agg(
        F.sum("cost").alias("cost"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(last.alias("no"), "audit"))), lambda x: x["audit"]), "").alias("audit")
    )

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The pieces of each conversation, in order, into one hash."""
        key, total, begun = None, None, False
        for batch in batches:
            out = ([], [])
            for conv_, _, text, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if total is None or conv_ != key:
                    if total is not None:
                        out[0].append(key)
                        out[1].append(total.hexdigest())
                    key, total, begun = conv_, sha256(), False
                if size:
                    total.update(("\n" + text if begun else text).encode("utf-8", "surrogatepass"))
                    begun = True
            yield pa.RecordBatch.from_arrays([pa.array(out[0], batch.column(0).type), pa.array(out[1], pa.string())], ["conv", "repaired_sha256"])
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], batch.column(0).type), pa.array([total.hexdigest()])], ["conv", "repaired_sha256"])

    strings = pieces.select("conv", last.alias("no"), _joined("roles", "texts").alias("text"), F.size("roles").alias("size"))
    hashes = strings.repartition("conv").sortWithinPartitions("conv", "no").mapInArrow(stream, f"conv {conv}, repaired_sha256 string")
    summary = counts.withColumnRenamed("conv", "c")
    for other in (crossed, turns, told, hashes):
        renamed = other.withColumnRenamed("conv", "c2")
        summary = summary.join(renamed, F.col("c").eqNullSafe(F.col("c2")), "left").drop("c2")
    return summary.select(
        F.col("c").alias("conv"), F.coalesce("gaps", F.lit(0)).cast("long").alias("gaps"), "blank", "duplicate", "truncated",
        (F.col("illegal") + F.coalesce("crossed", F.lit(0))).alias("illegal"), "cost", "audit", "repaired_sha256",
    ), pieces


def repair_conversations(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", chunk_rows: int = CHUNK_ROWS
) -> Repair:
    """summary: (conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) per conversation.

    rows: the repaired rows (conv, place, role, text), places ascending within a conversation.
    """
    kind = rows.schema[conv].dataType.simpleString()
    named = rows.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(role, F.lit(" ")).alias("role"), F.coalesce(text, F.lit(" ")).alias("text")
    )
    known = F.struct(F.col("conv").isNull(), F.col("conv"), F.col("role"), F.col("text"))
    hashed = named.withColumns(
        {"h1": F.xxhash64(known), "h2": F.xxhash64(F.lit(7), known), "salt": F.monotonically_increasing_id()}
    )
    chunks = _chunks(hashed, chunk_rows)
    one = F.col("starts") & F.col("ends")
    short = materialize(_short(chunks.where(one), kind), "repair-short")
    summary = short.withColumn("repaired_sha256", F.sha2(_joined("roles", "texts"), 256)).drop("roles", "texts")
    pieces = short.select("conv", F.lit(0).cast("long").alias("no"), "roles", "texts")
    rest = chunks.where(~one)
    if not rest.isEmpty():
        told, written = _long(rest, kind)
        summary = summary.unionByName(told)
        pieces = pieces.unionByName(written.select("conv", F.coalesce("no", F.lit((1 << 43) - 1)).alias("no"), "roles", "texts"))
    each = pieces.select("conv", "no", F.posexplode(F.arrays_zip("roles", "texts")).alias("i", "r"))
    fixed = each.select("conv", (F.col("no") * (1 << 20) + F.col("i")).alias("place"), F.col("r.roles").alias("role"), F.col("r.texts").alias("text"))
    return Repair(summary.withColumnRenamed("conv", conv), fixed.withColumnRenamed("conv", conv))


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows with faults planted by crc32 of `conv:turn`: dropped, emptied, without stops, repeated, or given to the user."""
    known = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.pmod(F.crc32(F.concat(known(conv), F.lit(":"), known(turn)).cast("binary")), F.lit(20))
    body, who = known(text), known(role)
    return rows.select(
        F.col(conv), F.col(turn),
        F.when(fault == 4, F.lit("user")).otherwise(who).alias(role),
        F.when(fault == 1, F.lit("")).when(fault == 2, F.regexp_replace(body, "[.!?]", "")).otherwise(body).alias(text),
        F.explode(F.when(fault == 0, F.array().cast("array<int>")).when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("__copy"),
    ).drop("__copy")
