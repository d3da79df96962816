"""Conversation repair, repeated windows and the Merkle manifest, against plain Python on small awkward tables."""

import collections
import hashlib
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ringsight.llm import merkle, repair, windows

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, block long, th string, salt string, part int"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def texts():
    pick = random.Random(11)
    words = ["on", "the", "The", "ré", "ing", "of,", "st", "ble."]
    text = lambda n: " ".join(pick.choice(words) + str(pick.randrange(40)) for _ in range(n))
    shared = text(30)
    out = [text(pick.randrange(1, 60)) for _ in range(25)]
    out += [f"{text(9)} {shared}\t{text(4)}", f"{shared}\n\n{text(50)}", shared, f"{text(3)} {shared}", text(5000), "same " * 300]
    out += ["", None, "  \t ", "x", " ".join(shared.split()[:19]), out[0], out[0], f"{shared} {shared}", shared.upper(), "a b c " * 12]
    return out


@pytest.fixture(scope="module")
def table():
    pick = random.Random(3)
    rows = [(k, t, pick.choice(["en", "fr", None, "é", "zz"]), pick.choice(["web", None]), pick.choice([None, k]), "k", 1, "t", "s", 0) for k, t in enumerate(texts())]
    rows += [rows[3], rows[3], rows[27], (None, rows[2][1], *[None] * 8), (None, None, *[None] * 8), (5, "other text", "en", "web", 1, "k", 1, "t", "s", 0)]
    return rows


@pytest.fixture(scope="module")
def docs(spark, table):
    return spark.createDataFrame(table, DOCS).repartition(4)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


# ---- repeated windows


def first_windows(rows):
    """(id, n_words, n_removed, kept) by a walk in order; rows of one id in the order of their texts' hashes."""
    seen, out = set(), []
    for key, text in rows:
        found = WORD.findall((text or "").encode())
        gone = [False] * len(found)
        for i in range(len(found) - 19):
            window = tuple(found[i : i + 20])
            if window in seen:
                gone[i : i + 20] = [True] * 20
            seen.add(window)
        out.append((key, len(found), sum(gone), b" ".join(w for w, g in zip(found, gone, strict=True) if not g).decode()))
    return collections.Counter(out)


@pytest.mark.parametrize("block,bucket", [(1 << 23, 1 << 20), (2000, 300), (1, 10)])
def test_windows(docs, block, bucket):
    ordered = [(r["doc_id"], r["text"]) for r in docs.orderBy("doc_id", F.xxhash64(F.coalesce("text", F.lit("")))).collect()]
    got = windows.remove_repeated_windows(docs, block_bytes=block, bucket_windows=bucket)
    assert got.columns == ["doc_id", "n_words", "n_removed", "spans", "kept"]
    rows = got.collect()
    assert collections.Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in rows) == first_windows(ordered)
    for r in rows:
        spans = [tuple(map(int, s.split(":"))) for s in r["spans"].split(",") if s]
        assert sum(b - a for a, b in spans) == r["n_removed"]
        assert all(b - a >= 20 for a, b in spans) and all(x[1] < y[0] for x, y in zip(spans, spans[1:], strict=False))


def test_windows_by_text_key(spark):
    passage = " ".join(f"w{k}" for k in range(25))
    rows = [("b", passage), ("a", f"x {passage}"), (None, "short"), ("é", passage + " end")]
    got = windows.remove_repeated_windows(spark.createDataFrame(rows, "name string, body string"), "name", "body").collect()
    assert {(r["name"], r["kept"]) for r in got} == {("a", f"x {passage}"), ("b", ""), (None, "short"), ("é", "end")}


def test_intervals():
    import numpy as np

    assert windows.intervals(np.array([1, 1, 0, 1, 0], bool)) == [(0, 2), (3, 4)]
    assert windows.intervals(np.zeros(0, bool)) == []


# ---- manifest


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(row, more=0):
    key, text, lang, source, n_chars = row[:5]
    return sha(*map(field, (key, source, lang, None if n_chars is None else n_chars + more, text)))


def tree(level, fan):
    out = [level]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][i : i + fan]) for i in range(0, len(out[-1]), fan)])
    return out


def manifest(rows, fan):
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r[2]].append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
    trees = {g: tree([leaf_of(r) for r in groups[g]], fan) for g in order}
    top = tree([trees[g][-1][0] for g in order], fan)
    out = []
    for g in order:
        for i, r in enumerate(groups[g]):
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            at, siblings = leaf_of(r, int(changed)), []
            for levels, place in ((trees[g], i), (top, order.index(g))):
                for level in levels[:-1]:
                    run = level[place // fan * fan : place // fan * fan + fan]
                    siblings += run[: place % fan] + run[place % fan + 1 :]
                    run[place % fan] = at
                    at, place = sha(*run), place // fan
            out.append((r[0], leaf_of(r), trees[g][-1][0], top[-1][0], sha(*siblings), at))
    return collections.Counter(out)


@pytest.mark.parametrize("fan,levels", [(2, 10), (2, 1), (2, 2), (3, 2), (128, 1)])
def test_manifest(docs, table, fan, levels):
    picked = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 0
    now = merkle.leaf_digest([F.col(c) + 1 if c == "n_chars" else F.col(c) for c in merkle.FIELDS])
    rows = merkle.merkle_manifest(docs, other=F.when(picked, now), fan=fan, levels=levels).collect()
    names = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root")
    assert collections.Counter(tuple(r[c] for c in names) for r in rows) == manifest(table, fan)
    for r in rows:
        assert merkle.fold(bytes.fromhex(r["leaf"]), bytes(r["path"])).hex() == r["root"]
    # a changed row that had a count does not verify; all others do
    changed = [r for r in rows if r["folded_root"] != r["root"]]
    assert {r["doc_id"] for r in changed} == {r[0] for r in table if r[4] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0}


@pytest.mark.parametrize("n,langs", [(1, 1), (2, 1), (3, 3), (8, 1), (9, 2), (40, 40)])
def test_manifest_of_small_shapes(spark, n, langs):
    rows = [(k, f"t{k}", f"l{k % langs:02d}", "s", k) for k in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = merkle.merkle_manifest(df, levels=2).collect()
    want = {(w[0], *w[1:5]) for w in manifest(rows, 2)}
    assert {(r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"]) for r in got} == want
    assert len(got) == n and all(r["folded_root"] == r["root"] for r in got)


# ---- conversations

SEEN = st.sampled_from(["a.", "b", "", " \t", "c!", "a.", "e ", "f. "])
ROLE = st.sampled_from(["user", "assistant", "system", "tool", "", " "])


def repaired(rows):
    """(blank, duplicate, truncated, illegal, cost, audit, rows) by full strings from the end."""
    seen, kinds, counts = set(), [], [0, 0, 0, 0]
    for role, text in rows:
        found = re.findall(r"[^\x20\x09-\x0D]", text)
        kind = 0 if not found else 1 if (role, text) in seen else 2 if found[-1] not in ".!?" else 3
        if kind < 3:
            counts[kind] += 1
        seen.add((role, text))
        kinds.append(kind)
    counts[3] = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    names = {"u": "user", "a": "assistant"}

    def inserted(best):
        for _ in range(4):
            for s in range(4):
                for c, name in names.items():
                    to = step.get((s, c))
                    if to is not None and best[to] is not None:
                        found = (best[to][0] + 3, "I" + best[to][1], [(name, ""), *best[to][2]])
                        if best[s] is None or found[:2] < best[s][:2]:
                            best[s] = found
        return best

    best = inserted([(0, "", []), None, None, (0, "", [])])
    for (role, text), kind in reversed(list(zip(rows, kinds, strict=True))):
        now = []
        for s in range(4):
            options = [(best[s][0] + 4, "D" + best[s][1], best[s][2])]
            for c, name, letter, price in [(role[:1], role, "K", 0), *((c, n, "R", 3) for c, n in names.items())]:
                to = step.get((s, c))
                if kind > 1 and to is not None:
                    options.append((best[to][0] + price + 3 * (kind == 2), letter + best[to][1], [(name, text), *best[to][2]]))
            now.append(min(options, key=lambda o: o[:2]))
        best = inserted(now)
    return (*counts, *best[0])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(ROLE, SEEN), max_size=9))
def test_cheapest_edits(rows):
    roles, bodies = [r for r, _ in rows], [t for _, t in rows]
    codes, counts = repair.classify(roles, bodies, None)
    state, audit = repair.trace(codes, repair.backward(codes, repair.END), repair.START)
    audit += repair.ending(state)
    *want, cost, least, kept = repaired(rows)
    assert counts == want and (repair.price(codes, audit), audit) == (cost, least)
    assert list(zip(*repair.edited(roles, bodies, audit, repair.START), strict=True)) == kept
    assert re.fullmatch("(s?(ua)+)?", "".join(role[0] for role, _ in kept))


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=12), st.integers(0, 9))
def test_differences_are_enough(codes, more):
    codes = bytes(c % 9 for c in codes)
    one, other = repair.backward(codes, repair.END), repair.backward(codes, tuple(x + more for x in repair.END))
    assert [repair.differences(a) for a in one] == [repair.differences(b) for b in other]
    assert all(repair.trace(codes, one, s) == repair.trace(codes, other, s) for s in range(4))


def conversations():
    pick = random.Random(5)
    rows = []
    for conv in [None, *range(25)]:
        for turn in range(pick.choice([1, 2, 3, 5, 9, 30])):
            role = pick.choice(["user", "assistant", "system", "tool", None, "", "user", "assistant"])
            text = pick.choice(["a.", "b", "", " ", "c!", "e", None, f"{conv}{turn}.", f"{conv}{turn}", f"{conv}-{turn}."])
            rows.append((conv, pick.choice([None, turn, turn, turn, turn + 3]), role, text, "x"))
    # one conversation with a long run that must go, and one that is only such a run
    rows += [(90, k, "user", "again." if 20 < k < 60 else f"{k}.", "x") for k in range(80)]
    rows += [(91, k, "user", " ", "x") for k in range(40)]
    rows += [(92, k, ("user", "assistant")[k % 2], f"{k}", "x") for k in range(50)]
    rows += [(93, k, "system", f"{k}.", "x") for k in range(31)]
    return rows + rows[:3]


@pytest.mark.parametrize("chunk", [1024, 7, 1])
def test_repair(spark, chunk):
    data = conversations()
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string, no string").repartition(5)
    found = repair.repair_conversations(df, chunk_rows=chunk)
    groups = collections.defaultdict(list)
    for conv, turn, role, text, _ in data:
        groups[conv].append((turn, " " if role is None else role, " " if text is None else text))
    want, kept = {}, {}
    for conv, rows in groups.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = [r[0] for r in rows if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        *told, left = repaired([r[1:] for r in rows])
        want[conv] = (gaps, *told, sha("\n".join(f"{r}:{t}" for r, t in left)))
        kept[conv] = left
    got = found.summary.collect()
    assert len(got) == len(want) and {r["conv_id"]: tuple(r)[1:] for r in got} == want
    rows = collections.defaultdict(list)
    for r in sorted(found.rows.collect(), key=lambda r: r["place"]):
        rows[r["conv_id"]].append((r["role"], r["text"]))
    assert all(rows[conv] == left for conv, left in kept.items())


def test_damage(spark):
    data = [(c, t, "assistant", "One. Two? Three!") for c in range(40) for t in range(3)] + [(None, None, None, None)]
    got = repair.damaged(spark.createDataFrame(data, "conv_id long, turn long, role string, text string"))
    want = []
    for conv, turn, role, text in data:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(name.encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        want += [(conv, turn, "user" if fault == 4 else role, text)] * {0: 0, 3: 2}.get(fault, 1)
    assert collections.Counter(map(tuple, got.collect())) == collections.Counter(want)


def test_empty_tables_of_the_new_operators(spark, nothing):
    assert windows.remove_repeated_windows(nothing).collect() == []
    assert merkle.merkle_manifest(nothing).collect() == []
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    found = repair.repair_conversations(empty)
    assert found.summary.collect() == [] and found.rows.collect() == []


def test_scans_are_told_from_shuffled_tables(spark, tmp_path):
    """Blocks are named by the place of a file only where a task reads that place as a whole."""
    from ringsight.llm import language_model, pieces

    pick = random.Random(1)
    rows = [(k, " ".join(pick.choice(["on", "the", "ré", "x y", "ing."]) + str(pick.randrange(9)) for _ in range(pick.randrange(40)))) for k in range(300)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(2).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    ids = docs.select("doc_id").distinct()
    forms = {"plain": docs, "dealt": docs.repartition(7), "sorted": docs.orderBy("text"), "joined": docs.join(ids, "doc_id"), "both": docs.where("doc_id < 100").union(docs.where("doc_id >= 100"))}
    assert [name for name, form in forms.items() if pieces._plain_scan(form)] == ["plain"]
    public_tokenizers = pytest.importorskip("public_tokenizers")
    model = str(public_tokenizers.path("piece_bpe_32k.model"))
    counts = ("doc_id", "n_tokens", "n_known", "train_tokens", "base_score")
    want = None
    for form in forms.values():
        found = sorted((r["doc_id"], list(r["ids"]), r["decoded"]) for r in pieces.encode(form, model).collect())
        told = sorted(tuple(round(r[c], 6) for c in counts) for r in language_model.score_documents(form).select(*counts).collect())
        want = want or (found, told)
        assert (found, told) == want


def test_texts_of_many_small_files_share_blocks(spark, tmp_path):
    import public_tokenizers

    from ringsight.llm import pieces

    model = str(public_tokenizers.path("piece_bpe_32k.model"))
    rows = spark.createDataFrame([(k, f"the same words again and {k % 7} more") for k in range(120)], "doc_id long, text string")
    for files in (1, 40):
        rows.repartition(files).write.parquet(str(tmp_path / str(files)))
    few, many = (pieces.encode(spark.read.parquet(str(tmp_path / x)), model) for x in ("1", "40"))
    found = [sorted((r["doc_id"], list(r["ids"]), r["decoded"], r["lossless"]) for r in x.collect()) for x in (few, many)]
    assert len(found[0]) == 120 and found[0] == found[1]
    assert len(many.inputFiles()) <= 2 * spark.sparkContext.defaultParallelism < 40
