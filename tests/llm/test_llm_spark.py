"""The text operators on a small table with awkward rows, against plain Python.

The table has nulls in every column, empty and very long texts, repeated rows, rows equal but for the id, and extra columns whose
names clash with those used inside.
"""

import collections
import hashlib
import math
import os
import random
import re
import zlib

import numpy as np
import pytest

from ringsight.llm import decontaminate, language_model, licenses, ngram_join, pieces, pii, quality, repeats, token_ids
from ringsight.llm.grace_dedup import grace_dedup

public_tokenizers = pytest.importorskip("public_tokenizers")

SCHEMA = "doc_id long, text string, lang string, slot long, rep string, score double, key string, th long, row string, block int"


def rows():
    pick = random.Random(4)
    words = [a + b for a in ("tha", "on", "e", "ré", "ing") for b in ("st", "", "or", "ble", "é")] + ["the"] * 9 + ["of,"] * 5
    text = lambda n: " ".join(pick.choice(words) for _ in range(n))
    texts = [text(pick.randrange(3, 120)) for _ in range(40)]
    shared = text(60)
    texts += [f"{text(10)} {shared} {text(9)}", f"{shared}\n{text(70)}", text(6000), "same " * 400, "", None, "   ", "x", "Same " * 70]
    near = text(100).split()
    for k in range(12):
        own = near.copy()
        own[8 * k] = f"new{k}"
        texts.append(" ".join(own))
    texts += [texts[0], texts[0], texts[1], texts[1].upper(), None, ""]
    texts += ["Write to a.b@c-d.org or +1 (974) 555-3436, 1.2.3.4 and 1.2.3.400.", "card 4785380592391139, 4785380592391138"]
    out = [(k, t, None if k % 3 else "en", k, "r", 0.5, "k", k, "row", 1) for k, t in enumerate(texts)]
    out += [out[2], out[2], (None, texts[0], *[None] * 8), (None, None, *[None] * 8), (None, "x", *[None] * 8)]
    return out


@pytest.fixture(scope="module")
def table():
    return rows()


@pytest.fixture(scope="module")
def docs(spark, table):
    return spark.createDataFrame(table, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def words_of(text):
    return (text or "").encode().lower().split()


@pytest.mark.parametrize("table_bytes", [64 << 20, 4000])
def test_exact_dedup(docs, table, table_bytes):
    decisions, kept = grace_dedup(docs, table_bytes=table_bytes)
    groups = collections.defaultdict(list)
    for r in table:
        groups[r[1] or ""].append(r[0])
    highest = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    want = collections.Counter(
        (r[0], highest[r[1] or ""], len(groups[r[1] or ""]), hashlib.sha256((r[1] or "").encode()).hexdigest()) for r in table
    )
    got = decisions.collect()
    assert collections.Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == want
    assert sum(r["kept"] for r in got) == len(groups) and all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])
    rows_kept = [tuple(r) for r in kept.collect()]
    assert kept.columns == docs.columns and len(rows_kept) == len(groups) and set(rows_kept) <= set(table)


def test_ngram_join(docs, table):
    got = ngram_join.ngram_join(docs).collect()
    sets = []
    for r in table:
        w = words_of(r[1])
        n = min(5, len(w))
        sets.append(frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if w else frozenset())
    linked = [
        [j for j, b in enumerate(sets) if j != i and a and b and len(a & b) >= 0.8 * len(a | b)] for i, a in enumerate(sets)
    ]
    want = collections.Counter((r[0], len(linked[i]), len(sets[i])) for i, r in enumerate(table))
    assert collections.Counter((r["doc_id"], r["n_links"], r["n_grams"]) for r in got) == want
    root = list(range(len(table)))
    for _ in table:
        root = [min([root[i], *(root[j] for j in linked[i])]) for i in range(len(table))]
    assert sum(r["kept"] for r in got) == len(set(root))
    classes = collections.Counter(root)
    assert sorted(r["class_size"] for r in got) == sorted(classes[x] for x in root)


def test_ngram_join_is_the_same_in_blocks(docs, monkeypatch):
    whole = sorted(map(str, ngram_join.ngram_join(docs).drop("kept").collect()))
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", 3)
    assert sorted(map(str, ngram_join.ngram_join(docs).drop("kept").collect())) == whole


def test_repeats(docs, table):
    got = {(r["doc_id"], r["n_words"]): r["spans"] for r in repeats.find_repeats(docs).collect()}
    texts = [tuple(words_of(r[1])) for r in table]
    copies, holders = collections.Counter(texts), collections.defaultdict(set)
    for w in texts:
        for k in range(len(w) - 49):
            holders[w[k : k + 50]].add(w)
    want = {}
    for r, w in zip(table, texts, strict=True):
        starts = [k for k in range(len(w) - 49) if copies[w] > 1 or len(holders[w[k : k + 50]]) > 1]
        if starts:
            want[(r[0], len(w))] = ",".join(f"{a}:{b}" for a, b in repeats._spans(starts, 50))
    assert got == want and len(want) > 5


def test_pii(docs, table):
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }

    def passes(kind, match):
        digits = [int(c) for c in match if c.isdigit()]
        if kind == "ip":
            return all(int(p) <= 255 for p in match.split("."))
        if kind == "card":
            doubled = [(d * 2 - 9 if d > 4 else d * 2) if i % 2 else d for i, d in enumerate(digits[::-1])]
            return 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0
        return kind == "email" or 9 <= len(digits) <= 15

    want = collections.Counter()
    for r in table:
        found = {k: [m.span() for m in re.finditer(p, r[1] or "") if passes(k, m.group())] for k, p in patterns.items()}
        text = ",".join(f"{k}:{a}:{b}" for k in patterns for a, b in found[k])
        want[(r[0], *(len(found[k]) for k in patterns), hashlib.sha256(text.encode()).hexdigest())] += 1
    got = pii.find_pii(docs).collect()
    assert collections.Counter((r["doc_id"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) for r in got) == want


def test_pii_learns_contexts(spark):
    texts = [(k, f"say hello, client address 1.2.{k}.77 is known é") for k in range(12)]
    texts += [(100, "client address 300.2.3.4 is new"), (101, "a version 300.2.3.4 is no address"), (102, None)]
    got = {r["doc_id"]: r for r in pii.find_pii(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got[100]["spans"] == "ip:15:24" and got[100]["n_added"] == 1 and got[100]["n_ip"] == 0
    assert got[101]["n_added"] == got[102]["n_added"] == got[3]["n_added"] == 0 and got[3]["spans"] == "ip:26:34"


def test_pii_finds_unseen_forms(spark):
    """Contexts learnt from the fixed patterns find a form of each kind that no pattern has; other contexts and other shapes stay out."""
    seeds = []
    for k in range(30):
        card = _luhn(f"4{k:02d}500031234")
        seeds += [
            f"call phone number +1 (974) 555-34{k:02d} now", f"please contact user{k}@mail{k % 7}.org today",
            f"host address is 10.0.{k}.7 behind it", f"charged to card {card} at once",
        ]
    amex = _luhn("37828224631000")
    new = {
        "call phone number 974-555-3499 now": "phone", "call phone number (974) 555-3498 now": "phone",
        "please contact jane at mail dot org today": "email", "please contact anna@localhost today": "email",
        "please contact jane (at) mail.org, today": "email", "please contact jim[at]mail[dot]org today": "email",
        "host address is 2001:db8::17 behind it": "ip", f"charged to card {amex[:4]}.{amex[4:10]}.{amex[10:]} at once": "card",
    }
    # no context of the kind, a shape of another use, an instance that holds too little, words without any mark
    clean = [
        "part order 974-555-3497 shipped", "call phone number 2024 now", "we met jane at noon", "charged to card 1234 at once",
        "please contact us today", "version is 2001:db8::18 maybe", "host address is 12 behind it", "please contact sales @ home today",
    ] + [f"it was 2024 in {k}" for k in range(40)]
    texts = [*seeds, *new, *clean, None, ""]
    rows = [(k if k != 3 else None, t, k) for k, t in enumerate(texts)] + [(9, texts[9], 9)]
    got = pii.find_pii(spark.createDataFrame(rows, "doc_id int, text string, row int")).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    at = len(seeds)
    for k, (text, kind) in enumerate(new.items(), at):
        name, start, end = by_id[k]["spans"].split(":")
        assert (name, by_id[k]["n_added"]) == (kind, 1), (text, by_id[k])
        assert int(start) == min(text.index(w) + len(w) for w in ("number ", "contact ", "is ", "card ") if w in text), (text, start)
        assert text[int(end)] in " ,", (text, end)
    # precision of the added spans: all are of `new`, none elsewhere
    assert sum(r["n_added"] for r in got) == len(new)


def _luhn(digits: str) -> str:
    for last in "0123456789":
        doubled = [(int(c) * 2 - 9 if int(c) > 4 else int(c) * 2) if i % 2 else int(c) for i, c in enumerate((digits + last)[::-1])]
        if sum(doubled) % 10 == 0:
            return digits + last


def test_pii_learns_from_what_it_found(spark):
    """A context that is seen with new identifiers only becomes strong in a later round, and finds more."""
    texts = [f"call phone number +1 (974) 555-34{k:02d} now" for k in range(100)]
    texts += [f"call phone number 974-555-35{k:02d} now" for k in range(16)]
    texts += [f"ring me under 974-555-35{k:02d} later" for k in range(16)]
    texts += ["ring me under 974-555-9999 later", "article no 974-555-8888 sold"]
    got = {r["doc_id"]: r for r in pii.find_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [got[k]["n_added"] for k in range(100, 134)] == [1] * 33 + [0] and got[132]["spans"] == "phone:14:26"


def test_pii_places_in_long_texts(spark):
    """Items and base spans side by side, marks around them, one long text."""
    part = "client address 1.2.{}.77 2020 (id 7), 4.4.4.4;foo@x.com\n+1 (743) 555-3824\n9 "
    long = "".join(part.format(k % 250) for k in range(3000))
    got = {r["doc_id"]: r for r in pii.find_pii(spark.createDataFrame([(1, long), (2, "client address 300.2.3.4. End")], "doc_id long, text string")).collect()}
    assert (got[1]["n_ip"], got[1]["n_email"], got[1]["n_phone"]) == (6000, 3000, 3000) and got[1]["n_added"] == 0
    assert got[2]["spans"] == "ip:15:24"


def test_token_files(spark, docs, table, tmp_path, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_ids, "SHARD_IDS", 3000)
    path = str(public_tokenizers.path("word_bpe_49k.json"))
    extra = [(1000, "It's A.B. <|endoftext|>x, don't... Don't, É,é. 12.5,", *[None] * 8)]
    token_ids.write_token_files(docs.union(spark.createDataFrame(extra, SCHEMA)), str(tmp_path / "ids"), path)
    got = token_ids.read_token_files(spark, str(tmp_path / "ids")).collect()
    tokenizer, want = Tokenizer.from_file(path), collections.Counter()
    for r in table + extra:
        ids = [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1]
        want[(r[0], len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))] += 1
    assert collections.Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    ids = [r["doc_id"] if r["doc_id"] is not None else -1 for r in sorted(got, key=lambda r: r["start"])]
    assert ids == sorted(ids)


def test_pieces_match_the_library(docs, table, tmp_path):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        model.ParseFromString(file.read())
    model.trainer_spec.model_type = 1
    for piece in model.pieces:  # the library adds single precision, so no score may dwarf the others
        piece.score = max(piece.score, -50000)
    path = tmp_path / "unigram.model"
    path.write_bytes(model.SerializeToString())
    library = sentencepiece.SentencePieceProcessor(model_file=str(path))
    got = pieces.encode(docs, str(path)).collect()
    assert all(r["lossless"] for r in got)
    want = collections.Counter((r[0], tuple(library.encode(r[1] or "")), r[1] or "") for r in table)
    assert collections.Counter((r["doc_id"], tuple(r["ids"]), r["decoded"]) for r in got) == want


def test_long_units_follow_the_same_rule(spark):
    long, path = "ab" * 400 + "ñ한" * 200, str(public_tokenizers.path("piece_bpe_32k.model"))
    table = pieces.load_pieces(path)
    scores = {n: (s, i) for n, s, i in zip(table.names, table.scores, table.ids, strict=True)}
    short = long[500:560] + "語☃"
    got = {r["doc_id"]: r for r in pieces.encode(spark.createDataFrame([(1, long), (2, short)], "doc_id long, text string"), path).collect()}
    assert got[1]["decoded"] == long and got[2]["decoded"] == short
    starts, ends, _ = table.cutter()(pieces.MARK + short)
    units = [(pieces.MARK + short)[i:j] for i, j in zip(starts, ends, strict=True)]
    ids = [i for u in units for i in pieces.segment(u, scores, table.longest, table.unknown_score)]
    spelled = [j for i in ids for j in ([i] if i >= 0 else [table.byte_ids[b] for b in chr(-i).encode()])]
    assert got[2]["ids"] == spelled


def test_language_model(docs, table):
    got = language_model.score_documents(docs).collect()
    held = [zlib.crc32(b"" if r[0] is None else str(r[0]).encode()) % 7 == 2 for r in table]
    tokens = [[*words_of(r[1]), None] for r in table]
    counts = collections.Counter(w for h, ts in zip(held, tokens, strict=True) if not h for w in ts)
    n, v = sum(counts.values()), len(counts)
    want = collections.Counter()
    for r, h, ts in zip(table, held, tokens, strict=True):
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ts)
        want[(r[0], h, len(ts), sum(counts[w] > 0 for w in ts), n, round(base, 6))] += 1
    found = collections.Counter(
        (r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got
    )
    assert found == want and all(-math.inf < r["score"] < 0 for r in got)


def test_language_model_learns_from_every_training_document(spark, monkeypatch):
    pick, round_, symbols = random.Random(6), language_model._round, []
    after = {a: [pick.randrange(60) for _ in range(3)] for a in range(60)}
    texts = []
    for _ in range(2000):
        words = [pick.randrange(60)]
        while len(words) < 120:
            words.append(pick.choice(after[words[-1]]))
        texts.append(" ".join(f"w{k}" for k in words))

    def kept(rows, *rest):
        symbols.extend(bytes(r[0]) for r in rows.collect())
        return round_(rows, *rest)

    monkeypatch.setattr(language_model, "_round", kept)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    got = language_model.score_documents(rows).collect()
    training = [r for r in got if not r["held_out"]]
    assert len(symbols) == len(training) == sum(zlib.crc32(str(k).encode()) % 7 != 2 for k in range(2000))
    assert sum(len(zlib.decompress(x)) // 2 for x in symbols) == training[0]["train_tokens"]
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_decontamination(spark, docs):
    pick = random.Random(9)
    item = [f"q{pick.randrange(400)}" for _ in range(40)]
    other = item.copy()
    for k in range(3, 40, 7):
        other[k] = "changed"
    texts = [(1, "the of " * 30 + " ".join(item) + ", and. " * 40), (2, " ".join(other)), (3, " ".join(item[:12])), (None, " ".join(item).upper())]
    whole = docs.select("doc_id", "text").union(spark.createDataFrame(texts, "doc_id long, text string"))
    items = spark.createDataFrame([(5, " ".join(item)), (6, ""), (7, None), (None, "entirely different words in this one here")], "item_id long, text string")
    found = decontaminate.find_items(whole, items)
    got = {(r["doc_id"], r["item_id"]) for r in found.collect()}
    assert got == {(1, 5), (2, 5), (None, 5)}
    assert decontaminate.find_items(whole, items.limit(0)).isEmpty() and decontaminate.find_items(whole.limit(0), items).isEmpty()


def test_altered_items_are_found_as_by_brute_force(spark):
    """Recall of the search against the confirmation rule at every place, for items that differ in about every fourth word."""
    pick = random.Random(11)
    vocabulary = [f"v{k}" for k in range(4000)]
    weights = [1 / (k + 3) for k in range(4000)]
    text = lambda n: pick.choices(vocabulary, weights, k=n)
    items = [text(pick.randrange(16, 60)) for _ in range(300)]
    texts, want = [], set()
    for k, item in enumerate(items):
        other = [pick.choices(vocabulary, weights)[0] if pick.random() < 0.25 else w for w in item]
        whole = [*text(150), *other, *text(150)]
        texts.append((k, " ".join(whole)))
        masks = {w: sum(1 << i for i, x in enumerate(item) if x == w) for w in item}
        size = len(item) + max(4, len(item) // 2)
        best = max(decontaminate.common_subsequence(item, masks, whole[a : a + size]) for a in range(len(whole) - size + 1))
        answer = item[-decontaminate.ANSWER :]
        there = any(whole[a : a + len(answer)] == answer for a in range(len(whole)))
        if best >= decontaminate.COVER * len(item) or best >= decontaminate.COVER_ANSWER * len(item) and there:
            want.add((k, k))
    found = decontaminate.find_items(spark.createDataFrame(texts, "doc_id long, text string").repartition(4), spark.createDataFrame([(k, " ".join(i)) for k, i in enumerate(items)], "item_id long, text string"))
    got = {(r["doc_id"], r["item_id"]) for r in found.collect()}
    assert len(want) > 100 and len(got & want) >= 0.99 * len(want), (len(got & want), len(want))


def test_quality(spark, docs):
    junk = [(1000 + k, "BUY!! NOW!! " * (k % 9 + 3)) for k in range(60)]
    good = [(2000 + k, f"the thing {k} of others is, as it was, there and on") for k in range(60)]
    whole = docs.select("doc_id", "text").union(spark.createDataFrame(junk + good, "doc_id long, text string"))
    labels = spark.createDataFrame([(i, int(i >= 2000), None) for i, _ in junk + good] + [(None, 1, 0), (1000, None, 1), (5, 7, 0)], "doc_id long, quality int, toxic int")
    scored = quality.with_scores(whole, quality.train(whole, labels)).collect()
    assert len(scored) == whole.count() and all(0 <= r["score"] <= 1 for r in scored)
    assert all((r["score"] >= quality.CUT) == (r["doc_id"] >= 2000) for r in scored if (r["doc_id"] or 0) >= 1000)
    none = quality.train(whole, labels.limit(0))
    assert all(r["score"] >= quality.CUT for r in quality.with_scores(docs, none).collect())


def test_quality_labels_that_conflict(spark):
    """Repeated equal labels count once, an id with both classes is left out, and empty tables give the neutral ranker."""
    texts = [(k, "BUY!! NOW!! " * (k % 9 + 3) if k % 2 else f"the thing {k} of others is, as it was, there and on") for k in range(80)]
    whole = spark.createDataFrame(texts, "doc_id long, text string")
    schema = "doc_id long, quality int"
    plain = spark.createDataFrame([(k, 1 - k % 2) for k in range(10, 80)], schema)
    mixed = plain.union(plain.limit(20)).union(spark.createDataFrame([(k, v) for k in range(10) for v in (0, 1)], schema))
    want, got = quality.train(whole, plain), quality.train(whole, mixed.repartition(7))
    assert np.allclose(want.weights, got.weights) and abs(want.threshold - got.threshold) < 1e-9 and np.abs(want.weights).max() > 0
    nothing = whole.limit(0)
    none = quality.train(nothing, plain)
    assert not none.weights.any() and quality.with_scores(nothing, none).isEmpty()


def test_plain_words_go_to_the_model_alone():
    """Words of ASCII and Latin letters skip the tokenizer's search for units, with the ids that the whole tokenizer gives."""
    encode = token_ids.RunEncoder(str(public_tokenizers.path("word_bpe_49k.json")))
    rng = random.Random(5)
    letters = [c for c in map(chr, range(0x41, 0x250)) if c.isalpha()]
    words = ["".join(rng.choices(letters, k=rng.randrange(1, 9))) + rng.choice(["", ".", ",", "&", "'s", "\u0301", "7"]) for _ in range(4000)]
    words += [c for c in letters] + ["İ", "ŉ", "ſ", "Straße.", "naïve,", "don't", "日本", "e\u0301", ".", ",", ""]
    for word in words:
        assert encode.encode(word).tolist() == encode.tokenizer.encode(word, add_special_tokens=False).ids, word
    given, batch = [], encode.tokenizer
    encode.tokenizer = type("Seen", (), {"encode_batch_fast": lambda _, part, **more: given.extend(part) or batch.encode_batch_fast(part, **more)})()
    encode.encode("Grüße élève, thing zwölf. x7")
    assert given == ["x7"]


def test_quality_shuffles_no_text(spark, monkeypatch):
    """Features are made before documents meet their labels, so texts stay where they are read."""
    texts = spark.createDataFrame([(k, f"text {k}") for k in range(20)], "doc_id long, text string")
    plans, write = [], quality.materialize
    monkeypatch.setattr(quality, "materialize", lambda df, label: plans.append(df._jdf.queryExecution().simpleString()) or write(df, label))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        quality.train(texts, spark.createDataFrame([(k, k % 2) for k in range(20)], "doc_id long, quality int"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert plans[0].index("Exchange") < plans[0].index("ArrowEvalPython")


def test_index_sums_few_matrices(spark, monkeypatch):
    """However many tasks read the documents, few of them send a matrix for the index."""
    texts = spark.createDataFrame([(k, f"a text with number {k}") for k in range(60)], "doc_id long, text string").repartition(60)
    sent, add = [], decontaminate.sum_arrays
    monkeypatch.setattr(decontaminate, "sum_arrays", lambda parts, dtype, **fan: sent.append(parts.count()) or add(parts, dtype, **fan))
    found = decontaminate.find_items(texts, texts.where("doc_id = 3").withColumnRenamed("doc_id", "item_id"))
    assert (3, 3) in {(r["doc_id"], r["item_id"]) for r in found.collect()}
    assert len(sent) > 1 and max(sent[1:]) <= decontaminate.FIT_TASKS


def test_index_is_fitted_on_all_documents(spark, monkeypatch):
    """No sample: the rows that the index multiplies hold every word of 400 documents and of the items."""
    texts = spark.createDataFrame([(k, f"text number {k} of many " * (k % 7 + 1)) for k in range(400)], "doc_id long, text string")
    items = texts.where("doc_id in (3, 9)").withColumnRenamed("doc_id", "item_id")
    fitted, words, basis = [], lambda t: sum(len(r[0]) // 2 for r in t.collect()), decontaminate.latent_basis
    monkeypatch.setattr(decontaminate, "latent_basis", lambda rows, a, own, *rest: fitted.append((words(rows), words(own))) or basis(rows, a, own, *rest))
    found = decontaminate.find_items(texts, items)
    assert fitted == [(sum(5 * (k % 7 + 1) for k in range(400)), 5 * (3 % 7 + 1) + 5 * (9 % 7 + 1))]
    assert {(3, 3), (9, 9)} <= {(r["doc_id"], r["item_id"]) for r in found.collect()}


def test_licenses(spark, docs):
    texts = [
        (1, "hello\nReleased under the MIT License.\nYou need a driver license here"),
        (2, "This program is free software: you can redistribute it under the terms of the GNU General Public License"),
        (3, "Copyright of the song was sold, and the license of the bar expired"),
        (4, None),
        (None, "LICENSED UNDER THE APACHE LICENSE, VERSION 2.0"),
    ]
    whole = docs.select("doc_id", "text").union(spark.createDataFrame(texts, "doc_id long, text string"))
    got = {(r["doc_id"], r["paragraph"], r["family"]) for r in licenses.scan_licenses(whole).collect()}
    assert got == {(1, 1, "mit"), (2, 0, "gpl"), (None, 0, "apache")}


def test_every_notice_and_other_wordings(spark, docs):
    """Each notice as it is, lines of notices without the usual keywords, and wordings that are not among the notices."""
    own = [(family, text) for family, texts in licenses.NOTICES.items() for text in texts]
    other = [
        ("mpl", "Note: if a copy of the MPL was not distributed with this file, you can obtain one from us at mozilla.org/MPL/2.0."),
        ("gpl", "This program is free software, you can redistribute it and modify it as you like"),
        ("gpl", "it under the terms of the GNU General Public"),
        ("mit", "to any person obtaining a copy of this software and associated documentation files"),
        ("bsd", "source and binary forms, with or without modification, are permitted provided that"),
        ("cc", "This picture is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ]
    texts = [(k, text) for k, (_, text) in enumerate(own + other)] + [(900 + k, text) for k, text in enumerate(licenses.DECOYS)]
    whole = docs.select("doc_id", "text").where("doc_id is null or doc_id > 10000").union(spark.createDataFrame(texts, "doc_id long, text string"))
    found = licenses.scan_licenses(whole).where("doc_id is not null").collect()
    assert {(r["doc_id"], r["family"]) for r in found} == {(k, family) for k, (family, _) in enumerate(own + other)}


def test_empty_tables(spark, nothing, tmp_path):
    decisions, kept = grace_dedup(nothing)
    assert decisions.isEmpty() and kept.isEmpty() and kept.columns == nothing.columns
    assert ngram_join.ngram_join(nothing).isEmpty() and repeats.find_repeats(nothing).isEmpty() and pii.find_pii(nothing).isEmpty()
    assert language_model.score_documents(nothing).isEmpty() and licenses.scan_licenses(nothing).isEmpty()
    assert pieces.encode(nothing, str(public_tokenizers.path("piece_bpe_32k.model"))).isEmpty()
    token_ids.write_token_files(nothing, str(tmp_path / "none"), str(public_tokenizers.path("word_bpe_49k.json")))
    assert token_ids.read_token_files(spark, str(tmp_path / "none")).isEmpty()


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="driver tables not found")
def test_pipeline(spark):
    import corpus_pipeline

    sf_dir = "/root/testdata/sf0.001"
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [k for k, _ in corpus_pipeline.STAGES] and corpus_pipeline.ORACLE_SQL is None
    found = corpus_pipeline.run(spark, sf_dir).collect()
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    assert all(texts[r["doc_id"]] == r["text"] and r["lossless"] for r in found)
    assert len({r["text"] for r in found}) == len(found) > 0.5 * len(texts)
    items = [r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert not any(i in r["text"] for i in items for r in found)
