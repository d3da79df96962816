"""The numpy parts of the text operators, without Spark."""

import pickle

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ringsight.llm import decontaminate, gru, ngram_join, pieces, quality, repeats, token_ids
from ringsight.llm.common import shingle_hashes, word_hashes
from ringsight.llm.grace_dedup import ContentTable


def plain_words(text: str) -> list[bytes]:
    return text.encode().lower().split()


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aAbé \n\t,.1", max_size=60))
def test_equal_words_have_equal_hashes(text):
    hashes, words = word_hashes(text), plain_words(text)
    assert len(hashes) == len(words)
    assert len(set(zip(hashes.tolist(), words, strict=True))) == len(set(words)) == len(set(hashes.tolist()))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 70000), st.integers(0, 2**64 - 1), st.just(0)), max_size=9000))
def test_simple8b_round_trip(values):
    values = np.array(values, np.uint64)
    words, offsets, escapes = token_ids.pack(values)
    assert (token_ids.unpack(words, offsets, escapes, len(values)) == values).all()


def test_simple8b_blocks_and_density():
    values = np.random.default_rng(0).integers(0, 2, 3 * token_ids.BLOCK + 7).astype(np.uint64)
    words, offsets, escapes = token_ids.pack(values)
    assert len(offsets) == 5 and len(escapes) == 0
    assert len(words) <= len(values) / 60 + 4 * 2
    assert (token_ids.unpack(words, offsets, escapes, len(values)) == values).all()


def test_shard_round_trip():
    data = token_ids.write_shard([3, None, 9], [2, 0, 3], np.array([5, 1, 7, 2**62, 1], np.uint64))
    ids, lengths, values = token_ids.read_shard(data)
    assert ids == [3, None, 9] and lengths.tolist() == [2, 0, 3] and values.tolist() == [5, 1, 7, 2**62, 1]
    with pytest.raises(ValueError):
        token_ids.read_shard(b"x" * 100)


def test_content_table_compares_contents():
    table = ContentTable(bits=2)
    assert [table.put(7, c, i) for i, c in enumerate([b"a", b"b", b"a", b"c", b"b", b"d", b"e"])] == [0, 1, 0, 3, 1, 5, 6]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.sampled_from("abc"), min_size=60, max_size=160), st.lists(st.sampled_from("abcdefgh"), min_size=60, max_size=160), st.integers(0, 50))
def test_a_shared_passage_shares_its_minimiser(left, right, at):
    """Whatever stands around it, a passage's own minimiser is chosen in both texts and has the same key."""
    passage = ["p%d" % (i * i % 17) for i in range(50)]
    found = []
    for words, place in ((left, at), (right, 0)):
        text = " ".join([*words[:place], *passage, *words[place:]])
        hashes = word_hashes(text)
        places, keys = repeats.suffixes(hashes, 50)
        starts, own = repeats.extended(hashes, places, np.ones(len(places), bool), 50)
        assert place in starts
        found.append(own[list(starts).index(place)])
        assert len(keys) == len(places)
    assert found[0] == found[1]


def test_jaccard_blocks_match_plain_sets():
    random = np.random.default_rng(3)
    base = random.integers(0, 2**63, 60).astype(np.uint64)
    sets = [np.unique(np.concatenate((random.choice(base, 55, replace=False), random.integers(0, 2**63, k % 9).astype(np.uint64)))) for k in range(40)]
    weights = random.integers(1, 4, 40)

    def linked(i, j):
        common = len(np.intersect1d(sets[i], sets[j]))
        return i != j and common / (len(sets[i]) + len(sets[j]) - common) >= 0.8

    links, root = ngram_join.verify(sets, weights, 0, 0.8)
    assert links.tolist() == [sum(weights[j] for j in range(40) if linked(i, j)) for i in range(40)]
    for i in range(40):
        for j in range(40):
            assert not linked(i, j) or root[i] == root[j]
    across, _ = ngram_join.verify(sets, weights, 15, 0.8)
    assert across.tolist() == [sum(weights[j] for j in range(40) if linked(i, j) and (i < 15) != (j < 15)) for i in range(40)]


def test_band_count_reaches_the_recall():
    bands = ngram_join.bands_for(0.8, 5, 0.9999)
    assert 1 - (1 - 0.8**5) ** bands >= 0.9999 > 1 - (1 - 0.8**5) ** (bands - 1)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=25), st.lists(st.integers(0, 5), max_size=30))
def test_bit_parallel_common_subsequence(item, words):
    masks = {w: sum(1 << i for i, x in enumerate(item) if x == w) for w in item}
    table = [[0] * (len(words) + 1) for _ in range(len(item) + 1)]
    for i, a in enumerate(item):
        for j, b in enumerate(words):
            table[i + 1][j + 1] = table[i][j] + 1 if a == b else max(table[i][j + 1], table[i + 1][j])
    assert decontaminate.common_subsequence(item, masks, words) == table[-1][-1]


def test_gradients_match_differences():
    random = np.random.default_rng(2)
    counts, classes = np.array([9.0, 5, 4, 3, 2, 2]), np.array([0, 0, 1, 1, 1, 2])
    model = gru.Gru(counts, classes, hidden=4, flat=random.normal(0, 0.3, gru.Gru(counts, classes, hidden=4).flat.size))
    y = random.integers(0, 6, (5, 3))
    x = np.concatenate((np.full((1, 3), 6), y[:-1]))
    x[3, 1] = 6
    fresh, used = x == 6, np.ones(y.shape, bool)
    h = np.zeros((3, 4))
    seen = []

    class Keep:
        def step(self, flat, slope, share):
            seen.append(slope.copy())

    def loss():
        states, _, _ = model.steps(x, h, fresh, keep=False)
        return -model.output(states[used].astype(np.float64), y[used])[0].sum() / used.sum()

    model.learn(x, y, h, fresh, used, Keep())
    for k in random.choice(model.flat.size, 40, replace=False):
        kept, step = model.flat[k], 1e-3
        model.flat[k] = kept + step
        up = loss()
        model.flat[k] = kept - step
        down = loss()
        model.flat[k] = kept
        assert abs((up - down) / (2 * step) - seen[0][k]) < 2e-3


def test_outputs_are_log_probabilities_for_any_number_of_tokens():
    random = np.random.default_rng(4)
    classes = np.array([0, 0, 0, 1, 1, 2, 3, 3])
    model = gru.Gru(np.full(8, 5.0), classes, hidden=4)
    for n in (0, 1, gru.CHUNK, gru.CHUNK + 3):
        states, y = random.normal(size=(n, 4)), random.integers(0, 8, n)
        rough = states @ model.Wc.T + model.bc
        want = rough[np.arange(n), classes[y]] - np.log(np.exp(rough).sum(axis=1))
        inner = states @ model.Ww.T + model.bw
        own = np.where(classes == classes[y][:, None], np.exp(inner), 0).sum(axis=1)
        assert np.allclose(model.output(states, y)[0], want + inner[np.arange(n), y] - np.log(own), atol=1e-5)


def test_windows_of_training_reuse_their_memory():
    random = np.random.default_rng(5)
    model = gru.Gru(np.full(6, 10.0), np.array([0, 0, 1, 1, 2, 2]))
    adam, h, after = gru.Adam(len(model.flat)), np.zeros((9, model.hidden), np.float32), []
    for size in (32, 32, 7):
        y = random.integers(0, 6, (size, 9))
        x = np.concatenate((np.full((1, 9), 6), y[:-1]))
        after.append(model.learn(x, y, h, x == 6, np.ones(y.shape, bool), adam))
        kept = [a.copy() for a in after]
        rooms = {k: v.ctypes.data for k, v in model.rooms.items()}
    assert all((a == b).all() for a, b in zip(after, kept, strict=True))  # states carried on are no views of it
    model.learn(x, y, h, x == 6, np.ones(y.shape, bool), adam)
    assert rooms and rooms == {k: v.ctypes.data for k, v in model.rooms.items()}


def test_probabilities_add_up_and_windows_carry_the_state():
    counts, classes = np.array([9.0, 5, 4, 3]), np.array([0, 0, 1, 2])
    model = gru.Gru(counts, classes, hidden=4)
    model.start_at_frequencies()
    total = sum(np.exp(gru.score(model, [np.array([a, b])])[0]) for a in range(4) for b in range(4))
    assert abs(total - 1) < 1e-5
    text = np.random.default_rng(1).integers(0, 4, 200)
    assert np.allclose(gru.score(model, [text], window=7), gru.score(model, [text, text[:3]], window=500)[0], rtol=1e-4)


def test_training_beats_the_start():
    counts, classes = np.full(6, 10.0), np.array([0, 0, 1, 1, 2, 2])
    texts = [np.tile([0, 3, 5, 1], 64) for _ in range(900)]
    model = gru.Gru(counts, classes)
    model.start_at_frequencies()
    before = gru.score(model, texts[:1])[0]
    assert gru.train(model, texts, pool=1 << 15) == 900 * 256
    assert gru.score(model, texts[:1])[0] > before * 0.9


def test_training_carries_long_documents(monkeypatch):
    """Only the first symbol of a document is fresh, inputs are the symbols before, and pieces follow in the lane of their document."""
    random = np.random.default_rng(4)
    texts = [random.integers(0, 6, n) for n in (9000, 2000, 700, 513, 40, 1, *random.integers(1, 900, 300))]
    model, tapes, starts, before = gru.Gru(np.full(6, 10.0), np.array([0, 0, 1, 1, 2, 2])), [], 0, []

    def learn(self, x, y, h, fresh, used, adam):
        nonlocal starts
        starts += int((fresh & used).sum())
        # the state handed on is the last target
        for k in range(x.shape[1]):
            if not fresh[0, k]:
                before.append(h[k, 0] == x[0, k])
            assert ((x[1:, k] == y[:-1, k]) | fresh[1:, k])[used[1:, k]].all()
        tapes.append(int(used.sum()))
        return np.repeat(y[-1][:, None], model.hidden, axis=1).astype(np.float32)

    monkeypatch.setattr(gru.Gru, "learn", learn)
    assert gru.train(model, texts, pool=3000) == sum(map(len, texts)) == sum(tapes)
    assert starts == len(texts) and before and all(before)


def test_ranker_orders_and_cuts():
    random = np.random.default_rng(0)
    good = random.random(400) < 0.8
    x = random.normal(0, 1, (400, quality.N_FEATURES))
    x[:, 3] += np.where(good, 4, -4)
    ranker = quality.fit_ranker(x, good)
    assert ((ranker.score(x) >= quality.CUT) == good).mean() > 0.99
    flat = quality.fit_ranker(x, np.ones(400, bool))
    assert (flat.score(x) >= quality.CUT).all()
    assert np.isfinite(quality.features("")).all() and np.isfinite(quality.features(None)).all()


def test_units_cover_texts(monkeypatch):
    names = ["▁ab", "b,", "▁▁", "é", "a"]
    cutter = pickle.loads(pickle.dumps(pieces.Pieces(names, list(range(5)), [0.0] * 5, [], 5, 6).cutter()))

    def cut(text):
        starts, ends, hashes = cutter(text)
        units = [text[i:j] for i, j in zip(starts, ends, strict=True)]
        assert "".join(units) == text and len(set(zip(units, hashes))) == len(set(units)) == len(set(hashes))
        return units

    assert cut("▁ab,▁▁a☃é") == ["▁ab,", "▁▁a", "☃", "é"] and cut("") == []
    for text in ("▁a▁▁b, c.▁", "▁", "▁▁x9_y²é\n▁", "\U0010ffff\ud800", "▁ab,▁abx▁▁▁▁▁▁▁a" * 9):
        whole = cut(text)
        assert {x for u in whole for x in zip(u, u[1:], strict=False)} <= {x for n in names for x in zip(n, n[1:], strict=False)}
        monkeypatch.setattr(pieces, "PART", 3)
        assert cut(text) == whole
        monkeypatch.undo()


def test_short_texts_are_one_gram():
    assert len(shingle_hashes(word_hashes("a b c"), 5)) == 1 and len(shingle_hashes(word_hashes(" "), 5)) == 0


def test_quality_weights_are_those_of_all_pairs():
    """The slope of the loss over every pair of a good and a bad row is zero at the weights, and the threshold is the exact quantile."""
    random = np.random.default_rng(3)
    good = random.random(900) < 0.3
    x = random.normal(0, 1, (900, quality.N_FEATURES)) + 0.4 * good[:, None] * random.random(quality.N_FEATURES)
    ranker = quality.fit_ranker(x, good)
    z = np.clip((x - x.mean(axis=0)) / x.std(axis=0), -8, 8)
    margin = z @ ranker.weights
    p = 1 / (1 + np.exp(margin[good][:, None] - margin[~good]))
    slope = (p.sum(axis=1) @ z[good] - p.sum(axis=0) @ z[~good]) / p.size - 1e-3 * ranker.weights
    assert np.abs(slope).max() < 1e-4, np.abs(slope).max()
    assert abs(ranker.threshold - np.quantile(margin, 1 - good.mean())) < 1e-9


def test_quality_of_parts_is_that_of_the_whole():
    random = np.random.default_rng(4)
    good = random.random(500) < 0.5
    x = random.normal(0, 1, (500, quality.N_FEATURES)) + good[:, None]
    whole = quality.fit_ranker(x, good)
    parts = quality._fit(lambda part: sum(part(x[k::7], good[k::7]) for k in range(7)))
    assert np.allclose(whole.weights, parts.weights) and abs(whole.threshold - parts.threshold) < 1e-9


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 2500), max_size=12), st.integers(0, 2**31))
def test_gram_counts_every_passage(sizes, seed):
    rng = np.random.default_rng(seed)
    texts = [(rng.zipf(1.4, n) % decontaminate.DIMS).astype(np.uint16) for n in sizes]
    idf = rng.random(decontaminate.DIMS) + 0.05
    given_ = rng.standard_normal((decontaminate.DIMS, 3)).astype(np.float32)
    want = np.zeros(given_.shape)
    for feature in texts:
        for start in decontaminate._starts(len(feature)):
            own, n = np.unique(feature[start : start + decontaminate.WINDOW].astype(np.int64), return_counts=True)
            row = n * idf[own] / np.linalg.norm(n * idf[own])
            want[own] += row[:, None] * (row @ given_[own])
    gram = decontaminate.Gram(given_, idf)
    for chunk in decontaminate._chunks(iter(texts)):
        gram.add(chunk)
    assert np.allclose(gram.sums, want, atol=1e-3)
