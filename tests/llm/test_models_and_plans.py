import collections

import math

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sylvaspark.llm import apply, balltree, classlm, mixing, packing, projections, sharding, textkit, toxicity
from tests.llm.common import corpus, frame, vocabulary, words


# ---- language model
def test_exchange_raises_the_likelihood():
    rng = np.random.default_rng(0)
    true = rng.integers(0, 3, 30)
    n = rng.poisson(np.where((true[:, None] + 1) % 3 == true[None, :], 20, 0.2))

    def likelihood(of):
        m = np.eye(3)[of]
        N = m.T @ n @ m
        f = lambda x: (x[x > 0] * np.log(x[x > 0])).sum()
        return f(N) - f(N.sum(axis=0)) - f(N.sum(axis=1))

    of = classlm.exchange(n.astype(float), 3)
    assert likelihood(of) > likelihood(np.arange(30) % 3)
    assert len({(a, b) for a, b in zip(of, true)}) == 3


def test_gain_is_the_difference_of_likelihoods():
    rng = np.random.default_rng(1)
    N, r, l, s = rng.integers(1, 9, (4, 4)).astype(float), rng.integers(0, 5, 4).astype(float), rng.integers(0, 5, 4).astype(float), 2.0
    f = lambda x: (x * np.log(x)).sum()
    L = lambda M: f(M) - f(M.sum(axis=0)) - f(M.sum(axis=1))
    for k in range(4):
        M = N.copy()
        M[k] += r
        M[:, k] += l
        M[k, k] += s
        assert classlm._gain(N, r, l, s)[k] == pytest.approx(L(M) - L(N))


def test_perplexities_against_brute_force(spark):
    rows = corpus(2, 50)
    docs = frame(spark, rows)
    model = classlm.fit(docs, vocabulary=40, core=10, classes=4)
    size = lambda w: min((len(w.encode()) - 1) // 3, classlm.RARE - 1)
    count = collections.Counter(w for _, t in rows for w in words(t))
    key = {w: int((textkit.Words(pa.array([w])).hash[0] & ~np.uint64(classlm.RARE - 1)) | np.uint64(size(w))) for w in count}
    place = {int(v): i for i, v in enumerate(model["vocab"])}
    assert sorted((count[w] for w in count if key[w] in place), reverse=True) == sorted(count.values(), reverse=True)[:40]
    total, border = 4 + classlm.RARE + 1, 4 + classlm.RARE
    cls = {w: int(model["class"][place[key[w]]]) if key[w] in place else 4 + size(w) for w in count}
    B = np.zeros((total, total))
    for _, t in rows:
        before = border
        for w in words(t):
            B[before, cls[w]] += 1
            before = cls[w]
    uni = (B.sum(axis=0) + 0.5) / (B.sum() + 0.5 * total)
    rare = collections.Counter(size(w) for w in count if key[w] not in place)
    members, kinds = collections.Counter(), collections.Counter()
    for w in count:
        if key[w] in place:
            members[cls[w]] += count[w]
            kinds[cls[w]] += 1
    got = classlm.perplexities(docs, vocabulary=40, core=10, classes=4).collect()
    assert len(got) == len(rows)
    by_text = collections.defaultdict(list)
    for r in got:
        by_text[r.doc_id].append(r)
    for i, t in rows:
        lp, before = 0.0, border
        for w in words(t):
            c = cls[w]
            row = B[before]
            p = classlm.LAMBDA * (row[c] / row.sum() if row.sum() else uni[c]) + (1 - classlm.LAMBDA) * uni[c]
            e = (count[w] + 0.5) / (members[c] + 0.5 * kinds[c]) if key[w] in place else 1 / rare[size(w)]
            lp += math.log(p) + math.log(e)
            before = c
        r = by_text[i][0]
        assert r.n_words == len(words(t)) and r.log_prob == pytest.approx(lp, rel=1e-6, abs=1e-6)
        assert r.perplexity is None if not words(t) else r.perplexity == pytest.approx(math.exp(min(700, -lp / len(words(t)))), rel=1e-6)


def test_language_model_of_repeated_rows(spark):
    """A row that comes three times counts three times, and is scored three times alike."""
    rows = [(1, "a b c d")] * 3 + [(2, "a b"), (None, "c d")]
    once = [(i, t) for i, (_, t) in enumerate(rows)]
    get = lambda r: sorted((x.n_words, round(x.log_prob, 9)) for x in classlm.perplexities(frame(spark, r)).collect())
    got = get(rows)
    assert len(got) == 5 and got == get(once) and len(set(got)) <= 3


def test_language_model_of_nothing(spark):
    assert classlm.perplexities(frame(spark, [])).count() == 0
    assert [r.perplexity for r in classlm.perplexities(frame(spark, [(1, None), (2, "")])).collect()] == [None, None]


def test_the_vocabulary_is_not_on_the_driver(spark, monkeypatch):
    """No table of the vocabulary's size comes to the driver: it came three times, as an object for each row."""
    rng = np.random.default_rng(8)
    docs = frame(spark, [(i, " ".join(f"w{x}" for x in rng.integers(0, 3000, 200))) for i in range(150)])
    seen = []
    for name in ("collect", "toPandas", "toArrow"):
        own = getattr(type(docs), name)
        monkeypatch.setattr(type(docs), name, lambda self, *a, own=own, **k: (out := own(self, *a, **k), seen.append(len(out)))[0])
    out = classlm.perplexities(docs, core=20, classes=4)
    assert out.where("log_prob < 0").count() == 150
    assert max(seen) <= 20 * 20
    assert len(classlm.fit(docs, core=20, classes=4)["vocab"]) > 2500


def test_words_are_found_by_their_starts():
    w = textkit.Words(pa.array([" ".join(f"w{x}" for x in range(3000)), "", "w5 w5 other"]))
    key = np.unique(w.hash & ~np.uint64(classlm.RARE - 1) | classlm._length_class(w).astype(np.uint64))
    for vocab in (key, key[::2], key[:1], key[-1:], key[5:9], np.array([0, 1 << 63, (1 << 64) - 1], np.uint64), key[:0]):
        assert (classlm._lookup_key(w, vocab, classlm._starts(vocab)) == classlm._lookup_key(w, vocab)).all()


def test_vocabulary_follows_from_the_counts(spark):
    """All words seen LEAST times are in the model, each with its own emission."""
    rng = np.random.default_rng(4)
    kinds = [[f"{c}{i:05d}" for i in range(6000)] for c in "ab"]
    texts = []
    for i in range(0, 6000, 10):  # words meet only within their ten, so most never meet a frequent word
        times = 60 if i < 300 else 12
        texts += [" ".join(kinds[k % 2][i + j] for k, j in enumerate(rng.integers(0, 10, 20))) for _ in range(times)]
    docs = frame(spark, list(enumerate(texts)))
    model = classlm.fit(docs)
    count = collections.Counter(w for t in texts for w in t.split())
    seen = [w for w in count if count[w] >= classlm.LEAST]
    key = textkit.Words(pa.array(seen))
    at = classlm._lookup_key(key, model["vocab"])
    assert len(model["vocab"]) == len(seen) > 8192 and (at >= 0).all()
    emit = collections.Counter()
    for w, i in zip(seen, at):
        emit[model["class"][i]] += math.exp(model["emit"][i])
    assert all(v == pytest.approx(1) for v in emit.values())


def test_words_join_by_all_their_neighbours(spark):
    """Words that never meet a word of the core get their class by the classes of the other words."""
    rng = np.random.default_rng(4)
    a, b, x, y, u, z = ([f"{c}{i:02d}" for i in range(n)] for c, n in (("a", 5), ("b", 5), ("x", 20), ("y", 20), ("u", 20), ("z", 20)))
    pick = lambda v: v[rng.integers(0, len(v))]
    texts = [" ".join(pick(v) for _ in range(6) for v in (a, b)) for _ in range(300)]
    texts += [" ".join(pick(v) for v in (a, x, a, x, a)) for _ in range(150)] + [" ".join(pick(v) for v in (y, x, y, x, y)) for _ in range(200)]
    texts += [" ".join(pick(v) for v in (b, u, b, u, b)) for _ in range(150)] + [" ".join(pick(v) for v in (z, u, z, u, z)) for _ in range(200)]
    model = classlm.fit(frame(spark, list(enumerate(texts))), core=10, classes=2)
    of = lambda v: model["class"][classlm._lookup_key(textkit.Words(pa.array(v)), model["vocab"])]
    assert len({*of(a)}) == len({*of(b)}) == 1 and of(a)[0] != of(b)[0]
    assert (of(x) == of(b)[0]).all() and (of(u) == of(a)[0]).all()  # x stand beside a, as b do, and u beside b
    assert (of(y) == of(a)[0]).all() and (of(z) == of(b)[0]).all()  # beside x and u only


# ---- toxicity
def test_gradients():
    rng = np.random.default_rng(0)
    m = {k: v.astype(np.float64) for k, v in toxicity.new_model(rng).items()}
    x, mask, y = rng.normal(size=(toxicity.T, 4, toxicity.D)), np.arange(toxicity.T)[:, None] < np.array([32, 5, 1, 20]), np.array([1.0, 0, 1, 0])
    _, g, dx = toxicity.gradients(m, x, mask, y)
    for t, b, d in ((0, 0, 3), (4, 1, 9), (0, 2, 17), (19, 3, 0), (25, 3, 2)):
        old, e = x[t, b, d], 1e-2
        x[t, b, d] = old + e
        up = toxicity.gradients(m, x, mask, y)[0]
        x[t, b, d] = old - e
        down = toxicity.gradients(m, x, mask, y)[0]
        x[t, b, d] = old
        assert (up - down) / 2 / e == pytest.approx(float(dx[t, b, d]), abs=2e-4)
    for k in m:
        i = tuple(rng.integers(0, s) for s in m[k].shape)
        old, e = m[k][i], 1e-2
        m[k][i] = old + e
        a = toxicity.gradients(m, x, mask, y)[0]
        m[k][i] = old - e
        b = toxicity.gradients(m, x, mask, y)[0]
        m[k][i] = old
        assert (a - b) / 2 / e == pytest.approx(float(g[k][i]), abs=2e-4)


def _fitted(seed=0):
    rng = np.random.default_rng(seed)
    tables = {k: rng.normal(size=toxicity.SLOTS).astype(np.float32) for k in ("word", "char", "known")}
    return {"model": toxicity.new_model(rng) | {k: 10 * v for k, v in toxicity.new_embeddings(rng).items()}, "tables": tables, "cut": 0.0}


def test_embeddings_are_learnt_by_their_gradients():
    f, rng = _fitted(), np.random.default_rng(1)
    v = vocabulary(__import__("random").Random(2), 60)
    words = textkit.Words(pa.array([" ".join(v)]))
    evidence = toxicity._evidence(words, np.arange(len(v)), f["tables"])
    m = {k: x.astype(np.float64) for k, x in f["model"].items()}
    word, mask, y = rng.integers(0, len(v), (toxicity.T, 4)), np.arange(toxicity.T)[:, None] < np.array([32, 5, 1, 20]), np.array([1.0, 0, 1, 0])
    loss = lambda: toxicity.gradients(m, toxicity._embedded(*evidence, m)[word], mask, y)
    dx = loss()[2]
    for k, (slots, grad) in zip(("Ew", "Ec"), toxicity.embedding_gradients(dx, word, mask, *evidence[1:])):
        for i in rng.integers(0, len(slots), 6):
            at, e = (slots[i], int(rng.integers(0, grad.shape[1]))), 1e-2
            m[k][at] += e
            up = loss()[0]
            m[k][at] -= 2 * e
            down = loss()[0]
            m[k][at] += e
            assert (up - down) / 2 / e == pytest.approx(float(grad[i, at[1]]), abs=2e-4)


def test_scores_by_force():
    """Every window of every text, one word at a time."""
    f, rng = _fitted(3), __import__("random").Random(4)
    v = vocabulary(rng, 80)
    texts = [" ".join(rng.choice(v) for _ in range(n)) for n in (1, 5, 31, 32, 33, 70, 150)] + [None, "", "..."]
    m = f["model"]
    sig = lambda x: 1 / (1 + np.exp(-x))

    def gru(rows, d):
        h, out, H = np.zeros(toxicity.H), [], toxicity.H
        for x in rows:
            a, p = x @ m["W" + d] + m["c" + d], h @ m["U" + d]
            z, r = sig(a[:H] + p[:H]), sig(a[H : 2 * H] + p[H : 2 * H])
            n = np.tanh(a[2 * H :] + r * p[2 * H :])
            h = n + z * (h - n)
            out.append(h)
        return out

    def logit(rows):
        s = np.concatenate((gru(rows, "f"), gru(rows[::-1], "b")[::-1]), axis=1)
        e = np.exp(np.tanh(s @ m["A"] + m["a"]) @ m["v"])
        return float((e / e.sum()) @ s @ m["u"] + m["o"][0])

    best, many = toxicity.scores(f, textkit.Words(pa.array(texts)))
    for t, b, n in zip(texts, best, many):
        w = textkit.Words(pa.array([t], pa.string()))
        size = int(w.count[0])
        if not size:
            assert b == -np.inf and n == 0
            continue
        x = toxicity._inputs(w, np.arange(size), f)
        starts = sorted({*range(0, max(size - toxicity.T, 0) + 1, toxicity.STRIDE), max(size - toxicity.T, 0)})
        by = {s: logit(x[s : s + toxicity.T]) for s in starts}
        top = max(by, key=by.get)
        fine = [s for s in range(top - 12, top + 13, 4) if 0 <= s <= size - toxicity.T]
        assert n == len(starts) and b == pytest.approx(max([*by.values(), *(logit(x[s : s + toxicity.T]) for s in fine)]), abs=1e-4)


def test_threshold_weighs_the_kinds_by_their_share():
    yes, no = np.array([3.0, 2.0, 1.0, 0.2]), np.array([0.5, 0.0, -1.0, -2.0])
    assert toxicity.threshold(yes, no, 0.5) == (pytest.approx(0.1), pytest.approx(8 / 9))
    cut, f1 = toxicity.threshold(yes, no, 0.05)  # one clean in four rejected would be most of what is rejected
    assert cut == pytest.approx(0.75) and f1 == pytest.approx(6 / 7)


@given(st.lists(st.integers(0, 200), max_size=10))
@settings(max_examples=40, deadline=None)
def test_windows_cover_all_words(counts):
    count = np.array(counts, dtype=np.int64)
    doc, at = toxicity.window_starts(count)
    for d, n in enumerate(counts):
        cover = {w for s in at[doc == d] for w in range(s, min(s + toxicity.T, n))}
        assert cover == set(range(n))


def _labelled(seed, n):
    import random

    rng = random.Random(seed)
    v = vocabulary(random.Random(0), 600)
    rows = []
    for i in range(n):
        w = [rng.choice(v) for _ in range(rng.randint(20, 150))]
        if toxic := i % 5 == 0:
            for _ in range(rng.randint(1, 3)):
                w.insert(rng.randrange(len(w)), "zqx" + rng.choice(v))
        rows.append((i, " ".join(w), int(toxic)))
    return rows


def test_toxicity_on_held_out_documents(spark):
    rows = _labelled(1, 900)
    docs = frame(spark, [r[:2] for r in rows] + [(5000, None), (5001, ""), (5002, "..."), (None, "zqxabc " * 5), (5003, "good words " * 20_000 + "zqxabc zqxdef " + "more words " * 500), rows[700][:2], rows[700][:2]])
    labels = spark.createDataFrame([(r[0], r[2], 1) for r in rows if r[0] < 600] + [(7, None, 1)], "doc_id long, toxic int, quality int")
    out = toxicity.score_documents(docs, labels).collect()
    assert len(out) == len(rows) + 7 and len({(r.score, r.n_windows) for r in out if r.doc_id == rows[700][0]}) == 1  # repeated rows score alike
    by = {r.doc_id: r for r in out}
    held = [r for r in rows if r[0] >= 600]
    assert sum(by[i].toxic == bool(t) for i, _, t in held) >= 0.97 * len(held)
    assert by[5003].toxic and by[None].toxic
    assert all(not by[i].toxic and by[i].score == 0 and by[i].n_windows == 0 for i in (5000, 5001, 5002))
    clean = apply.without_toxic(docs, labels)
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == {r.doc_id for r in out if not r.toxic}


def test_toxicity_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    out = toxicity.score_documents(frame(spark, [(1, "a b"), (2, None)]), none).collect()
    assert [(r.score, r.toxic) for r in out] == [(0, False), (0, False)]
    assert toxicity.score_documents(frame(spark, []), none).count() == 0


# ---- sharding
def test_sharding_by_force(spark):
    import hashlib

    rows = [(i, "ab" * (i % 37)) for i in range(400)] + [(None, "é"), (7, "again"), (7, "again"), (9000, "x" * 5000), (9001, None)]
    out = sharding.sharded(frame(spark, rows), limit=600).collect()
    assert len(out) == len(rows)
    h = lambda i: int(hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()[:8], 16)
    size = lambda t: len((t or "").encode())
    for r in out:
        d = 0
        while True:
            same = [(h(i), size(t)) for i, t in rows if h(i) >> (32 - d) == h(r.doc_id) >> (32 - d)]
            if sum(s for _, s in same) <= 600 or len({x for x, _ in same}) == 1:
                break
            d += 1
        assert (r.shard_depth, r.shard_prefix, r.shard_bytes) == (d, h(r.doc_id) >> (32 - d), sum(s for _, s in same))
    assert sharding.sharded(frame(spark, [])).count() == 0


def test_deep_cells_split_beyond_the_first_bits(spark):
    cell = lambda rows: spark.createDataFrame(rows, "cell long, bytes long, low long, high long")
    of = lambda *a: {r.cell: (r.shard_depth, r.shard_prefix, r.shard_bytes) for r in sharding.directory(*a).collect()}
    assert of(cell([(5, 900, 5 << 16, (5 << 16) + 9)]), 0, 16, 100) == {5: (None, None, None)}
    got = of(cell([(5 << 8, 900, 5 << 16, 5 << 16), ((5 << 8) + 1, 10, 9, 10), ((5 << 8) + 128, 60, 1, 2), ((5 << 8) + 129, 30, 3, 4)]), 17, 24, 100)
    assert got == {5 << 8: (24, 5 << 8, 900), (5 << 8) + 1: (24, (5 << 8) + 1, 10), (5 << 8) + 128: (17, 11, 90), (5 << 8) + 129: (17, 11, 90)}


def test_sharding_below_the_first_cells(spark, monkeypatch):
    """Hashes that share their first 20 bits split in the second pass."""
    monkeypatch.setattr(sharding, "hash32", lambda: (F.lit(77 << 24) + F.col("doc_id") * 64).cast("long"))
    rows = [(i, "x" * 10) for i in range(64)]
    out = sharding.sharded(frame(spark, rows), limit=100).collect()
    assert len(out) == 64 and {r.shard_depth for r in out} == {23} and {r.shard_bytes for r in out} == {80}


# ---- mixing
def _mix_rows():
    rng = np.random.default_rng(3)
    return [(i, " ".join(["w"] * int(rng.integers(1, 200))), ["en", "de", None][int(rng.integers(0, 3))], ["a", "a", "a", "b", "c", None][int(rng.integers(0, 6))]) for i in range(1500)]


def test_mixing_meets_all_constraints(spark):
    rows = _mix_rows()
    docs = spark.createDataFrame([(*r, 1) for r in rows] + [(9999, None, "en", "a", 1), (9998, " ", None, "zz", 1), (None, "w w", "de", "b", 1)], "doc_id long, text string, lang string, source string, copies int")
    target = {"a": 1.0, "b": 2.0, "c": 1.0, None: 1.0, "absent": 3.0}
    out = mixing.rates(docs, target).collect()
    assert len(out) == len(rows) + 3
    live = [r for r in out if r.n_tokens]
    total = sum(r.n_tokens for r in live)
    mass = lambda f: sum(r.n_tokens * r.rate for r in live if f(r))
    for s, t in {"a": 0.2, "b": 0.4, "c": 0.2, None: 0.2}.items():
        assert mass(lambda r: r.source == s) / total == pytest.approx(t, rel=1e-4)
    for x in ("en", "de", None):
        assert mass(lambda r: r.lang == x) == pytest.approx(sum(r.n_tokens for r in live if r.lang == x), rel=1e-3)
    logs = lambda w: sum(r.n_tokens * w(r) * math.log(r.n_tokens) for r in live) / sum(r.n_tokens * w(r) for r in live)
    assert logs(lambda r: r.rate) == pytest.approx(logs(lambda r: 1), rel=1e-4)
    assert all(r.copies in (math.floor(r.rate), math.floor(r.rate) + 1) for r in out)
    assert sum(r.copies for r in live) == pytest.approx(sum(r.rate for r in live), rel=0.05)
    assert [(r.rate, r.copies) for r in out if r.doc_id in (9998, 9999)] == [(1.0, 1)] * 2
    mixed = mixing.mixed(docs, target)
    assert mixed.columns == docs.columns
    got = collections.Counter((r.doc_id, r.text) for r in mixed.collect())
    by = {(r.doc_id, r.n_tokens): r.copies for r in out}
    assert all(got[i, t] == by[i, len(t.split())] for i, t, _, _ in rows)


def test_mixing_rates_are_tilted_and_copies_follow_the_hash(spark):
    """log rate = source term + language term + length term * log tokens, and the extra copy goes to documents whose hash is below the rest; one text is very long."""
    import hashlib

    rows = [r for r in _mix_rows() if r[2] and r[3]] + [(7001, "w " * 2000, "en", "b"), (7002, "w w", "en", "a"), (7002, "w w", "en", "a")]
    out = mixing.rates(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), {"a": 1.0, "b": 2.0, "c": 1.0}).collect()
    names = [*("abc"), "en", "de", "log"]
    X = np.array([[float(r.source == n or r.lang == n) for n in names[:-1]] + [math.log(r.n_tokens)] for r in out])
    y = np.log([r.rate for r in out])
    assert np.abs(X @ np.linalg.lstsq(X, y, rcond=None)[0] - y).max() < 1e-8
    for r in out:
        h = int(hashlib.md5(str(r.doc_id).encode()).hexdigest()[:8], 16) / 2**32
        assert r.copies == math.floor(r.rate) + (h < r.rate - math.floor(r.rate))
    assert len({(r.rate, r.copies) for r in out if r.doc_id == 7002}) == 1 and sum(r.doc_id == 7002 for r in out) == 2


def test_mixing_by_default_and_of_nothing(spark):
    docs = spark.createDataFrame(_mix_rows(), "doc_id long, text string, lang string, source string")
    out = mixing.rates(docs).collect()
    share = collections.Counter()
    for r in out:
        share[r.source] += r.n_tokens
    want = mixing.weights_by_root({s: n / sum(share.values()) for s, n in share.items()})
    got = collections.Counter()
    for r in out:
        got[r.source] += r.n_tokens * r.rate
    assert all(got[s] / sum(got.values()) == pytest.approx(w, rel=1e-4) for s, w in want.items())
    assert mixing.rates(docs.limit(0)).count() == 0 and mixing.mixed(docs.limit(0)).count() == 0
    gone = mixing.rates(docs, {"b": 1.0}).collect()
    assert all(r.copies == 0 for r in gone if r.source != "b")


# ---- packing
@given(st.lists(st.integers(1, 30), max_size=60))
@settings(max_examples=200, deadline=None)
def test_bins(sizes):
    size, cap = np.array(sizes, dtype=np.int64), 30
    b = packing.pack(size, cap)
    bins = collections.defaultdict(list)
    for i, x in zip(sizes, b.tolist()):
        bins[x].append(i)
    assert all(sum(v) <= cap and sum(s * 3 > cap for s in v) <= 2 for v in bins.values()) and sorted(bins) == list(range(len(bins)))
    # the same by plain search
    big, small = sorted((s for s in sizes if s * 3 > cap), reverse=True), sorted((s for s in sizes if s * 3 <= cap), reverse=True)
    room = []
    while big:
        s = big.pop(0)
        mate = next((m for m in big if m <= cap - s), 0)
        if mate:
            big.remove(mate)
        room.append(cap - s - mate)
    for s in small:
        fit = [r for r in room if r >= s]
        if fit:
            room.remove(min(fit))
            room.append(min(fit) - s)
        else:
            room.append(cap - s)
    assert sorted(cap - sum(v) for v in bins.values()) == sorted(room)


def test_packing_places_every_token(spark):
    rows = corpus(4, 80) + [(3, "a b"), (3, "a b")]
    out = packing.packed(frame(spark, rows), capacity=100, group_tokens=3000).collect()
    tokens = collections.Counter()
    for i, t in rows:
        tokens[i] += len((t or "").split())
    got = collections.Counter()
    fill = collections.Counter()
    for r in out:
        got[r.doc_id] += r.n_tokens
        fill[r.bin_id] += r.n_tokens
        assert r.start == r.piece_no * 100
    assert got == +tokens and max(fill.values()) <= 100
    assert len({(r.doc_id, r.copy_no, r.piece_no) for r in out}) == len(out)
    assert packing.packed(frame(spark, [])).count() == 0 and packing.packed(frame(spark, [(1, None), (2, " ")])).count() == 0


def test_packing_spreads_the_copies_of_an_id(spark):
    """A third of the rows has one id and a third none: the groups stay near their size, and all copies have numbers of their own."""
    rows = [(7, "w " * 30)] * 300 + [(None, "w " * 25)] * 300 + [(i, "w " * 20) for i in range(100, 400)]
    out = packing.packed(frame(spark, rows), capacity=100, group_tokens=2000).collect()
    copies = collections.defaultdict(list)
    groups = collections.Counter()
    for r in out:
        copies[r.doc_id].append(r.copy_no)
        groups[r.bin_id.split("-")[0]] += r.n_tokens
    assert sorted(copies[7]) == sorted(copies[None]) == list(range(300)) and all(copies[i] == [0] for i in range(100, 400))
    assert sum(groups.values()) == 300 * 75 and max(groups.values()) < 4000 and len(groups) >= 10


# ---- vectors
def _vectors(n=700, d=16, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    for i in range(0, n // 3):
        x[rng.integers(0, n)] = x[i] + rng.normal(size=d) * rng.choice([0, 0.02, 0.05])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return x.astype(np.float32)


def _table(spark, x, extra=()):
    rows = [(i, [float(a) for a in v], i % 3, "s") for i, v in enumerate(x)] + list(extra)
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int, score string")


ODD = [(90_001, None, 1, "s"), (90_002, [], 1, "s"), (90_003, [1.0, 2.0], 1, "s"), (None, [0.5] * 16, 1, "s"), (90_004, [0.0] * 16, 1, "s"), (90_005, [None] + [0.1] * 15, 1, "s")]


def test_top_k_is_exact(spark):
    x = _vectors()
    table = _table(spark, x, [*ODD, (5, [float(a) for a in x[5]], 0, "s")])
    out = balltree.top_k(table, k=5, every=1, shard_rows=100).collect()
    got = collections.defaultdict(list)
    for r in sorted(out, key=lambda r: r.rank):
        got[r.vec_id].append((r.neighbor_id, r.score))
    z = np.vstack([x.astype(np.float64), np.zeros(16)])
    ids = np.append(np.arange(len(x)), 90_004)
    s = np.round(z @ z.T, 9)
    for q in range(len(z)):
        order = [i for i in np.lexsort((ids, -s[q])) if i != q][:5]
        assert got[int(ids[q])] == [(int(ids[i]), s[q, i]) for i in order]
    assert len(got) == len(z)
    few = collections.defaultdict(list)
    for r in sorted(balltree.top_k(table, k=5, every=7, shard_rows=300).collect(), key=lambda r: r.rank):
        few[r.vec_id].append((r.neighbor_id, r.score))
    assert few == {i: v for i, v in got.items() if i % 7 == 0}


def test_top_k_with_a_hot_vector(spark):
    """A third of the rows is one vector: its shard is dealt to parts, and ties go by id."""
    x = np.concatenate((np.tile(np.eye(1, 8, dtype=np.float32), (200, 1)), _vectors(400, 8, 3) / 2))
    out = collections.defaultdict(list)
    for r in sorted(balltree.top_k(_table(spark, x), k=4, every=100, shard_rows=40).collect(), key=lambda r: r.rank):
        out[r.vec_id].append(r.neighbor_id)
    assert sorted(out) == [0, 100, 200, 300, 400, 500] and out[0] == [1, 2, 3, 4] and out[100] == [0, 1, 2, 3]


def test_top_k_of_few_and_none(spark):
    assert balltree.top_k(_table(spark, _vectors(3)), k=5, every=1).count() == 6
    assert balltree.top_k(_table(spark, [])).count() == 0
    assert balltree.top_k(_table(spark, np.ones((6, 4), np.float32)), k=2, shard_rows=2).where("rank = 1 and vec_id = 0").first().neighbor_id == 1


def test_near_pairs_recall(spark):
    x = _vectors(900, 16, 4)
    got = {(min(r.a, r.b), max(r.a, r.b)) for r in projections.near_pairs(_table(spark, x)).collect()}
    s = x.astype(np.float64) @ x.T.astype(np.float64)
    want = {(i, j) for i, j in np.argwhere(s >= 0.95).tolist() if i < j}
    assert len(got & want) >= 0.95 * len(want) > 50
    assert all(s[a, b] >= 0.95 - 1e-5 for a, b in got)


@pytest.mark.parametrize("small", [False, True])
def test_near_pairs_do_not_depend_on_partitions(spark, monkeypatch, small):
    if small:  # buckets are dealt to blocks
        monkeypatch.setattr(projections, "BLOCK_BYTES", 1 << 11)
        monkeypatch.setattr(projections, "TILE", 16)
    x = np.concatenate((_vectors(500, 16, 8), np.ones((60, 16), np.float32)))
    old, found = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in (1, 7, 50):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            found.append({(min(r.a, r.b), max(r.a, r.b)) for r in projections.near_pairs(_table(spark, x).repartition(n)).collect()})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert found[0] == found[1] == found[2] and {(a, b) for a in range(500, 560) for b in range(a + 1, 560)} <= found[0]


def test_near_groups(spark):
    x = _vectors(300, 16, 5)
    out = {r.vec_id: r for r in projections.near_groups(_table(spark, x, [*ODD, (3, [float(a) for a in x[3]], 0, "s")])).collect()}
    assert len(out) == 300 + 5
    assert all(out[i].group_id == i and not out[i].is_duplicate for i in (90_001, 90_002, 90_003, 90_004, 90_005))
    assert all(r.group_id <= i and r.is_duplicate == (r.group_id != i) for i, r in out.items())
    same = np.ones((50, 8), np.float32)
    assert {r.group_id for r in projections.near_groups(_table(spark, same)).collect()} == {0}
    assert projections.near_groups(_table(spark, [])).count() == 0


def _star(variants, others, cosine=0.96, d=64):
    """A base (0), variants at `cosine` to it and mostly below 0.95 to each other, and random vectors."""
    rng = np.random.default_rng(7)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    base = unit(rng.normal(size=d))
    off = rng.normal(size=(variants, d))
    off = unit(off - (off @ base)[:, None] * base)
    return np.concatenate((base[None], cosine * base + math.sqrt(1 - cosine**2) * off, unit(rng.normal(size=(others, d))))).astype(np.float32)


@pytest.mark.parametrize("small", [False, True])
def test_near_dedup_of_a_star_of_thousands(spark, monkeypatch, small):
    if small:  # buckets are dealt to blocks
        monkeypatch.setattr(projections, "BLOCK_BYTES", 1 << 15)
        monkeypatch.setattr(projections, "TILE", 64)
    x = _star(3000, 3000)
    table = _table(spark, x).cache()
    s = x @ x.T
    want = {(i, j) for i, j in np.argwhere(s >= 0.95 + 1e-5).tolist() if i < j}
    got = {(min(a, b), max(a, b)) for a, b in projections.near_pairs(table).toPandas().itertuples(index=False)}
    assert len(got & want) >= 0.98 * len(want) > 3000
    out = projections.near_groups(table).toPandas()
    assert len(out) == len(x)
    assert (out[out.vec_id <= 3000].group_id == 0).mean() >= 0.99 and (out[out.vec_id > 3000].group_id == out[out.vec_id > 3000].vec_id).all()
    table.unpersist()
