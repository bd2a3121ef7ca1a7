import collections

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sylvaspark.llm import apply, components, fingerprints, induced, jaccard, shared, suffixdedup, textkit, windows
from tests.llm.common import corpus, covered, frame, grams, span_cover, words


@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB1 .é\n", max_size=40)), max_size=8))
@settings(max_examples=60, deadline=None)
def test_words_are_those_of_the_regex(texts):
    w = textkit.Words(pa.array(texts, pa.string()))
    got = [[w.text(i).decode() for i in range(w.ptr[d], w.ptr[d + 1])] for d in range(len(texts))]
    lower = [["".join(c.lower() if c.isascii() else c for c in x) for x in d] for d in got]
    assert lower == [words(t) for t in texts]
    same = {}
    for d, ws in enumerate(lower):
        for k, x in enumerate(ws):
            assert same.setdefault(x, w.hash[w.ptr[d] + k]) == w.hash[w.ptr[d] + k]
    assert len(set(same.values())) == len(same)


def test_words_across_chunks(monkeypatch):
    texts = ["ab cd " * 50, "x" * 300, None, "yz"]
    want = textkit.Words(pa.array(texts))
    monkeypatch.setattr(textkit, "CHUNK", 16)
    got = textkit.Words(pa.array(texts))
    assert (got.hash == want.hash).all() and (got.ptr == want.ptr).all() and (got.start == want.start).all()


def test_rolling_hash_is_window_hash():
    h = textkit.mix(np.arange(100, dtype=np.uint64))
    for n in (1, 2, 7, 8, 50):
        assert (textkit.rolling_hash(h, n) == textkit.window_hash(h, n)).all()


@given(st.lists(st.integers(1, 3), max_size=60), st.integers(1, 3))
@settings(max_examples=150, deadline=None)
def test_suffix_order_and_common_prefixes(s, times):
    t = np.array(s * times + [0], np.uint8)
    order, common = induced.suffixes(t, 100)
    b = t.tobytes()
    want = sorted(range(len(b)), key=lambda i: b[i:])
    assert order.tolist() == want

    def common_of(i, j):
        k = 0
        while i + k < len(b) and j + k < len(b) and b[i + k] == b[j + k]:
            k += 1
        return min(k, 100)

    assert common.tolist() == [0] + [common_of(i, j) for i, j in zip(want, want[1:])]


def test_suffix_queues_spill(tmp_path):
    t = np.append(np.random.default_rng(0).integers(1, 5, 3000), 0).astype(np.uint8)
    a, b = induced.suffixes(t, 100), induced.suffixes(t, 100, f"file://{tmp_path}/q", 500)
    assert (a[0] == b[0]).all() and (a[1] == b[1]).all()
    assert not list((tmp_path / "q").glob("*/*"))


def jaccard_by_force(rows, t):
    sets = {i: grams(x, jaccard.N) for i, x in rows if i is not None and words(x)}
    out = {}
    for a in sets:
        for b in sets:
            if a < b:
                j = len(sets[a] & sets[b]) / len(sets[a] | sets[b])
                if j >= t:
                    out[a, b] = j
    return sets, out


SHORT = ["a b c d", "a b c e", "a b c", "a b c x e f g", "a b c d e f g", "a", "A", "b", "a a a a", "a b", "b a", "a b a"]


def jaccard_rows():
    """Pairs at, above and below the threshold: short texts, variants with some words edited, and a passage that many documents share."""
    rng = np.random.default_rng(3)
    rows = corpus(3, 150) + [(1000 + i, t) for i, t in enumerate(SHORT)]
    for k in range(100):
        w = [f"w{x}" for x in rng.integers(0, 300, int(rng.integers(4, 90)))]
        for v in range(int(rng.integers(2, 6))):
            edited = [f"e{rng.integers(0, 50)}" if rng.random() < 0.06 * v else x for x in w]
            rows.append((2000 + 10 * k + v, " ".join(edited)))
    passage = " ".join(f"p{i}" for i in range(12))
    return rows + [(4000 + i, f"{passage} " + " ".join(f"w{x}" for x in rng.integers(0, 300, 14))) for i in range(60)]


def classes_by_force(rows):
    _, want = jaccard_by_force(rows, jaccard.THRESHOLD)
    links, group = collections.Counter(i for p in want for i in p), {i: {i} for i, _ in rows if i is not None}
    for a, b in want:
        if group[a] is not group[b]:
            group[a] |= group[b]
            for i in group[b]:
                group[i] = group[a]
    return {i: (min(s), links[i]) for i, s in group.items()}


def variants(count, seed=5):
    rng = np.random.default_rng(seed)
    w = [f"w{x}" for x in rng.integers(0, 5000, 120)]
    return [(k, " ".join(f"e{rng.integers(0, 2000)}" if rng.random() < 0.08 else x for x in w)) for k in range(count)]


def test_candidates_of_a_cluster_are_not_its_pairs(spark, tmp_path):
    """A cluster of variants gives rows by set and group: its pairs grew with its square, and came once for each bucket."""
    rows = variants(400)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    records = docs.mapInArrow(jaccard._records(2), "kind byte, a long, b long, n int, sig binary")
    known = jaccard._keep_known(records.where("kind <> 0").groupBy("kind", "a").agg(F.sum("n").alias("n")), spark)
    found = jaccard._found(docs, 2, 0.5, known, len(rows), sum(len(grams(t, 2)) for _, t in rows))
    assert found.count() < 400 * 399 // 2
    assert found.select("a").distinct().count() == 400


@pytest.mark.parametrize("block", [1024, 7])
def test_links_of_a_cluster_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rows = variants(90) + variants(40, 6)[:30]
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    assert {r.doc_id: (r.class_id, r.n_links) for r in jaccard.classes(frame(spark, rows)).collect()} == classes_by_force(rows)


@pytest.mark.parametrize("block, known", [(128, 1 << 17), (4, 3)])
def test_jaccard_join_equals_brute_force(spark, monkeypatch, block, known):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "KNOWN", known)
    rows = jaccard_rows()
    d = frame(spark, rows).repartition(5)
    out = jaccard.jaccard_join(d).collect()
    sets, want = jaccard_by_force(rows, jaccard.THRESHOLD)
    lowest = {i: min(j for j in sets if sets[j] == s) for i, s in sets.items()}
    expect = {p: j for p, j in want.items() if all(lowest[i] == i for i in p)} | {(lowest[i], i): 1.0 for i in sets if lowest[i] != i}
    assert len(out) == len(expect) > 100
    assert {(r.doc_a, r.doc_b): pytest.approx(r.jaccard) for r in out} == expect
    got = jaccard.classes(d).collect()
    assert len(got) == len({i for i, _ in rows if i is not None})
    assert {r.doc_id: (r.class_id, r.n_links) for r in got} == classes_by_force(rows)


def test_jaccard_of_ids_with_several_texts(spark):
    w = [f"w{i}" for i in range(40)]
    a, b = " ".join(w), " ".join(f"v{i}" for i in range(40))
    rows = [(1, a), (1, b), (1, a), (2, " ".join(w[:36])), (3, b), (4, " ".join(f"v{i}" for i in range(3, 40))), (5, "else"), (0, " ".join(w[4:])), (6, None), (6, "")]
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard.classes(frame(spark, rows)).collect()}
    assert got == {0: (0, 2), 1: (0, 4), 2: (0, 2), 3: (0, 2), 4: (0, 2), 5: (5, 0), 6: (6, 0)}
    assert {(r.doc_a, r.doc_b) for r in jaccard.jaccard_join(frame(spark, rows)).collect()} == {(0, 1), (0, 2), (1, 2), (1, 3), (1, 4)}


def test_jaccard_of_hot_copies_and_a_very_long_text(spark):
    """A third of the rows has one text, another a text with one word edited; one text is long."""
    w = [f"w{i}" for i in range(30)]
    rows = [(i, " ".join(w)) for i in range(300)] + [(1000 + i, " ".join([*w[:15], f"x{i}", *w[16:]])) for i in range(300)] + [(5000, "long " * 100_000 + " ".join(w)), (5001, " ".join(f"q{i}" for i in range(60_000))), (5002, " ".join(f"q{i}" for i in range(80_000)))]
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard.classes(frame(spark, rows)).collect()}
    assert all(got[i] == (0, 600) for i in [*range(300), *range(1000, 1300)])
    assert got[5001] == got[5002] == (5001, 1)
    assert got[5000] == (0, 600)  # 31 bigrams: the repeated word's, and the 29 of the others with one before


def test_jaccard_tree_loses_nothing():
    rng = np.random.default_rng(5)
    base = [rng.integers(0, 1 << 62, rng.integers(20, 60), dtype=np.uint64) for _ in range(12)]
    sets = [np.unique(np.concatenate((b[: rng.integers(10, len(b))], rng.integers(0, 1 << 62, 6, dtype=np.uint64)))) for b in base for _ in range(25)]
    ptr = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
    sig = jaccard._bitmaps(np.unique(np.concatenate(sets), return_inverse=True)[1], ptr)
    a, b = jaccard.tree_pairs(np.diff(ptr), sig, 0.5)
    got = {(min(x, y), max(x, y)) for x, y in zip(a.tolist(), b.tolist())}
    for i in range(len(sets)):
        for j in range(i):
            o = len(np.intersect1d(sets[i], sets[j]))
            if o / (len(sets[i]) + len(sets[j]) - o) >= 0.5:
                assert (j, i) in got
    assert len(got) < len(sets) * (len(sets) - 1) // 4


@pytest.mark.parametrize("block", [128, 25])
def test_jaccard_of_a_large_group(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rows = [(i, " ".join(f"w{j}" for j in range(100)) + f" v{i} u{i}") for i in range(120)]
    assert jaccard.jaccard_join(frame(spark, rows, False)).count() == 120 * 119 // 2
    assert {(r.class_id, r.n_links) for r in jaccard.classes(frame(spark, rows, False)).collect()} == {(0, 119)}


def test_suffix_array_dedup_against_brute_force(spark):
    rows = corpus(5, 80)
    out = suffixdedup.repeated_spans(frame(spark, rows)).collect()
    assert span_cover(out) == covered(rows)
    assert all(r.first_doc_id < r.doc_id for r in out)


@pytest.mark.parametrize("length", [3, 20, 50, 100, 200, 400])
def test_repeats_window_by_window(length):
    for seed in range(40):
        rng = np.random.default_rng(seed)
        vocabulary = int(rng.choice([2, 5, 300, 100_000]))
        word = lambda n: rng.integers(0, vocabulary, n).astype(np.uint64)
        passage = word(length + int(rng.integers(0, 3)))
        runs = [np.concatenate((word(int(rng.integers(0, 60))), passage if rng.random() < 0.8 else word(length), word(int(rng.integers(0, 60))))) for _ in range(int(rng.integers(2, 6)))]
        docs, starts = [3 * d * int(rng.random() < 0.9) for d in range(len(runs))], rng.integers(0, 9, len(runs)).tolist()
        low = {}
        for d, r in zip(docs, runs):
            for j in range(len(r) - length + 1):
                k = r[j : j + length].tobytes()
                low[k] = min(low.get(k, d), d)
        want = sorted((d, s + j, low[r[j : j + length].tobytes()]) for d, s, r in zip(docs, starts, runs) for j in range(len(r) - length + 1) if low[r[j : j + length].tobytes()] < d)
        got = suffixdedup.repeats(np.array(docs), np.array(starts), runs, length, None, 1 << 20)
        assert sorted(zip(*[x.tolist() for x in got])) == want


def test_suffix_order_refuses_what_it_cannot_tell_apart():
    with pytest.raises(ValueError):
        induced.suffixes(np.zeros(1, np.uint8), induced.LONGEST + 1)


def test_suffix_array_dedup_in_small_shards(spark):
    rows = corpus(6, 60)
    assert span_cover(suffixdedup.repeated_spans(frame(spark, rows), budget=2000, shard_words=300).collect()) == covered(rows)


def test_suffix_array_dedup_of_a_hot_passage(spark):
    """A passage that every document has, and a text that a third of them is: anchors beyond `hot` runs give the same spans."""
    rng = np.random.default_rng(1)
    passage = " ".join(f"p{i}" for i in range(70))
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 2000, 40)) + f" {passage} " + " ".join(f"w{x}" for x in rng.integers(0, 2000, 30))) for i in range(60)]
    rows += [(100 + i, " ".join(f"c{j}" for j in range(90))) for i in range(40)] + [(100, " ".join(f"c{j}" for j in range(90))), (None, passage), (200, None)]
    want = covered(rows)
    for hot in (20, 1000):
        assert span_cover(suffixdedup.repeated_spans(frame(spark, rows), hot=hot).collect()) == want


def test_fingerprint_index_against_brute_force(spark):
    rows = corpus(7, 80)
    assert span_cover(fingerprints.incremental_spans(frame(spark, rows)).collect()) == covered(rows)


def test_fingerprint_index_batches_and_compaction(spark):
    rows = [r for r in corpus(8, 60) if r[0] is not None]
    folder = shared.shared_dir(spark)
    got = set()
    for k in range(4):
        index = fingerprints.FingerprintIndex(spark, folder, 3, fanout=2)  # opened again for each batch, as by a later job
        got |= span_cover(index.add(frame(spark, rows[k::4])).collect())
    assert len(index.runs) < 4
    words_of = dict(rows)
    order = {i: k for k in range(4) for i, _ in rows[k::4]}
    seen, want = {}, set()
    for i in sorted(order, key=lambda i: (order[i], i)):
        w = words(words_of[i])
        for j in range(len(w) - 49):
            first = seen.setdefault(tuple(w[j : j + 50]), i)
            if first != i:
                want |= {(i, c) for c in range(j, j + 50)}
    assert got == want
    assert index.add(frame(spark, rows[0::4])).count() >= 0
    assert fingerprints.FingerprintIndex(spark, folder, 99, length=7).buckets == 3 and fingerprints.FingerprintIndex(spark, folder).length == 50
    index.drop()
    assert fingerprints.FingerprintIndex(spark, folder, 9).runs == []


@pytest.mark.parametrize("operator", [jaccard.jaccard_join, suffixdedup.repeated_spans, fingerprints.incremental_spans])
def test_empty_tables(spark, operator):
    assert jaccard.classes(frame(spark, [])).count() == 0
    assert operator(frame(spark, [])).count() == 0
    assert operator(frame(spark, [(1, None), (2, ""), (None, "a b c")])).count() == 0


def test_repeated_rows(spark):
    text = " ".join(f"w{i}" for i in range(70))
    d = frame(spark, [(1, text), (1, text), (2, text), (2, text)])
    assert {(r.doc_a, r.doc_b) for r in jaccard.jaccard_join(d).collect()} == {(1, 2)}
    assert span_cover(suffixdedup.repeated_spans(d).collect()) == {(2, c) for c in range(70)}
    assert span_cover(fingerprints.incremental_spans(d).collect()) == {(2, c) for c in range(70)}


def test_windows_cover_every_start():
    w = textkit.Words(pa.array([" ".join(f"a{i % 17}" for i in range(n)) for n in (10, 50, 51, 400)]))
    r = windows.Runs(w)
    got = sorted((d, s + k) for d, s, c in zip(r.doc.tolist(), r.start.tolist(), r.count.tolist()) for k in range(c))
    assert got == [(d, s) for d, n in enumerate((10, 50, 51, 400)) for s in range(max(0, n - 49))]


@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40))
@settings(max_examples=5, deadline=None)
def test_components(spark, edges):
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long").repartition(3)).collect()}
    group = {i: {i} for e in edges for i in e}
    for a, b in edges:
        if group[a] is not group[b]:
            group[a] |= group[b]
            for i in group[b]:
                group[i] = group[a]
    assert got == {i: min(s) for i, s in group.items() if min(s) != i}


def test_pipeline_stages_cut_and_keep(spark):
    rows = [(i, t) for i, t in corpus(9, 60) if i is not None]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    left = {r.doc_id: r for r in apply.without_repeats(docs).collect()}
    cover = covered(rows)
    for i, t in rows:
        w = words(t)
        kept = [x for k, x in enumerate(w) if (i, k) not in cover]
        if w and not kept:
            assert i not in left
        elif any((i, k) in cover for k in range(len(w))):
            assert words(left[i].text) == kept and left[i].n_chars == len(left[i].text)
        else:
            assert left[i].text == t
    ones = {r.doc_id for r in apply.one_of_each_group(docs).collect()}
    sets, want = jaccard_by_force(rows, jaccard.THRESHOLD)
    assert {i for i, _ in rows} - ones <= {b for _, b in want}
    assert all(i in ones for i, t in rows if not any(i in p for p in want))
    assert apply.without_repeats(docs.limit(0)).count() == 0 and apply.one_of_each_group(docs.limit(0)).count() == 0
    assert docs.where(F.col("doc_id") < 0).count() == 0
