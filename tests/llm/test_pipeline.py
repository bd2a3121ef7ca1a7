import collections

import corpus_pipeline
from sylvaspark.llm import jaccard, mixing, shared, toxicity
from tests.llm.common import covered, grams, words

DIR = "/root/testdata/sf0.001"


def test_each_stage_by_force_and_the_whole_run(spark):
    docs = shared.persist_shared(spark.read.parquet(f"{DIR}/documents.parquet"), spark)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "ngram_jaccard_join", "suffix_array_dedup", "mixing", "packing"]
    tables = [docs]
    for _, stage in corpus_pipeline.STAGES:
        tables.append(shared.persist_shared(stage(spark, tables[-1], DIR), spark))
        if len(tables) < 6:
            assert tables[-1].columns == docs.columns
    read = lambda t: {r.doc_id: r.text for r in t.collect()}
    start, clean, ones, cut = map(read, tables[:4])

    toxic = {r.doc_id for r in toxicity.score_documents(docs, spark.read.parquet(f"{DIR}/labels.parquet")).collect() if r.toxic}
    assert clean == {i: t for i, t in start.items() if i not in toxic}

    sets = {i: grams(t, jaccard.N) for i, t in clean.items() if words(t)}
    group = {i: {i} for i in clean}
    for a in sets:
        for b in sets:
            if a < b and group[a] is not group[b] and len(sets[a] & sets[b]) >= jaccard.THRESHOLD * len(sets[a] | sets[b]):
                group[a] |= group[b]
                for i in group[b]:
                    group[i] = group[a]
    assert ones == {i: clean[i] for i in clean if min(group[i]) == i}

    gone = covered(list(ones.items()))
    want = {i: [w for k, w in enumerate(words(t)) if (i, k) not in gone] for i, t in ones.items()}
    assert {i: words(t) for i, t in cut.items()} == {i: w for i, w in want.items() if w or not words(ones[i])}
    assert all(cut[i] == t for i, t in ones.items() if not any((i, k) in gone for k in range(len(words(t)))))

    copies = {r.doc_id: r.copies for r in mixing.rates(tables[3]).collect()}
    mixed = collections.Counter(r.doc_id for r in tables[4].collect())
    assert mixed == +collections.Counter(copies)

    placed, fill = collections.Counter(), collections.Counter()
    for r in tables[5].collect():
        placed[r.doc_id] += r.n_tokens
        fill[r.bin_id] += r.n_tokens
    assert placed == +collections.Counter({i: n * len(cut[i].split()) for i, n in mixed.items()}) and max(fill.values()) <= 2048

    key = lambda t: sorted(map(tuple, t.select("doc_id", "copy_no", "piece_no", "n_tokens").collect()))
    assert key(corpus_pipeline.run(spark, DIR)) == key(tables[5])
