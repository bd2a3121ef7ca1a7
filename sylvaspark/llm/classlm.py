"""Operator 2, LM scoring by Brown class-based bigrams.

1. Word counts over all documents. All words seen `LEAST` times are modelled one by one (or the `vocabulary` most frequent, if that is given); every other word
   belongs to a rare class by its length in bytes, where each of its types is equally likely.
2. Exchange clustering of the `core` (the most frequent words) from their counts next to each other: words move between classes while that raises the likelihood of the class bigrams.
3. Counts of each vocabulary word before and after each class, over all documents, as a table of one row a word; each word beyond the core joins the class that it fits best by the
   same gain. Twice: first the neighbours with a class are those of the core, the rare classes and the border, then all of them are.
4. Class bigram counts over all documents give transitions, interpolated with the class unigrams; word counts give emissions.
5. Each document's log-likelihood and perplexity.

Defined results
- A word is a run of letters and digits, ASCII case apart; each document starts at the border symbol.
- Null and empty texts and texts without a word: n_words 0, log_prob 0, perplexity null. One row for each row of the input, repeated rows
  and null ids included (and repeated rows count as often as they come); other columns are ignored; an empty table gives no rows.
- Words equally frequent rank by their hash, so the result doesn't depend on the partitions.
Vocabulary, classes and core follow from the counts: classes grow with the power 0.3 of the vocabulary from 48, the core is ten words a class, from 512.
The vocabulary and its classes are tables in the shared folder. Tasks read them, and hold hashes with their starts, counts, classes and emissions (40 bytes a word); the driver holds what
follows from the number of classes only: counts of the core (core * core at most) and of class bigrams, and transitions.
"""

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sylvaspark.llm import shared, textkit

LEAST, CORE, CLASSES, RARE, SWEEPS, ROUNDS, LAMBDA = 5, 512, 48, 8, 8, 2, 0.9


def _summed(parts: list) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    u, inverse = np.unique(keys, return_inverse=True)
    return u, np.bincount(inverse, counts, len(u)).astype(np.int64)


def _emit(parts: list, names: list[str], split):
    if parts:
        keys, counts = _summed(parts)
        for s in range(0, len(keys), 1 << 18):
            e = slice(s, s + (1 << 18))
            yield pa.RecordBatch.from_arrays([*map(pa.array, split(keys[e])), pa.array(counts[e])], names)


def _columns(df: DataFrame) -> list[np.ndarray]:
    """A small table's columns on the driver, without an object for each row."""
    return [c.combine_chunks().to_numpy(zero_copy_only=False) for c in df.toArrow().columns]


def _written(df: DataFrame, spark: SparkSession) -> str:
    path = shared.shared_dir(spark)
    df.write.parquet(path)
    return path


def _read(path: str, **columns: pa.DataType) -> list[np.ndarray]:
    """The columns of a table in the shared folder."""
    fs, root = pafs.FileSystem.from_uri(path)
    files = [f.path for f in fs.get_file_info(pafs.FileSelector(root)) if f.path.endswith(".parquet")]
    t = ds.dataset(files, filesystem=fs, format="parquet", schema=pa.schema(list(columns.items()))).to_table()
    return [t.column(c).to_numpy() for c in columns]


def _loaded(model: dict) -> dict:
    """The model with its vocabulary, counts n and classes, from the shared folder. A word without a class has -1 while the classes are being made."""
    word, n = _read(model["words"], word=pa.int64(), n=pa.int64())
    word = word.view(np.uint64)
    order = np.argsort(word)
    vocab, of = word[order], np.full(len(word), -1)
    of[np.searchsorted(vocab, model["core"])] = model["core_class"]
    for path in model["assigned"]:
        at, k = _read(path, word=pa.int32(), **{"class": pa.int32()})
        of[at] = k
    return model | {"vocab": vocab, "starts": _starts(vocab), "n": n[order], "class": np.maximum(of, 0) if model["whole"] else of}  # 0: a word without any neighbour


def _with_emissions(model: dict) -> dict:
    model, classes = _loaded(model), model["classes"]
    in_class = np.bincount(model["class"], minlength=classes)
    members = np.bincount(model["class"], model["n"], classes)
    if len(model["vocab"]):
        model["emit"] = np.log(model["n"] + 0.5) - np.log(members + 0.5 * in_class)[model["class"]]
    else:
        model["emit"] = np.zeros(0)
    return model


def _counting(prepare, names: list[str], split, most: int = 1 << 20):
    """Counts of the codes that codes(words) yields, summed inside a partition while they fit; a task makes codes by prepare()."""

    @shared.released
    def counting(batches):
        parts, held, codes = [], 0, prepare()
        for b in batches:
            for at, to in textkit.slices(b.column("text")):
                c = codes(textkit.Words(b.column("text").slice(at, to - at)))
                u, n = np.unique(c, return_counts=True)
                parts.append((u, n))
                held += len(u)
                if held > 2 * most:
                    parts = [_summed(parts)]
                    held = len(parts[0][0])
                    if held > most:
                        yield from _emit(parts, names, split)
                        parts, held = [], 0
        yield from _emit(parts, names, split)

    return counting


def _length_class(words: textkit.Words) -> np.ndarray:
    return np.minimum((words.end - words.start - 1) // 3, RARE - 1)


def _neighbours(words: textkit.Words) -> np.ndarray:
    """Whether each word has a word of the same text before it."""
    inner = np.ones(len(words.hash), bool)
    inner[words.ptr[:-1][words.count > 0]] = False
    return inner


def _gain(N: np.ndarray, r: np.ndarray, l: np.ndarray, s) -> np.ndarray:
    """Gain of log-likelihood from adding a word with right and left class counts r, l and s bigrams with itself to each class. Leading axes are words."""
    f = lambda x: x * np.log(np.maximum(x, 1e-300))
    diagonal = lambda x: np.diagonal(x, axis1=-2, axis2=-1)
    total = lambda x: x.sum(axis=-1, keepdims=True)
    s = np.asarray(s)[..., None]
    rows, cols, diag = N.sum(axis=-1), N.sum(axis=-2), diagonal(N)
    fixed = total(f(rows)) - total(f(rows + l)) + total(f(cols)) - total(f(cols + r))  # the neighbours' classes gain whatever the word's class
    rows, cols = rows + l, cols + r
    a, b = f(N + r[..., None, :]) - f(N), f(N + l[..., :, None]) - f(N)
    out = a.sum(axis=-1) - diagonal(a) + b.sum(axis=-2) - diagonal(b) + f(diag + r + l + s) - f(diag)
    return out + fixed - f(rows + total(r) + s) + f(rows) - f(cols + total(l) + s) + f(cols)


def exchange(n: np.ndarray, classes: int, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of each word from the counts n[v, w] of v before w; words start in turn, in order of frequency."""
    words = len(n)
    of = np.arange(words) % classes
    M = np.eye(classes)[of]
    N = M.T @ n @ M
    order = np.argsort(-(n.sum(axis=0) + n.sum(axis=1)), kind="stable")
    for _ in range(sweeps):
        moved = 0
        for w in order:
            k = of[w]
            out, back = n[w].copy(), n[:, w].copy()
            s, out[w], back[w] = n[w, w], 0, 0
            r, l = np.bincount(of, out, classes), np.bincount(of, back, classes)
            N[k] -= r
            N[:, k] -= l
            N[k, k] -= s
            gain = _gain(N, r, l, s)
            best = int(gain.argmax())
            if gain[best] <= gain[k] + 1e-9:
                best = k
            moved += best != k
            of[w] = best
            N[best] += r
            N[:, best] += l
            N[best, best] += s
        if not moved:
            break
    return of


def _beside(docs: DataFrame, model: dict) -> DataFrame:
    """(word, near): of each vocabulary word, counts (code, n) of its neighbours' classes, before it, after it and of itself. Neighbours without a class are left out."""
    total = model["classes"] + RARE + 1

    def prepare():
        whole = _loaded(model)

        def codes(w):
            i, c = _classes_of(whole, w)
            before, inner = _before(whole, w, c), np.flatnonzero(_neighbours(w))
            same = np.zeros(len(i), bool)
            same[inner] = (i[inner] == i[inner - 1]) & (i[inner] >= 0)
            at = np.flatnonzero((i >= 0) & (before >= 0) & ~same)
            to = inner[(i[inner - 1] >= 0) & (c[inner] >= 0) & ~same[inner]]
            return np.concatenate((i[at] * 3 * total + before[at], (i[to - 1] * 3 + 1) * total + c[to], (i[same] * 3 + 2) * total))

        return codes

    split = lambda k: ((k // (3 * total)).astype(np.int32), (k % (3 * total)).astype(np.int32))
    rows = docs.mapInArrow(_counting(prepare, ["word", "code", "n"], split), "word int, code int, n long")
    return rows.groupBy("word").agg(F.collect_list(F.struct("code", "n")).alias("near"))


def _near(batch, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Words, and their counts as [word, side, class]."""
    near = batch.column("near")
    code, n = near.flatten().flatten()
    row = np.repeat(np.arange(len(near)), np.diff(near.offsets.to_numpy()))
    x = np.bincount(row * 3 * total + code.to_numpy(), n.to_numpy(), len(near) * 3 * total)
    return batch.column("word").to_numpy(), x.reshape(len(near), 3, total)


def _class_counts(model: dict):
    """Bigrams of classes of which at least one word is of the vocabulary."""
    classes = model["classes"]
    total = classes + RARE + 1

    @shared.released
    def counts(batches):
        of = _loaded(model)["class"]
        N = np.zeros((total, total))
        for b in batches:
            word, x = _near(b, total)
            has = of[word] >= 0
            k, x = of[word[has]], x[has]
            np.add.at(N.T, k, x[:, 0])
            x[:, 1, :classes] = 0  # counted before the other word
            np.add.at(N, k, x[:, 1])
            np.add.at(N, (k, k), x[:, 2, 0])
        at = np.flatnonzero(N)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(N.ravel()[at])], ["code", "n"])

    return counts


def _assigned(model: dict, N: np.ndarray, last: bool, step: int = 128):
    """(word, class): the class that each word that isn't fixed fits best, once taken out of its own. Before the last round, words without a neighbour in a class wait."""

    classes = model["classes"]

    @shared.released
    def assigned(batches):
        whole = _loaded(model)
        of, fixed = whole["class"], np.zeros(len(whole["vocab"]), bool)
        fixed[np.searchsorted(whole["vocab"], model["core"])] = True
        for b in batches:
            words, near = _near(b, len(N))
            keep = ~fixed[words] & (last | near[:, :2, :classes].any(axis=(1, 2)))
            words, near = words[keep], near[keep]
            best = np.zeros(len(words), np.int32)
            for at in range(0, len(words), step):
                l, r, s = near[at : at + step, 0], near[at : at + step, 1], near[at : at + step, 2, 0]
                own = of[words[at : at + step]]
                i = np.flatnonzero(own >= 0)
                k = own[i]
                M = np.repeat(N[None], len(own), axis=0)
                M[i, k] -= r[i]
                M[i, :, k] -= l[i]
                M[i, k, k] -= s[i]
                best[at : at + step] = _gain(M, r, l, s)[:, :classes].argmax(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(words.astype(np.int32)), pa.array(best)], ["word", "class"])

    return assigned


def _fitted(docs: DataFrame, vocabulary: int | None = None, core: int | None = None, classes: int | None = None) -> dict:
    """Counts the corpus and returns the model, whose vocabulary is in the shared folder; its size follows from the counts where none is given."""
    docs = shared.documents(docs, "text")
    spark = SparkSession.active()
    of_length = lambda w: w.hash & ~np.uint64(RARE - 1) | _length_class(w).astype(np.uint64)
    counts = docs.mapInArrow(_counting(lambda: of_length, ["word", "n"], lambda k: (textkit.signed(k),)), "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = shared.persist_shared(counts, spark)
    words = _written(counts.where(F.col("n") >= LEAST) if vocabulary is None else counts.orderBy(F.desc("n"), "word").limit(vocabulary), spark)
    frequent = spark.read.schema(counts.schema).parquet(words)
    rare, V = np.zeros(RARE, np.int64), 0
    for df, sign in ((counts, 1), (frequent, -1)):
        for k, types in df.groupBy(F.col("word").bitwiseAND(RARE - 1).alias("k")).count().collect():
            rare[k] += sign * types
            V += types if df is frequent else 0
    shared.forget(counts, spark)
    classes = max(CLASSES, round(V**0.3)) if classes is None else classes
    core = min(max(CORE, 10 * classes) if core is None else core, V)
    classes = max(1, min(classes, core))
    top = np.array([r.word for r in frequent.orderBy(F.desc("n"), "word").limit(core).collect()], np.int64).view(np.uint64)
    by_hash = np.argsort(top)
    sorted_top = top[by_hash]

    def pairs(w):
        i = _lookup_key(w, sorted_top)
        at = np.flatnonzero(_neighbours(w))
        a, b = i[at - 1], i[at]
        ok = (a >= 0) & (b >= 0)
        return by_hash[a[ok]] * core + by_hash[b[ok]]

    def counted(codes, rows: int) -> np.ndarray:
        code, n = _columns(codes.groupBy("code").agg(F.sum("n").alias("n")))
        out = np.zeros(rows)
        out[code] = n
        return out

    total = classes + RARE + 1  # the last one is the border
    model = {"words": words, "core": top, "core_class": np.zeros(0, np.int64), "assigned": [], "whole": False, "classes": classes}
    if core:
        m = counted(docs.mapInArrow(_counting(lambda: pairs, ["code", "n"], lambda k: (k,)), "code long, n long"), core * core)
        model["core_class"] = exchange(m.reshape(core, core), classes)
        for k in range(ROUNDS if V > core else 0):
            beside = shared.persist_shared(_beside(docs, model), spark)
            N = counted(beside.mapInArrow(_class_counts(model), "code long, n double"), total * total).reshape(total, total)
            path = _written(beside.mapInArrow(_assigned(model, N, k == ROUNDS - 1), "word int, class int"), spark)
            shared.forget(beside, spark)
            model = model | {"assigned": [*model["assigned"], path]}
    model = model | {"whole": True}

    def prepare():
        whole = _loaded(model)
        return lambda w: _bigrams(whole, w)

    B = counted(docs.mapInArrow(_counting(prepare, ["code", "n"], lambda k: (k,)), "code long, n long"), total * total).reshape(total, total)
    unigram = (B.sum(axis=0) + 0.5) / (B.sum() + 0.5 * total)
    seen = B.sum(axis=1, keepdims=True)
    transit = np.log(np.where(seen > 0, LAMBDA * B / np.maximum(seen, 1), LAMBDA * unigram) + (1 - LAMBDA) * unigram)
    return model | {"rare": -np.log(np.maximum(rare, 1).astype(float)), "transit": transit}


def fit(docs: DataFrame, **sizes) -> dict:
    """The model of _fitted() with its vocabulary, classes and emissions in memory."""
    return _with_emissions(_fitted(docs, **sizes))


def _starts(vocab: np.ndarray) -> np.ndarray:
    """The place of the first of the sorted hashes with each value of their leading bits, about one hash a value."""
    bits = max(1, len(vocab).bit_length())
    return np.searchsorted(vocab, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)).astype(np.int32)


def _lookup_key(words: textkit.Words, vocab: np.ndarray, starts: np.ndarray | None = None) -> np.ndarray:
    """The place of each word in the vocabulary, or -1; with the vocabulary's _starts() in a few steps instead of a binary search."""
    key = words.hash & ~np.uint64(RARE - 1) | _length_class(words).astype(np.uint64)
    if not len(vocab):
        return np.full(len(key), -1)
    if starts is None:
        at = np.minimum(np.searchsorted(vocab, key), len(vocab) - 1)
        return np.where(vocab[at] == key, at, -1)
    at = starts[key >> np.uint64(65 - len(starts).bit_length())].astype(np.int64)
    ended = len(vocab) - 1
    np.minimum(at, ended, out=at)
    found = vocab[at]
    live = np.flatnonzero((found < key) & (at < ended))
    while len(live):
        at[live] += 1
        found[live] = vocab[at[live]]
        live = live[(found[live] < key[live]) & (at[live] < ended)]
    return np.where(found == key, at, -1)


def _classes_of(model: dict, words: textkit.Words) -> tuple[np.ndarray, np.ndarray]:
    i = _lookup_key(words, model["vocab"], model.get("starts"))
    known = model["class"][np.maximum(i, 0)] if len(model["vocab"]) else i
    return i, np.where(i >= 0, known, model["classes"] + _length_class(words))


def _bigrams(model: dict, words: textkit.Words) -> np.ndarray:
    _, c = _classes_of(model, words)
    return _before(model, words, c) * (model["classes"] + RARE + 1) + c


def _before(model: dict, words: textkit.Words, c: np.ndarray) -> np.ndarray:
    border = model["classes"] + RARE
    return np.where(_neighbours(words), np.concatenate(([border], c[:-1])), border) if len(c) else c


def log_probs(model: dict, words: textkit.Words) -> np.ndarray:
    """Log-likelihood of each text."""
    i, c = _classes_of(model, words)
    if not len(c):
        return np.zeros(len(words.count))
    emit = np.where(i >= 0, model["emit"][np.maximum(i, 0)] if len(model["vocab"]) else 0, model["rare"][np.minimum(np.maximum(c - model["classes"], 0), RARE - 1)])
    lp = np.concatenate(([0.0], np.cumsum(emit + model["transit"][_before(model, words, c), c])))
    return lp[words.ptr[1:]] - lp[words.ptr[:-1]]


def _score(model: dict):
    @shared.released
    def score(batches):
        whole = _with_emissions(model)
        for b in batches:
            texts, ids = b.column("text"), b.column("doc_id")
            for at, to in textkit.slices(texts):
                words = textkit.Words(texts.slice(at, to - at))
                lp, n = log_probs(whole, words), words.count
                ppl = np.exp(np.minimum(-lp / np.maximum(n, 1), 700))
                yield pa.RecordBatch.from_arrays([ids.slice(at, to - at), pa.array(n.astype(np.int64)), pa.array(lp), pa.array(ppl, mask=n == 0)], ["doc_id", "n_words", "log_prob", "perplexity"])

    return score


def perplexities(docs: DataFrame, **sizes) -> DataFrame:
    """(doc_id, n_words, log_prob, perplexity) of documents (doc_id, text) under the model of these same documents."""
    model = _fitted(docs, **sizes)
    return shared.documents(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(_score(model), "doc_id long, n_words long, log_prob double, perplexity double")
