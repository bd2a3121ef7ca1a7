"""Operator 6, toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

Each word enters by word inputs (a learnt embedding of its hash, the smoothed log-odds of it between toxic and clean documents of the training sample, how far that
is known, its length) and character inputs (the mean of the learnt embeddings of its character 3- to 5-grams, borders included, and the mean, largest and least of their
log-odds). A GRU reads each window of 32 words in both directions, attention pools its states, and a logistic unit gives the window's score. Network and embeddings are
trained together by backpropagation. Windows start every 16 words and cover the whole text, and every 4 words around the highest of them; a document's score is its
highest window's.

The classifier is fitted on the driver to a bounded sample of labelled documents: at most `toxic_docs` toxic and `clean_docs` clean ones
(those with the least hash of doc_id). A toxic document says nothing of where it is toxic, so its training window is the one with the most evidence, chosen again by
the network after each round. A fifth of the sample is held out for the threshold, together with the documents over `train_chars` characters (up to `most_chars`), which don't train;
each kind weighs there by its share of all labels. Scoring covers every document whole.

Defined results
- Null and empty texts and texts without a word: score 0, no windows, not toxic. Rows without doc_id are scored as well.
- One row for each row of the input, repeated rows and ids included; other columns are ignored; an empty table gives no rows.
- Without labels of both kinds nothing can be learnt: every score is 0.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylvaspark.llm import shared, textkit

T, STRIDE, FINE, H, SLOTS = 32, 16, 4, 8, 1 << 18
EMBEDDED, EW, EC = 1 << 14, 8, 4
EMBEDDING_RATE = 0.005
TOXIC_DOCS, CLEAN_DOCS, TRAIN_CHARS, MOST_CHARS = 1000, 2000, 10_000, 1_000_000
SCHEMA = "doc_id long, score double, n_windows int, toxic boolean"


# ---- inputs
def _distinct(words: textkit.Words) -> tuple[np.ndarray, np.ndarray]:
    """(index of one occurrence of each distinct word, number of the distinct word of each word)."""
    _, first, inverse = np.unique(words.hash, return_index=True, return_inverse=True)
    return first, inverse


def _ngrams(words: textkit.Words, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the character n-grams of the words at those indices, and ptr."""
    size = words.end[at] - words.start[at] + 2
    ptr = np.concatenate(([0], np.cumsum(size)))
    raw = np.full(ptr[-1], 1, np.uint64)
    inner = np.ones(ptr[-1], bool)
    inner[ptr[:-1]] = inner[ptr[1:] - 1] = False
    byte = np.arange(ptr[-1]) - np.repeat(ptr[:-1], size) - 1 + np.repeat(words.start[at], size)
    raw[inner] = textkit.LOWER[words.data[byte[inner]]]
    left = np.repeat(ptr[1:], size) - np.arange(ptr[-1])
    word = np.repeat(np.arange(len(at)), size)
    slots, owner = [], []
    for n in (3, 4, 5):
        h = textkit.window_hash(raw + np.uint64(n * 1000), n)
        ok = np.flatnonzero(left[: len(h)] >= n)
        slots.append((h[ok] % np.uint64(SLOTS)).astype(np.int64))
        owner.append(word[ok])
    slots, owner = np.concatenate(slots), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return slots[order], np.searchsorted(owner[order], np.arange(len(at) + 1))


def _slot(h: np.ndarray) -> np.ndarray:
    return (h % np.uint64(SLOTS)).astype(np.int64)


def _evidence(words: textkit.Words, first: np.ndarray, tables: dict):
    """Fixed inputs of the words at those indices; their word slots, and the slots and ptr of their character n-grams."""
    slots, ptr = _ngrams(words, first)  # each word has one 3-gram at least
    v = tables["char"][slots]
    w = _slot(words.hash[first])
    size = np.diff(ptr)
    cols = [tables["word"][w], tables["known"][w], np.add.reduceat(v, ptr[:-1]) / size, np.maximum.reduceat(v, ptr[:-1]) / 2, np.minimum.reduceat(v, ptr[:-1]) / 2, np.minimum(words.end[first] - words.start[first], 30) / 15]
    return np.stack(cols, axis=1).astype(np.float32), w % EMBEDDED, slots % EMBEDDED, ptr


def _embedded(fixed: np.ndarray, w: np.ndarray, slots: np.ndarray, ptr: np.ndarray, m: dict) -> np.ndarray:
    return np.concatenate((fixed, m["Ew"][w], np.add.reduceat(m["Ec"][slots], ptr[:-1], axis=0) / np.diff(ptr)[:, None].astype(np.float32)), axis=1)


def _inputs(words: textkit.Words, first: np.ndarray, fitted: dict, step: int = 20_000) -> np.ndarray:
    parts = [_embedded(*_evidence(words, first[s : s + step], fitted["tables"]), fitted["model"]) for s in range(0, len(first), step)]
    return np.concatenate(parts)


FIXED = 6
D = FIXED + EW + EC


def _log_odds(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int) -> np.ndarray:
    n = a + b
    lo = np.log((a + 0.5) / (n_a + 1)) - np.log((b + 0.5) / (n_b + 1))
    return (np.clip(lo, -3, 6) * n / (n + 6)).astype(np.float32)


def tables_of(words: textkit.Words, toxic: np.ndarray) -> dict:
    """Log-odds by slot. Near copies in the sample count once: a document adds nothing if it shares the least 4-gram hash with an earlier one."""
    g, ptr = textkit.grams(words, 4)
    seen, fresh = set(), np.zeros(len(toxic), bool)
    for d in range(len(toxic)):
        if ptr[d + 1] > ptr[d]:
            low = int(g[ptr[d] : ptr[d + 1]].min())
            fresh[d] = low not in seen
            seen.add(low)
    first, inverse = _distinct(words)
    slots, nptr = _ngrams(words, first)
    count = {k: np.zeros((2, SLOTS)) for k in ("word", "char")}
    w = _slot(words.hash[first])
    for d in np.flatnonzero(fresh):
        own = np.unique(inverse[words.ptr[d] : words.ptr[d + 1]])
        count["word"][int(toxic[d])][np.unique(w[own])] += 1
        size = nptr[own + 1] - nptr[own]
        at = np.arange(size.sum()) + np.repeat(nptr[own] - np.concatenate(([0], np.cumsum(size)[:-1])), size)
        count["char"][int(toxic[d])][np.unique(slots[at])] += 1
    n_a, n_b = int((fresh & toxic).sum()), int((fresh & ~toxic).sum())
    out = {k: _log_odds(c[1], c[0], n_a, n_b) for k, c in count.items()}
    n = count["word"].sum(axis=0)
    return out | {"known": (n / (n + 6)).astype(np.float32)}


def window_starts(count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, first word in it) of all windows: every STRIDE words, the last one at the end of the text."""
    many = np.where(count > 0, np.maximum(-(-(count - T) // STRIDE), 0) + 1, 0)
    doc = np.repeat(np.arange(len(count)), many)
    at = (np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)) * STRIDE
    return doc, np.minimum(at, np.maximum(count[doc] - T, 0))


# ---- the network
def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def new_model(rng) -> dict:
    m = {}
    for d in "fb":
        m["W" + d] = rng.normal(0, 0.4, (D, 3 * H))
        m["U" + d] = rng.normal(0, 0.25, (H, 3 * H))
        m["c" + d] = np.zeros(3 * H)
    m |= {"A": rng.normal(0, 0.3, (2 * H, H)), "a": np.zeros(H), "v": rng.normal(0, 0.5, H), "u": rng.normal(0, 0.3, 2 * H), "o": np.zeros(1)}
    return {k: x.astype(np.float32) for k, x in m.items()}


def new_embeddings(rng) -> dict:
    return {"Ew": rng.normal(0, 0.05, (EMBEDDED, EW)).astype(np.float32), "Ec": rng.normal(0, 0.05, (EMBEDDED, EC)).astype(np.float32)}


def _gru(x: np.ndarray, u: np.ndarray, mask, steps, keep: list | None) -> np.ndarray:
    """x (T, B, 3H), projected inputs -> states (T, B, H) in the order of the words."""
    h = np.zeros((x.shape[1], H), np.float32)
    out = np.empty((x.shape[0], x.shape[1], H), np.float32)
    for t in steps:
        p = h @ u
        zr = _sigmoid(x[t, :, : 2 * H] + p[:, : 2 * H])
        z, r = zr[:, :H], zr[:, H:]
        n = np.tanh(x[t, :, 2 * H :] + r * p[:, 2 * H :])
        new = n + z * (h - n)
        if mask is not None:
            new = np.where(mask[t][:, None], new, h)
        if keep is not None:
            keep.append((t, h, z, r, n, p[:, 2 * H :]))
        out[t] = h = new
    return out


def forward(m: dict, xf: np.ndarray, xb: np.ndarray, mask, keep: dict | None = None) -> np.ndarray:
    """Logits of windows from projected inputs of both directions; mask (T, B) or None for full windows."""
    kf, kb = ([], []) if keep is not None else (None, None)
    s = np.concatenate((_gru(xf, m["Uf"], mask, range(len(xf)), kf), _gru(xb, m["Ub"], mask, range(len(xb) - 1, -1, -1), kb)), axis=2)
    e = np.tanh(s @ m["A"] + m["a"])
    score = e @ m["v"]
    if mask is not None:
        score = np.where(mask, score, -1e9)
    w = np.exp(score - score.max(axis=0))
    w /= w.sum(axis=0)
    pooled = np.einsum("tb,tbh->bh", w, s)
    if keep is not None:
        keep |= {"f": kf, "b": kb, "s": s, "e": e, "w": w, "pooled": pooled}
    return pooled @ m["u"] + m["o"]


def gradients(m: dict, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[float, dict, np.ndarray]:
    """Mean logistic loss of windows x (T, B, D), its gradients, and those of x."""
    k: dict = {}
    logit = forward(m, x @ m["Wf"] + m["cf"], x @ m["Wb"] + m["cb"], mask, k)
    p = _sigmoid(logit)
    loss = float(np.mean(np.logaddexp(0, logit) - y * logit))
    d = ((p - y) / len(y)).astype(np.float32)
    g = {"u": k["pooled"].T @ d, "o": d.sum(keepdims=True)}
    dp = d[:, None] * m["u"]
    ds = k["w"][..., None] * dp
    dw = np.einsum("tbh,bh->tb", k["s"], dp)
    dscore = k["w"] * (dw - (k["w"] * dw).sum(axis=0))
    g["v"] = np.einsum("tb,tbh->h", dscore, k["e"])
    de = dscore[..., None] * m["v"] * (1 - k["e"] ** 2)
    g["A"], g["a"] = np.einsum("tbi,tbj->ij", k["s"], de), de.sum(axis=(0, 1))
    ds = ds + de @ m["A"].T
    dx = np.zeros_like(x)
    for name, part in (("f", slice(0, H)), ("b", slice(H, 2 * H))):
        dh = np.zeros((x.shape[1], H), np.float32)
        gw, gu, gc = np.zeros((D, 3 * H)), np.zeros((H, 3 * H)), np.zeros(3 * H)
        for t, h, z, r, n, q in reversed(k[name]):
            dh = dh + ds[t, :, part]
            live = mask[t][:, None]
            dn = dh * (1 - z) * (1 - n * n) * live
            dz, dr = dh * (h - n) * z * (1 - z) * live, dn * q * r * (1 - r)
            pre, rec = np.concatenate((dz, dr, dn), axis=1), np.concatenate((dz, dr, dn * r), axis=1)
            gw += x[t].T @ pre
            dx[t] += pre @ m["W" + name].T
            gc += pre.sum(axis=0)
            gu += h.T @ rec
            dh = np.where(live, dh * z, dh) + rec @ m["U" + name].T
        g |= {"W" + name: gw, "U" + name: gu, "c" + name: gc}
    return loss, g, dx


def embedding_gradients(dx: np.ndarray, word: np.ndarray, mask: np.ndarray, w: np.ndarray, slots: np.ndarray, ptr: np.ndarray):
    """From the gradients of the inputs of distinct words `word` (T, B): (slots, gradients) of the word embeddings and of the character embeddings."""
    own, at = np.unique(word[mask], return_inverse=True)
    d = np.zeros((len(own), EW + EC), np.float32)
    np.add.at(d, at, dx[mask][:, FIXED:])
    size = ptr[own + 1] - ptr[own]
    part = np.arange(size.sum()) + np.repeat(ptr[own] - np.concatenate(([0], np.cumsum(size)[:-1])), size)
    out = []
    for slot, grad in ((w[own], d[:, :EW]), (slots[part], np.repeat(d[:, EW:] / size[:, None], size, axis=0))):
        u, k = np.unique(slot, return_inverse=True)
        g = np.zeros((len(u), grad.shape[1]), np.float32)
        np.add.at(g, k, grad)
        out.append((u, g))
    return out


def _gather(inputs: np.ndarray, inverse: np.ndarray, ptr: np.ndarray, count: np.ndarray, doc: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    step = np.arange(T)[:, None]
    mask = step < np.minimum(count[doc], T)
    word = inverse[np.where(mask, ptr[doc] + at + step, ptr[doc] + at)]
    return inputs[word], mask, word


def threshold(yes: np.ndarray, no: np.ndarray, share: float) -> tuple[float, float]:
    """(cut, F1) with the best F1 where toxic documents are that share of all: the middle of the best cuts."""
    cuts = np.unique(np.concatenate((yes, no)))
    cuts = (cuts[1:] + cuts[:-1]) / 2 if len(cuts) > 1 else cuts
    tp, fp = 1 - np.searchsorted(np.sort(yes), cuts) / len(yes), 1 - np.searchsorted(np.sort(no), cuts) / max(len(no), 1)
    f1 = 2 * tp * share / (tp * share + fp * (1 - share) + share)
    good = cuts[f1 >= f1.max() - 1e-9]
    return float((good[0] + good[-1]) / 2), float(f1.max())


def train(texts: list, toxic: np.ndarray, rounds: int = 3, steps: int = 120, batch: int = 192, seed: int = 5, long_texts: tuple = (), long_toxic: tuple = (), share: float | None = None) -> dict | None:
    """Model, tables and threshold, from texts and their labels; long texts count for the threshold only. `share`: of toxic documents among all labels."""
    words = textkit.Words(pa.array(texts, pa.large_string()))
    rng = np.random.default_rng(seed)
    held = rng.random(len(toxic)) < 0.2
    held &= words.count > 0
    use = (words.count > 0) & ~held
    if not (use & toxic).any() or not (use & ~toxic).any():
        return None
    fit = textkit.Words(pa.array([t for t, k in zip(texts, use) if k], pa.large_string()))
    tables = tables_of(fit, toxic[use])
    first, inverse = _distinct(words)
    fixed, w, slots, ptr = _evidence(words, first, tables)
    m, state, n = new_model(rng), {}, 0
    emb = new_embeddings(rng)
    moved = {k: np.full((EMBEDDED, 1), 1e-8, np.float32) for k in emb}
    inputs = _embedded(fixed, w, slots, ptr, emb)
    doc, at = window_starts(words.count)
    x_of = lambda i: _gather(inputs, inverse, words.ptr, words.count, doc[i], at[i])
    top = np.concatenate([np.where((k := x_of(np.arange(s, min(s + 8192, len(doc)))))[1], k[0][..., 0] + k[0][..., 2], -9).max(axis=0) for s in range(0, len(doc), 8192)])
    negative = np.flatnonzero(~toxic[doc] & use[doc])
    bounds = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
    for r in range(rounds):
        best = np.array([s + int(top[s:e].argmax()) for s, e in zip(bounds, np.append(bounds[1:], len(doc)))])
        positive = best[toxic[doc[best]] & use[doc[best]]]
        hard = negative[np.argsort(-top[negative])[: max(batch, len(negative) // 20)]]
        for _ in range(steps):
            i = np.concatenate((rng.choice(positive, batch // 2), rng.choice(negative, batch // 4), rng.choice(hard, batch // 4)))
            _, mask, word = x_of(i)
            seen = np.unique(word)
            size = ptr[seen + 1] - ptr[seen]
            part = np.arange(size.sum()) + np.repeat(ptr[seen] - np.concatenate(([0], np.cumsum(size)[:-1])), size)
            inputs[seen] = _embedded(fixed[seen], w[seen], slots[part], np.concatenate(([0], np.cumsum(size))), emb)
            _, g, dx = gradients(m, inputs[word], mask, toxic[doc[i]].astype(np.float32))
            for k, (at_slot, grad) in zip(("Ew", "Ec"), embedding_gradients(dx, word, mask, w, slots, ptr)):
                moved[k][at_slot] += (grad**2).mean(axis=1, keepdims=True)
                emb[k][at_slot] -= EMBEDDING_RATE * grad / np.sqrt(moved[k][at_slot])
            n += 1
            rate = 0.02 * min(1, n / 20) * (1 - 0.8 * n / (rounds * steps))
            for k, v in g.items():
                a, b = state.get(k, (0, 0))
                state[k] = a, b = 0.9 * a + 0.1 * v, 0.99 * b + 0.01 * v * v
                m[k] = (m[k] - rate * (a / (1 - 0.9**n)) / (np.sqrt(b / (1 - 0.99**n)) + 1e-6)).astype(np.float32)
        inputs = _embedded(fixed, w, slots, ptr, emb)
        top = np.concatenate([_logits(m, *x_of(np.arange(s, min(s + 4096, len(doc))))[:2]) for s in range(0, len(doc), 4096)])
    fitted = {"model": m | emb, "tables": tables}
    judge = np.flatnonzero(held if (held & toxic).sum() >= 20 else words.count > 0)
    best = scores(fitted, textkit.Words(pa.array([texts[i] for i in judge], pa.large_string())))[0]
    long = [scores(fitted, textkit.Words(pa.array([t], pa.large_string())))[0][0] for t in long_texts]
    best, kind = np.append(best, long), np.append(toxic[judge], np.array(long_toxic, bool))
    best, kind = best[np.isfinite(best)], kind[np.isfinite(best)]
    cut, f1 = threshold(best[kind], best[~kind], toxic.mean() if share is None else share)
    return fitted | {"cut": cut, "held_f1": f1, "held": len(best)}


def _logits(m: dict, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
    return forward(m, x @ m["Wf"] + m["cf"], x @ m["Wb"] + m["cb"], None if mask.all() else mask)


def scores(fitted: dict, words: textkit.Words) -> tuple[np.ndarray, np.ndarray]:
    """(logit of the highest window, number of windows that cover it) of each text."""
    m = fitted["model"]
    n_docs = len(words.count)
    best = np.full(n_docs, -np.inf)
    doc, at = window_starts(words.count)
    if len(doc):
        first, inverse = _distinct(words)
        inputs = _inputs(words, first, fitted)
        pf, pb = inputs @ m["Wf"] + m["cf"], inputs @ m["Wb"] + m["cb"]
        step = np.arange(T)[:, None]

        def logits(doc: np.ndarray, at: np.ndarray) -> np.ndarray:
            out = np.empty(len(doc), np.float32)
            full = words.count[doc] >= T
            for kind in (np.flatnonzero(full), np.flatnonzero(~full)):
                for s in range(0, len(kind), 2048):
                    i = kind[s : s + 2048]
                    base = words.ptr[doc[i]] + at[i]
                    if full[i[0]]:
                        rows, mask = inverse[base + step], None
                    else:
                        mask = step < words.count[doc[i]]
                        rows = inverse[np.where(mask, base + step, base)]
                    out[i] = forward(m, pf[rows], pb[rows], mask)
            return out

        top = logits(doc, at)
        np.maximum.at(best, doc, top)
        order = np.lexsort((-top, doc))
        lead = order[np.concatenate(([True], doc[order][1:] != doc[order][:-1]))]
        lead = lead[words.count[doc[lead]] > T]
        near = np.arange(-STRIDE + FINE, STRIDE, FINE)
        near = near[near != 0]
        fine, around = np.repeat(doc[lead], len(near)), (at[lead][:, None] + near).reshape(-1)
        ok = (around >= 0) & (around <= words.count[fine] - T)
        if ok.any():
            np.maximum.at(best, fine[ok], logits(fine[ok], around[ok]))
    return best, np.bincount(doc, minlength=n_docs)


def _score(fitted: dict | None):
    @shared.released
    def score(batches):
        for b in batches:
            texts, ids = b.column("text"), b.column("doc_id")
            for at, to in textkit.slices(texts, 4 << 20):
                if fitted is None:
                    best, many = np.full(to - at, -np.inf), window_starts(textkit.Words(texts.slice(at, to - at)).count)[0]
                    many = np.bincount(many, minlength=to - at)
                else:
                    best, many = scores(fitted, textkit.Words(texts.slice(at, to - at)))
                with np.errstate(over="ignore"):
                    p = 1 / (1 + np.exp(-(best - (fitted["cut"] if fitted else 0))))
                yield pa.RecordBatch.from_arrays([ids.slice(at, to - at), pa.array(p), pa.array(many.astype(np.int32)), pa.array(p > 0.5)], ["doc_id", "score", "n_windows", "toxic"])

    return score


def fit(docs: DataFrame, labels: DataFrame, toxic_docs: int = TOXIC_DOCS, clean_docs: int = CLEAN_DOCS, train_chars: int = TRAIN_CHARS, most_chars: int = MOST_CHARS) -> dict | None:
    """Trains on the bounded sample of labelled documents; None if a kind is missing."""
    labels = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic is not null")
    share = labels.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0]
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    sample = labels.where("toxic = 1").orderBy(*order).limit(toxic_docs).unionByName(labels.where("toxic = 0").orderBy(*order).limit(clean_docs))
    text = shared.documents(docs, "doc_id", "text").where(F.col("text").isNotNull() & (F.length("text") <= most_chars))
    rows = text.join(F.broadcast(sample), "doc_id").select("doc_id", "text", "toxic").toPandas().sort_values(["doc_id", "text"]).drop_duplicates("doc_id")
    if not len(rows):
        return None
    long = rows["text"].str.len() > train_chars
    short, long = rows[~long], rows[long]
    return train(short["text"].tolist(), short["toxic"].to_numpy() == 1, long_texts=tuple(long["text"]), long_toxic=tuple(long["toxic"] == 1), share=share)


def score_documents(docs: DataFrame, labels: DataFrame, **bounds) -> DataFrame:
    """(doc_id, score, n_windows, toxic) of documents (doc_id, text), with a classifier fitted to labels (doc_id, toxic)."""
    fitted = fit(docs, labels, **bounds)
    return shared.documents(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(_score(fitted), SCHEMA)
