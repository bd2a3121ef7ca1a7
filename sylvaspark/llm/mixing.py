"""Operator 5, mixing sources to target weights, by entropy balancing.

Documents get rates w with the least relative entropy, weighted by tokens, to keeping each document once, under linear token constraints:
each source has its target share of the tokens, each language keeps its share, and so does document length (the mean logarithm of a token's
document length). The solution is exponentially tilted: w = exp(source term + language term + length term * standardised log length). The terms solve
the convex dual, by Newton iterations whose gradients and Hessians are sums over all documents, made on the cluster, with step
halving. Rates are then rounded to whole copies: floor(w), and one more if a hash of doc_id in [0, 1) is below the rest.

Targets default to the square root of a source's share, normalised: hot sources shrink, small ones grow. The total of tokens stays.

Defined results
- Tokens are runs of non-blank characters. Documents without a token take no part in the constraints and are kept once (rate 1, 1 copy).
- A null source or language is a source or language of its own. A source that is given no target has target 0: rate 0, no copies.
- A target for a source that the table lacks is dropped and the others grow in proportion. A repeated row counts as often as it comes and gets the
  same number of copies each time; a null doc_id hashes like any value. An empty table gives no rows.
- Where the constraints can't all hold (say all of a language is in one source), the sources' targets hold and a small ridge
  decides the rest.
- Other columns are ignored.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sylvaspark.llm import shared, textkit

TOLERANCE, STEPS, RIDGE = 1e-9, 60, 1e-6


def _count_tokens(texts: pa.Array) -> pa.Array:
    """Starts of runs of bytes other than blank, tab, line feed, form feed, carriage return and vertical tab in each text; 0 for nulls."""
    out = [np.zeros(0, np.int64)]
    for at, to in textkit.slices(texts):
        data, offsets = textkit.buffers(texts.slice(at, to - at))
        solid = (data > 32) | ((data != 32) & ((data < 9) | (data > 13)))
        start = solid.copy()
        start[1:] &= ~solid[:-1]
        first = offsets[:-1][offsets[:-1] < offsets[1:]]
        start[first] = solid[first]
        out.append(np.diff(np.searchsorted(np.flatnonzero(start), offsets)))
    n = pa.array(np.concatenate(out), pa.int64())
    shared.release()
    return n


def tokens() -> "F.Column":
    """Number of runs of non-blank characters of `text`, counted batch by batch. It is declared nondeterministic, as else a filter on it counts once more."""
    return F.arrow_udf(_count_tokens, "long").asNondeterministic()(F.col("text"))


def weights_by_root(share: dict) -> dict:
    root = {k: v**0.5 for k, v in share.items()}
    return {k: v / sum(root.values()) for k, v in root.items()}


def solve(table: DataFrame, targets: dict | None = None, tolerance: float = TOLERANCE) -> tuple[dict, dict, float, float, float]:
    """Terms by source and language, the length term, and mean and deviation of log length, for rows (source, lang, tokens, docs): documents
    of one source, language and length have one rate, so the sums run over those."""
    cells = table.groupBy("source", "lang").agg(F.sum(F.col("docs") * F.col("tokens")).alias("mass"), F.sum(F.col("docs") * F.col("tokens") * F.log("tokens")).alias("l1"), F.sum(F.col("docs") * F.col("tokens") * F.log("tokens") ** 2).alias("l2")).collect()
    total = float(sum(c.mass for c in cells))
    if not total:
        return {}, {}, 0.0, 0.0, 1.0
    key = lambda x: (x is not None, x)
    share: dict = {}
    by_lang: dict = {}
    for c in cells:
        share[c.source] = share.get(c.source, 0) + c.mass / total
        by_lang[c.lang] = by_lang.get(c.lang, 0) + c.mass / total
    targets = weights_by_root(share) if targets is None else {k: v for k, v in targets.items() if k in share and v > 0}
    if not targets:
        raise ValueError("no source of the table has a target")
    targets = {k: v / sum(targets.values()) for k, v in targets.items()}
    mean = sum(c.l1 for c in cells) / total
    dev = max(sum(c.l2 for c in cells) / total - mean**2, 0) ** 0.5 or 1.0
    sources, langs = sorted(targets, key=key), sorted(by_lang, key=key)
    S, L = len(sources), len(langs)
    b = np.array([targets[s] for s in sources] + [by_lang[x] for x in langs] + [0.0])
    place = {s: i for i, s in enumerate(sources)}, {x: S + i for i, x in enumerate(langs)}
    z = (F.log("tokens") - F.lit(mean)) / F.lit(dev)
    live = table.where("tokens > 0")

    def value(x: np.ndarray):
        """Dual objective, gradient and Hessian: sums over documents by source and language."""
        w = F.col("docs") * F.col("tokens") / F.lit(total) * F.exp(F.lit(float(x[-1])) * F.col("z"))
        sums = live.withColumn("z", z).groupBy("source", "lang").agg(F.sum(w).alias("m0"), F.sum(w * F.col("z")).alias("m1"), F.sum(w * F.col("z") * F.col("z")).alias("m2")).collect()
        f, g, h = 0.0, np.zeros(len(b)), np.zeros((len(b), len(b)))
        for c in sums:
            if c.source in place[0]:
                i, j = place[0][c.source], place[1][c.lang]
                e = np.exp(x[i] + x[j])
                f += e * c.m0
                for p, q, m in ((i, i, c.m0), (j, j, c.m0), (i, j, c.m0), (j, i, c.m0), (i, -1, c.m1), (-1, i, c.m1), (j, -1, c.m1), (-1, j, c.m1), (-1, -1, c.m2)):
                    h[p, q] += e * m
                g[i] += e * c.m0
                g[j] += e * c.m0
                g[-1] += e * c.m1
        ridge = np.full(len(b), RIDGE)
        ridge[:S] = 0
        return f - b @ x + 0.5 * (ridge * x * x).sum(), g - b + ridge * x, h + np.diag(ridge)

    x = np.zeros(len(b))
    f, g, h = value(x)
    for _ in range(STEPS):
        if np.abs(g).max() < tolerance:
            break
        step = np.linalg.lstsq(h, -g, rcond=1e-12)[0]
        scale = min(1.0, 8 / max(np.abs(step).max(), 1e-12))
        while True:
            new = value(x + scale * step)
            if np.isfinite(new[0]) and new[0] <= f + 1e-4 * scale * (g @ step) + 1e-14:
                break
            scale /= 2
            if scale < 1e-8:
                return _terms(x, sources, langs, mean, dev)
        x = x + scale * step
        f, g, h = new
    return _terms(x, sources, langs, mean, dev)


def _terms(x, sources, langs, mean, dev):
    S = len(sources)
    return {s: float(x[i]) for i, s in enumerate(sources)}, {s: float(x[S + i]) for i, s in enumerate(langs)}, float(x[-1]), float(mean), float(dev)


def _term(column: str, terms: dict, otherwise: float) -> "F.Column":
    known = {k: v for k, v in terms.items() if k is not None}
    none = F.lit(terms.get(None, otherwise))
    if not known:
        return F.when(F.col(column).isNull(), none).otherwise(F.lit(otherwise))
    table = F.create_map(*[F.lit(x) for kv in known.items() for x in kv])
    return F.when(F.col(column).isNull(), none).otherwise(F.coalesce(F.try_element_at(table, F.col(column)), F.lit(otherwise)))


def unit_hash() -> "F.Column":
    """A number in [0, 1) from doc_id."""
    return F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def _solved(docs: DataFrame, targets: dict | None):
    spark = SparkSession.active()
    rows = docs.groupBy("source", "lang", tokens().alias("tokens")).agg(F.count("*").alias("docs"))
    table = shared.persist_shared(rows.where("tokens > 0"), spark)
    out = solve(table, targets)
    shared.forget(table, spark)
    return out


def _rate(n_tokens, solved) -> "F.Column":
    by_source, by_lang, length, mean, dev = solved
    log_rate = _term("source", by_source, float("-inf")) + _term("lang", by_lang, 0.0) + F.lit(length) * (F.log(F.greatest(n_tokens, F.lit(1))) - F.lit(mean)) / F.lit(dev)
    return F.when(n_tokens > 0, F.exp(log_rate)).otherwise(F.lit(1.0))


def _copies(rate) -> "F.Column":
    low = F.floor(rate)
    return (low + (unit_hash() < rate - low).cast("long")).cast("long")


def rates(docs: DataFrame, targets: dict | None = None) -> DataFrame:
    """(doc_id, source, lang, n_tokens, rate, copies) of documents (doc_id, text, lang, source)."""
    docs = shared.documents(docs, "doc_id", "text", "lang", "source")
    solved = _solved(docs, targets)
    rows = docs.select("doc_id", "source", "lang", tokens().alias("n_tokens"))
    return rows.withColumn("rate", _rate(F.col("n_tokens"), solved)).withColumn("copies", _copies(F.col("rate")))


def mixed(docs: DataFrame, targets: dict | None = None) -> DataFrame:
    """The documents, each as often as it has copies; the columns stay as they are."""
    solved = _solved(shared.documents(docs, "doc_id", "text", "lang", "source"), targets)
    names = docs.columns
    count, copies = "_tokens_of_the_mixture", "_copies_of_the_mixture"
    out = docs.withColumn(count, tokens()).withColumn(copies, _copies(_rate(F.col(count), solved)))
    return out.withColumn(copies, F.explode(F.array_repeat(F.lit(0), F.col(copies).cast("int")))).select(*names)
