"""Brute-force versions and awkward rows for the operators' tests."""

import random
import re

WORD = re.compile(r"(?:[0-9A-Za-z]|[^\x00-\x7f])+")


def words(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")]


def vocabulary(rng, n=400):
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(n)]


def corpus(seed=1, n=60):
    """(doc_id, text): random texts with exact copies, near copies, shared passages, repeated lines, and null, empty, short and very long texts."""
    rng = random.Random(seed)
    v = vocabulary(rng)
    text = lambda k: " ".join(rng.choice(v) for _ in range(k))
    rows = [(i, text(rng.randint(5, 220))) for i in range(n)]
    passage = text(80)
    for i in range(12):
        base = rows[rng.randrange(n)][1].split()
        for _ in range(rng.randint(0, 4)):
            base[rng.randrange(len(base))] = rng.choice(v)
        rows.append((n + i, " ".join(base)))
    rows += [(n + 12 + i, f"{text(30)}. {passage}! {text(20 + i)}") for i in range(4)]
    at = n + 16
    rows += [(at, None), (at + 1, ""), (at + 2, " ... "), (at + 3, "word"), (at + 4, "Word"), (at + 5, rows[0][1]), (at + 6, rows[0][1].upper()), (at + 7, text(9000)), (at + 8, "x" * 50_000), (at + 9, (text(5) + " ") * 60), (None, rows[1][1]), (at + 10, "é ü " + rows[2][1])]
    return rows


def frame(spark, rows, extra=True):
    """A documents table with columns whose names clash with what the operators use inside."""
    if not extra:
        return spark.createDataFrame(rows, "doc_id long, text string")
    more = [(*r, "x", 1.5, None, 7, "k") for r in rows]
    return spark.createDataFrame(more, "doc_id long, text string, key string, score double, n_tokens int, `group` int, h string")


def grams(text, n):
    w = words(text)
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def covered(rows, length=50):
    """{(doc, word)} of passages of `length` words that a lower document holds as well."""
    seen, texts = {}, {}
    for i, t in rows:
        if i is not None:
            texts[i] = words(t)
            for j in range(len(texts[i]) - length + 1):
                k = tuple(texts[i][j : j + length])
                seen[k] = min(seen.get(k, i), i)
    return {(i, c) for i, w in texts.items() for j in range(len(w) - length + 1) if seen[tuple(w[j : j + length])] < i for c in range(j, j + length)}


def span_cover(out):
    return {(r.doc_id, c) for r in out for c in range(r.start_word, r.start_word + r.n_words)}
