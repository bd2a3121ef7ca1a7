"""Operator 7, suffix-array dedup: passages of at least 50 words that repeat across documents.

1. Every window of 50 words is routed by its anchor (see windows); anchors of one document alone are dropped.
2. The word runs around the anchors that repeat are cut from the texts and sent to the anchor's shard.
3. Each shard collapses identical runs and sorts the suffixes of the rest by induced sorting (see induced), whose bucket queues carry suffixes with
   their common-prefix lengths and spill to the shared folder. Only the queues are external: text, names, and the suffix and prefix arrays are held in
   memory, so shards are cut to `SHARD_WORDS` words between anchors.
   An anchor of more than `HOT` runs isn't held at one place: its windows meet by their 128-bit fingerprints (anchor and digest of all words), whose lowest and highest
   documents are aggregated before they are shuffled.
4. Suffixes with 50 common words or more are one passage. Its occurrences in the lowest doc_id that has it stay; the windows of all
   others are reported, joined to spans where they touch.

Defined results
- A word is a run of letters and digits, ASCII case apart. Repetitions within one document alone aren't reported.
- Null, empty and shorter texts give no rows; rows without doc_id are left out; rows repeating an id count as one document.
- Other columns are ignored; an empty table gives no rows. Texts of any length are read whole.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sylvaspark.llm import induced, shared, textkit, windows

BUDGET = 16 << 20
#: Words of distinct runs that one suffix array takes. A longer shard is cut between anchors, which never need each other.
SHARD_WORDS = 3 << 18
#: Runs of an anchor up to which they are sorted in one shard.
HOT = 10_000
SPANS = "doc_id long, start_word long, n_words long, first_doc_id long"


def _anchors(length: int):
    @shared.released
    def anchors(batches):
        for b in batches:
            texts, ids = b.column("text"), b.column("doc_id").to_numpy()
            for at, to in textkit.slices(texts):
                r = windows.Runs(textkit.Words(texts.slice(at, to - at)), length)
                yield pa.RecordBatch.from_arrays([pa.array(textkit.signed(r.key)), pa.array(ids[at + r.doc]), pa.array(r.start.astype(np.int32)), pa.array(r.count.astype(np.int32))], ["key", "doc_id", "start", "count"])

    return anchors


def _cut(length: int, hot: bool):
    """Rows (doc_id, text, runs) -> the words of each run; or the windows of each run with their digests, at the anchor's key."""

    @shared.released
    def cut(batches):
        for b in batches:
            texts, ids, runs = b.column("text"), b.column("doc_id").to_numpy(), b.column("runs")
            for at, to in textkit.slices(texts):
                words = textkit.Words(texts.slice(at, to - at))
                part = runs.slice(at, to - at)
                row = np.repeat(np.arange(to - at), np.diff(part.offsets.to_numpy()))
                flat = part.flatten()
                start, count, key = (flat.field(c).to_numpy() for c in ("start", "count", "key"))
                ok = start + count + length - 1 <= words.count[row]
                row, start, count, key = row[ok], start[ok].astype(np.int64), count[ok], key[ok]
                digest = textkit.rolling_hash(words.hash, length) if hot else None
                for s in range(0, len(row), 4096):
                    e = slice(s, s + 4096)
                    r, first, many, own = row[e], start[e], count[e], key[e]
                    if hot:
                        window, r, own = windows.ranges(first, many), np.repeat(r, many), np.repeat(own, many)
                        cols = [pa.array(textkit.signed(digest[words.ptr[r] + window])), pa.array(ids[at + r]), pa.array(window)]
                        yield pa.RecordBatch.from_arrays([pa.array(own), *cols], ["key", "digest", "doc_id", "start"])
                    else:
                        size = many + length - 1
                        values = words.hash[windows.ranges(words.ptr[r] + first, size)]
                        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(ids[at + r]), pa.array(first), shared.binaries(values, np.concatenate(([0], np.cumsum(size))))], ["key", "doc_id", "start", "words"])

    return cut


def _symbols(runs: list[np.ndarray], width: int, local: np.ndarray) -> np.ndarray:
    """Ranks from 0 as `width` symbols of 2..254 each; `width` symbols of 1 after each run, and 0 at the end."""
    size = np.array([len(r) for r in runs])
    at = np.arange(len(local)) + np.repeat(np.arange(len(runs)), size)
    out = np.ones((len(local) + len(runs), width), np.uint8)
    for k in range(width):
        out[at, width - 1 - k] = local % 253 + 2
        local = local // 253
    return np.append(out.reshape(-1), np.uint8(0))


def repeats(doc: np.ndarray, start: np.ndarray, runs: list[np.ndarray], length: int, folder: str | None, budget: int):
    """(doc, window, first doc) of windows of runs that a lower document has as well."""
    where: dict[bytes, int] = {}
    which = np.array([where.setdefault(r.tobytes(), len(where)) for r in runs])
    distinct = [np.frombuffer(x, runs[0].dtype) for x in where]
    low = np.full(len(distinct), np.iinfo(np.int64).max)
    np.minimum.at(low, which, doc)
    vocabulary, local = np.unique(np.concatenate(distinct), return_inverse=True)
    width = 1
    while 253**width < len(vocabulary):
        width += 1
    t = _symbols(distinct, width, local)
    order, common = induced.suffixes(t, width * length, folder, budget)
    size = np.array([len(r) for r in distinct])
    head = np.concatenate(([0], np.cumsum(size + 1)))[:-1]
    valid = np.full(len(t) // width + 1, -1, np.int64)
    many = size - length + 1
    valid[windows.ranges(head, many)] = np.repeat(np.arange(len(distinct)), many)
    run = np.where(order % width == 0, valid[order // width], -1)
    rows = np.flatnonzero(run >= 0)
    near = np.minimum.reduceat(common[: rows[-1] + 1], np.concatenate(([0], rows[:-1] + 1)))
    new = np.flatnonzero(near < width * length)
    new = new if len(new) and new[0] == 0 else np.concatenate(([0], new))
    run, word = run[rows], order[rows] // width
    group = np.repeat(np.minimum.reduceat(low[run], new), np.diff(np.append(new, len(run))))
    first = np.empty(int(many.sum()), np.int64)
    base = np.concatenate(([0], np.cumsum(many)))
    first[base[run] + word - head[run]] = group
    take = many[which]
    lowest = first[windows.ranges(base[which], take)]
    d, w = np.repeat(doc, take), windows.ranges(start, take)
    hit = lowest < d
    return d[hit], w[hit], lowest[hit]


def spans(doc: np.ndarray, window: np.ndarray, first: np.ndarray, length: int):
    """Windows as spans of words that overlap or touch, with the lowest first document of each."""
    order = np.lexsort((window, doc))
    doc, window, first = doc[order], window[order], first[order]
    new = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (window[1:] > window[:-1] + length))))
    last = np.append(new[1:], len(doc)) - 1
    return doc[new], window[new], window[last] + length - window[new], np.minimum.reduceat(first, new)


def _shards(length: int, folder: str, budget: int, most: int):
    def batch_of(d, s, runs):
        out = repeats(np.array(d), np.array(s), runs, length, folder, budget)
        if len(out[0]):
            return pa.RecordBatch.from_arrays([pa.array(c) for c in spans(*out, length)], ["doc_id", "start_word", "n_words", "first_doc_id"])

    @shared.released
    def shards(batches):
        d, s, runs, held = [], [], [], 0
        for g in shared.grouped(batches):
            values, ptr = shared.ragged(g, "words", np.uint64)
            d += shared.column(g, "doc_id").to_pylist()
            s += shared.column(g, "start").to_pylist()
            runs += [values[i:j] for i, j in zip(ptr[:-1].tolist(), ptr[1:].tolist())]
            held += len(values)
            if held > most:
                if (b := batch_of(d, s, runs)) is not None:
                    yield b
                d, s, runs, held = [], [], [], 0
        if runs and (b := batch_of(d, s, runs)) is not None:
            yield b

    return shards


@shared.released
def _join_spans(batches):
    for g in shared.grouped(batches, "doc_id"):
        doc, start, n, first = (shared.column(g, c).to_numpy() for c in ("doc_id", "start_word", "n_words", "first_doc_id"))
        order = np.lexsort((start, doc))
        doc, start, n, first = doc[order], start[order], n[order], first[order]
        base = np.cumsum(np.concatenate(([0], doc[1:] != doc[:-1]))) * (int((start + n).max()) + 2)  # documents apart
        reach = np.maximum.accumulate(base + start + n)
        new = np.flatnonzero(np.concatenate(([True], (base + start)[1:] > reach[:-1])))
        last = np.append(new[1:], len(doc)) - 1
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (doc[new], start[new], reach[last] - base[last] - start[new], np.minimum.reduceat(first, new))], ["doc_id", "start_word", "n_words", "first_doc_id"])


def _hot_spans(cut: DataFrame, length: int) -> DataFrame:
    """Spans of the windows (key, digest, doc_id, start) that a lower document has as well."""
    spark = SparkSession.active()
    cut = shared.persist_shared(cut, spark)
    lowest = cut.groupBy("key", "digest").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").drop("high")
    lowest = shared.persist_shared(lowest, spark)  # a plain side of the join, so that AQE may split the other one's hot windows
    hits = cut.join(lowest, ["key", "digest"]).where("low < doc_id")
    return hits.select("doc_id", F.col("start").alias("start_word"), F.lit(length).cast("long").alias("n_words"), F.col("low").alias("first_doc_id")).distinct()


def repeated_spans(docs: DataFrame, length: int = windows.LENGTH, budget: int = BUDGET, shard_words: int = SHARD_WORDS, hot: int = HOT) -> DataFrame:
    """(doc_id, start_word, n_words, first_doc_id) of documents (doc_id, text): what dedup removes."""
    spark = SparkSession.active()
    docs = shared.documents(docs, "doc_id", "text").where(F.col("doc_id").isNotNull()).withColumn("doc_id", F.col("doc_id").cast("long"))
    anchors = shared.persist_shared(docs.mapInArrow(_anchors(length), "key long, doc_id long, start int, count int"), spark)
    keys = anchors.groupBy("key").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), (F.count("*") > hot).alias("hot")).where("low < high").select("key", "hot")
    keys = shared.persist_shared(keys, spark)
    anchors = anchors.join(keys, "key")

    def cut(part: DataFrame, of_hot: bool, schema: str) -> DataFrame:
        runs = part.groupBy("doc_id").agg(F.collect_list(F.struct("start", "count", "key")).alias("runs"))
        return docs.join(runs, "doc_id").mapInArrow(_cut(length, of_hot), schema)

    shards = cut(anchors.where("not hot"), False, "key long, doc_id long, start long, words binary")
    spans = shards.repartition("key").sortWithinPartitions("key").mapInArrow(_shards(length, shared.shared_dir(spark), budget, shard_words), SPANS)
    if not keys.where("hot").isEmpty():
        spans = spans.unionByName(_hot_spans(cut(anchors.where("hot"), True, "key long, digest long, doc_id long, start long"), length))
    return spans.repartition("doc_id").sortWithinPartitions("doc_id").mapInArrow(_join_spans, SPANS)
