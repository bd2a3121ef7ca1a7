"""Operator 1, n-gram Jaccard join, by signature trees.

Two documents are linked when the Jaccard index of their sets of word n-grams reaches `threshold`. The search is exact:

1. Documents with equal sets are one set (its 128-bit sums are equal), with the number of its copies; the lowest id stands for it.
2. N-grams have one order for all documents, from rare to frequent, by counts over all documents. Two sets that must share `need` n-grams to reach the threshold share k of
   their first |set| - need + k, for any k; k is 1 + need / 20. Only so many n-grams of each set are sent to buckets by hash.
3. Each set has a group, which variants of one text have in common, mostly; many sets are their own. In a bucket, each set counts the n-grams that it shares with one set at
   least of a group whose sizes don't rule the threshold out, and where that comes to k over all buckets, it meets the group. So a cluster of m variants gives m rows for
   each of its few groups and each bucket, not m * m.
4. Two groups of which each has sets that meet the other are cut to parts of about `BLOCK` sets, and the bitmaps of each two parts form signature trees, whose nodes hold the
   OR of token bitmaps with the ranges of set sizes and bit counts; a dual traversal drops the node pairs whose largest possible overlap is too small. Bitmaps have about
   four bits for each n-gram, and are folded to the narrowest of those that a tree compares.
5. The sets that are left meet by the same parts and are verified whole, by 64-bit n-grams.

`classes` gives one row per document, so neither the result nor any table of links grows with the square of a group: two parts give each set its number of links and
the lowest document it hangs together with. `jaccard_join` lists the pairs of representatives.

Defined results
- Null and empty texts, and texts without a word, match nothing; rows without doc_id are left out.
- Texts of fewer than n words are one n-gram each. Texts of any length are read whole.
- Documents with equal sets (exact copies) are linked, Jaccard 1. In `jaccard_join` each is paired with the lowest id among them, which stands for
  all in other pairs: no link between different texts is lost, and a text with a million copies gives a million rows, not their square.
- A pair comes once, doc_a < doc_b. A repeated row counts once. An id with several texts has the links of each of them (n_links counts text by text) and never one with itself.
- Other columns of the input are ignored, so their names don't matter; an empty table gives no rows.
The counts behind the order are made over all documents, of words and n-grams that come OFTEN times in a part of a partition (of COUNTED distinct n-grams); the KNOWN most
frequent are told to all tasks. Any order gives the same links, a good one fewer candidates.
"""

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sylvaspark.llm import components, shared, textkit

N, THRESHOLD, WORDS64, NARROW, WIDE = 2, 0.5, 8, 7, 16
LEAF, FANOUT, BLOCK, BLOCK_GRAMS = 16, 8, 1024, 1 << 18
OFTEN, OFTEN_WORD, COUNTED, KNOWN = 3, 8, 3 << 20, 1 << 20
BUCKET_BYTES, POSTING_BYTES, HELD, EACH, HOT = 20 << 20, 12, 1 << 21, 20, 16
DOCUMENT, WORD, GRAM = 0, 1, 2
LOW, HIGH, ALONE = 0, 1, 2
EPS = 1e-9


def _unique_sets(g: np.ndarray, ptr: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each slice sorted, without repetitions."""
    doc = np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))
    order = np.argsort(g)
    order = order[np.argsort(doc[order], kind="stable")]
    g = g[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (doc[1:] != doc[:-1])
    count = np.bincount(doc[new], minlength=len(ptr) - 1)
    return g[new], np.concatenate(([0], np.cumsum(count)))


def _set_ids(g: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """A number for each set, from the sum and the exclusive or of its n-grams and its size; 0 for empty ones."""
    size = np.diff(ptr)
    out = np.zeros(len(size), np.int64)
    some = np.flatnonzero(size)
    if len(some):
        starts = ptr[:-1][some]
        h = np.add.reduceat(g, starts) ^ textkit.mix(np.bitwise_xor.reduceat(textkit.mix(g), starts) + size[some].astype(np.uint64))
        out[some] = textkit.signed(textkit.mix(h))
    return out


def _signatures(g: np.ndarray, ptr: np.ndarray) -> pa.Array:
    """Bitmaps of 2^k bits, four times the size of the set at least where that is within NARROW and WIDE."""
    size = np.diff(ptr)
    bits = np.int64(1) << np.clip(np.ceil(np.log2(np.maximum(4 * size, 1))), NARROW, WIDE).astype(np.int64)
    base = np.concatenate(([0], np.cumsum(bits)))
    flags = np.zeros(base[-1], np.uint8)
    flags[np.repeat(base[:-1], size) + ((g >> np.uint64(20)).astype(np.int64) & np.repeat(bits - 1, size))] = 1
    return shared.binaries(np.packbits(flags, bitorder="little"), base // 8)


class _Counter:
    """Counts of hashes over a part of a partition."""

    def __init__(self, least: int):
        self.least, self.parts, self.held = least, [], 0

    def add(self, keys: np.ndarray) -> None:
        self.parts.append(np.unique(keys, return_counts=True))
        self.held += len(self.parts[-1][0])

    def full(self) -> bool:
        if self.held > 2 * COUNTED and len(self.parts) > 1:
            self.parts = [self._summed()]
            self.held = len(self.parts[0][0])
        return self.held > COUNTED and len(self.parts) == 1

    def _summed(self) -> tuple[np.ndarray, np.ndarray]:
        u, k = np.unique(np.concatenate([p[0] for p in self.parts]), return_inverse=True)
        return u, np.bincount(k, np.concatenate([p[1] for p in self.parts]), len(u)).astype(np.int64)

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        """The hashes that came often enough, with their counts; starts again."""
        if not self.parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        u, n = self._summed()
        self.parts, self.held = [], 0
        return u[n >= self.least], n[n >= self.least]


def _records(n: int):
    """Rows of three kinds: (DOCUMENT, doc_id, set id, size, bitmap), (WORD, hash, null, count, null) and (GRAM, hash, null, number of documents, null)."""

    def rows(kind: int, a, b, n, sig=None):
        sig = pa.nulls(len(n), pa.binary()) if sig is None else sig
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(n), kind, np.int8)), a, b, pa.array(n.astype(np.int32)), sig], ["kind", "a", "b", "n", "sig"])

    def often(kind: int, counter: _Counter):
        u, count = counter.take()
        for s in range(0, len(u), 1 << 18):
            e = slice(s, s + (1 << 18))
            yield rows(kind, pa.array(textkit.signed(u[e])), pa.nulls(len(u[e]), pa.int64()), count[e])

    @shared.released
    def records(batches):
        counters = {WORD: _Counter(OFTEN_WORD), GRAM: _Counter(OFTEN)}
        for b in batches:
            texts, ids = b.column("text"), b.column("doc_id")
            for at, to in textkit.slices(texts):
                words = textkit.Words(texts.slice(at, to - at))
                g, ptr = _unique_sets(*textkit.grams(words, n))
                yield rows(DOCUMENT, ids.slice(at, to - at), pa.array(_set_ids(g, ptr)), np.diff(ptr), _signatures(g, ptr))
                for kind, keys in ((WORD, words.hash), (GRAM, g)):
                    counters[kind].add(keys)
                    if counters[kind].full():
                        yield from often(kind, counters[kind])
        for kind, counter in counters.items():
            yield from often(kind, counter)

    return records


def _keep_known(counts: DataFrame, spark: SparkSession) -> str:
    """Writes the about KNOWN most frequent words and n-grams of (kind, a, n) to the shared folder, where the tasks read them: the driver holds none of them."""
    counts = shared.persist_shared(counts.withColumn("step", F.floor(8 * F.log2("n"))), spark)
    least, held = {WORD: 0, GRAM: 0}, {WORD: 0, GRAM: 0}
    for r in counts.groupBy("kind", "step").count().orderBy(F.desc("step")).collect():  # eight rows for each doubling of a count
        held[r.kind] += r["count"]
        if held[r.kind] > KNOWN:
            least[r.kind] = max(least[r.kind], r.step + 1)
    path = shared.shared_dir(spark)
    counts.where(F.col("step") >= F.when(F.col("kind") == WORD, least[WORD]).otherwise(least[GRAM])).select("kind", "a", "n").write.parquet(path)
    shared.forget(counts, spark)
    return path


def _read_known(path: str) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By kind, the hashes, sorted, and the logarithms of their counts."""
    fs, root = pafs.FileSystem.from_uri(path)
    files = [f.path for f in fs.get_file_info(pafs.FileSelector(root)) if f.path.endswith(".parquet")]
    out = {}
    for kind in (WORD, GRAM):
        t = ds.dataset(files, filesystem=fs, format="parquet", schema=pa.schema([("kind", pa.int8()), ("a", pa.int64()), ("n", pa.int64())])).to_table(filter=ds.field("kind") == kind)
        key = t.column("a").to_numpy().view(np.uint64)
        order = np.argsort(key)
        out[kind] = key[order], np.log2(np.maximum(t.column("n").to_numpy()[order], 1)).astype(np.float32)
    return out


def _looked_up(known: tuple[np.ndarray, np.ndarray], keys: np.ndarray, otherwise: float) -> np.ndarray:
    if not len(known[0]):
        return np.full(len(keys), otherwise, np.float32)
    at = np.minimum(np.searchsorted(known[0], keys), len(known[0]) - 1)
    return np.where(known[0][at] == keys, known[1][at], np.float32(otherwise))


def _ordered_sets(words: textkit.Words, n: int, known: dict, total: float):
    """(n-grams, ptr, logarithms of their known counts) of the sets, each in the common order: expected number of documents, then hash."""
    g, ptr = textkit.grams(words, n)
    many = np.diff(ptr)
    doc = np.repeat(np.arange(len(many)), many)
    first = np.arange(len(g)) - np.repeat(ptr[:-1] - words.ptr[:-1], many)
    f = _looked_up(known[WORD], words.hash, 0.0)
    e = np.full(len(g), -(n - 1) * total, np.float32)  # words as if independent
    for k in range(n):
        e += f[np.minimum(first + k, len(f) - 1)] if len(f) else 0
    seen = _looked_up(known[GRAM], g, -99)
    e = np.maximum(e, seen)
    e[np.repeat(words.count < n, many)] = -8
    place = np.clip((np.maximum(e, -8) + 8) * 6, 0, 255).astype(np.uint64) << np.uint64(56)
    order = np.argsort(place | g >> np.uint64(8))
    order = order[np.argsort(doc[order], kind="stable")]
    g, doc, seen = g[order], doc[order], seen[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (doc[1:] != doc[:-1])
    return g[new], np.concatenate(([0], np.cumsum(np.bincount(doc[new], minlength=len(many))))), seen[new]


def _groups(key: np.ndarray, seen: np.ndarray, row: np.ndarray, sid: np.ndarray) -> np.ndarray:
    """A 32-bit group for each set, from the n-grams of its prefix that HOT documents hold: of those whose counts are of the most common size, as what variants of one text
    have in common is about equally frequent, the one of least hash. Sets without such n-grams are their own groups. Groups only say which sets are counted together; any
    groups give the same links."""
    hot = np.flatnonzero(seen >= np.log2(HOT))
    row, key, level = row[hot], key[hot], np.minimum(seen[hot] * 2, 63).astype(np.int64)
    often = np.bincount(row * 64 + level, minlength=64 * len(sid)).reshape(-1, 64)
    hot = np.flatnonzero(level == often.argmax(axis=1)[row])
    out = sid.view(np.uint64) >> np.uint64(32)
    if len(hot):
        row, key = row[hot], textkit.mix(key[hot]) >> np.uint64(32)
        at = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
        out[row[at]] = np.minimum.reduceat(key, at)
    return out.astype(np.uint32).view(np.int32)


def _prefixes(n: int, t: float, path: str, total: float, buckets: int):
    """A row for each bucket that a slice of texts has n-grams for: 32 bits of n-grams with their places (up to 65,535), by set; set ids, sizes, groups, and the number of
    n-grams of each. n-grams that only share those bits make more candidates, never fewer."""

    @shared.released
    def prefixes(batches):
        known = _read_known(path)
        for b in batches:
            texts = b.column("text")
            for at, to in textkit.slices(texts):
                g, ptr, seen = _ordered_sets(textkit.Words(texts.slice(at, to - at)), n, known, total)
                sid, size = _set_ids(g, ptr), np.diff(ptr)
                _, one = np.unique(sid, return_index=True)  # equal sets of a slice go once
                one = one[size[one] > 0]
                if not len(one):
                    continue
                least = np.ceil(t * size[one] - EPS).astype(np.int64)  # shared with the smallest partner
                many = size[one] - least + 1 + least // EACH
                place = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                row = np.repeat(np.arange(len(one)), many)
                at_key = np.repeat(ptr[:-1][one], many) + place
                key = g[at_key]
                group = _groups(key, seen[at_key], row, sid[one])
                bucket = (key % np.uint64(buckets)).astype(np.uint16 if buckets <= 1 << 16 else np.int64)
                order = np.argsort(bucket, kind="stable")
                bucket, key, row, place = bucket[order], key[order], row[order], np.minimum(place[order], 65_535).astype(np.uint16)
                new_bucket = np.concatenate(([True], bucket[1:] != bucket[:-1]))
                seg = np.flatnonzero(new_bucket | np.concatenate(([True], row[1:] != row[:-1])))
                starts = np.flatnonzero(new_bucket)
                own, by_set = np.append(starts, len(key)), np.append(np.searchsorted(seg, starts), len(seg))
                cols = [shared.binaries((key >> np.uint64(32)).astype(np.uint32), own), shared.binaries(place, own)]
                cols += [shared.binaries(x, by_set) for x in (sid[one][row[seg]], size[one][row[seg]].astype(np.int32), group[row[seg]], np.diff(np.append(seg, len(key))).astype(np.int32))]
                yield pa.RecordBatch.from_arrays([pa.array(bucket[starts].astype(np.int32)), *cols], ["bucket", "keys", "places", "sids", "sizes", "groups", "counts"])

    return prefixes


def _needed(size_a, size_b, t: float) -> np.ndarray:
    return np.ceil(t / (1 + t) * (size_a + size_b) - EPS).astype(np.int64)


def _counts(size, place, lo, hi, after, t: float) -> np.ndarray:
    """Whether an n-gram of a set at that place, which others of sizes lo to hi hold with at most `after` n-grams from there on, counts with one of them: it may be among the
    first k that the two share."""
    need = _needed(size, np.maximum(lo, _smallest(size, t)), t)
    return (hi >= t * size - EPS) & (size >= t * lo - EPS) & (np.minimum(size - place, after) >= need - need // EACH)


def _smallest(size, t: float) -> np.ndarray:
    return np.ceil(t * size - EPS).astype(np.int64)


def _candidates(t: float):
    """(a, own, other, size, n, enough): of the n-grams of some buckets, how many of set a count with one set at least of the group `other`, and how many it has to share
    with one of them at least. Its own group is `own`, and is met as any other."""

    def summed(parts: list) -> tuple[np.ndarray, np.ndarray]:
        u, k = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        return u, np.bincount(k, np.concatenate([p[1] for p in parts]), len(u)).astype(np.int64)

    def emit(parts: list, ids: np.ndarray, sizes: np.ndarray, own: np.ndarray, groups: np.ndarray, least: np.ndarray):
        codes, n = summed(parts)
        for s in range(0, len(codes), 1 << 18):
            a, c = np.divmod(codes[s : s + (1 << 18)], len(groups))
            enough = 1 + _needed(sizes[a], np.maximum(least[c], _smallest(sizes[a], t)), t) // EACH
            cols = (ids[a], groups[own[a]], groups[c], sizes[a].astype(np.int32), n[s : s + (1 << 18)].astype(np.int32), enough.astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in cols], ["a", "own", "other", "size", "n", "enough"])

    def of_bucket(g):
        key, sid, size, group, count = (shared.ragged(g, c, d)[0] for c, d in (("keys", np.uint32), ("sids", np.int64), ("sizes", np.int32), ("groups", np.int32), ("counts", np.int32)))
        place = shared.ragged(g, "places", np.uint16)[0]
        ids, first, sid = np.unique(sid, return_index=True, return_inverse=True)
        sizes = size[first].astype(np.int64)
        groups, own = np.unique(group[first], return_inverse=True)
        least = np.full(len(groups), 1 << 62)
        np.minimum.at(least, own, sizes)
        once = np.zeros(len(sid), bool)
        once[first] = True  # equal sets of several slices
        at = np.flatnonzero(np.repeat(once, count))
        sid = np.repeat(sid, count)[at]
        key, place = key[at], place[at].astype(np.int64)
        order = np.argsort(key.astype(np.uint64) << np.uint64(32) | own[sid].astype(np.uint64))
        key, sid, place = key[order], sid[order], place[order]
        many = np.diff(np.append(np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))), len(key)))
        keep = np.repeat(many > 1, many)
        if not keep.any():
            return
        key, sid, place = key[keep], sid[keep], place[keep]
        size, group = sizes[sid], own[sid]
        new_key = np.concatenate(([True], key[1:] != key[:-1]))
        new = new_key | np.concatenate(([True], group[1:] != group[:-1]))
        at = np.flatnonzero(new)  # the postings of a key and a group
        members, lo, hi, after = np.diff(np.append(at, len(key))), np.minimum.reduceat(size, at), np.maximum.reduceat(size, at), np.maximum.reduceat(size - place, at)
        of = np.cumsum(new) - 1
        begin = np.append(np.flatnonzero(new_key[at]), len(at))  # the groups of a key
        run = np.cumsum(new_key) - 1
        begin, many = begin[run], np.diff(begin)[run]
        ends = np.cumsum(many)
        parts, held, s = [], 0, 0
        while s < len(key):
            e = max(s + 1, int(np.searchsorted(ends, (ends[s - 1] if s else 0) + (1 << 18), "right")))
            x = np.repeat(np.arange(s, e), many[s:e])
            y = np.arange(len(x)) - np.repeat(ends[s:e] - many[s:e] - ends[s] + many[s], many[s:e]) + begin[x]
            ok = _counts(size[x], place[x], lo[y], hi[y], after[y], t) & ((of[x] != y) | (members[y] > 1))
            parts.append(np.unique(sid[x[ok]] * len(groups) + group[at[y[ok]]], return_counts=True))
            held += len(parts[-1][0])
            if held > HELD:
                parts = [summed(parts)]
                held = len(parts[0][0])
                if held > HELD // 2:
                    yield from emit(parts, ids, sizes, own, groups, least)
                    parts, held = [], 0
            s = e
        if held:
            yield from emit(parts, ids, sizes, own, groups, least)

    @shared.released
    def candidates(batches):
        for g in shared.grouped(batches, "bucket"):
            bucket = shared.column(g, "bucket").to_numpy()
            cuts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
            for s, e in zip(cuts, np.append(cuts[1:], len(bucket))):
                yield from of_bucket(g.slice(s, e - s))

    return candidates


def _found(docs: DataFrame, n: int, t: float, known: str, total: int, grams: int) -> DataFrame:
    """What _candidates finds in each bucket of documents with so many n-grams."""
    buckets = max(12, -(-int(grams * (1 - t) + total) * POSTING_BYTES // BUCKET_BYTES))
    posted = docs.select("text").mapInArrow(_prefixes(n, t, known, float(np.log2(max(2, grams))), buckets), "bucket int, keys binary, places binary, sids binary, sizes binary, groups binary, counts binary")
    return posted.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_candidates(t), "a long, own int, other int, size int, n int, enough int")


def _met(found: DataFrame) -> DataFrame:
    """(sid, met): of sets (a, own, other, size) that meet groups, the keys of the parts of groups that they meet in, each with the set's side. A group is cut to parts of at most
    BLOCK sets and BLOCK_GRAMS n-grams or so; where no set of the other group came, there is no key."""
    own, other = F.col("own").cast("long"), F.col("other").cast("long")
    side = F.when(own == other, ALONE).when(own < other, LOW).otherwise(HIGH).cast("byte")
    key = F.call_function("shiftleft", F.least(own, other), F.lit(32)).bitwiseOR(F.greatest(own, other).bitwiseAND(F.lit(0xFFFFFFFF)))
    rows = found.select(key.alias("key"), F.col("a").alias("sid"), side.alias("side"), "size")
    by = Window.partitionBy("key")
    for s in (LOW, HIGH, ALONE):
        one = F.when(F.col("side") == s, 1)
        rows = rows.withColumn(f"n{s}", F.count(one).over(by))
        rows = rows.withColumn(f"b{s}", F.greatest(F.ceil(F.col(f"n{s}") / BLOCK), F.ceil(F.sum(one * F.col("size")).over(by) / BLOCK_GRAMS)))
    rows = rows.where(f"n{ALONE} > 1 OR (n{LOW} > 0 AND n{HIGH} > 0)")
    part = lambda b: F.pmod(F.xxhash64("sid"), F.col(b)).cast("long")
    every = lambda b, f: F.transform(F.sequence(F.lit(0).cast("long"), F.col(b) - 1), f)
    alone = every(f"b{ALONE}", lambda j: F.struct(F.xxhash64("key", F.least(j, part(f"b{ALONE}")), F.greatest(j, part(f"b{ALONE}"))).alias("key"), F.when(j == part(f"b{ALONE}"), ALONE).when(j > part(f"b{ALONE}"), LOW).otherwise(HIGH).cast("byte").alias("side")))
    low = every(f"b{HIGH}", lambda j: F.struct(F.xxhash64("key", part(f"b{LOW}"), j).alias("key"), F.col("side")))
    high = every(f"b{LOW}", lambda i: F.struct(F.xxhash64("key", i, part(f"b{HIGH}")).alias("key"), F.col("side")))
    rows = rows.select("sid", F.when(F.col("side") == ALONE, alone).when(F.col("side") == LOW, low).otherwise(high).alias("met"))
    return rows.groupBy("sid").agg(F.flatten(F.collect_list("met")).alias("met"))


def _possible(lo_a, hi_a, pop_a, lo_b, hi_b, pop_b, common, t):
    """Whether sets of those size ranges, with at least pop bits each and at most `common` bits in both, may reach the threshold."""
    most = np.minimum(hi_a - np.maximum(0, pop_a - common), hi_b - np.maximum(0, pop_b - common))
    return (hi_a >= t * lo_b) & (hi_b >= t * lo_a) & (most * (1 + t) >= t * (lo_a + lo_b) - 1e-6)


def _bitmaps(g: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """A bitmap of 64 * WORDS64 bits for each set of whole numbers."""
    flags = np.zeros((len(ptr) - 1, 64 * WORDS64), np.uint8)
    flags[np.repeat(np.arange(len(ptr) - 1), np.diff(ptr)), (g % (64 * WORDS64)).astype(np.int64)] = 1
    return np.packbits(flags, axis=1, bitorder="little").view(np.uint64)


def tree_pairs(size: np.ndarray, sig: np.ndarray, t: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows that may reach the threshold: dual traversal of a signature tree over rows ordered by size."""
    order = np.lexsort((sig[:, 1], sig[:, 0], size))
    size, sig = size[order].astype(np.int64), sig[order]
    pop = np.bitwise_count(sig).sum(axis=1).astype(np.int64)
    levels = [(size, size, pop, sig)]
    while len(levels[-1][0]) > 1:
        lo, hi, least, bits = levels[-1]
        at = np.arange(0, len(lo), LEAF if len(levels) == 1 else FANOUT)
        levels.append((np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at), np.minimum.reduceat(least, at), np.bitwise_or.reduceat(bits, at, axis=0)))
    a = b = np.zeros(1, np.int64)
    for depth in range(len(levels) - 1, 0, -1):
        fan = LEAF if depth == 1 else FANOUT
        lo, hi, least, bits = levels[depth - 1]
        step = np.arange(fan)
        found = []
        nodes = max(1, (1 << 21) // (fan * fan * bits.shape[1]))  # bounded memory
        for s in range(0, len(a), nodes):
            x = np.repeat(a[s : s + nodes, None] * fan + step, fan, axis=1).reshape(-1)
            y = np.tile(b[s : s + nodes, None] * fan + step, (1, fan)).reshape(-1)
            ok = (x <= y if depth > 1 else x < y) & (x < len(lo)) & (y < len(lo))
            x, y = x[ok], y[ok]
            ok = (hi[x] >= t * lo[y]) & (hi[y] >= t * lo[x])
            x, y = x[ok], y[ok]
            common = np.bitwise_count(bits[x] & bits[y]).sum(axis=1).astype(np.int64)
            ok = _possible(lo[x], hi[x], least[x], lo[y], hi[y], least[y], common, t)
            found.append((x[ok], y[ok]))
        a, b = (np.concatenate(v) for v in zip(*found)) if found else (a[:0], b[:0])
    return (order[a], order[b]) if len(levels) > 1 else (a[:0], b[:0])


def _prune(t: float):
    """Of the bitmaps of each two parts of groups, rows (key, sid, side) of those that may have a partner."""
    apart = int(np.ceil(np.log2(1 / t) - EPS))  # sets at the threshold have widths that many steps apart at most

    def of_key(side, size, rows, sigs):
        width = np.array([len(sigs[r]) for r in rows])
        hit = np.zeros(len(side), bool)
        for w in np.unique(width):
            some = np.flatnonzero((width >= w) & (width <= w << apart))
            if len(some) < 2:
                continue
            sig = np.stack([np.bitwise_or.reduce(sigs[rows[i]].reshape(-1, w), axis=0) for i in some]).view(np.uint64)
            x, y = tree_pairs(size[some], sig, t)
            x, y = some[x], some[y]
            ok = (np.minimum(width[x], width[y]) == w) & ((side[x] != side[y]) | (side[x] == ALONE))
            hit[x[ok]] = hit[y[ok]] = True
        return np.flatnonzero(hit)

    @shared.released
    def prune(batches):
        for g in shared.grouped(batches):
            key, sid, side, size = (shared.column(g, c).to_numpy() for c in ("key", "sid", "side", "size"))
            raw, ptr = shared.ragged(g, "sig", np.uint8)
            sigs = [raw[i:j] for i, j in zip(ptr[:-1].tolist(), ptr[1:].tolist())]
            starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            for s, e in zip(starts, np.append(starts[1:], len(key))):
                _, first = np.unique(sid[s:e], return_index=True)
                first += s
                keep = first[of_key(side[first], size[first].astype(np.int64), first, sigs)]
                if len(keep):
                    yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (key, sid, side)], ["key", "sid", "side"])

    return prune


def _sets(n: int):
    """The sets asked for, once for each key: rows (doc_id, text, wanted) -> (key, sid, side, rep, copies, grams)."""

    @shared.released
    def sets(batches):
        for b in batches:
            texts = b.column("text")
            for at, to in textkit.slices(texts):
                g, ptr = _unique_sets(*textkit.grams(textkit.Words(texts.slice(at, to - at)), n))
                sid, packed, wanted = _set_ids(g, ptr), shared.binaries(g, ptr), b.column("wanted").slice(at, to - at)
                row = np.repeat(np.arange(to - at), np.diff(wanted.offsets.to_numpy()))
                key, own, side, copies = (wanted.flatten().field(c) for c in ("key", "sid", "side", "copies"))
                keep = np.flatnonzero(own.to_numpy() == sid[row])  # of an id with several texts, the one that is meant
                for s in range(0, len(keep), 1000):
                    k = pa.array(keep[s : s + 1000])
                    r = pa.array(row[keep[s : s + 1000]])
                    yield pa.RecordBatch.from_arrays([key.take(k), own.take(k), side.take(k), b.column("doc_id").slice(at, to - at).take(r), copies.take(k), packed.take(r)], ["key", "sid", "side", "rep", "copies", "grams"])

    return sets


def _overlaps(local: np.ndarray, ptr: np.ndarray, x: np.ndarray, y: np.ndarray, vocabulary: int) -> np.ndarray:
    """Common members of the sets x[i] and y[i]; x is sorted."""
    mark, hit = np.zeros(vocabulary, np.int32), np.empty(len(x), np.int64)
    cuts = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1]))) if len(x) else []
    for c, d in zip(cuts, np.append(cuts[1:], len(x))):
        mine, partners = local[ptr[x[c]] : ptr[x[c] + 1]], y[c:d]
        mark[mine] = 1
        if len(partners) * 4 > len(ptr):
            hit[c:d] = np.add.reduceat(mark[local], ptr[:-1])[partners]
        else:
            hit[c:d] = [mark[local[ptr[p] : ptr[p + 1]]].sum() for p in partners]
        mark[mine] = 0
    return hit


def _verify(t: float, pairs: bool):
    """Of the sets of each two parts of groups, the pairs (doc_a, doc_b, jaccard), or rows (sid, rep, links, root): the links of each set, copies counted, and the lowest
    representative that it hangs together with."""

    def of_key(sid, side, rep, copies, grams, ptr):
        _, first = np.unique(sid, return_index=True)
        sid, side, rep, copies = sid[first], side[first], rep[first], copies[first]
        size = ptr[first + 1] - ptr[first]
        tokens = np.concatenate([grams[ptr[r] : ptr[r + 1]] for r in first])
        vocabulary, local = np.unique(tokens, return_inverse=True)
        at = np.concatenate(([0], np.cumsum(size)))
        x, y = tree_pairs(size, _bitmaps(local, at), t)
        across = (side[x] != side[y]) | (side[x] == ALONE)  # pairs within a part meet at its own key
        x, y = x[across], y[across]
        order = np.argsort(x, kind="stable")
        x, y = x[order], y[order]
        hit = _overlaps(local, at, x, y, len(vocabulary))
        j = hit / (size[x] + size[y] - hit)
        ok = j >= t
        return sid, rep, copies, x[ok], y[ok], j[ok]

    def rooted(rep, x, y):
        """The lowest rep of each set's component."""
        root = rep.copy()
        while True:
            low = root.copy()
            np.minimum.at(low, x, root[y])
            np.minimum.at(low, y, low[x])
            if (low == root).all():
                return root
            root = low

    @shared.released
    def verify(batches):
        for g in shared.grouped(batches):
            key, sid, side, rep, copies = (shared.column(g, c).to_numpy() for c in ("key", "sid", "side", "rep", "copies"))
            grams, ptr = shared.ragged(g, "grams", np.uint64)
            starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            for s, e in zip(starts, np.append(starts[1:], len(key))):
                if e - s < 2:
                    continue
                ids, reps, many, x, y, j = of_key(sid[s:e], side[s:e], rep[s:e], copies[s:e], grams, ptr[s : e + 1])
                if not len(x):
                    continue
                if pairs:
                    ok = reps[x] != reps[y]
                    a, b = reps[x[ok]], reps[y[ok]]
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(j[ok])], ["doc_a", "doc_b", "jaccard"])
                else:
                    links = np.bincount(x, many[y], len(ids)) + np.bincount(y, many[x], len(ids))
                    some = np.flatnonzero(links)
                    yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(reps[some]), pa.array(links[some].astype(np.int64)), pa.array(rooted(reps, x, y)[some])], ["sid", "rep", "links", "root"])

    return verify


def _joined(docs: DataFrame, n: int, t: float, pairs: bool) -> tuple[DataFrame, DataFrame]:
    """(doc_id, sid, size, rep, copies) of every document and text; what _verify finds."""
    spark = SparkSession.active()
    docs = shared.documents(docs, "doc_id", "text").where(F.col("doc_id").isNotNull())
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    records = shared.persist_shared(docs.mapInArrow(_records(n), "kind byte, a long, b long, n int, sig binary"), spark)
    counts = records.where(F.col("kind") != DOCUMENT).groupBy("kind", "a").agg(F.sum("n").alias("n"))
    documents = records.where(F.col("kind") == DOCUMENT)
    total, grams = documents.agg(F.count("*"), F.sum("n")).first()
    known = _keep_known(counts, spark)
    members = documents.select(F.col("a").alias("doc_id"), F.col("b").alias("sid"), F.col("n").alias("size")).distinct()
    sets = members.where("size > 0").groupBy("sid").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    sets = shared.persist_shared(sets, spark)
    found = _found(docs, n, t, known, total or 0, grams or 0).repartition("a")  # the rows of a set lie side by side
    found = found.groupBy("a", "own", "other", "size").agg(F.sum("n").alias("n"), F.min("enough").alias("enough")).where("n >= enough")
    wanted = shared.persist_shared(_met(found).join(sets.drop("copies"), "sid").withColumnRenamed("rep", "doc_id"), spark)
    bitmaps = shared.among(documents.select(F.col("a").alias("doc_id"), F.col("b").alias("sid"), F.col("n").alias("size"), "sig"), wanted)
    met = wanted.join(bitmaps, ["doc_id", "sid"]).select("sid", "size", "sig", F.inline("met")).select("key", "sid", "side", "size", "sig")
    left = met.repartition("key").sortWithinPartitions("key").mapInArrow(_prune(t), "key long, sid long, side byte")
    wanted = left.join(sets, "sid").groupBy(F.col("rep").alias("doc_id")).agg(F.collect_list(F.struct("key", "sid", "side", "copies")).alias("wanted"))
    wanted = shared.persist_shared(wanted, spark)
    met = shared.among(docs, wanted).join(wanted, "doc_id").select("doc_id", "text", "wanted").mapInArrow(_sets(n), "key long, sid long, side byte, rep long, copies long, grams binary")
    schema = "doc_a long, doc_b long, jaccard double" if pairs else "sid long, rep long, links long, root long"
    return members.join(sets, "sid", "left"), met.repartition("key").sortWithinPartitions("key").mapInArrow(_verify(t, pairs), schema)


def jaccard_join(docs: DataFrame, n: int = N, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_a, doc_b, jaccard) of documents (doc_id, text): representatives that are linked, and each other copy with its representative."""
    members, found = _joined(docs, n, threshold, True)
    copies = members.where("doc_id <> rep").select(F.col("rep").alias("doc_a"), F.col("doc_id").alias("doc_b"), F.lit(1.0).alias("jaccard"))
    return found.unionByName(copies).groupBy("doc_a", "doc_b").agg(F.max("jaccard").alias("jaccard"))


def classes(docs: DataFrame, n: int = N, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, class_id, n_links) of documents (doc_id, text): one row per id, with the lowest id of those it hangs together with and the number of its links."""
    spark = SparkSession.active()
    members, found = _joined(docs, n, threshold, False)
    members, found = shared.persist_shared(members, spark), shared.persist_shared(found, spark)
    several = members.where("size > 0").groupBy("doc_id").agg(F.count("*").alias("texts"), F.min("rep").alias("low"), F.max("rep").alias("high")).where("texts > 1")
    edges = found.select(F.col("rep").alias("a"), F.col("root").alias("b"))
    for rep in ("low", "high"):
        edges = edges.unionByName(several.select(F.col("doc_id").alias("a"), F.col(rep).alias("b")))
    of_rep = components.components(edges.where("a <> b"))
    links = found.groupBy("sid").agg(F.sum("links").alias("links"))
    rows = members.join(links, "sid", "left").join(of_rep.withColumnRenamed("node", "rep"), "rep", "left")
    class_id = F.coalesce("component", "rep", "doc_id")
    return rows.groupBy("doc_id").agg(F.min(class_id).alias("class_id"), F.sum(F.coalesce("links", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))).alias("n_links"))
