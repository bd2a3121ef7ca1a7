"""Operator 10, embedding near-dedup by sorted projection passes.

In each pass every vector gets a signature of concatenated random hyperplane bits. The vectors are sorted by signature; each is compared
with the next `window` ones of its range (2^SPAN neighbouring buckets) and with all that share its leading bits (its bucket), however many they are, and pairs whose cosine
reaches the threshold are kept. The verified pairs of all passes are united. Ranges are fixed by the signature and lie in one partition each, so the result doesn't depend on the
number of partitions.

The bucket takes log2(n / window) leading bits, so that unrelated vectors fill about a window. A pair at the threshold shares them with a probability that falls with
n; the number of passes is chosen so that at least 99 of 100 such pairs meet in some pass, in hot groups too. A bucket beyond two blocks is dealt to blocks, and each
two blocks meet in one group of rows, so no task holds a whole hot bucket. Work in a hot group grows with its square, unless it is soon found to be one component.

Defined results
- Every vector with an id has one row: its group is the lowest id of its component of verified pairs, its own id if it has none.
- Null and empty vectors, zero vectors, and vectors with nulls or not of the commonest length are alone. Rows without vec_id are left out; a repeated id is one
  vector of its group (all its rows are compared).
- Equal vectors have equal signatures and stand next to each other. Other columns are ignored; an empty table gives no rows.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sylvaspark.llm import components, shared, textkit

THRESHOLD, WINDOW, MISS, BITS = 0.95, 32, 0.01, 63
BLOCK_BYTES, TILE, SPAN = 1 << 23, 2048, 3


def plan_for(n: int, threshold: float, window: int) -> tuple[int, int]:
    """Leading bits of a bucket, and passes; fewer bits where the passes would be more than 256."""
    bit = 1 - math.acos(min(threshold, 1.0)) / math.pi
    bits = int(min(BITS, max(1.0, math.log2(max(2, n) / window) + 1)))
    passes = lambda k: max(2, math.ceil(math.log(MISS) / math.log1p(-min(bit**k, 0.999))))
    while bits and passes(bits) > 256:
        bits -= 1
    return bits, passes(bits)


def passes_for(n: int, threshold: float, window: int) -> int:
    return plan_for(n, threshold, window)[1]


def matrix(column, width: int) -> np.ndarray:
    c = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(c.flatten().to_numpy(zero_copy_only=False), np.float32).reshape(len(c), width)


def vectors(table: DataFrame) -> tuple[DataFrame, int]:
    """Rows (vec_id, embedding) with vectors of the commonest length and no nulls; that length."""
    rows = table.select(table["vec_id"].cast("long").alias("vec_id"), table["embedding"].cast("array<float>").alias("embedding"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
    width = rows.where(F.size("embedding") > 0).groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where((F.size("embedding") == F.lit(width[0] if width else 0)) & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x))), width[0] if width else 0


def _units(batch, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors other than zero, at length 1, and their ids."""
    x = matrix(batch.column("embedding"), width)
    norm = np.linalg.norm(x, axis=1)
    keep = np.flatnonzero(norm > 0)
    return np.ascontiguousarray(x[keep] / norm[keep, None]), batch.column("vec_id").to_numpy()[keep]


def _planes(width: int, passes: int) -> np.ndarray:
    return np.random.default_rng(11).normal(size=(width, passes * BITS)).astype(np.float32)


def _leading(x: np.ndarray, planes: np.ndarray) -> np.ndarray:
    return (x @ planes > 0).astype(np.int64) @ (np.int64(1) << np.arange(planes.shape[1] - 1, -1, -1, dtype=np.int64))


def _bucket_sizes(width: int, passes: int, bits: int):
    planes = _planes(width, passes)

    @shared.released
    def sizes(batches):
        for b in batches:
            x, _ = _units(b, width)
            for p in range(passes):
                bucket, n = np.unique(_leading(x, planes[:, p * BITS : p * BITS + bits]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), p, np.int32)), pa.array(bucket), pa.array(n.astype(np.int64))], ["pass", "bucket", "n"])

    return sizes


def _signatures(width: int, passes: int, bits: int, hot: dict[int, tuple[np.ndarray, np.ndarray]]):
    """hot: by pass, the buckets that are dealt to blocks (sorted) and their numbers of blocks. A row of block b goes to the pairs of blocks that b is in."""
    planes = _planes(width, passes)

    @shared.released
    def signatures(batches):
        for b in batches:
            x, ids = _units(b, width)
            for p in range(passes):
                sig = _leading(x, planes[:, p * BITS : (p + 1) * BITS])
                bucket = sig >> (BITS - bits)
                at, part = np.arange(len(ids)), np.zeros(len(ids), np.int64)
                if p in hot and len(ids):
                    buckets, blocks = hot[p]
                    k = np.minimum(np.searchsorted(buckets, bucket), len(buckets) - 1)
                    n = np.where(buckets[k] == bucket, blocks[k], 2)
                    own = (textkit.mix(ids.astype(np.uint64)) % n.astype(np.uint64)).astype(np.int64)
                    at = np.repeat(at, n - 1)
                    nth = np.arange(len(at)) - np.repeat(np.cumsum(n - 1) - (n - 1), n - 1)
                    own, n = own[at], n[at]
                    other = nth + (nth >= own)
                    part = np.where(buckets[k[at]] == bucket[at], np.minimum(own, other) * n + np.maximum(own, other), 0)
                step = max(1, BLOCK_BYTES // (4 * width))
                for s in range(0, len(at), step):
                    i = at[s : s + step]
                    raw = shared.binaries(x[i].reshape(-1), np.arange(len(i) + 1) * width)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), p, np.int32)), pa.array(bucket[i]), pa.array(part[s : s + step]), pa.array(sig[i]), pa.array(ids[i]), raw], ["pass", "bucket", "part", "sig", "vec_id", "v"])

    return signatures


def _sweep(tail, p: np.ndarray, ids: np.ndarray, x: np.ndarray, threshold: float, window: int):
    """Pairs of each vector with the next `window` ones of the same pass, range and part (the rows of p); the rows that go before the next batch."""
    if tail is not None:
        p, ids, x = (np.concatenate((o, n)) for o, n in zip(tail, (p, ids, x)))
    a, c = [], []
    for d in range(1, min(window, len(ids) - 1) + 1):
        near = np.einsum("ij,ij->i", x[:-d], x[d:])
        at = np.flatnonzero((near >= threshold) & (p[:-d] == p[d:]).all(axis=1) & (ids[:-d] != ids[d:]))
        a.append(ids[at])
        c.append(ids[at + d])
    return (p[-window:], ids[-window:], x[-window:]), np.concatenate(a or [ids[:0]]), np.concatenate(c or [ids[:0]])


def _all_pairs(ids: np.ndarray, x: np.ndarray, threshold: float):
    """All pairs of a bucket, a tile at a time."""
    for s in range(0, len(ids), TILE):
        for t in range(s, len(ids), TILE):
            i, j = np.nonzero(x[s : s + TILE] @ x[t : t + TILE].T >= threshold)
            i, j = i + s, j + t
            ok = (i < j) & (ids[i] != ids[j])
            yield ids[i[ok]], ids[j[ok]]


def _forest(ids: np.ndarray, x: np.ndarray, threshold: float):
    """Pairs of a bucket that join its components: all vectors are compared, but those already known to be in one. The ones near the
    bucket's mean come first, as the middle of a star joins all of it."""
    order = np.argsort(-(x @ x.mean(axis=0)), kind="stable")
    ids, x = ids[order], x[order]
    _, label = np.unique(ids, return_inverse=True)
    for s in range(0, len(ids), TILE):
        for t in range(s, len(ids), TILE):
            to = np.arange(t, min(t + TILE, len(ids)))
            own = label[s : s + TILE]
            if (own == own[0]).all():
                to = to[label[to] != own[0]]
            if not len(to):
                continue
            near = x[s : s + TILE] @ x[to].T >= threshold
            for i in np.flatnonzero((near & (label[s : s + TILE, None] != label[None, to])).any(axis=1)):
                hit = to[near[i]]
                found, first = np.unique(label[hit], return_index=True)
                new = found != label[s + i]
                if new.any():
                    b = ids[hit[first[new]]]
                    yield np.full(len(b), ids[s + i]), b
                    into = np.arange(label.max() + 1)
                    into[found] = label[s + i]
                    label = into[label]


def _neighbours(width: int, threshold: float, window: int, forest: bool):
    def whole(held):
        ids, x = (np.concatenate([h[k] for h in held]) for k in (0, 1))
        if len(ids) > window + 1:  # else the window has compared them all
            yield from (_forest if forest else _all_pairs)(ids, x, threshold)

    def found(batches):
        tail, held, last = None, [], None
        for b in batches:
            if not b.num_rows:
                continue
            ids, x = b.column("vec_id").to_numpy(), shared.fixed(b, "v", np.float32, width)
            key = np.stack((b.column("pass").to_numpy().astype(np.int64), b.column("bucket").to_numpy(), b.column("part").to_numpy()), axis=1)
            p = key >> np.array([0, SPAN, 0])
            starts = np.concatenate(([0], np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1, [len(key)]))
            for s, e in zip(starts[:-1], starts[1:]):
                if held and (key[s] != last).any():
                    yield from whole(held)
                    held = []
                held.append((ids[s:e], x[s:e]))
                last = key[s]
            tail, a, c = _sweep(tail, p, ids, x, threshold, window)
            yield a, c
        if held:
            yield from whole(held)

    @shared.released
    def neighbours(batches):
        for a, c in found(batches):
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(c)], ["a", "b"])

    return neighbours


def near_pairs(table: DataFrame, threshold: float = THRESHOLD, window: int = WINDOW, passes: int | None = None, forest: bool = False) -> DataFrame:
    """Verified pairs (a, b); with `forest`, of large buckets only as many as join their components."""
    rows, width = vectors(table)
    bits, enough = plan_for(rows.count(), threshold, window)
    passes, block = passes or enough, max(TILE, BLOCK_BYTES // (4 * max(width, 1)))
    sizes = rows.mapInArrow(_bucket_sizes(width, passes, bits), "pass int, bucket long, n long").groupBy("pass", "bucket").agg(F.sum("n").alias("n"))
    large = sizes.where(F.col("n") > 2 * block).orderBy("pass", "bucket").toPandas()  # at most one for 2 * block rows of a pass
    hot = {int(p): (g["bucket"].to_numpy(np.int64), -(-g["n"].to_numpy(np.int64) // block)) for p, g in large.groupby("pass")}
    signed = rows.mapInArrow(_signatures(width, passes, bits, hot), "pass int, bucket long, part long, sig long, vec_id long, v binary")
    reach = F.shiftright("bucket", SPAN)
    ordered = signed.repartitionByRange(F.col("pass"), reach, F.col("part")).sortWithinPartitions(F.col("pass"), reach, F.col("part"), F.col("sig"), F.col("vec_id"))
    return ordered.mapInArrow(_neighbours(width, threshold, window, forest), "a long, b long")


def near_groups(table: DataFrame, threshold: float = THRESHOLD, window: int = WINDOW, passes: int | None = None) -> DataFrame:
    """(vec_id, group_id, is_duplicate) of embeddings (vec_id, embedding)."""
    pairs = shared.persist_shared(near_pairs(table, threshold, window, passes, forest=True), SparkSession.active())
    linked = components.components(pairs)
    ids = table.select(table["vec_id"].cast("long").alias("vec_id")).where("vec_id is not null").distinct()
    out = ids.join(linked, ids["vec_id"] == linked["node"], "left")
    return out.select("vec_id", F.coalesce("component", "vec_id").alias("group_id"), F.col("component").isNotNull().alias("is_duplicate"))
