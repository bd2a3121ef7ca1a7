"""Operator 9, best-fit packing of documents into bins of `capacity` tokens, by large-item matching.

A document of more than `capacity` tokens is cut into full bins and one remaining piece. Pieces above one third of the capacity are large; a bin
takes two of them at most: from the largest on, each is matched with the largest unmatched one that still fits. Smaller pieces, from
the largest on, go to the bin with the least room that holds them. Documents are packed in groups of about
`group_tokens` tokens, by a hash of doc_id, each group on its own; a group has a bin at most that is filled for want of pieces. Rows that share an id (or have none) are
spread over the groups as well, and numbered by parts, so that an id that a third of all rows have makes no group larger.

Defined results
- Tokens are runs of non-blank characters; documents without one (null and empty texts among them) are in no bin.
- Every token of every other row is in one bin: a row has pieces piece_no = 0, 1, ... that start at token `start`.
- A repeated row is packed as often as it comes; its copies are told apart by copy_no. A null doc_id is packed like any other.
- Ties go by doc_id, copy_no and piece_no. Other columns are ignored; an empty table gives no rows.
"""

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sylvaspark.llm import mixing, shared

CAPACITY, GROUP_TOKENS, PARTS = 2048, 1 << 22, 1024
SCHEMA = "bin_id string, doc_id long, copy_no long, piece_no long, start long, n_tokens long"


def pack(size: np.ndarray, capacity: int) -> np.ndarray:
    """Bin of each piece (sizes 1..capacity, in the order in which ties go)."""
    order = np.argsort(-size, kind="stable")
    out = np.full(len(size), -1, np.int64)
    big = order[size[order] * 3 > capacity].tolist()
    room: list[int] = []
    # large pieces: unmatched ones wait by size, in a union-find over sizes that finds the largest size that fits
    waiting: dict[int, list[int]] = {}
    for i in reversed(big):
        waiting.setdefault(int(size[i]), []).append(i)
    below = list(range(capacity + 1))

    def largest(s: int) -> int:
        while below[s] != s:
            below[s] = below[below[s]]
            s = below[s]
        return s

    for s in range(capacity, 0, -1):
        if s not in waiting:
            below[s] = s - 1

    def take(s: int) -> int:
        i = waiting[s].pop()
        if not waiting[s]:
            below[s] = s - 1
        return i

    while s := largest(capacity):
        i = take(s)
        left, out[i] = capacity - s, len(room)
        if mate := largest(left):
            out[take(mate)] = len(room)
            left -= mate
        room.append(left)
    # small pieces: bins by room; a bitmap of the rooms that exist, as one integer, finds the least that holds the piece
    bins: dict[int, list[int]] = {}
    mask = 0
    for b in range(len(room) - 1, -1, -1):
        bins.setdefault(room[b], []).append(b)
        mask |= 1 << room[b]
    for heap in bins.values():
        heap.sort()
    for i in order[size[order] * 3 <= capacity].tolist():
        s = int(size[i])
        fits = mask >> s
        if fits:
            r = s + (fits & -fits).bit_length() - 1
            b = heapq.heappop(bins[r])
            if not bins[r]:
                mask ^= 1 << r
        else:
            r, b = capacity, len(room)
            room.append(capacity)
        out[i] = b
        room[b] = r = r - s
        heapq.heappush(bins.setdefault(r, []), b)
        mask |= 1 << r
    return out


def _packing(capacity: int):
    @shared.released
    def packing(batches):
        for t in shared.grouped(batches, "group"):
            g, doc, copy, n = shared.column(t, "group").to_numpy(), shared.column(t, "doc_id"), shared.column(t, "copy_no").to_numpy(), shared.column(t, "n_tokens").to_numpy()
            cuts = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1])))
            for s, e in zip(cuts, np.append(cuts[1:], len(g))):
                many = -(-n[s:e] // capacity)
                row = s + np.repeat(np.arange(e - s), many)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
                size = np.minimum(n[row] - piece * capacity, capacity)
                b = pack(size, capacity)
                names = pa.array([f"{g[s]}-{x}" for x in b.tolist()])
                yield pa.RecordBatch.from_arrays([names, doc.take(pa.array(row)), pa.array(copy[row]), pa.array(piece), pa.array(piece * capacity), pa.array(size)], ["bin_id", "doc_id", "copy_no", "piece_no", "start", "n_tokens"])

    return packing


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows (doc_id, n_tokens, salt) with copy_no: 0, 1, ... for the rows of one doc_id, by parts of at most about a PARTS-th of them."""
    part = F.pmod(F.xxhash64("salt"), F.lit(PARTS)).cast("int")
    counts = rows.groupBy("doc_id").agg(F.count("*").alias("rows"))
    several = counts.where("rows > 1").select(F.col("doc_id").alias("id"))
    by_part = Window.partitionBy("doc_id").orderBy("part")
    sizes = rows.join(several, rows["doc_id"].eqNullSafe(several["id"]), "left_semi").groupBy("doc_id", part.alias("part")).agg(F.count("*").alias("n"))
    sizes = sizes.withColumn("first", F.sum("n").over(by_part) - F.col("n"))
    sizes = sizes.select(F.col("doc_id").alias("id"), F.col("part").alias("of_part"), "first")
    rows = rows.withColumn("part", part)
    joined = rows.join(sizes, rows["doc_id"].eqNullSafe(sizes["id"]) & (rows["part"] == sizes["of_part"]), "left")
    within = F.row_number().over(Window.partitionBy("doc_id", "part").orderBy("n_tokens", "salt"))
    return joined.withColumn("copy_no", F.when(F.col("first").isNull(), F.lit(0)).otherwise(F.col("first") + within - 1).cast("long"))


def packed(docs: DataFrame, capacity: int = CAPACITY, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """(bin_id, doc_id, copy_no, piece_no, start, n_tokens) of documents (doc_id, text)."""
    spark = SparkSession.active()
    rows = shared.documents(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), mixing.tokens().alias("n_tokens")).where("n_tokens > 0")
    rows = shared.persist_shared(rows.withColumn("salt", F.monotonically_increasing_id()), spark)  # written, so that a row keeps its number
    total = rows.agg(F.sum("n_tokens")).first()[0] or 0
    groups = max(1, -(-total // group_tokens))
    rows = _numbered(rows).withColumn("group", F.pmod(F.xxhash64("doc_id", "copy_no"), F.lit(groups)))
    rows = rows.select("group", "doc_id", "copy_no", "n_tokens").repartition(min(groups, 100_000), "group").sortWithinPartitions("group", "doc_id", "copy_no")
    return rows.mapInArrow(_packing(capacity), SCHEMA)
