"""Operator 3, exact top-k search by inner product: ball-tree branch and bound per shard.

The queries are the vectors whose vec_id is divisible by `every`; they are searched against all vectors. Vectors go to the shard of their nearest pivot, a shard beyond
twice its size is dealt to parts (so equal vectors don't crowd one), and each shard or part has a file in the shared folder and a ball tree. For a query q, a ball with
centre c and radius r holds no inner product above q.c + |q| r; leaves are visited in the order of that bound (the least along the path from the root), until it falls
below the query's kth score. Queries visit the shards in the order of the same bound, in rounds of 1, 2, 4, ... shards; after each round the kth score
found so far goes with the query, which visits only shards that can still beat it.

Defined results
- k neighbours of each query, itself (its vec_id) left out, by score, then id; fewer where the table has fewer vectors.
- Scores are rounded to 9 places before they are compared, so ties are those of exact arithmetic.
- Null and empty vectors and those with nulls or not of the commonest length are left out, as are rows without vec_id; of rows that repeat an id the one
  with the least embedding counts. Zero vectors are searched and found like others.
- Other columns are ignored; an empty table gives no rows.
The driver and each task hold the shards' balls: at most about MOST_SHARDS.
"""

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sylvaspark.llm import projections, shared

K, EVERY, SHARD_ROWS, MOST_SHARDS, LEAF, EPS = 10, 100, 8192, 1 << 15, 256, 1e-6
FOUND = "vec_id long, neighbor_id long, score double"


class Tree:
    """Leaves of a ball tree over the rows of x, with the balls on the path to each."""

    def __init__(self, x: np.ndarray, leaf: int = LEAF):
        self.leaves: list[np.ndarray] = []
        self.paths: list[list[int]] = []
        self.centers: list[np.ndarray] = []
        self.radii: list[float] = []
        todo = [(np.arange(len(x)), [])]
        while todo:
            rows, path = todo.pop()
            c = x[rows].mean(axis=0)
            path = [*path, len(self.centers)]
            self.centers.append(c)
            self.radii.append(float(np.sqrt(((x[rows] - c) ** 2).sum(axis=1).max())))
            if len(rows) <= leaf:
                self.leaves.append(rows)
                self.paths.append(path)
                continue
            a = x[rows[((x[rows] - c) ** 2).sum(axis=1).argmax()]]
            b = x[rows[((x[rows] - a) ** 2).sum(axis=1).argmax()]]
            order = rows[np.argsort(x[rows] @ (b - a), kind="stable")]
            todo += [(order[: len(rows) // 2], path), (order[len(rows) // 2 :], path)]

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """Upper bound of q . x for the queries and each leaf."""
        all_balls = q @ np.array(self.centers).T + np.linalg.norm(q, axis=1)[:, None] * np.array(self.radii)
        return np.stack([all_balls[:, p].min(axis=1) for p in self.paths], axis=1)


def search(tree: Tree, x: np.ndarray, ids: np.ndarray, q: np.ndarray, qids: np.ndarray, k: int, kth: np.ndarray):
    """(query row, id, score) of the up to k best of x for each query, those below its kth score so far left out."""
    best_s, best_i = np.full((len(q), k), -np.inf), np.full((len(q), k), np.iinfo(np.int64).max)
    kth = kth.copy()
    bounds = tree.bounds(q)
    visit = np.argsort(-bounds, axis=1, kind="stable")
    live = np.arange(len(q))
    for turn in range(len(tree.leaves)):
        live = live[bounds[live, visit[live, turn]] + EPS >= kth[live]]
        if not len(live):
            break
        which = visit[live, turn]
        order = np.argsort(which, kind="stable")
        cuts = np.flatnonzero(np.concatenate(([True], which[order][1:] != which[order][:-1])))
        for s, e in zip(cuts, np.append(cuts[1:], len(order))):
            rows, leaf = live[order[s:e]], tree.leaves[which[order[s]]]
            scores = np.round(q[rows] @ x[leaf].T, 9)
            r, c = np.nonzero((scores >= kth[rows][:, None]) & (ids[leaf][None, :] != qids[rows][:, None]))
            if not len(r):
                continue
            hit = np.unique(r)
            row = np.concatenate((r, np.repeat(hit, k)))
            sc = np.concatenate((scores[r, c], best_s[rows[hit]].reshape(-1)))
            ii = np.concatenate((ids[leaf][c], best_i[rows[hit]].reshape(-1)))
            o = np.lexsort((ii, -sc, row))
            row, sc, ii = row[o], sc[o], ii[o]
            at = np.searchsorted(row, hit)[:, None] + np.arange(k)
            best_s[rows[hit]], best_i[rows[hit]] = sc[at], ii[at]
            kth[rows[hit]] = np.maximum(kth[rows[hit]], best_s[rows[hit], k - 1])
    r, c = np.nonzero(np.isfinite(best_s))
    return r, best_i[r, c], best_s[r, c], kth


def _assign(width: int, pivots: np.ndarray):
    @shared.released
    def assign(batches):
        for b in batches:
            x = projections.matrix(b.column("embedding"), width)
            near = np.concatenate([(x[s : s + 4096] @ pivots.T - 0.5 * (pivots**2).sum(axis=1)).argmax(axis=1) for s in range(0, len(x), 4096)] or [np.zeros(0, np.int64)])
            raw = shared.binaries(np.ascontiguousarray(x).reshape(-1), np.arange(len(x) + 1) * width)
            yield pa.RecordBatch.from_arrays([pa.array(near.astype(np.int32)), b.column("vec_id"), raw], ["shard", "vec_id", "v"])

    return assign


def _load(folder: str, cell: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of a cell: a shard, or a part of one."""
    fs, root = pafs.FileSystem.from_uri(f"{folder}/cell={cell}")
    t = ds.dataset(root, filesystem=fs, format="parquet").to_table(columns=["vec_id", "v"]).combine_chunks()
    return shared.column(t, "vec_id").to_numpy(), shared.fixed(t, "v", np.float32, width).astype(np.float64)


def _balls(folder: str, width: int):
    @shared.released
    def balls(batches):
        for b in batches:
            for cell in b.column("id").to_pylist():
                _, x = _load(folder, cell, width)
                c = x.mean(axis=0)
                yield pa.RecordBatch.from_arrays([pa.array([cell]), pa.array([c.tolist()]), pa.array([float(np.sqrt(((x - c) ** 2).sum(axis=1).max()))])], ["cell", "center", "radius"])

    return balls


def _routes(width: int, cells: np.ndarray, centers: np.ndarray, radii: np.ndarray, lo: int, hi: int):
    """Each query to the cells lo to hi in the order of its bounds, as far as they can beat its kth score."""

    @shared.released
    def routes(batches):
        for b in batches:
            x, kth = shared.fixed(b, "v", np.float32, width).astype(np.float64), b.column("kth").fill_null(-np.inf).to_numpy()
            for s in range(0, len(x), 1024):
                q = x[s : s + 1024]
                bound = q @ centers.T + np.linalg.norm(q, axis=1)[:, None] * radii
                turn = np.argsort(-bound, axis=1, kind="stable")[:, lo:hi]
                row, col = np.nonzero(np.take_along_axis(bound, turn, axis=1) + EPS >= kth[s : s + 1024, None])
                r = pa.array(s + row)
                yield pa.RecordBatch.from_arrays([pa.array(cells[turn[row, col]]), b.column("vec_id").take(r), b.column("v").take(r), pa.array(kth[s + row])], ["cell", "vec_id", "v", "kth"])

    return routes


def _visit(folder: str, width: int, k: int):
    """Queries sorted by cell -> the best of each cell; a cell is read once in a partition."""

    @shared.released
    def visit(batches):
        have, ids, x, tree = None, None, None, None
        for b in batches:
            cell = b.column("cell").to_numpy()
            cuts = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1]))) if len(cell) else []
            for s, e in zip(cuts, np.append(cuts[1:], len(cell))):
                if cell[s] != have:
                    have = int(cell[s])
                    ids, x = _load(folder, have, width)
                    tree = Tree(x)
                for at in range(s, e, 4096):
                    part = b.slice(at, min(4096, e - at))
                    qids = part.column("vec_id").to_numpy()
                    r, i, score, _ = search(tree, x, ids, shared.fixed(part, "v", np.float32, width).astype(np.float64), qids, k, part.column("kth").to_numpy())
                    yield pa.RecordBatch.from_arrays([pa.array(qids[r]), pa.array(i), pa.array(score)], ["vec_id", "neighbor_id", "score"])

    return visit


def top_k(table: DataFrame, k: int = K, every: int = EVERY, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(vec_id, rank, neighbor_id, score) of embeddings (vec_id, embedding) for the queries among them."""
    spark = SparkSession.active()
    rows, width = projections.vectors(table)
    rows = shared.persist_shared(rows.groupBy("vec_id").agg(F.min("embedding").alias("embedding")), spark)
    n = rows.count()
    if not n:
        return spark.createDataFrame([], "vec_id long, rank int, neighbor_id long, score double")
    shard_rows = max(shard_rows, -(-n // MOST_SHARDS))
    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(-(-n // shard_rows)).toPandas()
    pivots = np.stack([np.asarray(v, np.float32) for v in picked["embedding"]])
    v = shared.persist_shared(rows.mapInArrow(_assign(width, pivots), "shard int, vec_id long, v binary"), spark)
    shared.forget(rows, spark)
    sizes = v.groupBy("shard").count().toPandas().sort_values("shard")
    parts = np.where(sizes["count"] > 2 * shard_rows, -(-sizes["count"] // shard_rows), 1)
    first = np.cumsum(parts) - parts
    place = spark.createDataFrame([(int(s), int(f), int(p)) for s, f, p in zip(sizes["shard"], first, parts)], "shard int, first int, parts int")
    folder = shared.shared_dir(spark)
    celled = v.join(F.broadcast(place), "shard").select((F.col("first") + F.pmod(F.xxhash64("vec_id"), "parts")).cast("int").alias("cell"), "vec_id", "v")  # at most MOST_SHARDS rows
    celled.repartition("cell").write.partitionBy("cell").parquet(folder)
    kept = spark.read.schema("vec_id long, v binary, cell int").parquet(folder)
    cells = np.array(sorted(r.cell for r in kept.select("cell").distinct().collect()), np.int64)
    held = spark.createDataFrame([(int(c),) for c in cells], "id long").repartition(min(len(cells), 4 * spark.sparkContext.defaultParallelism))
    balls = held.mapInArrow(_balls(folder, width), "cell long, center array<double>, radius double").toPandas()
    cells, centers, radii = balls["cell"].to_numpy(), np.stack(balls["center"].to_numpy()), balls["radius"].to_numpy()
    queries = shared.persist_shared(kept.where(F.col("vec_id") % F.lit(every) == 0).select("vec_id", "v"), spark)
    best, lo, turns = spark.createDataFrame([], FOUND), 0, 1
    by_score = Window.partitionBy("vec_id").orderBy(F.desc("score"), "neighbor_id")
    while lo < len(cells):
        kth = best.groupBy("vec_id").agg(F.when(F.count("*") >= k, F.min("score")).alias("kth"))
        routed = queries.join(kth, "vec_id", "left").mapInArrow(_routes(width, cells, centers, radii, lo, lo + turns), "cell long, vec_id long, v binary, kth double")
        found = routed.repartition("cell").sortWithinPartitions("cell").mapInArrow(_visit(folder, width, k), FOUND)
        old, best = best, shared.persist_shared(best.unionByName(found).withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k).drop("rank"), spark)
        if lo:
            shared.forget(old, spark)
        lo, turns = lo + turns, 2 * turns
    return best.withColumn("rank", F.row_number().over(by_score)).select("vec_id", "rank", "neighbor_id", "score")
