"""Operator 4, sharding by extendible hashing.

The directory is indexed by the leading bits of a 32-bit hash of doc_id. A bucket over the byte limit splits on its next bit, and only that one;
so shards have different depths, and each ends with the first depth at which it fits. Bytes are summed on the cluster by 16 leading
bits, and again with 8 bits more only for the cells that are too large still. The directory is a table: each cell has the shard that it belongs to, and rows meet it by
their cell; the driver holds none of it.

Defined results
- The size of a row is the bytes of its text in UTF-8; null and empty texts have 0.
- A bucket whose rows all have one hash (one large document, or rows that repeat an id) can't split: it is a shard over the limit.
- A null doc_id hashes like the empty string. Every row of the input is in one shard, repeated rows too. Other columns are ignored; an
  empty table gives no rows.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sylvaspark.llm import shared

SHARD_BYTES, BITS = 1 << 20, 32


def hash32() -> "F.Column":
    return F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 8), 16, 10).cast("long")


def _prefix(depth: int) -> "F.Column":
    return F.shiftright("h", BITS - depth)


def directory(cells: DataFrame, start: int, have: int, limit: int) -> DataFrame:
    """(cell, shard_depth, shard_prefix, shard_bytes) of cells (cell, bytes, low, high) of `have` bits: the first depth from `start` on at which the bucket that holds
    the cell fits or has one hash only; null where even the cell is too large."""
    depth = F.explode(F.sequence(F.lit(start), F.lit(have))).alias("depth")
    each = cells.select("cell", "bytes", "low", "high", depth).withColumn("prefix", F.expr(f"shiftright(cell, {have} - depth)"))
    buckets = each.groupBy("depth", "prefix").agg(F.sum("bytes").alias("total"), F.min("low").alias("least"), F.max("high").alias("most"))
    buckets = buckets.where((F.col("total") <= limit) | (F.col("least") == F.col("most")))
    first = each.join(buckets, ["depth", "prefix"]).groupBy("cell").agg(F.min_by(F.struct("depth", "prefix", "total"), "depth").alias("leaf"))
    own = cells.select("cell").join(first, "cell", "left")
    return own.select("cell", F.col("leaf.depth").alias("shard_depth"), F.col("leaf.prefix").alias("shard_prefix"), F.col("leaf.total").alias("shard_bytes"))


def sharded(docs: DataFrame, limit: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, n_bytes, shard_depth, shard_prefix, shard_bytes) of documents (doc_id, text): the shard is a prefix of shard_depth bits."""
    spark = SparkSession.active()
    rows = shared.documents(docs, "doc_id", "text").select("doc_id", hash32().alias("h"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    rows = shared.persist_shared(rows, spark)
    names = ["doc_id", "n_bytes", "shard_depth", "shard_prefix", "shard_bytes"]
    out, start = None, 0
    for have in (16, 24, 32):
        part = rows.withColumn("cell", _prefix(have))
        cells = part.groupBy("cell").agg(F.sum("n_bytes").alias("bytes"), F.min("h").alias("low"), F.max("h").alias("high"))
        found = shared.persist_shared(directory(cells, start, have, limit), spark)
        rows = part.join(found, "cell").drop("cell")
        done = rows.where("shard_depth is not null").select(*names)
        out = done if out is None else out.unionByName(done)
        if found.where("shard_depth is null").isEmpty():
            break
        start, rows = have + 1, rows.where("shard_depth is null").select("doc_id", "h", "n_bytes")
    return out
