"""Connected components of an edge table: unions inside partitions, then large-star and small-star steps until nothing moves."""

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sylvaspark.llm import shared


@shared.released
def _unions(batches):
    """(node, lowest node of its component within the partition) as edges (a, b), a > b."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = x = parent.setdefault(p, p)
        return x

    for b in batches:
        for x, y in zip(b.column("a").to_pylist(), b.column("b").to_pylist()):
            x, y = root(x), root(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
    star = [(x, r) for x in list(parent) if (r := root(x)) != x]
    if star:
        yield pa.RecordBatch.from_arrays([pa.array([s[0] for s in star], pa.int64()), pa.array([s[1] for s in star], pa.int64())], ["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the lowest node of its component, for every node that isn't the lowest itself. Edges have columns a and b (long);
    repeated edges, loops and both directions may come."""
    spark = SparkSession.active()
    own = Window.partitionBy("a")

    def measured(df: DataFrame):
        df = shared.persist_shared(df, spark)
        return df, df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    stars, mark = measured(edges.select("a", "b").where("a <> b").mapInArrow(_unions, "a long, b long").distinct())
    while mark[0]:
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.withColumn("m", F.least(F.min("b").over(own), "a")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        small = large.withColumn("m", F.min("b").over(own))
        small = small.select(F.inline(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))))).where("a <> b").distinct()
        new, new_mark = measured(small)
        shared.forget(stars, spark)
        stars = new
        if new_mark == mark:
            break
        mark = new_mark
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component"))
