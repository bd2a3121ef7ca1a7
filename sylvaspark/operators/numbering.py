"""Numbers in a global order, without a window over one partition."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sylvaspark.plans.scratch import kept


def numbered(df: DataFrame, *order: str, name: str = "rn") -> DataFrame:
    """Rows with `name` = 1, 2, ... in the order of the columns. Rows are range-partitioned and kept; each range numbers its own, and starts behind the rows of the ranges before it.
    The order should be total: ties may be numbered either way."""
    ranged = kept(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).select("_range", "_before")  # one row a range
    own = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return ranged.withColumn(name, own).join(F.broadcast(before), "_range").withColumn(name, F.col(name) + F.col("_before")).drop("_range", "_before")


def batches(df: DataFrame, key: str, size: int, max_rows: int | None = None) -> DataFrame:
    """Batch numbers 0, 1, ... of `size` rows in the order of a unique key, to run a job in parts or to page through a table; at most max_rows rows."""
    ranked = numbered(df, key, name="_rn")
    ranked = ranked if max_rows is None else ranked.where(F.col("_rn") <= max_rows)
    return ranked.withColumn("batch", F.floor((F.col("_rn") - 1) / size).cast("int")).drop("_rn")
