"""Streaming forms of the batch jobs (an extension: the batch forms are authoritative)."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def drops(spark: SparkSession, folder: str, schema, files_per_batch: int = 1, fmt: str = "parquet", **options) -> DataFrame:
    """New files of a folder."""
    return spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_batch).options(**options).load(folder)


def rates(events: DataFrame, window: str = "30 minutes", late: str = "1 hour", ts: str = "ts") -> DataFrame:
    """Rows and their rate in each window; rows later than `late` are dropped."""
    w = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late).groupBy(F.window(ts, window)).agg(F.count("*").alias("n"), F.min(ts).alias("lo"), F.max(ts).alias("hi"))
    seconds = F.unix_micros("hi") / 1e6 - F.unix_micros("lo") / 1e6
    return w.select(F.col("window.start").alias("start"), "n", F.try_divide("n", seconds).alias("per_second"))


def upsert_into(target: str, key: str):
    """foreachBatch function: appends rows whose key the Parquet table lacks. Running a batch again adds nothing."""

    def merge(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        batch = batch.dropDuplicates([key])
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/_SUCCESS")
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            batch = batch.join(spark.read.parquet(target).select(key), key, "left_anti")
        batch.write.mode("append").parquet(target)

    return merge


def run_available(stream: DataFrame, merge, checkpoint: str) -> None:
    """Processes what is there, in checkpointed batches, and stops; a second run resumes behind the first."""
    stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def first_seen(stream: DataFrame, key: str, ts: str, late: str) -> DataFrame:
    """Rows without repetitions of a key within the watermark."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late).dropDuplicatesWithinWatermark([key])
