"""Sinks: sorted exports, reports, tables, JSON lines, upserts and their checks."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def sorted_tsv(df: DataFrame, path: str, *order, single_file: bool = False) -> None:
    """Tab-separated with a header, nulls empty, in global order: files of a range each, or a single file."""
    df = df.orderBy(*order)
    (df.coalesce(1) if single_file else df).write.mode("overwrite").csv(path, sep="\t", header=True, nullValue="", emptyValue="")


def csv_report(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").csv(path, header=True)


def table(df: DataFrame, path: str, partition_by=()) -> DataFrame:
    """Create-table-as-select: written as Parquet and read back."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return SparkSession.active().read.schema(df.schema).parquet(path) if not partition_by else SparkSession.active().read.parquet(path)


def json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def summary_text(stats: DataFrame, **parameters) -> str:
    """Parameters and the one row of figures, a line each."""
    row = stats.first().asDict()
    return "\n".join([f"{k}: {v}" for k, v in {**parameters, **row}.items()])


def verify_counts(**counts: DataFrame) -> int:
    """The number of rows that all the tables have; different numbers are an error."""
    n = {k: df.count() for k, df in counts.items()}
    if len(set(n.values())) > 1:
        raise ValueError(f"row counts differ: {n}")
    return next(iter(n.values()))


def materialise_files(df: DataFrame, folder: str) -> DataFrame:
    """Links (path, flat_name) of local files into a folder, copies where a link can't be made: (flat_name, result), result linked, copied, present or failed."""
    import os
    import shutil

    import pandas as pd

    def link(batches):
        for b in batches:
            out = []
            for path, name in zip(b["path"], b["flat_name"]):
                source, target = path.removeprefix("file:"), os.path.join(folder, name)
                try:
                    if os.path.exists(target):
                        out.append("present")
                        continue
                    try:
                        os.link(source, target)
                        out.append("linked")
                    except OSError:
                        shutil.copy(source, target)
                        out.append("copied")
                except OSError:
                    out.append("failed")
            yield pd.DataFrame({"flat_name": b["flat_name"], "result": out})

    return df.select("path", "flat_name").mapInPandas(link, "flat_name string, result string")


def counts(**tables: DataFrame) -> DataFrame:
    """(table, n) of several tables."""
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(k).alias("table"), "n") for k, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
