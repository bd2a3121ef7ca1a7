"""Sources: dumps with declared schemas, catalogues, manifests, folders of files, rasters."""

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sylvaspark import schemas

NULLS = ("", "NULL", r"\N")
CATALOGUE_NULLS = ("", "NA", "N/A", "#N/A")
CATALOGUE_FILES = {"name_usage_staging": "NameUsage.tsv", "vernacular_name": "VernacularName.tsv", "distribution": "Distribution.tsv", "media": "Media.tsv", "reference": "Reference.tsv", "type_material": "TypeMaterial.tsv"}


def dump(spark: SparkSession, path: str, table: str, release: str = "r1") -> DataFrame:
    """A tab-separated dump with a header; quotes are ordinary characters, empty fields are null, a bad row is an error."""
    return spark.read.csv(path, schema=schemas.dump(table, release), sep="\t", quote="\b", header=True, mode="FAILFAST")


def release(spark: SparkSession, folder: str, name: str = "r1", tables=("observations", "photos", "taxa", "observers")) -> dict[str, DataFrame]:
    """All tables of a release; a file that is missing is an error before anything is read."""
    fs = spark._jvm.org.apache.hadoop.fs
    for t in tables:
        p = fs.Path(f"{folder}/{t}.csv")
        if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
            raise FileNotFoundError(f"{folder}/{t}.csv")
    return {t: dump(spark, f"{folder}/{t}.csv", t, name) for t in tables}


def staging(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """A dump with the schema of an existing table."""
    return spark.read.csv(path, schema=like.schema, sep="\t", quote="\b", header=True, mode="FAILFAST")


def observations_with_markers(spark: SparkSession, path: str, most: float = 1e10) -> DataFrame:
    """Observations whose nulls may be written as NULL or \\N; anomaly scores over `most` are null."""
    s = schemas.dump("observations", "r2")
    raw = spark.read.csv(path, schema=", ".join(f"{f.name} string" for f in s), sep="\t", quote="\b", header=True)
    typed = raw.select([F.when(~F.col(f.name).isin(*NULLS), F.col(f.name)).try_cast("double" if f.name == "anomaly_score" else f.dataType).alias(f.name) for f in s])
    return typed.withColumn("anomaly_score", F.when(F.col("anomaly_score") <= most, F.col("anomaly_score")))


def lenient(spark: SparkSession, path: str, schema, sep: str = "\t") -> DataFrame:
    """Rows that don't fit the schema are skipped."""
    return spark.read.csv(path, schema=schema, sep=sep, header=True, mode="DROPMALFORMED")


def catalogue(spark: SparkSession, path: str, booleans=(), prefix: str = "col:") -> DataFrame:
    """A catalogue file: no quoting, all columns text, prefixes of the header dropped, its null marks (NA among them) null."""
    raw = spark.read.csv(path, sep="\t", quote="", header=True, inferSchema=False)
    raw = raw.toDF(*[c.removeprefix(prefix) for c in raw.columns])
    clean = raw.select([F.when(~F.col(f"`{c}`").isin(*CATALOGUE_NULLS), F.col(f"`{c}`")).alias(c) for c in raw.columns])
    return clean.withColumns({c: F.when(F.lower(c).isin("true", "1", "t"), True).when(F.lower(c).isin("false", "0", "f"), False) for c in booleans})


def catalogue_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {t: catalogue(spark, f"{folder}/{f}") for t, f in CATALOGUE_FILES.items()}


def too_wide(df: DataFrame, widths: dict[str, int]) -> DataFrame:
    """(column, width, longest) of text columns with values beyond their declared width."""
    longest = df.agg(*[F.coalesce(F.max(F.length(c)), F.lit(0)).alias(c) for c in widths])
    long = longest.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.lit(w).alias("width"), F.col(c).alias("longest")) for c, w in widths.items()])))
    return long.where("longest > width")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.csv(path, header=True)
    known = {f.name: f.dataType for f in schemas._struct(schemas.MANIFEST)}
    return df.select([F.col(c).try_cast(known[c]).alias(c) if c in known and c != "keep_flag" else (F.lower(c).isin("true", "1", "yes").alias(c) if c == "keep_flag" else F.col(c)) for c in df.columns])


def images(spark: SparkSession, folder: str, pattern: str = "*.jpg") -> DataFrame:
    """(path, filename, folder, bytes, sha256) of files below a folder."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder)
    return df.select("path", F.regexp_extract("path", r"([^/]+)$", 1).alias("filename"), F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("folder"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def parquet(spark: SparkSession, path: str, columns=None, condition=None) -> DataFrame:
    """Projection and filter reach the scan."""
    df = spark.read.parquet(path)
    df = df if condition is None else df.where(condition)
    return df if columns is None else df.select(*columns)


def jdbc(spark: SparkSession, url: str, table: str, predicates=None, **properties) -> DataFrame:
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties) if predicates else spark.read.jdbc(url, table, properties=properties)


def json_lines(spark: SparkSession, path: str, schema=None) -> DataFrame:
    return spark.read.json(path, schema=schema)


def values(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def id_list(spark: SparkSession, path: str) -> DataFrame:
    """Distinct whole numbers of a text file, one in a line."""
    return spark.read.text(path).select(F.trim("value").try_cast("bigint").alias("id")).where("id is not null").distinct()


def ascii_grids(spark: SparkSession, folder: str, tile: int = 100, pattern: str = "*.asc") -> DataFrame:
    """Tiles of ESRI ASCII grids (*.asc): tile_id, ulx, uly, px_w, px_h, cols, rows, nodata, values. One file is one task's work, and is cut to tiles as it is read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path", "content")

    def cut(batches):
        for b in batches:
            for path, raw in zip(b["path"], b["content"]):
                words = bytes(raw).split()
                head = {words[i].decode().lower(): float(words[i + 1]) for i in range(0, 12, 2)}
                n, m, size = int(head["ncols"]), int(head["nrows"]), head["cellsize"]
                grid = np.array(words[12:], np.float32).reshape(m, n)
                top = head["yllcorner"] + m * size
                rows = [(f"{path}#{r}-{c}", head["xllcorner"] + c * size, top - r * size, size, size, min(tile, n - c), min(tile, m - r), head["nodata_value"], grid[r : r + tile, c : c + tile].reshape(-1).tolist()) for r in range(0, m, tile) for c in range(0, n, tile)]
                yield pd.DataFrame(rows, columns=["tile_id", "ulx", "uly", "px_w", "px_h", "cols", "rows", "nodata", "values"])

    return files.mapInPandas(cut, "tile_id string, ulx double, uly double, px_w double, px_h double, cols int, rows int, nodata double, values array<float>")


def first_of(df: DataFrame, *names: str) -> str:
    """The first of several spellings that the table has."""
    for n in names:
        if n in df.columns:
            return n
    raise KeyError(f"none of {names} in {df.columns}")


def stacked(tables: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
