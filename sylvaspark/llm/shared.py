"""Tables written to the folder that all executors share, streams of sorted groups, and small helpers."""

import atexit
import ctypes
import functools
import re
import shutil
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own: dict[str, str] = {}

#: Bytes of an Arrow batch between the JVM and a Python worker, unless the session asks for fewer.
BATCH_BYTES = 8 << 20

#: 64-bit words of the bitmap by which documents are filtered before a join: 2 MB with their keys at most.
FILTER_WORDS = 1 << 17


def release() -> None:
    """Gives the memory that this Python worker has freed back to the system: workers live on between stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def released(f):
    """A function over batches that gives its memory back when its partition ends."""

    @functools.wraps(f)
    def run(batches):
        try:
            yield from f(batches)
        finally:
            release()

    return run


def small_batches(spark: SparkSession) -> None:
    """Bounds the Arrow batches of the session by BATCH_BYTES: rows of long texts would make batches of 64 MB in the JVM and in Python."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = re.fullmatch(r"(\d+)([kmgt]?)b?", spark.conf.get(key).lower())
    if not now or int(now[1]) << 10 * " kmgt".index(now[2] or " ") > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """A new path below spark.checkpoint.dir. Where that is unset, a temporary folder that goes with the process, in local mode only (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if "base" not in _own:
            _own["base"] = tempfile.mkdtemp(prefix="llm-")
            atexit.register(shutil.rmtree, _own["base"], ignore_errors=True)
        base = "file://" + _own["base"]
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def persist_shared(df: DataFrame, spark: SparkSession) -> DataFrame:
    """Cuts lineage: the rows are written as Parquet in the shared folder and read back."""
    path = shared_dir(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(df: DataFrame, spark: SparkSession) -> None:
    """Deletes the files behind a persist_shared() table that nothing will read again."""
    for f in {x.rsplit("/", 1)[0] for x in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(f)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def documents(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns of a documents table, whatever else it holds; its texts go to Python in small batches."""
    small_batches(df.sparkSession)
    return df.select(*[df[c] for c in columns])


def among(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The documents that may have a doc_id of `wanted`, by a bitmap of FILTER_WORDS * 64 hashes: broadcast whatever the table's size, so that few other texts are shuffled to be joined."""
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(64 * FILTER_WORDS))
    word, bit = F.floor(place / 64).alias("_word"), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(64)).cast("int"))
    bitmap = wanted.select(word, bit.alias("b")).groupBy("_word").agg(F.bit_or("b").alias("_bits"))
    own = docs.select("*", word)
    return own.join(F.broadcast(bitmap), "_word").where(F.col("_bits").bitwiseAND(bit) != 0).drop("_word", "_bits")


def grouped(batches, key: str = "key"):
    """Batches of a stream sorted by an integer key -> tables that hold whole groups only."""
    rest = None
    for b in batches:
        t = pa.Table.from_batches([b])
        if not t.num_rows:
            continue
        t = t if rest is None else pa.concat_tables([rest, t])
        k = t.column(key).to_numpy()
        cut = int(np.searchsorted(k, k[-1], "left"))
        if cut:
            yield t.slice(0, cut).combine_chunks()
        rest = t.slice(cut)
    if rest is not None and rest.num_rows:
        yield rest.combine_chunks()


def column(t, name: str) -> pa.Array:
    c = t[name] if isinstance(t, dict) else t.column(name)
    return (c.combine_chunks() if c.num_chunks != 1 else c.chunk(0)) if isinstance(c, pa.ChunkedArray) else c


def fixed(t, name: str, dtype, width: int) -> np.ndarray:
    """A column of binaries of one length as a matrix."""
    c = column(t, name).cast(pa.large_binary())
    _, off, data = c.buffers()
    if not len(c):
        return np.zeros((0, width), dtype)
    o = np.frombuffer(off, np.int64)[c.offset : c.offset + len(c) + 1]
    return np.frombuffer(data, np.uint8)[o[0] : o[-1]].view(dtype).reshape(len(c), width)


def ragged(t, name: str, dtype) -> tuple[np.ndarray, np.ndarray]:
    """A column of binaries as (values, ptr)."""
    c = column(t, name).cast(pa.large_binary())
    _, off, data = c.buffers()
    if not len(c):
        return np.zeros(0, dtype), np.zeros(1, np.int64)
    o = np.frombuffer(off, np.int64)[c.offset : c.offset + len(c) + 1]
    size = np.dtype(dtype).itemsize
    return np.frombuffer(data.slice(o[0], o[-1] - o[0]) if data is not None else b"", dtype), (o - o[0]) // size


def binaries(values: np.ndarray, ptr: np.ndarray) -> pa.Array:
    """values[ptr[i]:ptr[i+1]] as binaries."""
    data = np.ascontiguousarray(values)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ptr) - 1, [None, pa.py_buffer(np.ascontiguousarray(ptr, dtype=np.int64) * data.itemsize), pa.py_buffer(data)]).cast(pa.binary())
