"""Paths in the folder that executors share."""

import atexit
import re
import uuid

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []
_made: list[str] = []


def _forget() -> None:
    """Deletes at the end of the process what it wrote, where the folder can be reached from here."""
    for path in [*_made, *_own]:
        try:
            fs, root = pafs.FileSystem.from_uri(path)
            if fs.get_file_info(root).type == pafs.FileType.Directory:
                fs.delete_dir(root)
        except (OSError, ValueError):  # another kind of file system, or gone
            pass


def scratch(spark: SparkSession) -> str:
    """A new path in the folder that executors share; without spark.checkpoint.dir a temporary one that goes with the process, in local mode only (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not _made and not _own:
        atexit.register(_forget)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not _own:
            import tempfile

            _own.append("file://" + tempfile.mkdtemp(prefix="scratch-"))
        base = _own[0]
    path = f"{base.rstrip('/')}/{uuid.uuid4().hex}"
    _made.append(path)
    return path


def kept(df: DataFrame) -> DataFrame:
    """The rows as a Parquet table in the shared folder: computed once, whatever reads them, and safe from lost executors."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
