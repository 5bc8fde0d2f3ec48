"""Small helpers shared by the operators: words, intermediate tables, worker settings."""

from __future__ import annotations

import ctypes
import functools
import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cumulo.session import ensure_checkpoint_dir

#: What separates words: space, tab, line feed, vertical tab, form feed, carriage return.
BREAKS = "[\\x20\\x09-\\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: Rows of an Arrow batch sent to a Python worker (whole texts, so far fewer than Spark's default).
ARROW_ROWS = "1000"
#: Bytes of an Arrow batch, where the rows are long.
ARROW_BYTES = "16m"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; NULL stays NULL."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """Words of a text as an array; NULL and blank texts give an empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BREAKS), "")


def package_root() -> str:
    return os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def prepare(spark: SparkSession) -> None:
    """Worker settings for whole-text batches. Python workers must find this package: on a
    cluster it is installed or sent along (--py-files); where the same path exists, this is enough."""
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    env = spark.sparkContext.environment
    root = package_root()
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(p for p in (root, env.get("PYTHONPATH", "")) if p)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared checkpoint folder; Spark's file system removes it when the driver ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(jpath.getParent())
    fs.deleteOnExit(jpath)
    return path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back: its lineage ends in
    files that every executor can read, so a lost executor costs one re-read, not a re-run."""
    path = shared_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Hand memory that Python and Arrow have freed back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """`run` over the batches of a task, with `give_back` at its end: workers live on through later stages."""
    @functools.wraps(run)
    def whole(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()
    return whole
