"""Places for tables that a query writes for itself: one name for each run, removed when the driver ends."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from cumulo.session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared checkpoint folder; Spark's file system removes it when the driver ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/cumulo/{name}-{uuid.uuid4().hex}"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(jpath.getParent())
    fs.deleteOnExit(jpath)
    return path


def scratch_table(spark: SparkSession, name: str) -> tuple[str, str]:
    """(table name, path) of a table of this run; written with the path it is an external table."""
    return f"{name}_{uuid.uuid4().hex}", scratch_path(spark, name)


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written to a scratch path and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings for the plans made inside the block; what was set before is put back."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
