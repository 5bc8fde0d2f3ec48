"""Daily incremental jobs over stored snapshot tables (A7, A9, 3.1 / 3.2).

A job reads yesterday's partition of a snapshot table, applies a step
operator with today's facts and writes today's partition with dynamic
partition overwrite: re-running a day replaces that day only, and a failed
run leaves earlier partitions untouched. A day whose previous day is not
stored is refused (unless the caller allows the gap): it would lose every
key's history. Paths are shared storage (the
caller's warehouse or table location), never machine-local folders.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _path_exists(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


def previous_day(stored: DataFrame, part_col: str, day: dt.date, allow_gap: bool = False) -> dt.date | None:
    """The partition that `day` builds on: the day before, which must be there unless nothing earlier
    is stored. With `allow_gap` the latest earlier day is taken instead."""
    last = stored.filter(F.col(part_col) < F.lit(day)).agg(F.max(part_col)).first()[0]
    if last is not None and last != day - dt.timedelta(days=1) and not allow_gap:
        raise ValueError(f"no partition for the day before {day}; the latest is {last}")
    return last


def read_partition(spark: SparkSession, path: str, part_col: str, day: dt.date,
                   allow_gap: bool = False) -> DataFrame | None:
    """The partition that `day` builds on, or None before the first run."""
    if not _path_exists(spark, path):
        return None
    df = spark.read.parquet(path)
    prev = previous_day(df, part_col, day, allow_gap)
    return None if prev is None else df.filter(F.col(part_col) == F.lit(prev))


def run_step(spark: SparkSession, path: str, part_col: str, day: dt.date,
             step: Callable[[DataFrame | None, dt.date], DataFrame], allow_gap: bool = False) -> DataFrame:
    """Run `step(previous_partition, day)` and write its rows as partition `day`."""
    prev = read_partition(spark, path, part_col, day, allow_gap)
    out = step(prev, day)
    out = out.withColumn(part_col, F.lit(day).cast("date"))
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(part_col).parquet(path))
    return spark.read.parquet(path).filter(F.col(part_col) == F.lit(day))


def run_range(spark: SparkSession, path: str, part_col: str, start: dt.date, end: dt.date,
              step: Callable[[DataFrame | None, dt.date], DataFrame]) -> None:
    """Backfill day by day with the step (each day reads the stored previous day,
    so the lineage never grows across days)."""
    d = start
    while d <= end:
        run_step(spark, path, part_col, d, step)
        d += dt.timedelta(days=1)


def run_step_table(spark: SparkSession, table: str, part_col: str, day: dt.date,
                   step: Callable[[DataFrame | None, dt.date], DataFrame],
                   key: list[str] | None = None, buckets: int = 16, allow_gap: bool = False) -> DataFrame:
    """Like `run_step`, into a catalog table partitioned by day and, with
    `key`, bucketed (and sorted) by the entity key.

    Yesterday's partition then keeps its bucketing when read back, so the
    step's full outer join on the key shuffles only today's rows into the
    table's buckets; the large snapshot is never re-shuffled. Later days
    are added with `insertInto` and dynamic partition overwrite.
    """
    exists = spark.catalog.tableExists(table)
    last = previous_day(spark.table(table), part_col, day, allow_gap) if exists else None
    prev = None if last is None else spark.table(table).filter(F.col(part_col) == F.lit(last)).drop(part_col)
    out = step(prev, day).withColumn(part_col, F.lit(day).cast("date"))
    if not exists:
        w = out.write.format("parquet").mode("overwrite").partitionBy(part_col)
        if key:
            w = w.bucketBy(buckets, *key).sortBy(*key)
        w.saveAsTable(table)
    else:
        out.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)
    return spark.table(table).filter(F.col(part_col) == F.lit(day))
