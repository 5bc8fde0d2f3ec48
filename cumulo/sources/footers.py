"""What Parquet footers say about a layout, read by the tasks that hold the file names.

A footer lists row groups and, for each of their columns, bytes, values, NULLs and the smallest and
largest value. Only footers are read, a file at a time, through the file system that the path names.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

COLUMNS = ("variant string, file string, row_group int, column string, num_rows long, num_nulls long, "
           "compressed_bytes long, uncompressed_bytes long, lo double, hi double")


def _number(value) -> float | None:
    """A value on the number line, None for what has no place on it."""
    if isinstance(value, bool):
        return float(value)
    if isinstance(value, (int, float)):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=value.tzinfo or dt.timezone.utc).timestamp()
    if isinstance(value, dt.date):
        return float(value.toordinal())
    return None


def footers(variants: Mapping[str, DataFrame]) -> DataFrame:
    """One row per variant, file, row group and column of the files behind each DataFrame (a plain file scan)."""
    files = [(name, f) for name, df in variants.items() for f in df.inputFiles()]
    spark = next(iter(variants.values())).sparkSession
    schema = pa.schema([("variant", pa.string()), ("file", pa.string()), ("row_group", pa.int32()), ("column", pa.string()),
                        *((c, pa.int64()) for c in ("num_rows", "num_nulls", "compressed_bytes", "uncompressed_bytes")),
                        ("lo", pa.float64()), ("hi", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq
        from pyarrow import fs
        for b in batches:
            for name, uri in zip(b.column("variant").to_pylist(), b.column("file").to_pylist()):
                system, path = fs.FileSystem.from_uri(uri)
                with system.open_input_file(path) as f:
                    meta = pq.ParquetFile(f).metadata
                rows = []
                for g in range(meta.num_row_groups):
                    group = meta.row_group(g)
                    for c in range(group.num_columns):
                        col = group.column(c)
                        s = col.statistics
                        ranged = s is not None and s.has_min_max
                        rows.append({"variant": name, "file": uri, "row_group": g, "column": col.path_in_schema,
                                     "num_rows": group.num_rows, "num_nulls": s.null_count if s is not None and s.has_null_count else None,
                                     "compressed_bytes": col.total_compressed_size, "uncompressed_bytes": col.total_uncompressed_size,
                                     "lo": _number(s.min) if ranged else None, "hi": _number(s.max) if ranged else None})
                yield pa.RecordBatch.from_pylist(rows, schema)

    listed = spark.createDataFrame(files, "variant string, file string")
    return listed.repartition(max(1, min(len(files), 1000))).mapInArrow(run, COLUMNS)


def column_sizes(feet: DataFrame) -> DataFrame:
    """variant, column, num_rows, num_nulls, row_groups, compressed_bytes, uncompressed_bytes."""
    return feet.groupBy("variant", "column").agg(
        F.sum("num_rows").alias("num_rows"), F.sum("num_nulls").alias("num_nulls"), F.count(F.lit(1)).alias("row_groups"),
        F.sum("compressed_bytes").alias("compressed_bytes"), F.sum("uncompressed_bytes").alias("uncompressed_bytes"))


def range_overlap(feet: DataFrame) -> DataFrame:
    """variant, column, row_groups, mean_hit: the mean share of row groups whose range admits a value that is the
    smallest of one of them, that is how little a filter on the column can leave out (1 / row_groups is best).

    Row groups that begin up to a value less those that end before it; counted by rank, without pairs."""
    ranged = feet.where("lo IS NOT NULL AND hi IS NOT NULL")
    ends = ranged.select("variant", "column", F.col("lo").alias("at"), F.lit(1).alias("begins"), F.lit(0).alias("ends")).union(
        ranged.select("variant", "column", F.col("hi").alias("at"), F.lit(0), F.lit(1)))
    # one row for each distinct value of a column's ranges: as many as row groups at most twice
    at = ends.groupBy("variant", "column", "at").agg(F.sum("begins").alias("begins"), F.sum("ends").alias("ends"))
    upto = Window.partitionBy("variant", "column").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("variant", "column").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    depth = at.withColumn("depth", F.sum("begins").over(upto) - F.coalesce(F.sum("ends").over(before), F.lit(0)))
    return depth.groupBy("variant", "column").agg(
        F.sum("begins").alias("row_groups"),
        (F.sum(F.col("depth") * F.col("begins")) / F.sum("begins") / F.sum("begins")).alias("mean_hit"))
