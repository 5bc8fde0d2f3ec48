"""Readers, writers and layout tools."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None,
             header: bool = True) -> DataFrame:
    """A1: CSV with a header. With no schema every column is a string (A2 types it)."""
    r = spark.read.option("header", header).option("mode", "PERMISSIVE")
    if schema is not None:
        r = r.schema(schema)
    return r.csv(path)


def apply_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """A2: project a string table onto typed columns, by name, in one select.

    `try_cast` turns malformed values into NULL instead of failing the job
    (ANSI mode would raise on the first bad row).
    """
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def write_bucketed(df: DataFrame, table: str, buckets: int, keys: list[str],
                   sort_by: list[str] | None = None, partition_by: list[str] | None = None,
                   mode: str = "overwrite", fmt: str = "parquet", path: str | None = None) -> None:
    """Bucketed (and optionally partitioned) table so later joins on `keys` skip the shuffle.
    With `path` the table is external."""
    w = df.write.format(fmt).mode(mode).bucketBy(buckets, *keys)
    if path:
        w = w.option("path", path)
    if sort_by:
        w = w.sortBy(*sort_by)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(table)


def write_partitioned(df: DataFrame, path: str, partition_by: list[str],
                      mode: str = "overwrite", sort_within: list[str] | None = None) -> None:
    """Identity-partitioned parquet. With the session's dynamic
    partition overwrite only the partitions present in `df` are replaced, so a
    re-run of one snapshot date is idempotent."""
    if sort_within:
        df = df.sortWithinPartitions(*sort_within)
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def with_year_partition(df: DataFrame, ts_col: str, out: str = "year") -> DataFrame:
    """`years(ts)` transform as a derived column (parquet tables reject transforms).
    Queries must filter on `out` for pruning."""
    return df.withColumn(out, F.year(F.col(ts_col)))


def insert_into(df: DataFrame, table: str, overwrite: bool = True) -> None:
    """insertInto by position into an existing table; columns are put
    in the table's order first so the positional insert is by name."""
    cols = df.sparkSession.table(table).columns
    df.select(*cols).write.insertInto(table, overwrite=overwrite)


def upsert(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of `updates` replace rows of `target` with the same key.

    One shuffle on the key (anti join) plus a union; no MERGE needed.
    """
    keep = target.join(updates.select(*keys).distinct(), on=keys, how="left_anti")
    return keep.unionByName(updates, allowMissingColumns=False)


def create_table_as(df: DataFrame, table: str, mode: str = "overwrite",
                    partition_by: list[str] | None = None, path: str | None = None) -> None:
    """CTAS (overwrite replaces an existing table); with `path` the table is external."""
    w = df.write.mode(mode).format("parquet")
    if path:
        w = w.option("path", path)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(table)


def drop_table(spark: SparkSession, table: str) -> None:
    """Drop a table if it exists."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def ensure_database(spark: SparkSession, name: str) -> None:
    """Create a database (schema) if it does not exist."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def layout_report(frames: dict[str, DataFrame]) -> DataFrame:
    """Bytes and file count per table variant, from file metadata.

    Reads only the `_metadata` struct, deduplicated per file, so the cost is
    one pass over file footers, not the data.
    """
    out = None
    for name, df in frames.items():
        part = (df.select(F.col("_metadata.file_path").alias("file_path"),
                          F.col("_metadata.file_size").alias("file_size"))
                .distinct()
                .agg(F.sum("file_size").cast("bigint").alias("size_bytes"),
                     F.count("*").alias("num_files"))
                .select(F.lit(name).alias("variant"), "size_bytes", "num_files"))
        out = part if out is None else out.unionByName(part)
    return out


@contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Persist a shared intermediate for the block, then release it."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Catalog listing as a DataFrame (metadata only)."""
    rows = [(t.name, t.database, t.tableType, t.isTemporary)
            for t in spark.catalog.listTables(database)]
    return spark.createDataFrame(rows, "name string, database string, table_type string, is_temporary boolean")


def list_columns(spark: SparkSession, table: str) -> DataFrame:
    """A table's columns in order, with type and partition / bucket marks (metadata only)."""
    rows = [(i, c.name, c.dataType, c.nullable, c.isPartition, c.isBucket) for i, c in enumerate(spark.catalog.listColumns(table))]
    return spark.createDataFrame(rows, "position int, name string, data_type string, nullable boolean, is_partition boolean, "
                                       "is_bucket boolean")


def column_profile(df: DataFrame) -> DataFrame:
    """One row per column: name, type, rows, NULLs, smallest and largest value as text; one scan."""
    fields = [f for f in df.schema.fields]
    agg = df.agg(F.count(F.lit(1)).alias("num_rows"), *[x for i, f in enumerate(fields) for x in (
        F.count_if(F.col(f"`{f.name}`").isNull()).alias(f"_n{i}"), F.min(f"`{f.name}`").cast("string").alias(f"_lo{i}"),
        F.max(f"`{f.name}`").cast("string").alias(f"_hi{i}"))])
    row = lambda i, f: F.struct(
        F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("data_type"), F.col("num_rows"),
        F.col(f"_n{i}").alias("num_nulls"), F.col(f"_lo{i}").alias("lowest"), F.col(f"_hi{i}").alias("highest"))
    return agg.select(F.inline(F.array(*[row(i, f) for i, f in enumerate(fields)])))


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The physical plan as text (for plan assertions in tests)."""
    qe = df._jdf.queryExecution()
    return df.sparkSession._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(qe, mode)
