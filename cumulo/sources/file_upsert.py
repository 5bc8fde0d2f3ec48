"""Upserts that rewrite only the files that can hold a touched key.

A table is a folder with data files, a list of the live files for each version and a Bloom filter for each
file. Rows are dealt into buckets by the hash of the key and written in key order, so a file has a bucket, a
range of keys and a filter. An upsert finds the files that can hold one of its keys (bucket by equality,
then range, then filter), writes the rows of those files that are not replaced together with the new
rows, and lists the new files beside the untouched ones as the next version. Readers take the
latest complete version; nothing is changed in place, so a failed upsert leaves the table as it was and
can be repeated. One writer at a time.

The filters are rows (file, block, bitmap of 32,768 bits): a key belongs to one block of its file's filter
and sets four bits in it. They are built and asked with Spark's bitmap functions and equi-joins; the driver
handles file names only.

Defined cases: NULL in a key is a value like any other; several update rows of one key all stay; an upsert
without rows makes a version equal to the last; other columns have any name that does not begin with an underscore.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_KEYS = 2500  # keys of a filter block: about 13 bits a key
BITS = 32768


def _hashes(keys: list[str]) -> dict[str, Column]:
    h, bits = F.xxhash64(*keys), F.xxhash64(F.lit(1), *keys)
    return {"_h": h, **{f"_p{i}": F.pmod(F.shiftright(bits, 15 * i), F.lit(BITS)) for i in range(4)}}


def _block(n_blocks: Column) -> Column:
    return F.pmod(F.shiftright("_h", 20), n_blocks)


def version(spark: SparkSession, path: str) -> int:
    """The latest complete version, -1 if there is none."""
    conf, n = spark._jsc.hadoopConfiguration(), 0
    while True:
        done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/files/_version={n}/_SUCCESS")
        if not done.getFileSystem(conf).exists(done):
            return n - 1
        n += 1


def live_files(spark: SparkSession, path: str) -> DataFrame:
    """file, _bucket, n, n_blocks, lo, hi of the latest version."""
    return spark.read.parquet(f"{path}/files/_version={version(spark, path)}")


def read_files(spark: SparkSession, path: str, files: list[str]) -> DataFrame:
    return spark.read.option("basePath", f"{path}/data").parquet(*files).drop("_bucket", "_version")


def read(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the latest version."""
    return read_files(spark, path, [r.file for r in live_files(spark, path).select("file").collect()])


def _add_version(rows: DataFrame, path: str, keys: list[str], n: int, buckets: int, per_file: int,
                 kept: DataFrame | None) -> None:
    """Write `rows` as data of version n, its filters, and last the list of its files and the kept ones."""
    spark, at = rows.sparkSession, f"{path}/data/_version={n}"
    dealt = rows.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    (dealt.repartitionByRange("_bucket", *keys).sortWithinPartitions("_bucket", *keys).write.mode("overwrite")
     .option("maxRecordsPerFile", per_file).partitionBy("_bucket").parquet(at))
    schema = dealt.schema  # an empty version has no file to read it from
    written = spark.read.schema(schema).parquet(at)
    keyed = written.select(F.col("_metadata.file_path").alias("file"), "_bucket", F.struct(*keys).alias("k"),
                           *[c.alias(x) for x, c in _hashes(keys).items()])
    stats = keyed.groupBy("file", "_bucket").agg(F.count(F.lit(1)).alias("n"), F.min("k").alias("lo"), F.max("k").alias("hi")) \
        .withColumn("n_blocks", F.ceil(F.col("n") / BLOCK_KEYS))
    bits = keyed.join(stats.select("file", "n_blocks"), "file").select(
        "file", _block(F.col("n_blocks")).alias("block"), F.explode(F.array(*[f"_p{i}" for i in range(4)])).alias("p"))
    (bits.groupBy("file", "block").agg(F.bitmap_construct_agg("p").alias("bits"))
     .write.mode("overwrite").parquet(f"{path}/filters/_version={n}"))
    stats = stats.select("file", "_bucket", "n", "n_blocks", "lo", "hi")
    (stats if kept is None else kept.unionByName(stats)).write.mode("overwrite").parquet(f"{path}/files/_version={n}")


def create(df: DataFrame, path: str, keys: list[str], buckets: int = 16, per_file: int = 1_000_000) -> None:
    """The first version. Choose `buckets` so that a bucket has a handful of files."""
    _add_version(df, path, keys, 0, buckets, per_file, None)


def _has_bit(bits: str, position: str) -> Column:
    byte = F.expr(f"cast(conv(hex(substring({bits}, cast({position} div 8 as int) + 1, 1)), 16, 10) as int)")
    return byte.bitwiseAND(F.expr(f"shiftleft(1, cast({position} % 8 as int))")) != 0


def touched_files(spark: SparkSession, path: str, updates: DataFrame, keys: list[str], buckets: int = 16) -> DataFrame:
    """file: live files whose bucket, range and filter admit one of the updates' keys."""
    asked = updates.select(*keys).distinct().select(
        F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("_bucket"), F.struct(*keys).alias("k"),
        *[c.alias(x) for x, c in _hashes(keys).items()])
    files = live_files(spark, path)
    may = asked.join(files, "_bucket").where("k >= lo AND k <= hi").withColumn("block", _block(F.col("n_blocks")))
    filters = spark.read.parquet(f"{path}/filters").drop("_version")
    hit = may.join(filters, ["file", "block"])
    for i in range(4):
        hit = hit.where(_has_bit("bits", f"_p{i}"))
    return hit.select("file").distinct()


def upsert(spark: SparkSession, path: str, updates: DataFrame, keys: list[str], buckets: int = 16,
           per_file: int = 1_000_000) -> list[str]:
    """Rows of `updates` replace the table's rows of the same key or are added; returns the files that were replaced.

    `buckets` must be that of `create`."""
    n = version(spark, path)
    old = [r.file for r in touched_files(spark, path, updates, keys, buckets).collect()]
    rows = updates
    if old:
        given = updates.select(F.struct(*keys).alias("_k")).distinct()
        stays = read_files(spark, path, old).withColumn("_k", F.struct(*keys)).join(given, "_k", "left_anti").drop("_k")
        rows = stays.unionByName(updates)
    gone = spark.createDataFrame([(f,) for f in old], "file string")
    _add_version(rows, path, keys, n + 1, buckets, per_file, live_files(spark, path).join(gone, "file", "left_anti"))
    return old
