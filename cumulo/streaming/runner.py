"""Sources, sinks and checkpoints for the streaming jobs.

Kafka and JDBC need connector jars that are not on the local classpath;
they are options here, exercised on a cluster. Tests use the file source
and the memory / parquet sinks, which have the same semantics.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from cumulo.session import ensure_checkpoint_dir
from cumulo.streaming.windows import parse_event_time, with_watermark

# The landed event schema (raw event time is a string).
EVENT_SCHEMA = StructType([StructField(c, StringType()) for c in
                           ("ip", "event_time", "referrer", "host", "url", "geodata")])


def file_source(spark: SparkSession, path: str, schema: StructType = EVENT_SCHEMA, fmt: str = "json",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """A12 (file form): JSON / parquet files arriving in a directory."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def kafka_source(spark: SparkSession, servers: str, topic: str, schema: StructType = EVENT_SCHEMA,
                 starting_offsets: str = "latest") -> DataFrame:
    """Kafka JSON values parsed with a schema, starting at the latest offset."""
    raw = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
           .option("subscribe", topic).option("startingOffsets", starting_offsets).load())
    return raw.select(F.from_json(F.col("value").cast("string"), schema).alias("e")).select("e.*")


def events_with_time(df: DataFrame, delay: str = "15 seconds") -> DataFrame:
    """L2: parsed event time + watermark."""
    return with_watermark(parse_event_time(df), "event_timestamp", delay)


def checkpoint_path(spark: SparkSession, name: str) -> str:
    """Per-query checkpoint location under the shared checkpoint directory."""
    return os.path.join(ensure_checkpoint_dir(spark), "streams", name)


def jdbc_writer(url: str, table: str, properties: dict) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer appending a micro-batch over JDBC.

    Micro-batches can be replayed after a failure; the batch id is written
    with the rows so the target can drop replays (unique key on it)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.jdbc(url, table, mode="append",
                                                                 properties=properties)
    return write


def parquet_writer(path: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer into parquet partitioned by batch id: a replayed batch
    overwrites its own partition (dynamic overwrite), so the sink is idempotent."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))
    return write


def sinks_writer(paths: dict[str, str], rows: dict[str, Callable[[DataFrame, int], DataFrame]]) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer that feeds several sinks from one micro-batch: name -> path, name -> rows of the sink.

    Each sink takes the batch under its id, replacing what an earlier attempt at the batch has left there, so a
    batch that failed between two sinks is simply repeated. Sinks are written in the order of `paths`."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for name, path in paths.items():
                parquet_writer(path)(rows[name](batch, batch_id), batch_id)
        finally:
            batch.unpersist()
    return write


def late_rows_writer(spark: SparkSession, root: str, ts: str, delay_seconds: int, window_seconds: int,
                     by: list[str]) -> Callable[[DataFrame, int], None]:
    """Per micro-batch the window counts of the rows in time and the number of rows too late for their window.

    The watermark of a batch is the greatest event time of all batches before it less the delay, as a
    stateful query has it; a row is late if its window ended by then. Three sinks below `root`: `seen`
    (greatest event time), `counts` (window_start, keys, num_hits) and `late` (window_start, keys, num_late), each
    under the batch's id. `seen` is written last and asked for earlier batches only, so a repeated batch
    splits its rows as before; counted and late rows add up to the rows read. NULL times are late in no window:
    they are in `late` with a NULL window."""
    paths = {name: os.path.join(root, name) for name in ("counts", "late", "seen")}
    size = F.lit(window_seconds)
    seconds = F.unix_seconds(ts)
    start = F.timestamp_seconds(seconds - F.pmod(seconds, size))

    def marked(batch: DataFrame, batch_id: int) -> DataFrame:
        before = None
        if batch_id > 0:  # batch 0 has none before it
            seen = spark.read.schema("top timestamp, batch_id long").parquet(paths["seen"])
            before = seen.where(F.col("batch_id") < batch_id).agg(F.max("top")).first()[0]
        late = F.lit(False) if before is None else (
            F.unix_seconds(start) + size <= F.unix_seconds(F.lit(before)) - F.lit(delay_seconds))
        return batch.select(start.alias("window_start"), *by, F.coalesce(late, F.lit(True)).alias("_late"))

    def counted(flag: bool, out: str):
        def rows(batch: DataFrame, batch_id: int) -> DataFrame:
            m = marked(batch, batch_id)
            known = F.col("window_start").isNotNull()
            some = m.where(F.col("_late") | ~known) if flag else m.where(~F.col("_late") & known)
            return some.groupBy("window_start", *by).agg(F.count(F.lit(1)).alias(out))
        return rows

    return sinks_writer(paths, {"counts": counted(False, "num_hits"), "late": counted(True, "num_late"),
                                "seen": lambda batch, _: batch.agg(F.max(ts).alias("top"))})


def kafka_sink(df: DataFrame, servers: str, topic: str, checkpoint: str) -> StreamingQuery:
    """Rows as JSON values to Kafka."""
    return (df.select(F.to_json(F.struct(*df.columns)).alias("value")).writeStream.format("kafka")
            .option("kafka.bootstrap.servers", servers).option("topic", topic)
            .option("checkpointLocation", checkpoint).start())


def start(df: DataFrame, name: str, *, mode: str = "append", trigger_seconds: float | None = 10,
          batch_writer: Callable[[DataFrame, int], None] | None = None, fmt: str | None = None,
          path: str | None = None, checkpoint: str | None = None,
          state_partitions: int | None = None, available_now: bool = False) -> StreamingQuery:
    """Start a query with a checkpoint (exactly-once state, replayable batches).

    The number of state partitions of a stateful query is fixed by
    `spark.sql.shuffle.partitions` when its checkpoint is first created and
    read back from the checkpoint afterwards; `state_partitions` sets it for
    a new query (the reference runs aggregations at parallelism 3). With
    `available_now` the query ends when all that is there has been processed.
    """
    spark = df.sparkSession
    w = (df.writeStream.queryName(name).outputMode(mode)
         .option("checkpointLocation", checkpoint or checkpoint_path(spark, name)))
    if available_now:
        w = w.trigger(availableNow=True)
    elif trigger_seconds:
        w = w.trigger(processingTime=f"{trigger_seconds} seconds")
    if batch_writer is not None:
        w = w.foreachBatch(batch_writer)
    elif fmt:
        w = w.format(fmt)
    width = "spark.sql.shuffle.partitions"
    before = spark.conf.get(width)
    if state_partitions:
        spark.conf.set(width, str(state_partitions))  # the query takes its own copy of the session's settings
    try:
        return w.start(path) if path else w.start()
    finally:
        spark.conf.set(width, before)
