"""Session construction with the settings the library assumes.

On a cluster the session normally exists already; `configure` only fills
in settings that are unset, so cluster-level choices (shuffle width,
checkpoint directory) win.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the library relies on. Static auto-broadcast is off: plans only
# broadcast what is bounded by construction (see operators.joins), while
# AQE may still switch a join to broadcast from *measured* shuffle sizes.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    # rows of one task: its sort buffers and hash maps hold many times the compressed bytes it reads
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # merge session windows inside each input partition before the shuffle
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def build_session(master: str | None = None, app: str = "cumulo",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
         # checkpoint files are deleted once their RDDs are no longer referenced
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**DEFAULTS, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if spark.sparkContext.master.startswith("local"):
        ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Return the checkpoint directory, setting a scratch one only when unset.

    On a cluster `spark.checkpoint.dir` must name shared storage and is left alone;
    the fallback exists for local runs and tests only. Sessions without a local
    SparkContext (Spark Connect) keep whatever the server is configured with.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server owns the setting
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getConf().get("spark.checkpoint.dir", None)
    try:
        current = spark.conf.get("spark.checkpoint.dir", None) or current
    except Exception:  # noqa: BLE001
        pass
    if current:
        sc.setCheckpointDir(current)
        return current
    jdir = sc._jsc.sc().getCheckpointDir()
    if jdir.isDefined():
        return jdir.get()
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="cumulo-ckpt-", dir=os.environ.get("CUMULO_SCRATCH", "/tmp"))
    sc.setCheckpointDir(path)
    return path


def scale_settings(input_bytes: int, target_partition_bytes: int = 256 * 1024 * 1024) -> dict:
    """Shuffle and scan sizing for a given input volume.

    With AQE the initial shuffle width only has to be large enough that no
    reducer gets more than about `target_partition_bytes`; AQE then
    coalesces small partitions and splits skewed ones at run time. Scan
    splits use the same size. At 100 TB this gives about 400k initial
    partitions.
    """
    n = max(1, -(-input_bytes // target_partition_bytes))
    t = str(target_partition_bytes)
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": t,
        "spark.sql.files.maxPartitionBytes": t,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    }


def apply_settings(spark: SparkSession, settings: dict) -> None:
    """Set runtime SQL settings (static ones are left to the cluster)."""
    for k, v in settings.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # noqa: BLE001
            pass
