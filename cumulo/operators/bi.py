"""Tables behind the BI extracts (M1x-M6x): top-n sets and their usage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cumulo.functions.columns import safe_ratio


def top_n(df: DataFrame, key: str, n: int, metric: str = "num_events") -> DataFrame:
    """F6/M1x: the n keys with most rows (ties -> smallest key). A top-n
    report: the limit is the feature and its output is bounded by n."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias(metric))
    return counts.orderBy(F.col(metric).desc(), F.col(key)).limit(n)


def restrict_to(df: DataFrame, top: DataFrame, key: str) -> DataFrame:
    """Semi join to a top-n set; the set has at most n rows, so it is broadcast."""
    return df.join(F.broadcast(top.select(key)), on=key, how="left_semi")


def top_k_per_group(df: DataFrame, group: Sequence[str], key: str, metric: str, k: int,
                    buckets: int | None = None, rank_col: str = "rank") -> DataFrame:
    """M3x: top k keys per group by metric (ties -> smallest key).

    Two levels so no group is ranked in one task: keys are first ranked
    inside (group, hash bucket of key) keeping k each, then the survivors
    (at most k x buckets per group) are ranked per group.
    """
    group = list(group)
    if buckets is None:   # as wide as a shuffle, so each first-level group is a slice of one
        buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(metric).desc(), F.col(key)]
    b = F.pmod(F.xxhash64(F.col(key)), F.lit(buckets))
    w1 = Window.partitionBy(*group, b).orderBy(*order)
    pre = df.withColumn("_r1", F.row_number().over(w1)).filter(F.col("_r1") <= k).drop("_r1")
    w2 = Window.partitionBy(*group).orderBy(*order)
    return pre.withColumn(rank_col, F.row_number().over(w2)).filter(F.col(rank_col) <= k)


def share_within(df: DataFrame, group: Sequence[str], metric: str, out: str = "share") -> DataFrame:
    """D11/M4x: metric over its group's total (groups here are top-k, tiny)."""
    w = Window.partitionBy(*group)
    return df.withColumn(out, safe_ratio(F.col(metric), F.sum(metric).over(w)))
