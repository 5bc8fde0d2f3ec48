"""Join helpers with explicit broadcast policy.

Static auto-broadcast is off in `cumulo.session`; a side is broadcast only
when its size is bounded: either by construction (a fixed dimension such
as nation-derived devices) or by a plan-statistics check below a limit.
Anything else is a shuffle join, which AQE may still turn into a
broadcast from sizes measured at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cumulo.sources.scratch import stored

DEFAULT_MAX_BROADCAST_BYTES = 64 * 1024 * 1024
UNPACKED = 8  # bytes in memory of a byte of a compressed columnar file, taken generously


def estimated_bytes(df: DataFrame) -> int | None:
    """Optimizer's size estimate of `df` (no job is run); None if unknown."""
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
        return int(str(stats.sizeInBytes()))
    except Exception:  # noqa: BLE001
        return None


def broadcast_if_small(df: DataFrame, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint only when the estimate, taken for compressed bytes, is known and stays under `max_bytes`
    unpacked; without the hint adaptive execution decides on the measured size."""
    size = estimated_bytes(df)
    return F.broadcast(df) if size is not None and size * UNPACKED <= max_bytes else df


def join_bounded_dimension(facts: DataFrame, dim: DataFrame, on, how: str = "left",
                           max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Facts joined to a dimension; the dimension is broadcast when its
    estimated size is under `max_bytes`, otherwise the join shuffles."""
    return facts.join(broadcast_if_small(dim, max_bytes), on=on, how=how)


def anti_join(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """C11: rows of `left` with no match in `right` (left join / IS NULL pattern)."""
    return left.join(right, on=on, how="left_anti")


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Null join keys never match; drop them before the shuffle."""
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.filter(cond)


def heavy_keys(df: DataFrame, keys: Sequence[str], share: int = 1000) -> DataFrame:
    """Keys, n of the keys that hold more than 1 / `share` of the rows, so fewer than `share` of them.
    Counted with a partial aggregate; rows with a NULL key are not looked at."""
    counts = drop_null_keys(df.select(*keys), keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") * share > df.agg(F.count(F.lit(1))).scalar())


def heavy_hitter_join(facts: DataFrame, dim: DataFrame, keys: Sequence[str], how: str = "inner", share: int = 1000,
                      rows_per_task: int = 1_000_000, broadcast_rows: int = 100_000) -> DataFrame:
    """The rows of `facts.join(dim, keys, how)` (inner or left), whatever keys the facts crowd on.

    Facts of heavy keys are not shuffled by key: they meet the dimension rows of those keys by broadcast,
    if these are few (`broadcast_rows`, counted), else in salted groups of about `rows_per_task` facts, to each of which
    the key's dimension rows are copied; a fact's salt is a hash of all its columns. The other facts,
    at most 1 / `share` of the rows a key, are joined by a plain shuffle. Facts with a NULL key match nothing:
    they pass by a left join and are dropped by an inner one before any shuffle."""
    if how not in ("inner", "left"):
        raise ValueError(how)
    keys = list(keys)
    heavy = stored(heavy_keys(facts, keys, share), "heavy-keys")
    known = drop_null_keys(facts, keys)
    dims = stored(dim.join(F.broadcast(heavy), keys), "heavy-dimension")
    hot = known.join(F.broadcast(heavy), keys)
    if dims.count() <= broadcast_rows:
        crowded = hot.drop("n").join(F.broadcast(dims.drop("n")), keys, how)
    else:
        salts = F.greatest(F.lit(1), F.ceil(F.col("n") / rows_per_task)).cast("long")
        salted = hot.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in facts.columns]), salts)).drop("n")
        copies = dims.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1))).drop("n")
        crowded = salted.join(copies, [*keys, "_salt"], how).drop("_salt")
    rest = known.join(F.broadcast(heavy), keys, "left_anti").join(dim, keys, how)
    out = rest.unionByName(crowded)
    if how == "left":
        missing = [f for f in dim.schema.fields if f.name not in keys]
        unknown = facts.where(~F.coalesce(*[F.when(F.col(k).isNull(), False) for k in keys], F.lit(True)))
        out = out.unionByName(unknown.select(*facts.columns, *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing]))
    return out


def key_skew(df: DataFrame, keys: Sequence[str], top: int = 20) -> DataFrame:
    """Heaviest join keys (a report; top-n is the feature)."""
    return df.groupBy(*keys).count().orderBy(F.col("count").desc(), *keys).limit(top)
