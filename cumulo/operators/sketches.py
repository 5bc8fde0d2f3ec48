"""Summaries that are kept per day and merged over any period: distinct counts, user sets, quantiles.

Each summary has a fixed size (or, for user sets, one bit a user), is built with a partial aggregate and
merges with another one, so a month is read from its days' summaries and the events are scanned once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cumulo.operators.joins import heavy_hitter_join
from cumulo.sources.scratch import stored

LG_K = 14  # HyperLogLog registers (log 2): relative standard error 1.04 / sqrt(2**14) = 0.8 %
KLL_K = 800  # KLL: rank error below 0.4 % of the rows at 99 % confidence, per sketch and for any merge


# -- distinct counts (D2, P15) ----------------------------------------------------------------------

def daily_visitors(df: DataFrame, keys: Sequence[str], user: str, day: str, lg_k: int = LG_K) -> DataFrame:
    """day, keys, visitors: a HyperLogLog sketch of the day's users; NULL users are not counted."""
    return df.groupBy(day, *keys).agg(F.hll_sketch_agg(user, lg_k).alias("visitors"))


def merged_visitors(sketches: DataFrame, keys: Sequence[str | Column], out: str = "num_visitors") -> DataFrame:
    """Estimated distinct users of each group of daily sketches (`keys` may be expressions of the day)."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("visitors")).alias(out))


# -- user sets (P11, P12, H10) ----------------------------------------------------------------------

def day_bitmaps(df: DataFrame, user: str, day: str, keys: Sequence[str] = ()) -> DataFrame:
    """day, keys, bucket, bits: the day's users as bitmaps of 32,768 ids, one row for each bucket that has any.

    Ids are whole numbers of any sign; NULL ids and NULL days are left out."""
    known = df.where(F.col(user).isNotNull() & F.col(day).isNotNull())
    return known.groupBy(day, *keys, F.bitmap_bucket_number(F.col(user)).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col(user))).alias("bits"))


def rolling_active(bitmaps: DataFrame, day: str, spans: dict[str, int], keys: Sequence[str] = ()) -> DataFrame:
    """day, keys and for each span (name -> days) the exact number of users active in the days up to `day`.

    Every day from the first to the last is returned where any span has users. The span may have any length:
    a bitmap is handed to each day it counts for and the bitmaps of a (day, bucket) are joined by OR."""
    last = bitmaps.agg(F.max(day)).scalar()
    widest = max(spans.values())
    shifted = bitmaps.select(
        F.col(day).alias("_own"), F.explode(F.sequence(F.col(day), F.least(F.date_add(day, widest - 1), last))).alias(day),
        *keys, "bucket", "bits")
    age = F.datediff(F.col(day), F.col("_own"))
    per_bucket = shifted.groupBy(day, *keys, "bucket").agg(*[
        F.bitmap_or_agg(F.when(age < n, F.col("bits")).otherwise(F.unhex(F.lit("")))).alias(name) for name, n in spans.items()])
    return per_bucket.groupBy(day, *keys).agg(*[F.sum(F.bitmap_count(name)).alias(name) for name in spans])


# -- quantiles (O4) ---------------------------------------------------------------------------------

def daily_quantiles(df: DataFrame, keys: Sequence[str], value: Column, day: str, k: int = KLL_K) -> DataFrame:
    """day, keys, sketch: a KLL sketch of the day's values; NULL values are not counted."""
    known = df.withColumn("_value", value.cast("double")).where("_value IS NOT NULL")
    return known.groupBy(day, *keys).agg(F.kll_sketch_agg_double("_value", k).alias("sketch"))


def merged_quantiles(sketches: DataFrame, keys: Sequence[str | Column], at: dict[str, float], k: int = KLL_K) -> DataFrame:
    """keys, n (values), and for each name the quantile at its rank."""
    merged = sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", k).alias("_s"))
    names = [c for c in merged.columns if c != "_s"]
    return merged.select(*names, F.kll_sketch_get_n_double("_s").alias("n"), *[
        F.kll_sketch_get_quantile_double("_s", F.lit(q)).alias(name) for name, q in at.items()])


def rank_share(df: DataFrame, keys: Sequence[str], value: Column, estimates: DataFrame, estimate: str,
               broadcast_rows: int = 100_000) -> DataFrame:
    """keys, below, upto: exact shares of the values below and not above the estimate (its true ranks).

    The values are not shuffled by group, of which there may be few: the estimates go to them by broadcast, if
    they are few (`broadcast_rows`, counted), else only the values of light groups are dealt by key."""
    known = df.withColumn("_value", value.cast("double")).where("_value IS NOT NULL").select(*keys, "_value")
    held = stored(estimates.select(*keys, F.col(estimate).alias("_e")), "estimates")
    both = known.join(F.broadcast(held), list(keys)) if held.count() <= broadcast_rows else \
        heavy_hitter_join(known, held, keys)
    return both.groupBy(*keys).agg(
        F.avg(F.when(F.col("_value") < F.col("_e"), 1.0).otherwise(0.0)).alias("below"),
        F.avg(F.when(F.col("_value") <= F.col("_e"), 1.0).otherwise(0.0)).alias("upto"))
