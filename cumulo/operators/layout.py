"""Physical-layout jobs (K1-K8): bucketed joins, top groups, cached
aggregates and a file-size layout experiment."""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cumulo.operators.joins import broadcast_if_small
from cumulo.sources.io import layout_report, plan_text, write_bucketed
from cumulo.sources.scratch import scratch_path, scratch_table, settings, stored


def match_facts(details: DataFrame, matches: DataFrame, medals_players: DataFrame,
                key: str = "match_id", player: str = "player_gamertag") -> DataFrame:
    """K1: match details + match attributes + medal counts per (match, player).

    Medals are summed per (match, player) *before* the join and joined on
    both columns (T11: joining on the match alone multiplies rows). When
    the three inputs are tables bucketed on `key` with equal bucket counts,
    Spark plans the joins without exchanges (see `bucketed_match_facts`).
    """
    med = medals_players.groupBy(key, player).agg(F.sum("count").cast("bigint").alias("medal_count"))
    return (details.join(matches, on=key, how="inner")
            .join(med, on=[key, player], how="left")
            .withColumn("medal_count", F.coalesce(F.col("medal_count"), F.lit(0).cast("bigint"))))


def bucketed_match_facts(spark: SparkSession, details: DataFrame, matches: DataFrame,
                         medals_players: DataFrame, prefix: str, buckets: int = 16,
                         key: str = "match_id") -> DataFrame:
    """Write the three inputs bucketed (and sorted) by `key`, read
    them back and join: with bucketing on the same key and count the joins
    need no shuffle (checked on the plan in the tests). The medal join is on
    (match, player); for it to reuse the match bucketing the session needs
    `spark.sql.requireAllClusterKeysForCoPartition=false`."""
    names = {n: f"{prefix}_{n}" for n in ("details", "matches", "medals")}
    write_bucketed(details, names["details"], buckets, [key], sort_by=[key])
    write_bucketed(matches, names["matches"], buckets, [key], sort_by=[key])
    write_bucketed(medals_players, names["medals"], buckets, [key], sort_by=[key])
    return match_facts(spark.table(names["details"]), spark.table(names["matches"]),
                       spark.table(names["medals"]))


#: Joins on a superset of the bucket keys stay in their buckets, and of two tables with unlike numbers of buckets
#: the larger number is read as the smaller one (which must divide it, up to the ratio).
IN_BUCKETS = {"spark.sql.requireAllClusterKeysForCoPartition": "false",
              "spark.sql.bucketing.coalesceBucketsInJoin.enabled": "true",
              "spark.sql.bucketing.coalesceBucketsInJoin.maxBucketRatio": "16"}


def bucket_number(*frames: DataFrame, least: int = 16, rows: int = 250_000) -> int:
    """Buckets for tables that are joined in their buckets: the least power of two, `least` or more, that leaves the
    largest table about `rows` rows a bucket. Counted: for projections of Parquet tables from the footers alone."""
    wanted = max((df.count() for df in frames), default=0) / rows
    n = least
    while n < wanted and n < 65_536:  # Spark allows 100,000 buckets
        n *= 2
    return n


def bucketed(df: DataFrame, name: str, buckets: int, keys: Sequence[str]) -> DataFrame:
    """`df` as a bucketed table of this run, one sorted file for each bucket, read back."""
    table, path = scratch_table(df.sparkSession, name)
    write_bucketed(df.repartition(buckets, *keys), table, buckets, list(keys), sort_by=list(keys), path=path)
    return df.sparkSession.table(table)


def joined_in_buckets(spark: SparkSession, join: Callable[[], DataFrame], name: str,
                      plans: list[str] | None = None) -> DataFrame:
    """The rows of `join()` over bucketed tables, planned and run under `IN_BUCKETS`, stored and read back.

    The settings hold for this job only. The plan that ran is appended to `plans`."""
    with settings(spark, IN_BUCKETS):
        out = join()
        if plans is not None:
            plans.append(plan_text(out, "simple"))
        return stored(out, name)


def top_one(df: DataFrame, order: Sequence, n: int = 1) -> DataFrame:
    """top rows by a total order (sort + limit: a top-k report)."""
    return df.orderBy(*order).limit(n)


def top_mean(facts: DataFrame, entity: str, measure: str, per: str, out: str) -> DataFrame:
    """K2: entity with the highest mean of `measure` per `per` (ties -> smallest id)."""
    per_unit = facts.groupBy(entity, per).agg(F.sum(measure).alias("_m"))
    mean = per_unit.groupBy(entity).agg(F.avg("_m").alias(out))
    return top_one(mean, [F.col(out).desc(), F.col(entity)])


def most_frequent(facts: DataFrame, dims: Sequence[str], unit: str) -> DataFrame:
    """K3: most frequent value of each dimension counted in distinct `unit`s.

    One row per dimension: (dimension, value, num_units), all dimensions from
    one scan. Each dimension's best comes from a `max` over struct(count,
    value) - a partial aggregate.
    """
    pairs = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("v")) for d in dims])
    counts = facts.select(F.col(unit).alias("_unit"), F.inline(pairs)).groupBy("dimension", "v").agg(
        F.count_distinct("_unit").alias("n"))
    best = counts.groupBy("dimension").agg(F.max(F.struct("n", "v")).alias("b"))
    return best.select("dimension", F.col("b.v").alias("value"), F.col("b.n").alias("num_units"))


def top_filtered_group(facts: DataFrame, dim: DataFrame, dim_key: str, dim_filter, group: str,
                       measure: str, names: DataFrame, name_key: str, name_col: str) -> DataFrame:
    """K4: filter a dimension, join the facts to it (broadcast when its
    checked size allows), total by `group`, keep the top group, *then* look
    up its name (T12: limit before the lookup, so the order survives)."""
    d = dim.filter(dim_filter).select(dim_key)
    totals = facts.join(d, on=dim_key, how="inner").groupBy(group).agg(F.sum(measure).alias("total"))
    top = top_one(totals, [F.col("total").desc(), F.col(group)])
    return top.join(names.select(F.col(name_key).alias(group), name_col), on=group, how="left")


def medal_facts(details: DataFrame, medals_players: DataFrame, key: str = "match_id",
                player: str = "player_gamertag", medal: str = "medal_id") -> DataFrame:
    """K6: medals per (match, player, medal), full-joined with the players of
    each match on (match, player).

    Medals are summed per (match, player, medal) *before* the join (partial
    aggregate): AQE cannot split skewed partitions of a full outer join, so
    the join only ever sees one row per medal kind of a (match, player);
    the details side is distinct on the key, so nothing multiplies.
    """
    med = medals_players.groupBy(key, player, medal).agg(F.sum("count").cast("bigint").alias("medal_count"))
    return details.select(key, player).distinct().join(med, on=[key, player], how="full") \
        .select(key, player, medal, "medal_count")


def cached_reports(facts: DataFrame, entity: str, other: str, measure: str,
                   agg: DataFrame | None = None) -> DataFrame:
    """One shared aggregate read by two reports, returned as one
    labelled union.

    Both reports read the same aggregate subtree, so Spark runs its shuffle
    once and reuses it (ReusedExchange). A caller that keeps the aggregate
    for more jobs passes it in persisted, e.g. `with io.cached(agg): ...`.
    """
    if agg is None:
        agg = shared_aggregate(facts, entity, other, measure)
    by_entity = agg.groupBy(entity).agg(F.sum("total").alias("total"),
                                        F.count(F.lit(1)).alias("num_groups"))
    by_other = agg.groupBy(other).agg(F.sum("total").alias("total"), F.count(F.lit(1)).alias("num_groups"))
    return (by_entity.select(F.lit(entity).alias("report"), F.col(entity).cast("string").alias("key"),
                             "total", "num_groups")
            .unionByName(by_other.select(F.lit(other).alias("report"), F.col(other).cast("string").alias("key"),
                                         "total", "num_groups")))


def shared_aggregate(facts: DataFrame, entity: str, other: str, measure: str) -> DataFrame:
    """The aggregate behind `cached_reports`: one row per (entity, other)."""
    return facts.groupBy(entity, other).agg(F.sum(measure).alias("total"))


def layout_experiment(df: DataFrame, orders: Mapping[str, Sequence[str]], partition_by: Sequence[str] = (),
                      base: str | None = None) -> DataFrame:
    """Write the same rows once per sort order (sorted within
    partitions) and report bytes and file counts per variant.

    Files go under the session's checkpoint directory (shared storage on a
    cluster), one fresh sub-folder per run, removed when the driver ends.
    """
    spark = df.sparkSession
    root = base or scratch_path(spark, "layout")
    frames = {}
    for name, cols in orders.items():
        path = os.path.join(root, name)
        out = df.sortWithinPartitions(*cols) if cols else df
        w = out.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
        frames[name] = spark.read.parquet(path)
    return layout_report(frames)


def interleaved(df: DataFrame, cols: Sequence[str], bits: int = 16) -> Column:
    """The columns' bits taken in turns, the highest first: rows near in all columns are near in this order.

    A column's value is its place between its smallest and largest value, in `bits` bits (scalar subqueries); NULL is
    the lowest place. `bits` times the number of columns must not exceed 63."""
    if bits * len(cols) > 63:
        raise ValueError("too many bits")
    out = F.lit(0).cast("bigint")
    for j, c in enumerate(cols):
        kind = df.schema[c].dataType.typeName()
        v = (F.unix_micros(F.col(c).cast("timestamp")) if kind.startswith("timestamp") else
             F.unix_date(c) if kind == "date" else F.col(c)).cast("double")
        lo, hi = (df.agg(f(v)).scalar() for f in (F.min, F.max))
        place = F.coalesce(F.floor(F.try_divide(v - lo, hi - lo) * (2 ** bits - 2)) + 1, F.when(v.isNotNull(), 1).otherwise(0)).cast("bigint")
        for i in range(bits):
            out = out.bitwiseOR(F.shiftleft(F.shiftright(place, i).bitwiseAND(F.lit(1)), i * len(cols) + len(cols) - 1 - j))
    return out


def layout_variants(df: DataFrame, orders: Mapping[str, Sequence], files: int) -> dict[str, DataFrame]:
    """K5: the same rows written once for each order as `files` range-ordered files (or dealt round-robin for none)."""
    out = {}
    for name, order in orders.items():
        dealt = df.repartitionByRange(files, *order).sortWithinPartitions(*order) if order else df.repartition(files)
        out[name] = stored(dealt, f"layout-{name}")
    return out


def enrich_events(events: DataFrame, devices: DataFrame, renames: Mapping[str, str] | None = None) -> DataFrame:
    """K8: events left-joined to device attributes, day column, renamed columns."""
    e = events.join(broadcast_if_small(devices), on="device_id", how="left").withColumn(
        "event_day", F.to_date("event_time"))
    return e.withColumnsRenamed(dict(renames)) if renames else e


def repartitioned(df: DataFrame, n: int, cols: list[str]) -> DataFrame:
    """the rows dealt by the hash of `cols` into `n` partitions, also where adaptive execution would merge them."""
    return df.repartition(n, *cols)


def globally_sorted(df: DataFrame, order: list[str]) -> DataFrame:
    """every row in one order, by range partitions sorted each in its own task; no limit."""
    return df.orderBy(*order)
