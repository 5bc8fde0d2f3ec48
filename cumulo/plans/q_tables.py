"""Queries over tables with a layout of their own: file-wise upsert, derived partitions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from cumulo.plans import adapters as A
from cumulo.plans.registry import query
from cumulo.plans.sqlparts import PS, with_
from cumulo.operators.joins import heavy_hitter_join
from cumulo.operators.layout import interleaved, layout_variants
from cumulo.sources import derived, file_upsert, footers
from cumulo.sources.scratch import scratch_path
from cumulo.sources.tables import load


@query("upsert_by_file", with_(PS) + """SELECT player_id, season, gp, total FROM ps
QUALIFY season = MAX(season) OVER (PARTITION BY player_id)""")
def q_upsert_by_file(spark, sf):
    """Each player's latest season: all but the two last seasons in the first version, each of these as an
    upsert that rewrites the files its players' keys can be in."""
    seasons = A.player_seasons(spark, sf).select("player_id", "season", "gp", "total")
    last = seasons.agg(F.max("season")).first()[0] or 0
    path = scratch_path(spark, "latest-season")
    before = seasons.where(F.col("season") < last - 1)
    file_upsert.create(before.groupBy("player_id").agg(F.max(F.struct("season", "gp", "total")).alias("s"))
                       .select("player_id", "s.*"), path, ["player_id"], buckets=4, per_file=2000)
    for season in (last - 1, last):
        file_upsert.upsert(spark, path, seasons.where(F.col("season") == season), ["player_id"], buckets=4, per_file=2000)
    return file_upsert.read(spark, path)


DERIVED = [derived.Transform("o_orderdate", "month"), derived.Transform("o_custkey", "bucket", 4)]


def _derived_orders(spark, sf) -> str:
    path = scratch_path(spark, "derived-orders")
    derived.write(load(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"]), path, DERIVED)
    return path


@query("date_pruned_orders", """SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders
WHERE o_orderdate >= TIMESTAMP '1995-03-10' AND o_orderdate < TIMESTAMP '1996-02-01'""")
def q_date_pruned_orders(spark, sf):
    """A range of order dates from a table partitioned by month and customer bucket; only months that can
    hold it are read."""
    return derived.scan(spark, _derived_orders(spark, sf), [
        ("o_orderdate", ">=", dt.datetime(1995, 3, 10)), ("o_orderdate", "<", dt.datetime(1996, 2, 1))])


@query("bucket_pruned_orders", """SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders
WHERE o_custkey = (SELECT MIN(o_custkey) FROM orders)""")
def q_bucket_pruned_orders(spark, sf):
    """One customer's orders from the same table; only the customer's bucket is read."""
    path = _derived_orders(spark, sf)
    first = spark.read.parquet(path).agg(F.min("o_custkey")).first()[0]
    return derived.scan(spark, path, [("o_custkey", "=", first)])


@query("layout_footers", """WITH c AS (SELECT COUNT(*) AS num_rows, COUNT(*) - COUNT(l_partkey) AS p, COUNT(*) - COUNT(l_suppkey) AS s,
  COUNT(*) - COUNT(l_quantity) AS q FROM lineitem)
SELECT variant, "column", CAST(num_rows AS BIGINT) AS num_rows, CAST(CASE "column" WHEN 'l_partkey' THEN p WHEN 'l_suppkey' THEN s ELSE q END AS BIGINT) AS num_nulls,
  variant <> 'unsorted' AND "column" <> 'l_quantity' AND NOT (variant = 'by_part' AND "column" = 'l_suppkey') AS prunes
FROM c, (VALUES ('unsorted'), ('by_part'), ('interleaved')) v(variant), (VALUES ('l_partkey'), ('l_suppkey'), ('l_quantity')) k("column")""")
def q_layout_footers(spark, sf):
    """Rows and NULLs of each column and layout, from the files' footers, and whether a filter on the column
    leaves out at least a third of the row groups: one sort order serves its first column, interleaved bits both."""
    lines = load(spark, sf, "lineitem", ["l_partkey", "l_suppkey", "l_quantity"])
    feet = footers.footers(layout_variants(lines, {
        "unsorted": [], "by_part": ["l_partkey"], "interleaved": [interleaved(lines, ["l_partkey", "l_suppkey"])]}, files=16))
    overlap = footers.range_overlap(feet)
    return footers.column_sizes(feet).join(overlap.select("variant", "column", "mean_hit"), ["variant", "column"]).select(
        "variant", "column", "num_rows", "num_nulls", (F.col("mean_hit") < 2 / 3).alias("prunes"))


@query("heavy_hitter_join", """SELECT l_orderkey, l_linenumber, l_suppkey, s_nationkey, s_acctbal FROM lineitem
LEFT JOIN supplier ON l_suppkey = s_suppkey""")
def q_heavy_hitter_join(spark, sf):
    """Line items with their supplier: suppliers above 1 / 200 of the lines meet theirs by broadcast, the others
    by a shuffle."""
    lines = load(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_suppkey"])
    suppliers = load(spark, sf, "supplier", ["s_suppkey", "s_nationkey", "s_acctbal"]).withColumnRenamed("s_suppkey", "l_suppkey")
    return heavy_hitter_join(lines, suppliers, ["l_suppkey"], "left", share=200).select(
        "l_orderkey", "l_linenumber", "l_suppkey", "s_nationkey", "s_acctbal")
