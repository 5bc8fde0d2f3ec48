"""Queries over stored tables (section 2A, C5, C13, C15, P2): written, read back, compared.

Every run of a query writes tables of its own below the shared checkpoint folder, removed when the driver ends.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from cumulo.operators import growth as G
from cumulo.operators import layout as L
from cumulo.operators.joins import key_skew
from cumulo.plans import adapters as A
from cumulo.plans.jobs import run_step_table
from cumulo.plans.q_growth import GROWTH_SQL
from cumulo.plans.q_history import AF
from cumulo.plans.q_layout import FACTS_SQL
from cumulo.plans.registry import query
from cumulo.plans.sqlparts import MATCHES, with_
from cumulo.sources import io
from cumulo.sources.scratch import scratch_path, scratch_table
from cumulo.sources.tables import load

ORDERS = StructType([StructField("o_orderkey", LongType()), StructField("o_custkey", LongType()),
                     StructField("o_orderstatus", StringType()), StructField("o_totalprice", DoubleType())])


@query("csv_typed", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def q_csv_typed(spark, sf):
    """A1 / A2: orders written as CSV text, read back as strings and typed by name."""
    path = scratch_path(spark, "cumulo_csv_orders")
    load(spark, sf, "orders", ORDERS.names).write.mode("overwrite").option("header", True).csv(path)
    return io.apply_schema(io.read_csv(spark, path), ORDERS)


@query("year_partition", """SELECT o_orderstatus, COUNT(*) AS num_orders, CAST(MAX(year(o_orderdate)) AS INTEGER) AS year
FROM orders WHERE year(o_orderdate) = 1996 GROUP BY 1""")
def q_year_partition(spark, sf):
    """Orders in a year-partitioned table, one partition read back."""
    path = scratch_path(spark, "cumulo_orders_by_year")
    orders = load(spark, sf, "orders", ["o_orderkey", "o_orderstatus", "o_orderdate"])
    io.write_partitioned(io.with_year_partition(orders, "o_orderdate"), path, ["year"])
    return (spark.read.parquet(path).filter(F.col("year") == 1996).groupBy("o_orderstatus")
            .agg(F.count(F.lit(1)).alias("num_orders"), F.max("year").cast("int").alias("year")))


def _store_growth_days(spark, sf):
    """The growth table of every day from the first to the last event day, partitioned by day and bucketed
    by the key: the days before the last in one write, the last as a step on the stored day before."""
    act = A.web_events(spark, sf).filter(F.col("user_id").isNotNull()).select("user_id", "event_date")
    first, last = act.agg(F.min("event_date"), F.max("event_date")).first()  # decide which days are written
    table, path = scratch_table(spark, "cumulo_growth_days")
    if first is None:
        return G.growth_accounting_backfill(act, "user_id", dt.date(1970, 1, 1)).withColumn("snapshot_date", F.col("date"))
    if first < last:
        before = last - dt.timedelta(days=1)
        days = G.growth_accounting_backfill(act.filter(F.col("event_date") <= F.lit(before)), "user_id", before)
        days = days.withColumn("snapshot_date", F.col("date"))
        by_file = days.repartition("snapshot_date", F.pmod(F.hash("user_id"), F.lit(8)))  # a file for a day's bucket
        io.write_bucketed(by_file, table, 8, ["user_id"], sort_by=["user_id"], partition_by=["snapshot_date"], path=path)
    run_step_table(spark, table, "snapshot_date", last,
                   lambda prev, day: G.growth_accounting_step(prev, act, "user_id", day), key=["user_id"], buckets=8)
    return spark.table(table)


def _growth_rows(stored):
    return stored.select("user_id", "first_active_date", "last_active_date", "daily_active_state",
                         "weekly_active_state", F.size("dates_active").alias("n_dates"), "date")


@query("snapshot_days", GROWTH_SQL + """SELECT date, daily_active_state, weekly_active_state, COUNT(*) AS num_users,
  CAST(SUM(n_dates) AS BIGINT) AS num_dates FROM g GROUP BY 1, 2, 3""")
def q_snapshot_days(spark, sf):
    """Users per day and states over the stored day partitions of every day."""
    return _growth_rows(_store_growth_days(spark, sf)).groupBy("date", "daily_active_state", "weekly_active_state").agg(
        F.count(F.lit(1)).alias("num_users"), F.sum("n_dates").cast("bigint").alias("num_dates"))


@query("snapshot_all_days", GROWTH_SQL + """SELECT user_id, first_active_date, last_active_date, daily_active_state,
  weekly_active_state, n_dates, date FROM g""")
def q_snapshot_all_days(spark, sf):
    """The growth table of every day, stored in day partitions bucketed by the key and read back."""
    return _growth_rows(_store_growth_days(spark, sf))


@query("bucketed_tables_join", with_(MATCHES, FACTS_SQL) + """SELECT match_id, player_gamertag, mapid, playlist_id,
  player_total_kills, player_total_deaths, medal_count FROM facts""")
def q_bucketed_tables_join(spark, sf):
    """The three inputs written as tables bucketed by the match, medals summed and both joins made in
    the buckets, without an exchange, though one join has the player as a second key. The number of buckets follows
    the rows: a bucket is one task."""
    matches, medals = A.matches(spark, sf), A.medals_matches_players(spark, sf)
    n = L.bucket_number(matches, medals)  # details has no more rows than medals
    details, found, medals = (L.bucketed(df, "cumulo_k1", n, ["match_id"]) for df in (
        A.match_details(spark, sf), matches, medals))
    return L.joined_in_buckets(spark, lambda: L.match_facts(details, found, medals).select(
        "match_id", "player_gamertag", "mapid", "playlist_id", "player_total_kills", "player_total_deaths",
        "medal_count"), "bucketed-facts")


@query("bucketed_unlike_join", with_(MATCHES) + """SELECT match_id, player_gamertag, player_total_kills, mapid, playlist_id
FROM details JOIN matches USING (match_id)""")
def q_bucketed_unlike_join(spark, sf):
    """Tables of 16 and of 8 buckets (more on larger inputs) joined without an exchange: the 16 are read as 8."""
    matches = A.matches(spark, sf)
    n = L.bucket_number(matches, A.medals_matches_players(spark, sf))  # details has no more rows than medals
    details = L.bucketed(A.match_details(spark, sf), "cumulo_k1_wide", n, ["match_id"])
    found = L.bucketed(matches, "cumulo_k1_half", n // 2, ["match_id"])
    return L.joined_in_buckets(spark, lambda: details.join(found, "match_id").select(
        "match_id", "player_gamertag", "player_total_kills", "mapid", "playlist_id"), "unlike-buckets")


@query("orders_by_customer", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def q_orders_by_customer(spark, sf):
    """the orders dealt by customer into eight partitions, written and read back."""
    path = scratch_path(spark, "cumulo_orders_by_customer")
    L.repartitioned(load(spark, sf, "orders", ORDERS.names), 8, ["o_custkey"]).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@query("orders_sorted", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def q_orders_sorted(spark, sf):
    """all orders in one global order, written as range-ordered files and read back."""
    path = scratch_path(spark, "cumulo_orders_sorted")
    L.globally_sorted(load(spark, sf, "orders", ORDERS.names), ["o_custkey", "o_orderkey"]).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@query("key_skew", "SELECT l_suppkey, COUNT(*) AS count FROM lineitem GROUP BY 1 ORDER BY count DESC, l_suppkey LIMIT 20")
def q_key_skew(spark, sf):
    """The heaviest join keys of lineitem (a top-20 report)."""
    return key_skew(load(spark, sf, "lineitem", ["l_suppkey"]), ["l_suppkey"])


@query("actor_films_history", with_(AF) + """SELECT af.actor_id, af.year, af.film_id, af.votes, af.rating, ay.n_items, ay.mean_measure
FROM af JOIN ay ON ay.actor_id = af.actor_id AND ay.year = af.year""")
def q_actor_films_history(spark, sf):
    """The film rows behind the yearly summaries, stored as a long table beside them and read back.
    One row per film: an array of them would grow without bound for one actor."""
    films = A.actor_films(spark, sf).select("actor_id", "film_id", "votes", "rating", "year")
    path = scratch_path(spark, "cumulo_actor_films")
    io.write_partitioned(films, path, ["year"])
    stored = spark.read.parquet(path).withColumn("year", F.col("year").cast("int"))
    per_year = stored.groupBy("actor_id", "year").agg(F.count(F.lit(1)).alias("n_items"), F.avg("rating").alias("mean_measure"))
    return stored.join(per_year, ["actor_id", "year"]).select("actor_id", "year", "film_id", "votes", "rating",
                                                              "n_items", "mean_measure")
