"""Map the provided test tables onto the operators' inputs.

The reference's own data (box scores, web events, films) is not shipped,
so each operator reads a table derived by Spark from the provided parquet
files; every derivation is a projection or an aggregate, so its size grows
with the inputs. `oracles.py` holds the same derivations in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cumulo.functions.columns import season_year
from cumulo.sources.tables import load

# Spend thresholds (mean order price per customer-year) for the
# player-season scoring classes; descending, strictly greater wins.
SEASON_THRESHOLDS = ((400000, "star"), (250000, "good"), (150000, "average"))
SEASON_DEFAULT = "bad"

# Number of teams (nation keys) and device rows.
N_TEAMS = 25


def web_events(spark: SparkSession, sf_dir: str, device_mod: int = 20) -> DataFrame:
    """events -> web events (user, device, host, url, referrer, time).

    host := event_type, url := '/' || event_type, device := user_id % device_mod,
    referrer := one of seven values by event_id % 7 (one of them NULL).
    """
    e = load(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    r = F.col("event_id") % 7
    referrer = (F.when(r == 0, "https://www.google.com/search")
                .when(r == 1, "https://t.co/a1b2")
                .when(r == 2, "https://www.linkedin.com/feed")
                .when(r == 3, "https://lnkd.in/xyz")
                .when(r == 4, "https://news.example.org/")
                .when(r == 5, "https://www.example.com/blog"))
    return e.select(
        "event_id", "user_id",
        (F.col("user_id") % device_mod).alias("device_id"),
        F.col("event_type").alias("host"),
        F.concat(F.lit("/"), F.col("event_type")).alias("url"),
        referrer.alias("referrer"),
        F.col("ts").alias("event_time"),
        F.to_date("ts").alias("event_date"),
        "value")


def devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation -> device dimension (25 rows; bounded by the nation table)."""
    n = load(spark, sf_dir, "nation", ["n_nationkey", "n_regionkey"])
    k = F.col("n_nationkey")
    return n.select(
        k.cast("bigint").alias("device_id"),
        F.when(k % 4 == 0, "Chrome").when(k % 4 == 1, "Firefox").when(k % 4 == 2, "Safari")
         .otherwise("Edge").alias("browser_type"),
        F.when(k % 3 == 0, "Desktop").when(k % 3 == 1, "Mobile").otherwise("Tablet").alias("device_type"),
        F.when(F.col("n_regionkey") == 0, "Windows").when(F.col("n_regionkey") == 1, "Mac OS X")
         .when(F.col("n_regionkey") == 2, "Linux").when(F.col("n_regionkey") == 3, "iOS")
         .otherwise("Android").alias("os_type"))


def player_seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders -> one row per (customer, order year): games, mean and total spend.

    Spend is summed in integer cents so totals are exact whatever the
    summation order (partial aggregates combine in any order).
    """
    o = load(spark, sf_dir, "orders", ["o_custkey", "o_orderdate", "o_totalprice"])
    g = (o.groupBy(F.col("o_custkey").alias("player_id"),
                   F.year("o_orderdate").cast("int").alias("season"))
         .agg(F.count(F.lit(1)).alias("gp"),
              F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("total_cents")))
    return g.select("player_id", "season", "gp",
                    (F.col("total_cents").cast("double") / F.col("gp") / 100.0).alias("pts"),
                    (F.col("total_cents").cast("double") / 100.0).alias("total"),
                    "total_cents")


def player_static(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer -> static player attributes (one row per key)."""
    c = load(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"])
    return c.select(F.col("c_custkey").alias("player_id"), F.col("c_name").alias("player_name"),
                    F.col("c_nationkey").alias("country"), F.col("c_mktsegment").alias("college"))


def actor_films(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders -> films: actor := customer, film := order, rating := price / 50,000, votes := order key % 1000."""
    o = load(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"])
    return o.select(F.col("o_custkey").alias("actor_id"),
                    F.col("o_orderkey").alias("film_id"),
                    F.year("o_orderdate").cast("int").alias("year"),
                    (F.col("o_orderkey") % 1000).alias("votes"),
                    (F.col("o_totalprice") / 50000.0).alias("rating"))


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders -> games: home team := customer % 25, visitor := another team, home win := status 'F'."""
    o = load(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus"])
    home = F.col("o_custkey") % N_TEAMS
    return o.select(
        F.col("o_orderkey").alias("game_id"),
        F.to_date("o_orderdate").alias("game_date"),
        season_year(F.to_date("o_orderdate")).alias("season"),
        home.alias("home_team_id"),
        ((home + 1 + F.col("o_orderkey") % (N_TEAMS - 1)) % N_TEAMS).alias("visitor_team_id"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("home_team_wins"))


def game_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem -> box scores: game := order, player := supplier, team := supplier % 25.

    (game, team, player) repeats (several lines of one supplier in one
    order), so dedup is exercised.
    """
    li = load(spark, sf_dir, "lineitem", ["l_orderkey", "l_suppkey", "l_linenumber",
                                          "l_quantity", "l_extendedprice", "l_discount"])
    return li.select(
        F.col("l_orderkey").alias("game_id"),
        (F.col("l_suppkey") % N_TEAMS).alias("team_id"),
        F.col("l_suppkey").alias("player_id"),
        F.concat(F.lit("player_"), F.col("l_suppkey").cast("string")).alias("player_name"),
        F.concat(F.lit("T"), (F.col("l_suppkey") % N_TEAMS).cast("string")).alias("team_abbreviation"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_quantity").alias("pts"),
        F.col("l_extendedprice").alias("reb"),
        F.col("l_discount").alias("ast"))


def teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation -> teams (team id, abbreviation, nickname, city, arena, founded)."""
    n = load(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    return n.select(
        F.col("n_nationkey").cast("bigint").alias("team_id"),
        F.concat(F.lit("T"), F.col("n_nationkey").cast("string")).alias("abbreviation"),
        F.col("n_name").alias("nickname"),
        F.concat(F.lit("CITY_"), F.col("n_regionkey").cast("string")).alias("city"),
        F.concat(F.lit("ARENA_"), F.col("n_nationkey").cast("string")).alias("arena"),
        (F.lit(1946) + F.col("n_nationkey")).cast("bigint").alias("yearfounded"))


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders -> matches: map := customer % 5 (a region), playlist := priority."""
    o = load(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate"])
    return o.select(F.col("o_orderkey").alias("match_id"), (F.col("o_custkey") % 5).alias("mapid"),
                    (F.col("o_orderstatus") != "P").alias("is_team_game"),
                    F.col("o_orderpriority").alias("playlist_id"),
                    F.col("o_orderdate").alias("completion_date"))


def match_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem -> one row per (match, player): kills := sum of quantities, deaths := lines."""
    li = load(spark, sf_dir, "lineitem", ["l_orderkey", "l_suppkey", "l_quantity"])
    return (li.groupBy(F.col("l_orderkey").alias("match_id"),
                       F.concat(F.lit("gamer_"), F.col("l_suppkey").cast("string")).alias("player_gamertag"))
            .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("player_total_kills"),
                 F.count(F.lit(1)).alias("player_total_deaths")))


def medals_matches_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem -> medal awards: medal := part, count := line number."""
    li = load(spark, sf_dir, "lineitem", ["l_orderkey", "l_suppkey", "l_partkey", "l_linenumber"])
    return li.select(F.col("l_orderkey").alias("match_id"),
                     F.concat(F.lit("gamer_"), F.col("l_suppkey").cast("string")).alias("player_gamertag"),
                     F.col("l_partkey").alias("medal_id"), F.col("l_linenumber").alias("count"))


def medals(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "part", ["p_partkey", "p_name", "p_type"])
    return p.select(F.col("p_partkey").alias("medal_id"), F.col("p_name").alias("name"),
                    F.col("p_type").alias("description"))


def maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = load(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    return r.select(F.col("r_regionkey").cast("bigint").alias("mapid"), F.col("r_name").alias("name"))
