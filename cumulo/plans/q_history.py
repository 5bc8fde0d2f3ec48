"""Queries over cumulative and SCD tables (P1-P9, P23) on player seasons."""

from __future__ import annotations

from pyspark.sql import functions as F

from cumulo.operators import cumulative as C
from cumulo.operators import scd as S
from cumulo.operators.analytics import STATE_LABELS, state_changes
from cumulo.plans import adapters as A
from cumulo.plans.registry import query
from cumulo.plans.sqlparts import CLASS_SQL, PS, SNAP, SPINE, STATES, with_

KEY = ["player_id"]
STRUCT = ["season", "gp", "pts", "total", "total_cents"]


def _ps(spark, sf):
    return A.player_seasons(spark, sf)


def _max_season(ps):
    return ps.agg(F.max("season")).scalar()


def _states(ps, last=None):
    return C.snapshot_states(ps, KEY, "season", measure="pts", thresholds=A.SEASON_THRESHOLDS,
                             default_class=A.SEASON_DEFAULT, last_period=last)


def _backfill(spark, sf, ps, last=None):
    static = A.player_static(spark, sf).select("player_id", "player_name", "country")
    return C.cumulate_backfill(ps, KEY, "season", struct_cols=STRUCT, measure="pts",
                               thresholds=A.SEASON_THRESHOLDS, default_class=A.SEASON_DEFAULT,
                               last_period=last, static=static)


def _as_of(ps, period, static=None):
    return C.snapshot_as_of(ps, KEY, "season", period, struct_cols=STRUCT, measure="pts", thresholds=A.SEASON_THRESHOLDS,
                            default_class=A.SEASON_DEFAULT, static=static)


def _render(df):
    """History array -> scalar summaries (comparable with an SQL oracle)."""
    h = F.col("history")
    return df.select(
        "player_id", "player_name", "country", "current_period", "scoring_class",
        "years_since_last_active", "is_active",
        F.size(h).alias("n_seasons"),
        F.try_element_at(h, F.lit(1))["pts"].alias("first_pts"),
        (F.aggregate(h, F.lit(0).cast("bigint"), lambda acc, s: acc + s["total_cents"])
         .cast("double") / 100.0).alias("hist_total"))


RENDER_SQL = """SELECT snap.player_id, c_name AS player_name, c_nationkey AS country, season AS current_period,
       """ + CLASS_SQL.format(x="last_pts") + """ AS scoring_class,
       CAST(season - last_season AS INTEGER) AS years_since_last_active, is_active,
       CAST(n_seasons AS INTEGER) AS n_seasons, first_pts, hist_total
FROM snap LEFT JOIN customer ON c_custkey = snap.player_id"""


@query("scd2_backfill", with_(PS, SPINE, SNAP, STATES, """islands AS (
  SELECT player_id, scoring_class, season,
         season - ROW_NUMBER() OVER (PARTITION BY player_id, scoring_class ORDER BY season) AS island FROM states)""")
       + """SELECT player_id, scoring_class, MIN(season) AS start_period, MAX(season) AS end_period
FROM islands GROUP BY player_id, scoring_class, island""")
def q_scd2_backfill(spark, sf):
    """One tracked attribute over the dense snapshot table."""
    return S.scd2_backfill(_states(_ps(spark, sf)), KEY, "season", ["scoring_class"])


SCD_MULTI_SQL = with_(PS, SPINE, SNAP, STATES, """islands AS (
  SELECT player_id, scoring_class, is_active, season, season - ROW_NUMBER() OVER (
         PARTITION BY player_id, scoring_class, is_active ORDER BY season) AS island
  FROM states WHERE season <= {cut})""") + \
    """SELECT player_id, scoring_class, is_active, MIN(season) AS start_period, MAX(season) AS end_period,
       CAST({cut} AS INTEGER) AS current_period
FROM islands GROUP BY player_id, scoring_class, is_active, island"""


@query("scd2_multi", SCD_MULTI_SQL.format(cut="(SELECT MAX(season) - 1 FROM ps)"))
def q_scd2_multi(spark, sf):
    """Two attributes, cut-off one period before the last, labelled with it."""
    ps = _ps(spark, sf)
    cut = _max_season(ps) - 1
    return S.scd2_backfill_as_of(_states(ps), KEY, "season", ["scoring_class", "is_active"], cut)


def _incremental(spark, sf, open_by):
    ps = _ps(spark, sf)
    last = _max_season(ps)
    states = _states(ps)
    hist = S.scd2_backfill(states.filter(F.col("season") <= last - 1), KEY, "season",
                           ["scoring_class", "is_active"])
    today = states.filter(F.col("season") == last)
    return S.scd2_step(hist, today, KEY, ["scoring_class", "is_active"], last, open_by=open_by)


@query("scd2_incremental", SCD_MULTI_SQL.format(cut="(SELECT MAX(season) FROM ps)"))
def q_scd2_incremental(spark, sf):
    """yesterday's SCD + today's snapshot == backfill through today (dense input)."""
    return _incremental(spark, sf, "end")


@query("scd2_incremental_latest", SCD_MULTI_SQL.format(cut="(SELECT MAX(season) FROM ps)"))
def q_scd2_incremental_latest(spark, sf):
    """The open row found by row_number (latest start) instead of end = p - 1."""
    return _incremental(spark, sf, "latest")


@query("cumulate_backfill", with_(PS, SPINE, SNAP) + RENDER_SQL)
def q_cumulate_backfill(spark, sf):
    """Every (player, season) snapshot with its history array, in one pass."""
    return _render(_backfill(spark, sf, _ps(spark, sf)))


@query("cumulate_step", with_(PS, SPINE, SNAP) + RENDER_SQL + " WHERE season = (SELECT MAX(season) FROM ps)")
def q_cumulate_step(spark, sf):
    """Snapshot at the last season from the previous snapshot plus that season's facts."""
    ps = _ps(spark, sf)
    last = _max_season(ps)
    prev = _as_of(ps, last - 1, A.player_static(spark, sf).select("player_id", "player_name", "country"))
    today = ps.filter(F.col("season") == last).join(
        A.player_static(spark, sf).select("player_id", "player_name", "country"), KEY, "left")
    step = C.cumulate_step(prev, today, KEY, last, struct_cols=STRUCT, carry=["player_name", "country"],
                           measure="pts", thresholds=A.SEASON_THRESHOLDS, default_class=A.SEASON_DEFAULT)
    return _render(step)


@query("history_unnest", with_(PS) + "SELECT player_id, season, gp, pts, total FROM ps")
def q_history_unnest(spark, sf):
    """The last snapshot's history arrays back to rows."""
    ps = _ps(spark, sf)
    last = _max_season(ps)
    snap = _as_of(ps, last)
    rows = C.unnest_history(snap, ["player_id"])
    return rows.select("player_id", "season", "gp", "pts", "total")


@query("first_last_ratio", with_(PS, """fl AS (SELECT player_id, arg_min(pts, season) AS first_pts,
  arg_max(pts, season) AS last_pts FROM ps GROUP BY 1)""")
       + """SELECT player_id, last_pts / CASE WHEN first_pts = 0 THEN 1 ELSE first_pts END
                AS ratio_last_to_first FROM fl""")
def q_first_last_ratio(spark, sf):
    """P5: latest season's value over the first season's, on the last snapshot."""
    ps = _ps(spark, sf)
    last = _max_season(ps)
    snap = _as_of(ps, last)
    r = C.first_last_ratio(snap, ["player_id"], "pts")
    return r


AF = """af AS (SELECT o_custkey AS actor_id, o_orderkey AS film_id, CAST(year(o_orderdate) AS INTEGER) AS year,
  o_orderkey % 1000 AS votes, o_totalprice / 50000.0 AS rating FROM orders),
ay AS (SELECT actor_id, year, COUNT(*) AS n_items, AVG(rating) AS mean_measure, SUM(votes) AS sum_votes
  FROM af GROUP BY 1, 2),
lasty AS (SELECT MAX(year) AS y FROM af),
hist AS (SELECT actor_id, COUNT(*) AS n_years, CAST(SUM(n_items) AS BIGINT) AS n_films, MAX(year) AS last_year,
  arg_max(mean_measure, year) AS last_mean FROM ay GROUP BY 1)"""

ACTOR_THRESHOLDS = ((8, "star"), (7, "good"), (6, "average"))


@query("cumulate_group_step", with_(AF) + """SELECT actor_id,
  CASE WHEN last_mean > 8 THEN 'star' WHEN last_mean > 7 THEN 'good' WHEN last_mean > 6 THEN 'average'
       ELSE 'bad' END AS quality_class,
  last_year = (SELECT y FROM lasty) AS is_active,
  CAST((SELECT y FROM lasty) - last_year AS INTEGER) AS years_since_last_active,
  CAST(n_years AS INTEGER) AS n_years, n_films,
  (SELECT y FROM lasty) AS current_year
FROM hist""")
def q_cumulate_group_step(spark, sf):
    """Many films per actor and year; the last year's step on top of the backfilled snapshot."""
    af = A.actor_films(spark, sf)
    last = af.agg(F.max("year")).scalar()
    per_year = (af.groupBy("actor_id", "year")
                .agg(F.count(F.lit(1)).alias("n_items"), F.avg("rating").alias("mean_measure"),
                     F.sum("votes").alias("sum_votes")))
    prev = C.snapshot_as_of(per_year, ["actor_id"], "year", last - 1,
                            struct_cols=["year", "n_items", "mean_measure", "sum_votes"], measure="mean_measure",
                            thresholds=ACTOR_THRESHOLDS, default_class="bad", class_col="quality_class")
    step = C.cumulate_group_step(prev, af, ["actor_id"], "year", last, measure="rating",
                                 thresholds=ACTOR_THRESHOLDS, default_class="bad",
                                 class_col="quality_class", snapshot_col="current_year",
                                 extra_sums=["votes"])
    h = F.col("history")
    return step.select("actor_id", "quality_class", "is_active", "years_since_last_active",
                       F.size(h).alias("n_years"),
                       F.aggregate(h, F.lit(0).cast("bigint"), lambda a, s: a + s["n_items"]).alias("n_films"),
                       "current_year")


# Two left joins with the seasons a player played: this one and the one before in the data.
_L = {k: v.replace("'", "''") for k, v in STATE_LABELS.items()}
STATE_SQL = with_(PS, """seasons AS (SELECT season, DENSE_RANK() OVER (ORDER BY season) AS i FROM ps GROUP BY season),
played AS (SELECT player_id, i FROM ps JOIN seasons USING (season)),
debut AS (SELECT player_id, MIN(i) AS i FROM played GROUP BY player_id)""") + f"""
SELECT debut.player_id, seasons.season, CASE WHEN seasons.i = debut.i THEN '{_L["new"]}'
    WHEN cur.i IS NULL THEN CASE WHEN old.i IS NULL THEN '{_L["stayed_retired"]}' ELSE '{_L["retired"]}' END
    WHEN old.i IS NULL THEN '{_L["returned"]}' ELSE '{_L["continued"]}' END AS state
FROM debut JOIN seasons ON seasons.i >= debut.i
LEFT JOIN played cur ON cur.player_id = debut.player_id AND cur.i = seasons.i
LEFT JOIN played old ON old.player_id = debut.player_id AND old.i = seasons.i - 1"""


@query("state_changes", STATE_SQL)
def q_state_changes(spark, sf):
    """Lifecycle label per player and season."""
    return state_changes(_ps(spark, sf), KEY, "season")
