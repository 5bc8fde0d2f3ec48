"""Cumulative tables: step fold == backfill, unnest order, ratio guard, class carry."""

from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from cumulo.operators import cumulative as C
from cumulo.plans import adapters as A
from tests.conftest import SF_SMALL

STRUCT = ["season", "gp", "pts", "total_cents"]
KW = dict(measure="pts", thresholds=A.SEASON_THRESHOLDS, default_class=A.SEASON_DEFAULT)


def test_step_fold_equals_backfill(spark):
    ps = A.player_seasons(spark, SF_SMALL).cache()
    lo, hi = ps.agg(F.min("season"), F.max("season")).first()
    full = C.cumulate_backfill(ps, ["player_id"], "season", struct_cols=STRUCT, **KW).cache()
    snap = None
    for p in range(lo, hi + 1):
        today = ps.filter(F.col("season") == p)
        if snap is None:
            empty = full.limit(0).select("player_id", "history", "scoring_class", "years_since_last_active")
            snap = C.cumulate_step(empty, today, ["player_id"], p, struct_cols=STRUCT, **KW)
        else:
            snap = C.cumulate_step(snap, today, ["player_id"], p, struct_cols=STRUCT, **KW)
        snap = snap.checkpoint(eager=True)
        want = full.filter(F.col("current_period") == p)
        cols = ["player_id", "history", "scoring_class", "years_since_last_active", "is_active", "current_period"]
        assertDataFrameEqual(snap.select(*cols), want.select(*cols))


def test_unnest_and_ratio(spark):
    h = spark.createDataFrame(
        [(1, [(2001, 0.0), (2002, 5.0)]), (2, [(2001, 2.0), (2003, 8.0)]), (3, [])],
        "k long, history array<struct<season:int, pts:double>>")
    rows = C.unnest_history(h, ["k"])
    assert [tuple(r) for r in rows.orderBy("k", "season").collect()] == [
        (1, 2001, 0.0), (1, 2002, 5.0), (2, 2001, 2.0), (2, 2003, 8.0)]
    r = {x.k: x.ratio_last_to_first for x in C.first_last_ratio(h, ["k"], "pts").collect()}
    assert r == {1: 5.0, 2: 4.0, 3: None}


def test_group_step_keeps_class_when_inactive(spark):
    prev = spark.createDataFrame([(1, [], "star", 0)],
                                 "actor_id long, history array<struct<year:int, n_items:bigint, mean_measure:double>>, "
                                 "quality_class string, years_since_last_active int")
    films = spark.createDataFrame([(2, 1976, 9.0), (2, 1976, 7.0)], "actor_id long, year int, rating double")
    out = C.cumulate_group_step(prev, films, ["actor_id"], "year", 1976, measure="rating",
                                thresholds=((8, "star"), (7, "good"), (6, "average")), default_class="bad",
                                class_col="quality_class")
    got = {r.actor_id: (r.quality_class, r.is_active, len(r.history)) for r in out.collect()}
    assert got == {1: ("star", False, 0), 2: ("good", True, 1)}
