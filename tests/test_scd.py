"""SCD type 2: literal fixtures, step == backfill, invariants."""

from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from cumulo.operators import cumulative as C
from cumulo.operators import scd as S
from cumulo.plans import adapters as A
from tests.conftest import SF_SMALL


def test_scd_single_attribute(spark):
    rows = [("ann", 2001, "good"), ("ann", 2002, "good"), ("ann", 2003, "bad"), ("bob", 2003, "bad")]
    df = spark.createDataFrame(rows, "player_name string, current_season long, scoring_class string")
    out = S.scd2_backfill(df, ["player_name"], "current_season", ["scoring_class"],
                          start_col="start_date", end_col="end_date")
    expected = spark.createDataFrame(
        [("ann", "good", 2001, 2002), ("ann", "bad", 2003, 2003), ("bob", "bad", 2003, 2003)],
        "player_name string, scoring_class string, start_date long, end_date long")
    assertDataFrameEqual(out, expected)


def test_scd_actors_with_cutoff_and_nulls(spark):
    rows = [(1, "a", 2019, "good", True), (1, "a", 2020, "good", True), (1, "a", 2021, "star", True),
            (2, "b", 2019, None, True), (2, "b", 2020, None, True), (2, "b", 2021, "bad", False)]
    df = spark.createDataFrame(rows, "actorid long, actor string, current_year long, quality_class string, is_active boolean")
    out = S.scd2_backfill_as_of(df, ["actorid", "actor"], "current_year", ["quality_class", "is_active"], 2021,
                                current_col="current_year")
    expected = spark.createDataFrame(
        [(1, "a", "good", True, 2019, 2020, 2021), (1, "a", "star", True, 2021, 2021, 2021),
         (2, "b", None, True, 2019, 2020, 2021), (2, "b", "bad", False, 2021, 2021, 2021)],
        "actorid long, actor string, quality_class string, is_active boolean, start_period long, end_period long, current_year int")
    assertDataFrameEqual(out, expected)
    # the cut-off drops later periods
    early = S.scd2_backfill_as_of(df, ["actorid"], "current_year", ["quality_class"], 2020)
    assert early.filter(F.col("end_period") > 2020).count() == 0


def _states(spark):
    ps = A.player_seasons(spark, SF_SMALL)
    return C.snapshot_states(ps, ["player_id"], "season", measure="pts", thresholds=A.SEASON_THRESHOLDS,
                             default_class=A.SEASON_DEFAULT)


def test_step_fold_equals_backfill(spark):
    states = _states(spark).cache()
    attrs = ["scoring_class", "is_active"]
    lo, hi = states.agg(F.min("season"), F.max("season")).first()
    for open_by in ("end", "latest"):
        scd = S.scd2_backfill(states.filter(F.col("season") == lo), ["player_id"], "season", attrs)
        for p in range(lo + 1, hi + 1):
            scd = S.scd2_step(scd, states.filter(F.col("season") == p), ["player_id"], attrs, p,
                              open_by=open_by).drop("current_period").checkpoint(eager=True)
        full = S.scd2_backfill(states, ["player_id"], "season", attrs)
        assertDataFrameEqual(scd, full)


def test_scd_invariants(spark):
    states = _states(spark)
    scd = S.scd2_backfill(states, ["player_id"], "season", ["scoring_class", "is_active"])
    assert S.scd_intervals_valid(scd, ["player_id"]).count() == 0
    lengths = scd.agg(F.sum(F.col("end_period") - F.col("start_period") + 1)).first()[0]
    assert lengths == states.count()
    # expanding the intervals gives back the dense input
    back = scd.select("player_id", "scoring_class", "is_active",
                      F.explode(F.sequence("start_period", "end_period")).alias("season"))
    assertDataFrameEqual(back, states.select("player_id", "scoring_class", "is_active", "season"))


def test_step_keeps_missing_keys_and_is_rerunnable(spark):
    scd = spark.createDataFrame([(1, "x", 2000, 2001), (2, "y", 2000, 2001)],
                                "k long, a string, start_period long, end_period long")
    today = spark.createDataFrame([(1, "x"), (3, "z")], "k long, a string")
    out = S.scd2_step(scd, today, ["k"], ["a"], 2002).drop("current_period")
    expected = spark.createDataFrame([(1, "x", 2000, 2002), (2, "y", 2000, 2001), (3, "z", 2002, 2002)],
                                     "k long, a string, start_period long, end_period long")
    assertDataFrameEqual(out, expected)
    again = S.scd2_step(out, today, ["k"], ["a"], 2002, open_by="latest").drop("current_period")
    assertDataFrameEqual(again, expected)


def test_step_again_gives_the_same_table(spark):
    """Both ways to find open rows; a key that stays, one that changes, one that leaves, a new and a NULL key."""
    key, at = ["k"], ["c"]
    old = spark.createDataFrame([("a", "x", 1, 1), ("b", "x", 1, 1), ("d", "x", 1, 1), (None, "x", 1, 1)],
                                "k string, c string, start_period int, end_period int")
    today = spark.createDataFrame([("a", "x"), ("b", "y"), ("e", "z"), (None, "x")], "k string, c string")
    for mode in ("end", "latest"):
        one = S.scd2_step(old, today, key, at, 2, open_by=mode)
        rows = {(r.k, r.c, r.start_period, r.end_period) for r in one.collect()}
        assert rows == {("a", "x", 1, 2), ("b", "x", 1, 1), ("b", "y", 2, 2), ("d", "x", 1, 1), ("e", "z", 2, 2), (None, "x", 1, 2)}
        assert one.count() == 6
        again = S.scd2_step(one, today, key, at, 2, open_by=mode)
        assert sorted(map(repr, again.collect())) == sorted(map(repr, one.collect()))
        other = S.scd2_step(one, today.replace("y", "w", "c"), key, at, 2, open_by=mode)
        assert {(r.k, r.c, r.start_period, r.end_period) for r in other.filter("k = 'b'").collect()} == {
            ("b", "x", 1, 1), ("b", "w", 2, 2)}
