"""Column listing and profile, contracts, as-of snapshots, engagement, retention per cell."""

import datetime as dt
import os

from pyspark.sql import functions as F

from cumulo.operators import cumulative as C
from cumulo.operators import experiment as X
from cumulo.operators import health as H
from cumulo.plans import adapters as A
from cumulo.sources import io
from cumulo.sources.specs import CONTRACTS, TableSpec, columns
from tests.conftest import SF_SMALL

D = dt.date(2024, 3, 1)


def test_columns_and_profile(spark, scratch):
    df = spark.createDataFrame([(1, "a", None), (2, None, None), (None, "c", None)], "id long, `a b` string, d date")
    io.create_table_as(df.withColumnRenamed("a b", "s").withColumn("p", F.lit(1)), "t_columns", partition_by=["p"],
                       path=os.path.join(scratch, "t"))
    got = {r.name: (r.data_type, r.is_partition) for r in io.list_columns(spark, "t_columns").collect()}
    assert got == {"id": ("bigint", False), "s": ("string", False), "d": ("date", False), "p": ("int", True)}
    prof = {r.name: (r.data_type, r.num_rows, r.num_nulls, r.lowest, r.highest) for r in io.column_profile(df).collect()}
    assert prof == {"id": ("bigint", 3, 1, "1", "2"), "a b": ("string", 3, 1, "a", "c"), "d": ("date", 3, 3, None, None)}
    assert [r.num_rows for r in io.column_profile(df.where("false")).collect()] == [0, 0, 0]


def test_contract_report_counts_breaks(spark):
    spec = TableSpec("t", columns("k long, j long, s string"), ["k", "j"], {"s": ("x", "y")})
    df = spark.createDataFrame([(1, 1, "x"), (1, 1, "z"), (1, None, None), (2, 1, "y"), (2, 1, "q"), (2, 1, "x")], spec.schema)
    assert {r.check: r.num for r in spec.report(df).collect()} == {"rows": 6, "null_key": 1, "bad_s": 2, "duplicate_key": 2}
    assert {r.check: r.num for r in spec.report(df.where("false")).collect()} == {"rows": 0, "null_key": 0, "bad_s": 0, "duplicate_key": 0}


def test_adapters_conform_to_their_contracts(spark):
    for name, table in (("web_events", A.web_events), ("player_seasons", A.player_seasons), ("actor_films", A.actor_films)):
        df = table(spark, SF_SMALL)
        want = [(f.name, f.dataType) for f in CONTRACTS[name].schema.fields]
        assert [(f.name, f.dataType) for f in df.schema.fields] == want, name
    drift = H.schema_drift(spark, A.web_events(spark, SF_SMALL), CONTRACTS["web_events"].schema)
    assert drift.count() == 0


def test_snapshot_as_of_is_the_backfill_of_that_period(spark):
    facts = spark.createDataFrame([(1, 2000, 5.0), (1, 2003, 50.0), (2, 2001, 20.0), (3, 2004, 1.0), (None, 2000, 7.0), (2, 2004, None)],
                                  "k long, season int, pts double")
    how = dict(struct_cols=["season", "pts"], measure="pts", thresholds=((30, "high"), (10, "mid")), default_class="low")
    every = C.cumulate_backfill(facts, ["k"], "season", **how)
    for season in (1999, 2000, 2002, 2004):
        one = C.snapshot_as_of(facts, ["k"], "season", season, **how)
        want = every.where(F.col("current_period") == season)
        assert sorted(map(repr, one.select(sorted(one.columns)).collect())) == sorted(map(repr, want.select(sorted(one.columns)).collect()))


def test_retention_and_sessions_per_cell(spark):
    day = lambda n: D + dt.timedelta(days=n)
    events = spark.createDataFrame([(1, day(0)), (1, day(0)), (1, day(1)), (1, day(7)), (2, day(0)), (2, day(8)), (3, day(6)),
                                    (4, day(8)), (None, day(2))], "user_id long, event_date date")
    sessions = spark.createDataFrame([(1, 10), (1, 20), (2, 60), (None, 5)], "user_id long, seconds long")
    cells = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "b"), (5, "b")], "user_id long, cell string")
    got = {r.cell: tuple(r)[1:] for r in X.cell_engagement(events, sessions, cells).collect()}
    # day 8 is the last: user 3 could come back after 1 day and not after 7, user 4 after neither
    assert got == {"a": (2, 3, 30.0, 0.5, 0.5), "b": (2, 0, None, 0.0, None)}


def test_engagement_days_without_events(spark):
    events = spark.createDataFrame([(1, D), (1, D), (2, D), (1, D + dt.timedelta(days=2)), (None, D + dt.timedelta(days=1))], "u long, d date")
    got = {r.d: tuple(r)[1:] for r in H.engagement_kpi(events, "u", "d").collect()}
    assert got == {D: (3, 2, 2, 2, 1.5, 1.0), D + dt.timedelta(days=1): (0, 0, 2, 2, None, 0.0),
                   D + dt.timedelta(days=2): (1, 1, 2, 2, 1.0, 0.5)}
