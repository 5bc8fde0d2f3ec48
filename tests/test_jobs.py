"""Stored daily jobs: day-by-day runs equal the backfill; a re-run is idempotent."""

import datetime as dt
import os

from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from cumulo.operators import growth as G
from cumulo.plans import adapters as A
from cumulo.plans.jobs import run_range, run_step
from tests.conftest import SF_SMALL


def test_growth_job_days_equal_backfill_and_rerun(spark, scratch):
    act = A.web_events(spark, SF_SMALL).select("user_id", "event_date").filter(F.col("user_id").isNotNull())
    act = act.cache()
    lo = act.agg(F.min("event_date")).first()[0]
    hi = lo + dt.timedelta(days=5)
    path = os.path.join(scratch, "users_growth_accounting")

    def step(prev, day):
        if prev is not None:
            prev = prev.drop("snapshot_date")
        return G.growth_accounting_step(prev, act, "user_id", day)

    run_range(spark, path, "snapshot_date", lo, hi, step)
    stored = spark.read.parquet(path)
    full = G.growth_accounting_backfill(act.filter(F.col("event_date") <= hi), "user_id", hi)
    assertDataFrameEqual(stored.drop("snapshot_date"), full)
    before = stored.count()
    run_step(spark, path, "snapshot_date", hi, step)          # re-run of the last day
    assert spark.read.parquet(path).count() == before


def test_bucketed_snapshot_table_step(spark):
    from cumulo.plans.jobs import run_step_table
    from cumulo.sources.io import plan_text
    act = A.web_events(spark, SF_SMALL).select("user_id", "event_date").filter(F.col("user_id").isNotNull())
    act = act.cache()
    lo = act.agg(F.min("event_date")).first()[0]
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")

    def step(prev, day):
        return G.growth_accounting_step(prev, act, "user_id", day)

    for i in range(4):
        run_step_table(spark, "t_growth", "snapshot_date", lo + dt.timedelta(days=i), step,
                       key=["user_id"], buckets=8)
    hi = lo + dt.timedelta(days=3)
    full = G.growth_accounting_backfill(act.filter(F.col("event_date") <= hi), "user_id", hi)
    stored = spark.table("t_growth")
    assertDataFrameEqual(stored.drop("snapshot_date"), full)
    # re-run of the last day replaces it
    run_step_table(spark, "t_growth", "snapshot_date", hi, step, key=["user_id"], buckets=8)
    assert spark.table("t_growth").count() == stored.count()
    # the snapshot side of the next step's join is read in its buckets: one exchange, for today's rows
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        prev = spark.table("t_growth").filter(F.col("snapshot_date") == hi).drop("snapshot_date")
        plan = plan_text(G.growth_accounting_step(prev, act, "user_id", hi + dt.timedelta(days=1)))
        tree = plan.split("\n\n")[0].splitlines()
        join_at = next(i for i, ln in enumerate(tree) if "SortMergeJoin" in ln)
        snapshot_side = [ln for ln in tree[join_at + 1:] if ln.lstrip().startswith(":")]
        assert "Bucketed: true" in plan and "SelectedBucketsCount: 8 out of 8" in plan
        assert snapshot_side and not any("Exchange" in ln for ln in snapshot_side), plan
        assert any("Exchange" in ln for ln in tree[join_at + 1:]), plan     # today's side is shuffled
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.sql("DROP TABLE IF EXISTS t_growth")


def test_a_missing_day_is_refused(spark, scratch):
    import pytest
    path = os.path.join(scratch, "gap")
    day = dt.date(2023, 1, 1)

    def step(prev, d):
        mine = spark.createDataFrame([(f"k{d.day}",)], "k string")
        return mine if prev is None else prev.select("k").union(mine).distinct()

    run_step(spark, path, "d", day, step)
    with pytest.raises(ValueError):
        run_step(spark, path, "d", day + dt.timedelta(days=2), step)
    out = run_step(spark, path, "d", day + dt.timedelta(days=2), step, allow_gap=True)
    assert {r.k for r in out.collect()} == {"k1", "k3"}
    run_step(spark, path, "d", day, step)   # nothing earlier is stored: a first run
