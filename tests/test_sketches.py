"""Daily summaries merged over periods, against the exact values."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cumulo.operators import sketches as S
from cumulo.sources.io import plan_text
from cumulo.sources.scratch import stored

DAY = dt.date(2024, 1, 1)


@pytest.fixture(scope="module")
def events(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice("ab"), rnd.randrange(-40_000, 200_000, 7) if rnd.random() > 0.02 else None, DAY + dt.timedelta(days=rnd.choice([*range(20), 50, 51])),
             rnd.expovariate(0.1) if rnd.random() > 0.02 else None) for _ in range(20_000)]
    return spark.createDataFrame(rows, "host string, user long, day date, value double").repartition(5).cache()


def test_visitors_within_three_errors(events):
    daily = S.daily_visitors(events, ["host"], "user", "day", lg_k=10)
    got = {r.host: r.num_visitors for r in S.merged_visitors(daily, ["host"]).collect()}
    for r in events.groupBy("host").agg(F.count_distinct("user").alias("n")).collect():
        assert abs(got[r.host] - r.n) <= 3 * 1.04 / 2 ** 5 * r.n


def test_rolling_sets_are_exact(events):
    spans = {"d1": 1, "d7": 7, "d40": 40}
    got = {(r.day, r.host): (r.d1, r.d7, r.d40) for r in S.rolling_active(S.day_bitmaps(events, "user", "day", ["host"]), "day", spans, ["host"]).collect()}
    seen = {}
    for r in events.where("user IS NOT NULL").collect():
        seen.setdefault(r.host, {}).setdefault(r.day, set()).add(r.user)
    want = {}
    for host, by in seen.items():
        for i in range(52):
            d = DAY + dt.timedelta(days=i)
            n = tuple(len(set().union(*(by.get(d - dt.timedelta(days=j), set()) for j in range(k)))) for k in spans.values())
            if any(n):
                want[d, host] = n
    assert got == want


def test_bitmaps_of_odd_ids(spark):
    ids = [0, 1, -1, 32767, 32768, 32769, -32768, -32769, 2**40, 2**40 + 1, None]
    df = spark.createDataFrame([(i, DAY) for i in ids] * 2, "user long, day date")
    row = S.rolling_active(S.day_bitmaps(df, "user", "day"), "day", {"n": 1}).collect()
    assert [(r.day, r.n) for r in row] == [(DAY, 10)]
    assert S.rolling_active(S.day_bitmaps(df.where("false"), "user", "day"), "day", {"n": 1}).count() == 0


@pytest.mark.parametrize("k,bound", [(100, 0.03), (800, 0.006)])
def test_quantile_ranks(events, k, bound):
    daily = S.daily_quantiles(events, ["host"], F.col("value"), "day", k=k)
    est = S.merged_quantiles(daily, ["host"], {"q10": 0.1, "q50": 0.5, "q99": 0.99}, k=k)
    for name, q in (("q10", 0.1), ("q50", 0.5), ("q99", 0.99)):
        for r in S.rank_share(events, ["host"], F.col("value"), est, name).collect():
            assert r.below <= q + bound and r.upto >= q - bound
    n = {r.host: r.n for r in est.collect()}
    assert n == {r.host: r.n for r in events.where("value IS NOT NULL").groupBy("host").agg(F.count(F.lit(1)).alias("n")).collect()}


def test_ranks_of_few_groups_are_not_dealt_by_group(events):
    est = stored(S.merged_quantiles(S.daily_quantiles(events, ["host"], F.col("value"), "day"), ["host"], {"q50": 0.5}), "est")
    by = lambda **x: S.rank_share(events, ["host"], F.col("value"), est, "q50", **x)
    plan = plan_text(by(), "simple")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    rows = [sorted(map(tuple, df.collect())) for df in (by(), by(broadcast_rows=0))]
    assert rows[0] == rows[1] and len(rows[0]) == 2
