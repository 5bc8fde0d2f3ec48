"""Growth accounting step == backfill; funnel == brute force; retention."""

import datetime as dt
from collections import defaultdict

from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from cumulo.operators import growth as G
from cumulo.plans import adapters as A
from tests.conftest import SF_SMALL

D = dt.date


def test_growth_step_equals_backfill(spark):
    act = A.web_events(spark, SF_SMALL).select("user_id", "event_date").filter(F.col("user_id").isNotNull())
    act = act.cache()
    hi = act.agg(F.max("event_date")).first()[0]
    d = hi - dt.timedelta(days=3)
    full = G.growth_accounting_backfill(act, "user_id", hi).cache()
    snap = full.filter(F.col("date") == d - dt.timedelta(days=1))
    while d <= hi:
        snap = G.growth_accounting_step(snap, act, "user_id", d).checkpoint(eager=True)
        assertDataFrameEqual(snap, full.filter(F.col("date") == d))
        d += dt.timedelta(days=1)


def test_growth_states_fixture(spark):
    # user 1: active d1, d2, d4; user 2: active d1 only; user 3 new on d4
    days = [(1, D(2023, 1, 1)), (1, D(2023, 1, 2)), (1, D(2023, 1, 4)), (2, D(2023, 1, 1)), (3, D(2023, 1, 4))]
    act = spark.createDataFrame(days, "user_id long, event_date date")
    g = G.growth_accounting_backfill(act, "user_id", D(2023, 1, 4))
    got = {(r.user_id, r.date.day): r.daily_active_state for r in g.collect()}
    assert got[(1, 1)] == "New" and got[(1, 2)] == "Retained" and got[(1, 3)] == "Churned"
    assert got[(1, 4)] == "Resurrected" and got[(2, 2)] == "Churned" and got[(2, 3)] == "Stale"
    assert got[(3, 4)] == "New"
    weekly = {(r.user_id, r.date.day): r.weekly_active_state for r in g.collect()}
    assert weekly[(2, 4)] == "Retained"
    curve = {r.days_since_first_active: (r.pct_active, r.num_users) for r in G.retention_curve(g).collect()}
    assert curve[0] == (1.0, 3)


def _funnel_brute(rows, target, min_n):
    ev = {(u, t, url) for (u, t, url) in rows}
    by_day = defaultdict(list)
    for u, t, url in ev:
        by_day[(u, t.date())].append((t, url))
    conv = {}
    for u, t, url in ev:
        later = [x for x in by_day[(u, t.date())] if x[0] > t]
        if later:
            conv[(u, t, url)] = 1 if any(v == target for _, v in later) else 0
    per = defaultdict(list)
    for (u, t, url), c in conv.items():
        per[url].append(c)
    return {url: (len(cs), sum(cs) / len(cs)) for url, cs in per.items()
            if sum(cs) / len(cs) > 0 and len(cs) > min_n}


def test_funnel_matches_brute_force(spark):
    web = A.web_events(spark, SF_SMALL).select("user_id", "event_time", "url", "host")
    rows = [(r.user_id, r.event_time, r.url) for r in web.collect()]
    want = _funnel_brute(rows, "/purchase", 5)
    got = {r.url: (r.num_events, r.pct_converted) for r in G.funnel(web, "user_id", "url", "/purchase",
                                                                    min_n=5).collect()}
    assert got == want and got
