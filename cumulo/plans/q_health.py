"""Health-check and KPI queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cumulo.operators import health as H
from cumulo.plans import adapters as A
from cumulo.plans.q_growth import GROWTH_SQL
from cumulo.plans.registry import query
from cumulo.plans.sqlparts import WEB, with_
from cumulo.sources.tables import load

W20 = WEB.format(mod=20)


@query("missing_partitions", with_(W20, """b AS (SELECT CAST(date_trunc('month', MIN(event_date)) AS DATE) AS lo,
  CAST(last_day(MAX(event_date)) AS DATE) AS hi FROM web)""") + """SELECT CAST(d AS DATE) AS missing_date
FROM (SELECT UNNEST(range((SELECT lo FROM b), (SELECT hi FROM b) + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d)
WHERE CAST(d AS DATE) NOT IN (SELECT DISTINCT event_date FROM web)""")
def q_missing_partitions(spark, sf):
    """O1: days of the covered months without events."""
    web = A.web_events(spark, sf)
    lo = web.agg(F.trunc(F.min("event_date"), "month")).scalar()
    hi = web.agg(F.last_day(F.max("event_date"))).scalar()
    return H.missing_partitions(web, "event_date", lo, hi)


EXPECTED_SEGMENTS = ("view", "click", "purchase", "signup", "error", "refund")


@query("segment_coverage", "SELECT s AS missing_segment FROM (VALUES ('view'), ('click'), ('purchase'), ('signup'), "
       "('error'), ('refund')) t(s) WHERE s NOT IN (SELECT DISTINCT event_type FROM events)")
def q_segment_coverage(spark, sf):
    """Expected event types that have no rows."""
    return H.segment_coverage(load(spark, sf, "events", ["event_type"]), "event_type", EXPECTED_SEGMENTS)


NULL_COLS = ("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")


@query("null_contract", "SELECT COUNT(*) AS num_rows, column_name, null_count FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count FROM lineitem" for c in NULL_COLS)
       + ") x, lineitem GROUP BY column_name, null_count")
def q_null_contract(spark, sf):
    """NULL counts of the not-null columns of lineitem, one scan."""
    return H.null_contract(load(spark, sf, "lineitem", list(NULL_COLS)), NULL_COLS)


@query("profit_kpi", """SELECT l_returnflag, l_linestatus, COUNT(*) AS num_items,
  CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS units,
  CAST(SUM(CAST(round(l_extendedprice * 100) AS BIGINT) * (100 - CAST(round(l_discount * 100) AS BIGINT))) AS DOUBLE) / 10000.0 AS revenue,
  CAST(SUM(CAST(round(l_extendedprice * 100) AS BIGINT) * (100 - CAST(round(l_discount * 100) AS BIGINT))) AS DOUBLE) / 10000.0
    / CAST(SUM(CAST(l_quantity AS BIGINT)) AS DOUBLE) AS revenue_per_unit
FROM lineitem GROUP BY 1, 2""")
def q_profit_kpi(spark, sf):
    """Profit KPI (revenue after discount) per return flag and line status."""
    li = load(spark, sf, "lineitem", ["l_returnflag", "l_linestatus", "l_extendedprice", "l_discount", "l_quantity"])
    return H.profit_kpi(li, ["l_returnflag", "l_linestatus"])


@query("late_arrival", """WITH lags AS (SELECT o_orderpriority, datediff('day', o_orderdate, l_shipdate) AS lag
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
ranked AS (SELECT *, cume_dist() OVER (PARTITION BY o_orderpriority ORDER BY lag) AS share FROM lags)
SELECT o_orderpriority, COUNT(*) AS num_rows, COUNT(*) FILTER (WHERE lag > 60) AS num_late,
  CAST(MAX(lag) AS INTEGER) AS max_lag_days, CAST(SUM(lag) AS DOUBLE) / COUNT(*) AS mean_lag_days,
  CAST(MIN(lag) FILTER (WHERE share >= 0.9) AS INTEGER) AS p90_lag_days
FROM ranked GROUP BY 1""")
def q_late_arrival(spark, sf):
    """Delay from order to shipment per priority, with its exact 90th percentile."""
    li = load(spark, sf, "lineitem", ["l_orderkey", "l_shipdate"])
    o = load(spark, sf, "orders", ["o_orderkey", "o_orderdate", "o_orderpriority"])
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    return H.late_arrival(j, "o_orderdate", "l_shipdate", ["o_orderpriority"])


@query("engagement_kpi", with_(W20, """days AS (SELECT CAST(UNNEST(generate_series(MIN(event_date), MAX(event_date), INTERVAL 1 DAY)) AS DATE) AS d
  FROM web WHERE user_id IS NOT NULL)""") + """SELECT d AS event_date, COUNT(*) FILTER (event_date = d) AS num_events,
  COUNT(DISTINCT user_id) FILTER (event_date = d) AS daily_active, COUNT(DISTINCT user_id) FILTER (event_date > d - 7) AS weekly_active,
  COUNT(DISTINCT user_id) AS monthly_active,
  CAST(COUNT(*) FILTER (event_date = d) AS DOUBLE) / NULLIF(COUNT(DISTINCT user_id) FILTER (event_date = d), 0) AS events_per_user,
  CAST(COUNT(DISTINCT user_id) FILTER (event_date = d) AS DOUBLE) / COUNT(DISTINCT user_id) AS stickiness
FROM days JOIN web ON event_date <= d AND event_date > d - 28 WHERE user_id IS NOT NULL GROUP BY 1""")
def q_engagement_kpi(spark, sf):
    """Engagement roll-up per day: events, daily, weekly and monthly active users, events per user, stickiness."""
    return H.engagement_kpi(A.web_events(spark, sf), "user_id", "event_date")


@query("growth_kpi", GROWTH_SQL + "SELECT date, daily_active_state, COUNT(*) AS num_users FROM g GROUP BY 1, 2")
def q_growth_kpi(spark, sf):
    """Daily growth KPI = users per daily state per day (from P18's backfill)."""
    from cumulo.operators.activity import run_date
    from cumulo.operators.growth import growth_accounting_backfill
    act = A.web_events(spark, sf).filter(F.col("user_id").isNotNull()).select("user_id", "event_date")
    g = growth_accounting_backfill(act, "user_id", run_date(act), with_dates=False)
    return g.groupBy("date", "daily_active_state").agg(F.count(F.lit(1)).alias("num_users"))
