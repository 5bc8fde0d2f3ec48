"""Queries over summaries kept per day: visitor sketches, user bitmaps, quantile sketches."""

from __future__ import annotations

from pyspark.sql import functions as F

from cumulo.operators import sketches as S
from cumulo.plans import adapters as A
from cumulo.plans.registry import query
from cumulo.plans.sqlparts import WEB, with_
from cumulo.sources.scratch import stored
from cumulo.sources.tables import load

W20 = WEB.format(mod=20)


@query("month_visitors", with_(W20) + """SELECT CAST(date_trunc('month', event_date) AS DATE) AS month, host, COUNT(*) AS num_events,
  TRUE AS within_bound FROM web GROUP BY 1, 2""")
def q_month_visitors(spark, sf):
    """Visitors of each host and month from stored daily sketches, held against the exact number:
    within three standard errors (or one visitor)."""
    web = A.web_events(spark, sf)
    daily = stored(S.daily_visitors(web, ["host"], "user_id", "event_date"), "daily-visitors")
    month = F.trunc("event_date", "month").alias("month")
    est = S.merged_visitors(daily, [month, "host"])
    exact = web.groupBy(month, "host").agg(F.count_distinct("user_id").alias("exact"), F.count(F.lit(1)).alias("num_events"))
    bound = F.greatest(F.lit(1.0), F.col("exact") * (3 * 1.04 / 2 ** (S.LG_K / 2)))
    return exact.join(est, ["month", "host"]).select(
        "month", "host", "num_events", (F.abs(F.col("num_visitors") - F.col("exact")) <= bound).alias("within_bound"))


@query("active_users", with_(W20, """days AS (SELECT CAST(UNNEST(generate_series(MIN(event_date), MAX(event_date), INTERVAL 1 DAY)) AS DATE) AS d
  FROM web WHERE user_id IS NOT NULL)""") + """SELECT d AS event_date,
  COUNT(DISTINCT user_id) FILTER (event_date = d) AS daily_active, COUNT(DISTINCT user_id) FILTER (event_date > d - 7) AS weekly_active,
  COUNT(DISTINCT user_id) FILTER (event_date > d - 28) AS monthly_active, COUNT(DISTINCT user_id) AS active_45
FROM days JOIN web ON event_date <= d AND event_date > d - 45 GROUP BY 1""")
def q_active_users(spark, sf):
    """Users active in the last 1, 7, 28 and 45 days, for every day, from stored daily bitmaps."""
    bits = stored(S.day_bitmaps(A.web_events(spark, sf), "user_id", "event_date"), "daily-bitmaps")
    return S.rolling_active(bits, "event_date", {"daily_active": 1, "weekly_active": 7, "monthly_active": 28, "active_45": 45})


@query("shipping_quantiles", """SELECT l_returnflag, COUNT(*) AS n, TRUE AS median_within, TRUE AS p90_within
FROM lineitem WHERE l_extendedprice IS NOT NULL AND l_returnflag IS NOT NULL GROUP BY 1""")
def q_shipping_quantiles(spark, sf):
    """Median and 90th percentile of the line price per return flag from quantile sketches of each day,
    held against the exact ranks: within 1 % of the rows."""
    lines = load(spark, sf, "lineitem", ["l_returnflag", "l_extendedprice", "l_shipdate"]).withColumn("day", F.to_date("l_shipdate"))
    price = F.col("l_extendedprice")
    daily = stored(S.daily_quantiles(lines, ["l_returnflag"], price, "day"), "daily-quantiles")
    est = stored(S.merged_quantiles(daily, ["l_returnflag"], {"median": 0.5, "p90": 0.9}), "quantiles")
    out = est.select("l_returnflag", "n")
    for name, q in (("median", 0.5), ("p90", 0.9)):
        share = S.rank_share(lines, ["l_returnflag"], price, est, name)
        ok = (F.col("below") <= q + 0.01) & (F.col("upto") >= q - 0.01)
        out = out.join(share.select("l_returnflag", ok.alias(f"{name}_within")), "l_returnflag")
    return out
