"""Queries over date lists, activity words and month arrays (P10-P17) on web events."""

from __future__ import annotations

from pyspark.sql import functions as F

from cumulo.functions.columns import distinct_count
from cumulo.operators import activity as AC
from cumulo.operators.joins import join_bounded_dimension
from cumulo.plans import adapters as A
from cumulo.plans.registry import query
from cumulo.sources.io import upsert
from cumulo.plans.sqlparts import DEVICES, WEB, with_

W20 = WEB.format(mod=20)
ASOF = "lastday AS (SELECT MAX(event_date) AS d FROM web)"


def _before(day):
    return F.date_sub(day, 1)


def _web(spark, sf):
    return A.web_events(spark, sf)


def _last_day(web):
    return AC.run_date(web)


def _dates_str(c="dates_active"):
    return F.array_join(F.col(c).cast("array<string>"), ",")


def _datelist(web, keys, drop_null=True):
    last = _last_day(web)
    days = AC.active_days(web, keys, drop_null_keys=drop_null)
    prev = AC.datelist_backfill(days, keys, _before(last))
    return AC.datelist_step(prev, days, keys, last, null_keys=not drop_null)


DATELIST_SQL = with_(W20, DEVICES, ASOF) + """SELECT {keys}, array_to_string(list_sort(list(DISTINCT event_date)), ',') AS dates_active,
  CAST(COUNT(DISTINCT event_date) AS INTEGER) AS n_dates, (SELECT d FROM lastday) AS date
FROM {src} WHERE event_date <= (SELECT d FROM lastday) {where} GROUP BY {keys}"""


@query("user_datelist", DATELIST_SQL.format(keys="user_id", src="web", where="AND user_id IS NOT NULL"))
def q_user_datelist(spark, sf):
    """P10: users' date lists: backfill to the day before the last, then one step."""
    d = _datelist(_web(spark, sf), ["user_id"])
    return d.select("user_id", _dates_str().alias("dates_active"),
                    F.size("dates_active").alias("n_dates"), "date")


@query("user_device_datelist", DATELIST_SQL.format(
    keys="user_id, browser_type", src="web JOIN devices USING (device_id)", where="AND user_id IS NOT NULL"))
def q_user_device_datelist(spark, sf):
    """P10 by (user, browser): events joined to the device dimension first."""
    web = join_bounded_dimension(_web(spark, sf), A.devices(spark, sf), "device_id", how="inner")
    d = _datelist(web, ["user_id", "browser_type"])
    return d.select("user_id", "browser_type", _dates_str().alias("dates_active"),
                    F.size("dates_active").alias("n_dates"), "date")


@query("host_datelist", DATELIST_SQL.format(keys="host", src="web", where=""))
def q_host_datelist(spark, sf):
    """P10 by host (NULL hosts kept, as in the reference)."""
    d = _datelist(_web(spark, sf), ["host"], drop_null=False)
    return d.select("host", _dates_str().alias("dates_active"), F.size("dates_active").alias("n_dates"), "date")


WORD_SQL = with_(W20, ASOF, """dd AS (SELECT DISTINCT user_id, event_date FROM web
  WHERE user_id IS NOT NULL AND event_date <= (SELECT d FROM lastday)),
words AS (SELECT user_id, CAST(SUM(CASE WHEN datediff('day', event_date, (SELECT d FROM lastday)) BETWEEN 0 AND 31
  THEN CAST(1 AS BIGINT) << (31 - datediff('day', event_date, (SELECT d FROM lastday))) ELSE 0 END) AS BIGINT) AS datelist_int
  FROM dd GROUP BY user_id)""")


def _words(spark, sf):
    return AC.datelist_int(_datelist(_web(spark, sf), ["user_id"]), ["user_id"], "date")


@query("datelist_int", WORD_SQL + "SELECT user_id, datelist_int FROM words")
def q_datelist_int(spark, sf):
    """32-day activity word from the users' date lists."""
    return _words(spark, sf)


@query("datelist_metrics", WORD_SQL + """SELECT user_id,
  bit_count(datelist_int) > 0 AS monthly_active, CAST(bit_count(datelist_int) AS INTEGER) AS l32,
  bit_count(datelist_int & 4261412864) > 0 AS weekly_active,
  CAST(bit_count(datelist_int & 4261412864) AS INTEGER) AS l7,
  bit_count(datelist_int & 33292288) > 0 AS weekly_active_previous_week FROM words""")
def q_datelist_metrics(spark, sf):
    """Monthly / weekly activity from the word."""
    return AC.datelist_metrics(_words(spark, sf), ["user_id"])


def _daily_hits(web):
    return AC.active_days(web, ["user_id"])


def _months(daily, keys, last, measures, null_keys=True, **kw):
    """The table after the last day's step: earlier months as stored, the last one a day longer."""
    month_col = kw.get("month_col", "month_start")
    stored = AC.month_array_backfill(daily, keys, _before(last), measures, **kw)
    step = AC.month_array_step(stored, daily, keys, last, measures, null_keys=null_keys, **kw)
    earlier = stored.filter(F.col(month_col) < F.trunc(last, "month"))
    return earlier.withColumn("date_partition", last).unionByName(step)


def _month_hits(spark, sf):
    web = _web(spark, sf)
    return _months(_daily_hits(web), ["user_id"], _last_day(web), [("hit_array", "num_hits")], null_keys=False)


# Every (key, month) with activity crossed with the month's days up to the last day of the data.
MONTH_SQL = with_(W20, ASOF, """daily AS (SELECT {keys}, event_date, date_trunc('month', event_date)::DATE AS m, {vals}
  FROM web {where} GROUP BY ALL),
active AS (SELECT {keys}, m, MIN(event_date) AS first_found_date FROM daily GROUP BY ALL),
filled AS (SELECT active.*, days.day, {filled} FROM active
  CROSS JOIN LATERAL (SELECT UNNEST(range(active.m, least(active.m + INTERVAL 1 MONTH, (SELECT d FROM lastday) + INTERVAL 1 DAY),
                                          INTERVAL 1 DAY))::DATE AS day) days
  LEFT JOIN daily ON daily.event_date = days.day AND {joinon})""")
USER_MONTHS = MONTH_SQL.format(keys="user_id", vals="COUNT(*) AS num_hits", where="WHERE user_id IS NOT NULL",
                               filled="daily.num_hits", joinon="daily.user_id = active.user_id")


@query("month_hits", USER_MONTHS + """SELECT user_id, m AS month_start, first_found_date,
  array_to_string(list(COALESCE(CAST(num_hits AS VARCHAR), 'null') ORDER BY day), ',') AS hit_array,
  (SELECT d FROM lastday) AS date_partition FROM filled GROUP BY user_id, m, first_found_date""")
def q_month_hits(spark, sf):
    """NULL-padded arrays of daily hits for every month; one step on top of the backfill."""
    m = _month_hits(spark, sf)
    return m.select("user_id", "month_start", "first_found_date",
                    F.array_join(F.col("hit_array").cast("array<string>"), ",", "null").alias("hit_array"),
                    "date_partition")


@query("day_slot_totals", USER_MONTHS + """SELECT m AS month_start,
  CAST(COALESCE(SUM(num_hits) FILTER (day = m), 0) AS BIGINT) AS num_hits_first_day,
  CAST(COALESCE(SUM(num_hits) FILTER (day = m + 1), 0) AS BIGINT) AS num_hits_second_day,
  CAST(COALESCE(SUM(num_hits) FILTER (day = m + 2), 0) AS BIGINT) AS num_hits_third_day
FROM filled GROUP BY m""")
def q_day_slot_totals(spark, sf):
    """Totals of the first three day slots across users, per month (out-of-range slots count 0)."""
    m = _month_hits(spark, sf)
    return AC.slot_totals(m, "hit_array", ["month_start"], [0, 1, 2],
                          ["num_hits_first_day", "num_hits_second_day", "num_hits_third_day"])


@query("metric_array_daily", USER_MONTHS + """SELECT 'site_hits' AS metric_name, day AS event_date,
  CAST(SUM(COALESCE(num_hits, 0)) AS BIGINT) AS value FROM filled GROUP BY day""")
def q_metric_array_daily(spark, sf):
    """P14 + A8 + P17: zero-padded metric arrays, upserted on (user, month, metric), then summed back to days."""
    web = _web(spark, sf)
    last = _last_day(web)
    daily = _daily_hits(web)
    ms = [("metric_array", "num_hits")]
    prev = AC.month_array_backfill(daily, ["user_id"], _before(last), ms, pad=0,
                                   first_found_col=None).withColumn("metric_name", F.lit("site_hits"))
    step = AC.month_array_step(prev, daily, ["user_id"], last, ms, pad=0, first_found_col=None,
                               null_keys=False).withColumn("metric_name", F.lit("site_hits"))
    table = upsert(prev, step, ["user_id", "month_start", "metric_name"])
    return AC.metric_array_to_daily(table, ["metric_name"])


@query("host_month_reduced", MONTH_SQL.format(
    keys="host", vals="COUNT(*) AS hits, COUNT(DISTINCT user_id) AS visitors", where="",
    filled="daily.hits, daily.visitors", joinon="daily.host IS NOT DISTINCT FROM active.host")
       + """SELECT host, m AS month,
  array_to_string(list(COALESCE(hits, 0) ORDER BY day), ',') AS hit_array,
  array_to_string(list(COALESCE(visitors, 0) ORDER BY day), ',') AS unique_visitors_array
FROM filled GROUP BY host, m""")
def q_host_month_reduced(spark, sf):
    """Parallel hit and unique-visitor month arrays per host, zero padded; both counts from one aggregate."""
    web = _web(spark, sf)
    daily = web.groupBy("host", "event_date").agg(F.count(F.lit(1)).alias("num_hits"),
                                                  distinct_count("user_id").alias("visitors"))
    table = _months(daily, ["host"], _last_day(web), [("hit_array", "num_hits"), ("unique_visitors_array", "visitors")],
                    pad=0, first_found_col=None, month_col="month")
    return table.select("host", "month",
                        F.array_join(F.col("hit_array").cast("array<string>"), ",").alias("hit_array"),
                        F.array_join(F.col("unique_visitors_array").cast("array<string>"), ",")
                        .alias("unique_visitors_array"))
