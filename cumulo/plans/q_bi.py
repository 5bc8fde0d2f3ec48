"""BI extract tables (M1x-M6x) and the geo lookup (U1) on web events."""

from __future__ import annotations

from pyspark.sql import functions as F

from cumulo.operators import bi as BI
from cumulo.operators.joins import join_bounded_dimension
from cumulo.operators.lookup import geo_enrich
from cumulo.plans import adapters as A
from cumulo.plans.registry import query
from cumulo.plans.sqlparts import DEVICES, WEB, with_
from cumulo.sources.tables import load

W20 = WEB.format(mod=20)
TOP = """top{n} AS (SELECT host, COUNT(*) AS num_events FROM web GROUP BY host ORDER BY num_events DESC, host LIMIT {n})"""


def _web(spark, sf, mod=20):
    return A.web_events(spark, sf, device_mod=mod)


@query("top_hosts", with_(W20, TOP.format(n=3)) + "SELECT host, num_events FROM top3")
def q_top_hosts(spark, sf):
    """M1x: the three hosts with most events."""
    return BI.top_n(_web(spark, sf), "host", 3)


@query("top_hosts_year", with_(W20, TOP.format(n=10)) + """SELECT host, CAST(year(event_time) AS INTEGER) AS year,
  COUNT(*) AS num_events FROM web WHERE host IN (SELECT host FROM top10) GROUP BY 1, 2""")
def q_top_hosts_year(spark, sf):
    """M2x: events per year of the ten hosts ranked on all years."""
    web = _web(spark, sf)
    top = BI.top_n(web, "host", 10)
    return (BI.restrict_to(web, top, "host")
            .groupBy("host", F.year("event_time").alias("year")).agg(F.count(F.lit(1)).alias("num_events")))


YEARLY = """yearly AS (SELECT CAST(year(event_time) AS INTEGER) AS year, host, COUNT(*) AS num_events FROM web GROUP BY 1, 2),
ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY year ORDER BY num_events DESC, host) AS rank FROM yearly)"""


def _top3_by_year(spark, sf):
    yearly = _web(spark, sf).groupBy(F.year("event_time").alias("year"), "host").agg(
        F.count(F.lit(1)).alias("num_events"))
    return BI.top_k_per_group(yearly, ["year"], "host", "num_events", 3)


@query("top_growth", with_(W20, YEARLY) + "SELECT year, host, num_events, CAST(rank AS INTEGER) AS rank FROM ranked WHERE rank <= 3")
def q_top_growth(spark, sf):
    """M3x: top three hosts of each year."""
    return _top3_by_year(spark, sf)


@query("top_share", with_(W20, YEARLY) + """SELECT year, host, num_events,
  CAST(num_events AS DOUBLE) / SUM(num_events) OVER (PARTITION BY year) AS share FROM ranked WHERE rank <= 3""")
def q_top_share(spark, sf):
    """M4x: each top-three host's share of the top three's events per year."""
    return BI.share_within(_top3_by_year(spark, sf).drop("rank"), ["year"], "num_events")


@query("top_daily", with_(W20, TOP.format(n=3)) + """SELECT host, event_date, COUNT(*) AS num_events
FROM web WHERE host IN (SELECT host FROM top3) GROUP BY 1, 2""")
def q_top_daily(spark, sf):
    """M5x: daily events of the three top hosts."""
    web = _web(spark, sf)
    return (BI.restrict_to(web, BI.top_n(web, "host", 3), "host")
            .groupBy("host", "event_date").agg(F.count(F.lit(1)).alias("num_events")))


@query("events_devices", with_(WEB.format(mod=30), DEVICES) + """SELECT browser_type, os_type, COUNT(*) AS num_events
FROM web LEFT JOIN devices USING (device_id) GROUP BY 1, 2""")
def q_events_devices(spark, sf):
    """M6x: events related to devices on the device id (unmatched kept)."""
    e = join_bounded_dimension(_web(spark, sf, 30), A.devices(spark, sf), "device_id", how="left")
    return e.groupBy("browser_type", "os_type").agg(F.count(F.lit(1)).alias("num_events"))


@query("geo_lookup", with_(WEB.format(mod=30)) + """SELECT event_id,
  CASE WHEN n_nationkey IS NULL THEN '{}' ELSE CAST(json_object('country', n_name,
    'state', 'REGION_' || CAST(n_regionkey AS VARCHAR), 'city', 'CITY_' || CAST(n_nationkey AS VARCHAR)) AS VARCHAR)
  END AS geodata
FROM web LEFT JOIN nation ON n_nationkey = web.device_id""")
def q_geo_lookup(spark, sf):
    """Location JSON per event from a lookup table ('{}' when unknown)."""
    return geo_enrich(_web(spark, sf, 30), locations(spark, sf), "device_id").select("event_id", "geodata")


def locations(spark, sf):
    """nation -> location table keyed like the events' device id (25 rows)."""
    n = load(spark, sf, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    return n.select(F.col("n_nationkey").cast("bigint").alias("device_id"), F.col("n_name").alias("country"),
                    F.concat(F.lit("REGION_"), F.col("n_regionkey").cast("string")).alias("state"),
                    F.concat(F.lit("CITY_"), F.col("n_nationkey").cast("string")).alias("city"))
