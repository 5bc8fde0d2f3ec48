"""Experiment queries (N1-N4) on web events."""

from __future__ import annotations

from pyspark.sql import functions as F

from cumulo.operators import experiment as X
from cumulo.operators.ordered import sessionize
from cumulo.plans import adapters as A
from cumulo.plans.registry import query
from cumulo.plans.q_stream import SESSIONS_SQL
from cumulo.plans.sqlparts import WEB, with_

W20 = WEB.format(mod=20)


def _users(web):
    return X.per_user_outcomes(web, "user_id", F.col("url") == "/purchase",
                               F.round(F.col("value") * 100).cast("bigint"))


@query("experiment_cells", with_(W20, """b AS (SELECT DISTINCT user_id,
  ('0x' || substr(md5('homepage_test:' || user_id), 1, 8))::BIGINT % 10000 AS bucket FROM web)""") + """
SELECT user_id, CASE WHEN bucket < 3400 THEN 'control' WHEN bucket < 6700 THEN 'variant_a' ELSE 'variant_b' END AS cell FROM b""")
def q_experiment_cells(spark, sf):
    """Hash-assigned cells (control + two variants) per user."""
    users = A.web_events(spark, sf).select("user_id").distinct()
    return X.assign_cells(users, "user_id", "homepage_test",
                          (("control", 34), ("variant_a", 33), ("variant_b", 33)))


@query("experiment_exposures", with_(W20, """b AS (SELECT *, ('0x' || substr(md5('homepage_test:' || user_id), 1, 8))::BIGINT % 10000 AS bucket
  FROM web)""") + """
SELECT CASE WHEN bucket < 3400 THEN 'control' WHEN bucket < 6700 THEN 'variant_a' ELSE 'variant_b' END AS cell, host,
  COUNT(*) AS exposures FROM b WHERE user_id IS NOT NULL GROUP BY ALL""")
def q_experiment_exposures(spark, sf):
    """Events of assigned users by cell and host."""
    web = A.web_events(spark, sf)
    cells = q_experiment_cells(spark, sf)
    return X.exposures(web, cells, "user_id").groupBy("cell", "host").agg(F.count(F.lit(1)).alias("exposures"))


@query("experiment_readout", with_(W20, """u AS (SELECT user_id, MAX(CASE WHEN url = '/purchase' THEN 1 ELSE 0 END) AS converted,
  CAST(SUM(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS value_cents,
  CASE WHEN user_id % 2 = 0 THEN 'control' ELSE 'treatment' END AS cell FROM web GROUP BY user_id),
g AS (SELECT cell, COUNT(*) AS users, CAST(SUM(converted) AS BIGINT) AS conversions,
  CAST(SUM(value_cents) AS BIGINT) AS s, round(var_samp(value_cents) / 10000.0, 4) AS var_value FROM u GROUP BY cell),
h AS (SELECT cell, users, conversions, CAST(conversions AS DOUBLE) / CAST(users AS DOUBLE) AS conversion_rate,
  CAST(s AS DOUBLE) / CAST(users AS DOUBLE) / 100.0 AS mean_value,
  var_value FROM g),
c AS (SELECT CAST(users AS DOUBLE) AS cn, CAST(conversions AS DOUBLE) AS ck FROM h WHERE cell = 'control')""")
       + """SELECT cell, users, conversions, conversion_rate, mean_value, var_value,
  conversion_rate / (ck / cn) - 1.0 AS lift,
  CASE WHEN cell <> 'control' THEN (conversion_rate - ck / cn) /
    sqrt(((CAST(conversions AS DOUBLE) + ck) / (CAST(users AS DOUBLE) + cn)) *
         (1.0 - (CAST(conversions AS DOUBLE) + ck) / (CAST(users AS DOUBLE) + cn)) * (1.0 / CAST(users AS DOUBLE) + 1.0 / cn)) END AS z
FROM h, c""")
def q_experiment_readout(spark, sf):
    """Readout per cell; cells here by user parity so the SQL oracle can reproduce them."""
    users = _users(A.web_events(spark, sf)).withColumn(
        "cell", F.when(F.col("user_id") % 2 == 0, "control").otherwise("treatment"))
    # rounded, so that the order in which partial variances merge does not show
    return X.experiment_readout(users).withColumn("var_value", F.round("var_value", 4))


@query("experiment_engagement", SESSIONS_SQL + """, b AS (SELECT DISTINCT user_id,
  ('0x' || substr(md5('homepage_test:' || user_id), 1, 8))::BIGINT % 10000 AS bucket FROM web WHERE user_id IS NOT NULL),
c AS (SELECT user_id, CASE WHEN bucket < 3400 THEN 'control' WHEN bucket < 6700 THEN 'variant_a' ELSE 'variant_b' END AS cell FROM b),
firsts AS (SELECT user_id, MIN(event_date) AS d0 FROM web GROUP BY 1), z AS (SELECT MAX(event_date) AS z FROM web),
r AS (SELECT c.cell, c.user_id, d0, d0 + 1 <= z AS e1, d0 + 7 <= z AS e7,
  EXISTS (SELECT 1 FROM web w WHERE w.user_id = c.user_id AND w.event_date = d0 + 1) AS a1,
  EXISTS (SELECT 1 FROM web w WHERE w.user_id = c.user_id AND w.event_date = d0 + 7) AS a7 FROM c JOIN firsts USING (user_id), z),
per AS (SELECT cell, COUNT(*) AS n, CAST(SUM(epoch(session_end) - epoch(session_start) - 300) AS BIGINT) AS len
  FROM (SELECT user_id, date_trunc('second', session_start) AS session_start, date_trunc('second', session_end) AS session_end FROM sess)
  JOIN c USING (user_id) GROUP BY 1)
SELECT cell, COUNT(*) AS users, CAST(MIN(per.n) AS BIGINT) AS num_sessions, CAST(MIN(per.len) AS DOUBLE) / MIN(per.n) AS mean_session_seconds,
  CAST(COUNT(*) FILTER (e1 AND a1) AS DOUBLE) / COUNT(*) FILTER (e1) AS retention_1,
  CAST(COUNT(*) FILTER (e7 AND a7) AS DOUBLE) / COUNT(*) FILTER (e7) AS retention_7
FROM r LEFT JOIN per USING (cell) GROUP BY cell""")
def q_experiment_engagement(spark, sf):
    """Sessions, their mean length and the retention after 1 and 7 days per experiment cell."""
    web = A.web_events(spark, sf)
    sessions = sessionize(web, ["user_id", "host"], "event_time", 300)
    seconds = sessions.select("user_id", (F.unix_seconds(F.col("session_end").cast("timestamp"))
                                          - F.unix_seconds(F.col("session_start").cast("timestamp")) - 300).alias("seconds"))
    return X.cell_engagement(web, seconds, q_experiment_cells(spark, sf).where("user_id IS NOT NULL"))


@query("daily_kpis", with_(W20) + """SELECT event_date, COUNT(DISTINCT user_id) AS dau, COUNT(*) AS events,
  COUNT(*) FILTER (WHERE host = 'click') AS clicks, COUNT(*) FILTER (WHERE host = 'view') AS views,
  CAST(COUNT(*) FILTER (WHERE host = 'click') AS DOUBLE) / CAST(COUNT(*) FILTER (WHERE host = 'view') AS DOUBLE) AS ctr,
  COUNT(*) FILTER (WHERE host = 'purchase') AS purchases FROM web GROUP BY event_date""")
def q_daily_kpis(spark, sf):
    """DAU, click-through and purchases per day."""
    return X.daily_kpis(A.web_events(spark, sf), "user_id", "host")
