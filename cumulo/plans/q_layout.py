"""Layout-job queries (K1-K8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cumulo.operators import layout as L
from cumulo.plans import adapters as A
from cumulo.plans.registry import query
from cumulo.plans.sqlparts import DEVICES, MATCHES, WEB, with_

FACTS_SQL = """facts AS (SELECT d.*, m.mapid, m.is_team_game, m.playlist_id, m.completion_date,
  COALESCE(md.medal_count, 0) AS medal_count
  FROM details d JOIN matches m USING (match_id)
  LEFT JOIN (SELECT match_id, player_gamertag, CAST(SUM(count) AS BIGINT) AS medal_count FROM mmp GROUP BY 1, 2) md
  USING (match_id, player_gamertag))"""


def _facts(spark, sf):
    return L.match_facts(A.match_details(spark, sf), A.matches(spark, sf), A.medals_matches_players(spark, sf))


@query("bucketed_join_facts", with_(MATCHES, FACTS_SQL) + """SELECT match_id, player_gamertag, mapid, playlist_id,
  player_total_kills, player_total_deaths, medal_count FROM facts""")
def q_bucketed_join_facts(spark, sf):
    """K1: details x matches x medals per (match, player) (T11 key)."""
    return _facts(spark, sf).select("match_id", "player_gamertag", "mapid", "playlist_id",
                                    "player_total_kills", "player_total_deaths", "medal_count")


@query("top_mean", with_(MATCHES, """pm AS (SELECT player_gamertag, AVG(player_total_kills) AS avg_kills
  FROM details GROUP BY 1)""") + "SELECT * FROM pm ORDER BY avg_kills DESC, player_gamertag LIMIT 1")
def q_top_mean(spark, sf):
    """K2: player with the highest mean kills per match."""
    return L.top_mean(A.match_details(spark, sf), "player_gamertag", "player_total_kills", "match_id", "avg_kills")


@query("top_group", with_(MATCHES, """c1 AS (SELECT playlist_id AS v, COUNT(DISTINCT match_id) AS n FROM matches GROUP BY 1),
c2 AS (SELECT CAST(mapid AS VARCHAR) AS v, COUNT(DISTINCT match_id) AS n FROM matches GROUP BY 1)""")
       + """SELECT 'playlist_id' AS dimension, v AS value, n AS num_units FROM (SELECT * FROM c1 ORDER BY n DESC, v DESC LIMIT 1)
UNION ALL SELECT 'mapid', v, n FROM (SELECT * FROM c2 ORDER BY n DESC, v DESC LIMIT 1)""")
def q_top_group(spark, sf):
    """K3: most played playlist and map."""
    return L.most_frequent(A.matches(spark, sf), ["playlist_id", "mapid"], "match_id")


@query("top_filtered_group", with_(MATCHES, """t AS (SELECT m.mapid, SUM(x.count) AS total FROM mmp x
  JOIN (SELECT medal_id FROM medals WHERE name LIKE '%ring%') md USING (medal_id)
  JOIN matches m USING (match_id) GROUP BY 1 ORDER BY total DESC, mapid LIMIT 1)""")
       + "SELECT t.mapid, CAST(t.total AS BIGINT) AS total, maps.name FROM t LEFT JOIN maps USING (mapid)")
def q_top_filtered_group(spark, sf):
    """K4: map with most medals of the '%ring%' kind, named after the limit."""
    facts = A.medals_matches_players(spark, sf).join(A.matches(spark, sf).select("match_id", "mapid"), "match_id")
    r = L.top_filtered_group(facts, A.medals(spark, sf), "medal_id", F.col("name").like("%ring%"), "mapid",
                             "count", A.maps(spark, sf), "mapid", "name")
    return r.select("mapid", F.col("total").cast("bigint").alias("total"), "name")


@query("medal_facts", with_(MATCHES) + """SELECT match_id, player_gamertag, medal_id, CAST(SUM(count) AS BIGINT) AS medal_count
FROM (SELECT DISTINCT match_id, player_gamertag FROM details) d FULL JOIN mmp USING (match_id, player_gamertag)
GROUP BY 1, 2, 3""")
def q_medal_facts(spark, sf):
    """K6: medals per (match, player, medal) after a full join on (match, player)."""
    return L.medal_facts(A.match_details(spark, sf), A.medals_matches_players(spark, sf))


@query("cached_reports", with_(MATCHES, FACTS_SQL, """agg AS (SELECT player_gamertag, playlist_id,
  SUM(player_total_kills) AS total FROM facts GROUP BY 1, 2)""")
       + """SELECT 'player_gamertag' AS report, player_gamertag AS key, CAST(SUM(total) AS BIGINT) AS total,
  COUNT(*) AS num_groups FROM agg GROUP BY 2
UNION ALL SELECT 'playlist_id', playlist_id, CAST(SUM(total) AS BIGINT), COUNT(*) FROM agg GROUP BY 2""")
def q_cached_reports(spark, sf):
    """K7: one cached aggregate, two reports."""
    r = L.cached_reports(_facts(spark, sf), "player_gamertag", "playlist_id", "player_total_kills")
    return r.withColumn("total", F.col("total").cast("bigint"))


@query("events_enriched", with_(WEB.format(mod=30), DEVICES) + """SELECT event_id, user_id, device_id,
  browser_type AS browser, device_type, os_type, CAST(event_time AS DATE) AS event_day
FROM web LEFT JOIN devices USING (device_id)""")
def q_events_enriched(spark, sf):
    """K8: events with device attributes (some devices unmatched), day column, renamed."""
    e = L.enrich_events(A.web_events(spark, sf, device_mod=30), A.devices(spark, sf),
                        {"browser_type": "browser"})
    return e.select("event_id", "user_id", "device_id", "browser", "device_type", "os_type", "event_day")


@query("layout_report")
def q_layout_report(spark, sf):
    """Bytes per sort order of the same rows (no SQL oracle: file sizes)."""
    m = A.matches(spark, sf)
    return L.layout_experiment(m, {"unsorted": [], "by_playlist": ["playlist_id", "mapid"],
                                   "by_map": ["mapid", "playlist_id"]})
