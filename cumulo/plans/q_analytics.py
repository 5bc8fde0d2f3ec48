"""Analytical-pattern queries (P21-P27) and dedup probes."""

from __future__ import annotations

from pyspark.sql import functions as F

from cumulo.operators import analytics as AN
from cumulo.operators.clean import duplicate_keys
from cumulo.operators.joins import join_bounded_dimension
from cumulo.plans import adapters as A
from cumulo.plans.registry import query
from cumulo.plans.sqlparts import DEVICES, GAMES, GD, GD_DEDUP, WEB, with_

W20 = WEB.format(mod=20)
GD_ORDER = ["line_no", "pts", "reb", "ast"]


def _gdd(spark, sf):
    return AN.dedup(A.game_details(spark, sf), ["game_id", "team_id", "player_id"], GD_ORDER)


@query("dedup_facts", with_(GD, GD_DEDUP) + "SELECT * FROM gdd")
def q_dedup_facts(spark, sf):
    """One box-score row per (game, team, player), first by line number."""
    return _gdd(spark, sf)


@query("duplicate_keys", with_(GD) + """SELECT game_id, team_id, player_id, COUNT(*) AS num_rows
FROM gd GROUP BY 1, 2, 3 HAVING COUNT(*) > 1""")
def q_duplicate_keys(spark, sf):
    """Keys that occur more than once."""
    return duplicate_keys(A.game_details(spark, sf), ["game_id", "team_id", "player_id"])


def _level(label, dims):
    cols = ", ".join(f"COALESCE({c}, '{AN.UNKNOWN}') AS {c}" if c in dims else f"'{AN.OVERALL}' AS {c}"
                     for c in ("os_type", "device_type", "browser_type"))
    return f"SELECT '{label}' AS aggregation_level, {cols}, COUNT(*) AS number_of_hits FROM seen GROUP BY ALL"


@query("dashboard_rollup", with_(W20, DEVICES, "seen AS (SELECT * FROM web JOIN devices USING (device_id))")
       + " UNION ALL ".join([_level(AN.ALL_DIMS_LABEL, ("os_type", "device_type", "browser_type")),
                             *[_level(c, (c,)) for c in ("browser_type", "device_type", "os_type")]]))
def q_dashboard_rollup(spark, sf):
    """Hits by (browser, device, os) and by each alone in one scan."""
    ev = join_bounded_dimension(A.web_events(spark, sf), A.devices(spark, sf), "device_id", how="inner")
    return AN.dashboard_rollup(ev)


REF_CLASS_SQL = """CASE WHEN referrer LIKE '%linkedin%' THEN 'Linkedin' WHEN referrer LIKE '%t.co%' THEN 'Twitter'
  WHEN referrer LIKE '%google%' THEN 'Google' WHEN referrer LIKE '%lnkd%' THEN 'Linkedin'
  WHEN referrer LIKE '%example.com%' THEN 'On Site' ELSE referrer END"""

TRAFFIC_MIN_TOTAL = 100


@query("traffic_windows", with_(W20, DEVICES, "hits AS (SELECT url, " + REF_CLASS_SQL + """ AS referrer, event_date
  FROM web JOIN devices USING (device_id))""", """
daily AS (SELECT referrer, url, event_date, COUNT(*) AS count FROM hits WHERE referrer IS NOT NULL GROUP BY ALL),
numbered AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY referrer, url ORDER BY event_date) AS i FROM daily),
months AS (SELECT referrer, url, date_trunc('month', event_date) AS m, SUM(count) AS c FROM daily GROUP BY ALL),
totals AS (SELECT referrer, url, SUM(count) AS c FROM daily GROUP BY ALL)""") + """
SELECT n.referrer, n.url, n.event_date, n.count,
  CAST(SUM(o.count) FILTER (o.i > n.i - 7) AS BIGINT) AS weekly_rolling_count,
  CAST(SUM(o.count) FILTER (o.i <= n.i - 7) AS BIGINT) AS previous_weekly_rolling_count,
  CAST(n.count AS DOUBLE) / ANY_VALUE(months.c) AS pct_of_month, CAST(n.count AS DOUBLE) / ANY_VALUE(totals.c) AS pct_of_total
FROM numbered n JOIN numbered o ON o.referrer = n.referrer AND o.url = n.url AND o.i BETWEEN n.i - 13 AND n.i
JOIN months ON months.referrer = n.referrer AND months.url = n.url AND months.m = date_trunc('month', n.event_date)
JOIN totals ON totals.referrer = n.referrer AND totals.url = n.url
WHERE totals.c > """ + str(TRAFFIC_MIN_TOTAL) + " GROUP BY n.referrer, n.url, n.event_date, n.count, n.i")
def q_traffic_windows(spark, sf):
    """Referrer class, weekly / previous week rolling counts, month and total shares."""
    ev = join_bounded_dimension(A.web_events(spark, sf), A.devices(spark, sf), "device_id", how="inner")
    return AN.traffic_windows(ev, own_patterns=["%example.com%"], min_total=TRAFFIC_MIN_TOTAL)


# Games won by each team that has a box score in them.
WON = """won AS (SELECT DISTINCT gd.game_id, gd.team_id, gd.team_abbreviation, game_date,
  CAST(COALESCE((gd.team_id = home_team_id) = (home_team_wins = 1), FALSE) AS INTEGER) AS win
  FROM gd LEFT JOIN games USING (game_id))"""


def _answer(i, who, total, source, by):
    q = AN.QUESTIONS[i].replace("'", "''")
    return f"""(SELECT '{q}' AS question, {who} AS answer, CAST({total} AS DOUBLE) AS vals FROM {source}
  GROUP BY {by} ORDER BY vals DESC, answer DESC LIMIT 1)"""


@query("grouping_answers", with_(GD, GD_DEDUP, GAMES, WON, """points AS (SELECT gdd.*, season FROM gdd LEFT JOIN games USING (game_id))""")
       + " UNION ALL ".join([
           _answer(0, "player_name", "SUM(COALESCE(pts, 0))", "points", "player_name, team_abbreviation"),
           _answer(1, "player_name", "SUM(COALESCE(pts, 0))", "points", "player_name, season"),
           _answer(2, "team_abbreviation", "SUM(win)", "won", "team_abbreviation")]))
def q_grouping_answers(spark, sf):
    """P24 (+ P27): three answers from one grouping-sets scan."""
    return AN.grouping_answers(_gdd(spark, sf), A.games(spark, sf), team_games=A.game_details(spark, sf))


# A stretch of 90 games is the difference of two running totals 90 games apart.
@query("best_rolling_90", with_(GD, GAMES, WON, """run AS (SELECT team_id,
  ROW_NUMBER() OVER w AS i, SUM(win) OVER w AS wins FROM won WINDOW w AS (PARTITION BY team_id ORDER BY game_date, game_id)),
best AS (SELECT team_id, CAST(MAX(a.wins - COALESCE(b.wins, 0)) AS BIGINT) AS max_in_window
  FROM run a LEFT JOIN (SELECT team_id AS t, i + 90 AS j, wins FROM run) b ON t = team_id AND j = i GROUP BY team_id)""")
       + "SELECT team_id, max_in_window FROM best QUALIFY RANK() OVER (ORDER BY max_in_window DESC) = 1")
def q_best_rolling_90(spark, sf):
    """P25: most wins in any 90-game stretch; every team tied for the best."""
    pairs = A.game_details(spark, sf).select("game_id", "team_id").distinct()
    ds = AN.team_win(pairs, A.games(spark, sf)).select("game_id", "game_date", "team_id", "team_win")
    r = AN.best_rolling(ds, "team_id", ["game_date", "game_id"], "team_win", 90)
    return r.select("team_id", F.col("max_in_window").cast("bigint").alias("max_in_window"))


# A streak ends here and began after the last game without more than 10 points.
@query("longest_streak", with_(GD, GD_DEDUP, GAMES, """scores AS (SELECT player_id, game_id, game_date, SUM(pts) > 10 AS hit
  FROM gdd LEFT JOIN games USING (game_id) GROUP BY ALL),
numbered AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY player_id ORDER BY game_date, game_id) AS i FROM scores),
since AS (SELECT player_id, hit, i - COALESCE(MAX(i) FILTER (NOT hit) OVER (PARTITION BY player_id ORDER BY i), 0) AS len
  FROM numbered)""")
       + "SELECT player_id, CAST(MAX(len) AS BIGINT) AS longest_streak FROM since WHERE hit GROUP BY player_id")
def q_longest_streak(spark, sf):
    """Longest run of consecutive games with more than 10 points, per player."""
    gdd = _gdd(spark, sf)
    per_game = gdd.groupBy("player_id", "game_id").agg(F.sum("pts").alias("pts"))
    g = A.games(spark, sf).select("game_id", "game_date")
    ds = per_game.join(g, on="game_id", how="left")
    return AN.longest_streak(ds, "player_id", ["game_date", "game_id"], F.coalesce(F.col("pts"), F.lit(0.0)) > 10)


@query("referrer_class", with_(W20) + "SELECT " + REF_CLASS_SQL + """ AS referrer_class, COUNT(*) AS num_events
FROM web GROUP BY 1""")
def q_referrer_class(spark, sf):
    """Referrer classed by LIKE patterns, first match wins; unmatched keep their value."""
    from cumulo.functions.columns import DEFAULT_REFERRER_PATTERNS, pattern_class
    pats = list(DEFAULT_REFERRER_PATTERNS) + [("%example.com%", "On Site")]
    return (A.web_events(spark, sf).groupBy(pattern_class("referrer", pats).alias("referrer_class"))
            .agg(F.count(F.lit(1)).alias("num_events")))
