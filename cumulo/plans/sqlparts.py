"""SQL (DuckDB dialect) for the adapter tables, shared by the oracles.

Each constant is one CTE body that mirrors a function in `adapters.py`.
"""

CLASS_SQL = ("CASE WHEN {x} > 400000 THEN 'star' WHEN {x} > 250000 THEN 'good' "
             "WHEN {x} > 150000 THEN 'average' ELSE 'bad' END")

PS = """ps0 AS (
  SELECT o_custkey AS player_id, CAST(year(o_orderdate) AS INTEGER) AS season,
         COUNT(*) AS gp, CAST(SUM(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS total_cents
  FROM orders GROUP BY 1, 2),
ps AS (
  SELECT player_id, season, gp, CAST(total_cents AS DOUBLE) / gp / 100.0 AS pts,
         CAST(total_cents AS DOUBLE) / 100.0 AS total, total_cents FROM ps0)"""

SPINE = """firsts AS (SELECT player_id, MIN(season) AS first_season FROM ps GROUP BY 1),
spine AS (
  SELECT player_id, CAST(UNNEST(range(first_season, (SELECT MAX(season) FROM ps) + 1)) AS INTEGER) AS season
  FROM firsts)"""

SNAP = """snap AS (
  SELECT s.player_id, s.season, ps.pts IS NOT NULL AS is_active, ps.pts, ps.gp, ps.total,
         last_value(ps.pts IGNORE NULLS) OVER (PARTITION BY s.player_id ORDER BY s.season
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_pts,
         max(CASE WHEN ps.pts IS NOT NULL THEN s.season END) OVER (PARTITION BY s.player_id ORDER BY s.season
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_season,
         count(ps.pts) OVER (PARTITION BY s.player_id ORDER BY s.season
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n_seasons,
         CAST(sum(ps.total_cents) OVER (PARTITION BY s.player_id ORDER BY s.season
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) / 100.0 AS hist_total,
         first_value(ps.pts IGNORE NULLS) OVER (PARTITION BY s.player_id ORDER BY s.season
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS first_pts
  FROM spine s LEFT JOIN ps ON ps.player_id = s.player_id AND ps.season = s.season)"""

STATES = """states AS (
  SELECT player_id, season, is_active, """ + CLASS_SQL.format(x="last_pts") + """ AS scoring_class
  FROM snap)"""

WEB = """web AS (
  SELECT event_id, user_id, user_id % {mod} AS device_id, event_type AS host,
         '/' || event_type AS url,
         CASE event_id % 7 WHEN 0 THEN 'https://www.google.com/search' WHEN 1 THEN 'https://t.co/a1b2'
              WHEN 2 THEN 'https://www.linkedin.com/feed' WHEN 3 THEN 'https://lnkd.in/xyz'
              WHEN 4 THEN 'https://news.example.org/' WHEN 5 THEN 'https://www.example.com/blog' END AS referrer,
         ts AS event_time, CAST(ts AS DATE) AS event_date, value
  FROM events)"""

DEVICES = """devices AS (
  SELECT CAST(n_nationkey AS BIGINT) AS device_id,
         CASE n_nationkey % 4 WHEN 0 THEN 'Chrome' WHEN 1 THEN 'Firefox' WHEN 2 THEN 'Safari' ELSE 'Edge' END AS browser_type,
         CASE n_nationkey % 3 WHEN 0 THEN 'Desktop' WHEN 1 THEN 'Mobile' ELSE 'Tablet' END AS device_type,
         CASE n_regionkey WHEN 0 THEN 'Windows' WHEN 1 THEN 'Mac OS X' WHEN 2 THEN 'Linux' WHEN 3 THEN 'iOS'
              ELSE 'Android' END AS os_type
  FROM nation)"""

GAMES = """games AS (
  SELECT o_orderkey AS game_id, CAST(o_orderdate AS DATE) AS game_date,
         CAST(CASE WHEN month(o_orderdate) >= 10 THEN year(o_orderdate) ELSE year(o_orderdate) - 1 END AS INTEGER) AS season,
         o_custkey % 25 AS home_team_id,
         (o_custkey % 25 + 1 + o_orderkey % 24) % 25 AS visitor_team_id,
         CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS home_team_wins
  FROM orders)"""

GD = """gd AS (
  SELECT l_orderkey AS game_id, l_suppkey % 25 AS team_id, l_suppkey AS player_id,
         'player_' || CAST(l_suppkey AS VARCHAR) AS player_name,
         'T' || CAST(l_suppkey % 25 AS VARCHAR) AS team_abbreviation,
         l_linenumber AS line_no, l_quantity AS pts, l_extendedprice AS reb, l_discount AS ast
  FROM lineitem)"""

GD_DEDUP = """gdd AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY game_id, team_id, player_id
                                 ORDER BY line_no, pts, reb, ast) AS rn FROM gd) WHERE rn = 1)"""


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"

MATCHES = """matches AS (SELECT o_orderkey AS match_id, o_custkey % 5 AS mapid, o_orderstatus <> 'P' AS is_team_game,
  o_orderpriority AS playlist_id, o_orderdate AS completion_date FROM orders),
details AS (SELECT l_orderkey AS match_id, 'gamer_' || CAST(l_suppkey AS VARCHAR) AS player_gamertag,
  CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS player_total_kills, COUNT(*) AS player_total_deaths
  FROM lineitem GROUP BY 1, 2),
mmp AS (SELECT l_orderkey AS match_id, 'gamer_' || CAST(l_suppkey AS VARCHAR) AS player_gamertag,
  l_partkey AS medal_id, l_linenumber AS count FROM lineitem),
medals AS (SELECT p_partkey AS medal_id, p_name AS name, p_type AS description FROM part),
maps AS (SELECT CAST(r_regionkey AS BIGINT) AS mapid, r_name AS name FROM region)"""
