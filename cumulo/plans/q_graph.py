"""Graph table queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cumulo.operators import graph as GR
from cumulo.operators.analytics import dedup
from cumulo.plans import adapters as A
from cumulo.plans.registry import query
from cumulo.plans.sqlparts import GAMES, GD, GD_DEDUP, with_


def _gdd(spark, sf):
    return dedup(A.game_details(spark, sf), ["game_id", "team_id", "player_id"], ["line_no", "pts", "reb", "ast"])


def _vertices(spark, sf):
    teams = GR.vertices(A.teams(spark, sf), "team_id", "team",
                        {"abbreviation": "abbreviation", "nickname": "nickname", "city": "city",
                         "arena": "arena", "year_founded": "yearfounded"},
                        dedup_order=["abbreviation", "nickname", "city", "arena", "yearfounded"])
    per_player = _gdd(spark, sf).groupBy("player_id").agg(
        F.max("player_name").alias("player_name"), F.count(F.lit(1)).alias("number_of_games"),
        F.sum("pts").cast("bigint").alias("total_points"))
    players = GR.vertices(per_player, "player_id", "player",
                          {"player_name": "player_name", "number_of_games": "number_of_games",
                           "total_points": "total_points"})
    games = GR.vertices(A.games(spark, sf), "game_id", "game",
                        {"game_date": "game_date", "season": "season", "home_team_id": "home_team_id",
                         "visitor_team_id": "visitor_team_id", "home_team_wins": "home_team_wins"})
    return teams.unionByName(players).unionByName(games)


def _edges(spark, sf):
    gdd = _gdd(spark, sf)
    plays_in = GR.edges(gdd, "player_id", "player", "game_id", "game", "plays_in",
                        {"pts": "pts", "team_id": "team_id", "team_abbreviation": "team_abbreviation"})
    per_team = gdd.groupBy("player_id", "team_id").agg(F.count(F.lit(1)).alias("games"),
                                                      F.sum("pts").cast("bigint").alias("total_points"))
    plays_on = GR.edges(per_team, "player_id", "player", "team_id", "team", "plays_on",
                        {"games": "games", "total_points": "total_points"})
    return plays_in.unionByName(plays_on)


VERTICES_SQL = with_(GD, GD_DEDUP, GAMES) + """SELECT CAST(n_nationkey AS VARCHAR) AS identifier, 'team' AS type,
  CAST(json_object('abbreviation', 'T' || CAST(n_nationkey AS VARCHAR), 'nickname', n_name,
    'city', 'CITY_' || CAST(n_regionkey AS VARCHAR), 'arena', 'ARENA_' || CAST(n_nationkey AS VARCHAR),
    'year_founded', CAST(1946 + n_nationkey AS VARCHAR)) AS VARCHAR) AS properties FROM nation
UNION ALL
SELECT CAST(player_id AS VARCHAR), 'player', CAST(json_object('player_name', MAX(player_name),
  'number_of_games', CAST(COUNT(*) AS VARCHAR), 'total_points', CAST(CAST(SUM(pts) AS BIGINT) AS VARCHAR)) AS VARCHAR)
FROM gdd GROUP BY player_id
UNION ALL
SELECT CAST(game_id AS VARCHAR), 'game', CAST(json_object('game_date', CAST(game_date AS VARCHAR),
  'season', CAST(season AS VARCHAR), 'home_team_id', CAST(home_team_id AS VARCHAR),
  'visitor_team_id', CAST(visitor_team_id AS VARCHAR), 'home_team_wins', CAST(home_team_wins AS VARCHAR)) AS VARCHAR)
FROM games"""


@query("vertices", VERTICES_SQL)
def q_vertices(spark, sf):
    """Team, player and game vertices with JSON properties."""
    return GR.with_json(_vertices(spark, sf))


@query("edges_membership", with_(GD, GD_DEDUP) + """SELECT CAST(player_id AS VARCHAR) AS subject_identifier,
  'player' AS subject_type, CAST(game_id AS VARCHAR) AS object_identifier, 'game' AS object_type,
  'plays_in' AS edge_type, CAST(json_object('pts', CAST(pts AS VARCHAR), 'team_id', CAST(team_id AS VARCHAR),
  'team_abbreviation', team_abbreviation) AS VARCHAR) AS properties FROM gdd
UNION ALL
SELECT CAST(player_id AS VARCHAR), 'player', CAST(team_id AS VARCHAR), 'team', 'plays_on',
  CAST(json_object('games', CAST(COUNT(*) AS VARCHAR), 'total_points', CAST(CAST(SUM(pts) AS BIGINT) AS VARCHAR)) AS VARCHAR)
FROM gdd GROUP BY player_id, team_id""")
def q_edges_membership(spark, sf):
    """plays_in (player -> game) and plays_on (player -> team) edges."""
    return GR.with_json(_edges(spark, sf))


@query("graph_contract_raw", with_(GD) + """SELECT 'edge_key' AS issue, CAST(player_id AS VARCHAR) AS detail
FROM gd GROUP BY player_id, game_id HAVING COUNT(*) > 1""")
def q_graph_contract_raw(spark, sf):
    """J4 on box scores before dedup: every (player, game) edge that occurs more than once."""
    raw = A.game_details(spark, sf)
    return GR.graph_contract(_vertices(spark, sf), GR.edges(raw, "player_id", "player", "game_id", "game", "plays_in",
                                                            {"pts": "pts"}))


@query("graph_contract", with_(GD) + "SELECT 'none' AS issue, 'none' AS detail FROM gd WHERE 1 = 0")
def q_graph_contract(spark, sf):
    """Violations of the vertex / edge contract (expected: none)."""
    return GR.graph_contract(_vertices(spark, sf), _edges(spark, sf))
