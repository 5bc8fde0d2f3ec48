"""Queries over the catalog and table contracts, and small projections that had no query of their own."""

from __future__ import annotations

from pyspark.sql import functions as F

from cumulo.functions.columns import url_host
from cumulo.operators import layout as L
from cumulo.operators.clean import upper_cols, with_defaults
from cumulo.plans import adapters as A
from cumulo.plans.q_layout import FACTS_SQL
from cumulo.plans.registry import query
from cumulo.plans.sqlparts import GD, MATCHES, PS, WEB, with_
from cumulo.sources import io
from cumulo.sources.scratch import scratch_table, stored
from cumulo.sources.specs import CONTRACTS
from cumulo.sources.tables import load

W20 = WEB.format(mod=20)


@query("stored_aggregate", with_(W20) + """SELECT host, referrer, event_date, COUNT(*) AS num_hits, CAST(SUM(event_id) AS BIGINT) AS sum_ids
FROM web GROUP BY 1, 2, 3""")
def q_stored_aggregate(spark, sf):
    """An aggregate made into a table partitioned by day (CTAS), replaced once, read back from the catalog."""
    table, path = scratch_table(spark, "cumulo_hits")
    hits = A.web_events(spark, sf).groupBy("host", "referrer", "event_date").agg(
        F.count(F.lit(1)).alias("num_hits"), F.sum("event_id").alias("sum_ids"))
    for df in (hits.withColumn("num_hits", F.col("num_hits") * 0), hits):
        io.create_table_as(df, table, partition_by=["event_date"], path=path)
    return spark.table(table).select("host", "referrer", "event_date", "num_hits", "sum_ids")


@query("column_profile", " UNION ALL ".join(
    f"SELECT '{c}' AS name, '{t}' AS data_type, COUNT(*) AS num_rows, COUNT(*) - COUNT({c}) AS num_nulls, "
    f"CAST(MIN({c}) AS VARCHAR) AS lowest, CAST(MAX({c}) AS VARCHAR) AS highest FROM orders"
    for c, t in (("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_orderpriority", "string"))))
def q_column_profile(spark, sf):
    """Type, NULLs and range of each column, in one scan."""
    return io.column_profile(load(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]))


@query("persisted_reports", with_(MATCHES, FACTS_SQL, """agg AS (SELECT player_gamertag, playlist_id,
  SUM(player_total_kills) AS total FROM facts GROUP BY 1, 2)""")
       + """SELECT 'player_gamertag' AS report, player_gamertag AS key, CAST(SUM(total) AS BIGINT) AS total,
  COUNT(*) AS num_groups FROM agg GROUP BY 2
UNION ALL SELECT 'playlist_id', playlist_id, CAST(SUM(total) AS BIGINT), COUNT(*) FROM agg GROUP BY 2""")
def q_persisted_reports(spark, sf):
    """The shared aggregate persisted for two reports, each written, then released."""
    facts = L.match_facts(A.match_details(spark, sf), A.matches(spark, sf), A.medals_matches_players(spark, sf))
    with io.cached(L.shared_aggregate(facts, "player_gamertag", "playlist_id", "player_total_kills")) as agg:
        out = stored(L.cached_reports(facts, "player_gamertag", "playlist_id", "player_total_kills", agg=agg), "reports")
    return out.withColumn("total", F.col("total").cast("bigint"))


@query("events_normalised", with_(W20) + """SELECT event_id, UPPER(host) AS host, COALESCE(referrer, 'DIRECT') AS referrer,
  CASE WHEN referrer IS NULL THEN NULL ELSE split_part(lower(referrer), '/', 3) END AS referrer_host FROM web""")
def q_events_normalised(spark, sf):
    """Missing referrers filled, hosts in upper case, the host of each referrer's address."""
    web = A.web_events(spark, sf).select("event_id", "host", "referrer", url_host("referrer").alias("referrer_host"))
    return upper_cols(with_defaults(web, {"referrer": "DIRECT"}), ["host"])


_CHECKED = {"web_events": A.web_events, "player_seasons": A.player_seasons, "actor_films": A.actor_films,
            "game_details": A.game_details}


def _contract_sql(table: str, source: str, key: list[str], bad: dict[str, str]) -> list[str]:
    keys = ", ".join(key)
    nulls = " OR ".join(f"{k} IS NULL" for k in key)
    checks = {"rows": "COUNT(*)", "null_key": f"COUNT(*) FILTER ({nulls})",
              **{f"bad_{c}": f"COUNT(*) FILTER ({c} NOT IN ({v}))" for c, v in bad.items()}}
    out = [f"SELECT '{table}' AS \"table\", '{n}' AS \"check\", {e} AS num FROM {source}" for n, e in checks.items()]
    return out + [f"SELECT '{table}', 'duplicate_key', COUNT(*) FROM (SELECT 1 FROM {source} GROUP BY {keys} HAVING COUNT(*) > 1)"]


@query("contract_report", with_(W20, PS, GD, """films AS (SELECT o_custkey AS actor_id, o_orderkey AS film_id FROM orders)""")
       + " UNION ALL ".join([*_contract_sql("web_events", "web", ["event_id"], {"host": "'view', 'click', 'purchase', 'signup', 'error'"}),
                             *_contract_sql("player_seasons", "ps", ["player_id", "season"], {}),
                             *_contract_sql("actor_films", "films", ["actor_id", "film_id"], {}),
                             *_contract_sql("game_details", "gd", ["game_id", "team_id", "player_id"], {})]))
def q_contract_report(spark, sf):
    """The contracts of four input tables, counted: rows, NULL keys, repeated keys, values outside their set."""
    out = None
    for name, table in _CHECKED.items():
        part = CONTRACTS[name].report(table(spark, sf))
        out = part if out is None else out.unionByName(part)
    return out
