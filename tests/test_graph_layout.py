"""Graph fixtures and plan assertions for broadcast (C4) and bucketed (C5) joins."""

import json

from pyspark.sql import functions as F

from cumulo.operators import graph as GR
from cumulo.operators import layout as L
from cumulo.operators.joins import broadcast_if_small, estimated_bytes
from cumulo.plans import adapters as A
from cumulo.sources.io import plan_text
from tests.conftest import SF_SMALL


def test_team_vertex_dedup(spark):
    rows = [(7, "HRB", "Herons", "Port Adler", "Quay Hall", 1988),
            (7, "HRB", "Egrets", "Port Adler", "Quay Hall", 1988)]
    teams = spark.createDataFrame(rows, "team_id long, abbreviation string, nickname string, city string, "
                                        "arena string, yearfounded long")
    v = GR.with_json(GR.vertices(teams, "team_id", "team",
                                 {"abbreviation": "abbreviation", "nickname": "nickname", "city": "city",
                                  "arena": "arena", "year_founded": "yearfounded"},
                                 dedup_order=["nickname"]))
    out = v.collect()
    assert len(out) == 1 and out[0].identifier == "7" and out[0].type == "team"
    assert json.loads(out[0].properties)["nickname"] == "Egrets"  # first by the explicit order
    assert GR.graph_contract(GR.vertices(teams, "team_id", "team", {"a": "arena"}),
                             GR.edges(teams, "team_id", "team", "team_id", "team", "plays_on", {})).count() == 2


def test_explicit_broadcast_join_plan(spark):
    ev = A.web_events(spark, SF_SMALL)
    dev = A.devices(spark, SF_SMALL)
    assert estimated_bytes(dev) is not None
    plan = plan_text(ev.join(broadcast_if_small(dev), "device_id"))
    assert "BroadcastHashJoin" in plan
    big = broadcast_if_small(dev, max_bytes=1)   # over the limit: no hint, a shuffle join is planned
    assert "SortMergeJoin" in plan_text(ev.join(big, "device_id"))


def test_bucketed_join_has_no_exchange(spark):
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        facts = L.bucketed_match_facts(spark, A.match_details(spark, SF_SMALL), A.matches(spark, SF_SMALL),
                                       A.medals_matches_players(spark, SF_SMALL), prefix="t_k1")
        plan = plan_text(facts)
        joins = plan.count("SortMergeJoin")
        assert joins >= 2 and "Exchange" not in plan, plan
        unbucketed = L.match_facts(A.match_details(spark, SF_SMALL), A.matches(spark, SF_SMALL),
                                   A.medals_matches_players(spark, SF_SMALL))
        assert "Exchange" in plan_text(unbucketed)
        assert facts.count() == unbucketed.count()
    finally:
        spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "true")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_layout_report_sizes(spark):
    m = A.matches(spark, SF_SMALL)
    r = {x.variant: x for x in L.layout_experiment(m, {"unsorted": [], "sorted": ["playlist_id", "mapid"]}).collect()}
    assert set(r) == {"unsorted", "sorted"} and all(x.size_bytes > 0 and x.num_files >= 1 for x in r.values())


def test_pushdown_and_pruning(spark):
    ev = A.web_events(spark, SF_SMALL).filter(F.col("user_id") == 7).select("user_id", "host")
    plan = plan_text(ev)
    assert "PushedFilters: [IsNotNull(user_id), EqualTo(user_id,7)]" in plan
    assert "ReadSchema: struct<user_id:bigint,event_type:string>" in plan


def test_cached_reports_with_persisted_aggregate(spark):
    from cumulo.sources.io import cached
    facts = L.match_facts(A.match_details(spark, SF_SMALL), A.matches(spark, SF_SMALL),
                          A.medals_matches_players(spark, SF_SMALL))
    agg = L.shared_aggregate(facts, "player_gamertag", "playlist_id", "player_total_kills")
    plain = L.cached_reports(facts, "player_gamertag", "playlist_id", "player_total_kills")
    with cached(agg):
        from_cache = L.cached_reports(facts, "player_gamertag", "playlist_id", "player_total_kills", agg=agg)
        assert "InMemoryRelation" in plan_text(from_cache, "extended") or "InMemoryTableScan" in plan_text(from_cache)
        assert sorted(from_cache.collect()) == sorted(plain.collect())
