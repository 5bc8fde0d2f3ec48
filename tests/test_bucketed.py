"""Bucketed joins as the registered queries run them: no exchange, equal rows, settings put back."""

import pytest

from cumulo.operators import layout as L
from cumulo.plans import adapters as A
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def tables(spark):
    return {n: L.bucketed(f(spark, SF_SMALL), "t_buckets", b, ["match_id"]) for n, f, b in (
        ("details", A.match_details, 16), ("matches", A.matches, 16), ("medals", A.medals_matches_players, 16), ("eight", A.matches, 8))}


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_no_exchange(spark, tables, adaptive):
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        plans: list = []
        facts = L.joined_in_buckets(spark, lambda: L.match_facts(tables["details"], tables["matches"], tables["medals"]), "t", plans)
        unlike = L.joined_in_buckets(spark, lambda: tables["details"].join(tables["eight"], "match_id"), "t", plans)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert all("Exchange" not in p and "SortMergeJoin" in p for p in plans) and "Coalesced to 8" in plans[1]
    plain = L.match_facts(A.match_details(spark, SF_SMALL), A.matches(spark, SF_SMALL), A.medals_matches_players(spark, SF_SMALL))
    rows = lambda df: sorted(map(repr, df.select(*sorted(df.columns)).collect()))
    assert rows(facts) == rows(plain)
    assert rows(unlike) == rows(A.match_details(spark, SF_SMALL).join(A.matches(spark, SF_SMALL), "match_id"))
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"


def test_one_file_for_each_bucket(tables):
    assert len(tables["details"].inputFiles()) <= 16


def test_buckets_follow_the_rows(spark):
    few, many = spark.range(10), spark.range(1000)
    assert L.bucket_number(few, rows=10) == L.bucket_number(rows=10) == 16
    assert L.bucket_number(few, many, rows=10) == 128 and L.bucket_number(many, least=8, rows=100) == 16
    assert L.bucket_number(A.matches(spark, SF_SMALL), A.medals_matches_players(spark, SF_SMALL)) == 16
