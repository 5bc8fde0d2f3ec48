"""Every registered query against its DuckDB oracle on sf0.001 (the driver's check at small scale)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from cumulo.plans import registry
from cumulo.sources.tables import TABLES, table_path
from tests.conftest import SF_SMALL

QUERIES = E.queries()
ORACLES = E.oracle_sql()


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in recs), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_SMALL, t)}')")
    return con


def test_every_query_has_an_oracle_or_is_rows_only():
    assert set(ORACLES) <= set(QUERIES)
    own = {q for q in QUERIES if q in registry.QUERIES}
    assert own - set(ORACLES) == {"layout_report"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    cur = duck.execute(ORACLES[name])
    d_cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(d_cols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(d_cols, cur.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["player_id", "scoring_class", "start_period", "end_period"]
    assert df.count() > 0
