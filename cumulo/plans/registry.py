"""Registry of queries (Spark builders) and their DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register `fn(spark, sf_dir) -> DataFrame` under `name` with an optional oracle."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all() -> None:
    from cumulo.plans import (  # noqa: F401
        q_history, q_activity, q_growth, q_analytics, q_graph, q_layout, q_bi,
        q_experiment, q_health, q_stream, q_storage, q_tables, q_sketches, q_catalog,
    )
