"""Readers for the provided parquet tables.

`load` names the columns it needs so the scan's ReadSchema is pruned even
before Catalyst sees the rest of the plan.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def load(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def register_all(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Register each table as a temp view (A3) for SQL-style use."""
    for n in names:
        load(spark, sf_dir, n).createOrReplaceTempView(n)
