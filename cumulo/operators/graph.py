"""Property-graph tables (J1, J2, J4): vertices and edges with map properties.

Properties are `map<string,string>` in the tables and JSON text on output.
Pair edges between members of one group (player-player) are not built:
they emit every pair inside a group, quadratic in the group size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cumulo.operators.analytics import dedup

# Allowed vertex and edge types of the graph contract.
VERTEX_TYPES = ("player", "team", "game")
EDGE_TYPES = ("plays_against", "shares_team", "plays_in", "plays_on")


def props(fields: Mapping[str, Column | str]) -> Column:
    """Ordered string map of properties."""
    kv = []
    for k, v in fields.items():
        c = F.col(v) if isinstance(v, str) else v
        kv += [F.lit(k), c.cast("string")]
    return F.create_map(*kv)


def vertices(df: DataFrame, id_col: str, vtype: str, fields: Mapping[str, Column | str],
             dedup_order: Sequence[str] | None = None) -> DataFrame:
    """One vertex per identifier (first row by `dedup_order` when duplicated)."""
    if dedup_order is not None:
        df = dedup(df, [id_col], dedup_order)
    return df.select(F.col(id_col).cast("string").alias("identifier"), F.lit(vtype).alias("type"),
                     props(fields).alias("properties"))


def edges(df: DataFrame, subject: str, subject_type: str, obj: str, object_type: str, edge_type: str,
          fields: Mapping[str, Column | str]) -> DataFrame:
    """One edge per input row (dedup beforehand)."""
    return df.select(F.col(subject).cast("string").alias("subject_identifier"),
                     F.lit(subject_type).alias("subject_type"),
                     F.col(obj).cast("string").alias("object_identifier"),
                     F.lit(object_type).alias("object_type"),
                     F.lit(edge_type).alias("edge_type"),
                     props(fields).alias("properties"))


def with_json(df: DataFrame, col: str = "properties") -> DataFrame:
    """Properties as JSON text (nulls kept as JSON null)."""
    return df.withColumn(col, F.to_json(F.col(col), {"ignoreNullFields": "false"}))


def graph_contract(vertices_df: DataFrame, edges_df: DataFrame) -> DataFrame:
    """Contract violations - unknown types and duplicate composite keys.

    One aggregate per table on its composite key yields both checks, so
    each table is read once.
    """
    v = vertices_df.groupBy("identifier", "type").agg(F.count(F.lit(1)).alias("_n"))
    v_issues = v.select(F.explode(F.array_compact(F.array(
        F.when(~F.col("type").isin(*VERTEX_TYPES), F.lit("vertex_type")),
        F.when(F.col("_n") > 1, F.lit("vertex_key"))))).alias("issue"), F.col("identifier").alias("detail"))
    ek = ["subject_identifier", "subject_type", "object_identifier", "object_type", "edge_type"]
    e = edges_df.groupBy(*ek).agg(F.count(F.lit(1)).alias("_n"))
    bad_type = (~F.col("edge_type").isin(*EDGE_TYPES) | ~F.col("subject_type").isin(*VERTEX_TYPES)
                | ~F.col("object_type").isin(*VERTEX_TYPES))
    e_issues = e.select(F.explode(F.array_compact(F.array(
        F.when(bad_type, F.lit("edge_type")),
        F.when(F.col("_n") > 1, F.lit("edge_key"))))).alias("issue"), F.col("subject_identifier").alias("detail"))
    return v_issues.unionByName(e_issues)
