"""Connected components of an edge table by alternating stars.

Large star: every node hands its larger neighbours the smallest node of its neighbourhood. Small star:
every node hands its smaller neighbours and itself the smallest of them. Repeated, the edges become one
star around each component's smallest node, in a number of rounds that grows with the logarithm of the
nodes. A round is one written table; it only joins edges with one minimum per node, so no neighbourhood is
gathered, and of the table the driver learns its number of rows and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cumulo.llm.common import materialise


def _mark(edges: DataFrame):
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.pmod(F.xxhash64("b", "a"), F.lit(2**31)))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) of every node of `edges` (a, b: long, in any order); comp is the smallest node reachable.

    Loops and repeated edges do not matter; a node that has only a loop is not returned."""
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = materialise(edges, "component-edges")
    mark = _mark(edges)
    while True:
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("m", "a").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.union(low.where("m < a").select("a", F.col("m").alias("b"))).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        star = small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select("a", F.col("m").alias("b"))).distinct()
        edges = materialise(star, "component-edges")
        now = _mark(edges)
        if now == mark:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("comp")).union(
                edges.select("b", F.col("b").alias("comp")).distinct())
        mark = now
