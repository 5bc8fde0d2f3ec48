"""Sharding by k-d tree partitioning.

The documents' metadata (not their texts) spans a space with one axis per dimension. A node
holding m target shards is split along its widest axis at the weighted quantile that gives
floor(m/2) of its m shares of bytes to the left side, until every node is one shard; with m a
power of two that is the weighted median each time. `target_bytes` sets the number of shards
as ceil(total / target).

A value's coordinate on its axis is its rank among the axis' distinct values, spread over 20 bits: strings
that share a long prefix lie as far apart as others, and one outlying number does not squeeze the rest.
Weighted quantiles are distributed and exact: every row has, for each axis, a 48-bit sort key
(20 bits of the coordinate, then 28 bits of a row hash, so that rows of one hot value can still
be parted), and the key where the running weight crosses the target is found 16 bits at a time
from per-node histograms. All nodes of a level are split by the same three passes over the
metadata table; per pass a node sends one row to the driver.

Laws: sizes are near equal (each split is off by at most one row's size). Slots are numbered
without gaps inside each shard through hashed slices, so no task holds a whole shard.

Defined cases: NULL text has size 1 and crc32 0; a NULL or NaN dimension comes before the
axis' smallest value; rows that repeat an id are parted by a row number; an empty table gives an empty result;
columns not named in `dims` are not looked at.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from cumulo.llm.common import materialise

COORD_BITS, TIE_BITS, DIGIT_BITS = 20, 28, 16
ROUNDS = (COORD_BITS + TIE_BITS) // DIGIT_BITS
SLICE_ROWS = 100_000


def ranked(values: DataFrame, name: str) -> DataFrame:
    """(value, coord) of the distinct values of column `v`: its rank among them, spread over the coordinates above 0.

    Values are sorted over all partitions; a partition's offset comes from the partitions' counts."""
    order = materialise(values.select("v").distinct().repartitionByRange("v").sortWithinPartitions("v").withColumn(
        "at", F.monotonically_increasing_id()), name)
    part, inside = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = order.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))  # one row for each partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    last = F.greatest(counts.agg(F.sum("n")).scalar() - 1, F.lit(1))
    rank = F.col("offset") + inside
    return order.withColumn("part", part).join(F.broadcast(offsets), "part").select(
        "v", (F.floor(rank * ((1 << COORD_BITS) - 2) / last) + 1).cast("long").alias("coord"))


def _metadata(docs: DataFrame, id_col: str, text_col: str, dims: list[str]) -> DataFrame:
    """id, row, bytes, crc and for each dimension its coordinate c0, c1, ...; NULL and NaN have coordinate 0."""
    raw = F.encode(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), "utf-8")
    meta = materialise(docs.select(
        F.col(f"`{id_col}`").alias("id"), F.octet_length(raw).cast("long").alias("bytes"),
        F.crc32(raw).alias("crc"), F.monotonically_increasing_id().alias("row"),
        *[F.col(f"`{d}`").alias(f"v{i}") for i, d in enumerate(dims)]), "kd-values")
    for i in range(len(dims)):
        v = F.col(f"v{i}")
        if isinstance(meta.schema[f"v{i}"].dataType, (T.FloatType, T.DoubleType)):
            v = F.when(~F.isnan(v), v)
        axis = ranked(meta.select(v.alias("v")).where("v IS NOT NULL"), f"kd-axis-{i}").withColumnRenamed("coord", f"c{i}")
        meta = meta.withColumn(f"v{i}", v).join(axis.withColumnRenamed("v", f"v{i}"), f"v{i}", "left").withColumn(
            f"c{i}", F.coalesce(f"c{i}", F.lit(0).cast("long"))).drop(f"v{i}")
    return meta


def _keys(meta: DataFrame, n_dims: int) -> DataFrame:
    tie = F.pmod(F.xxhash64("id", "row"), F.lit(1 << TIE_BITS))
    return meta.select("id", "row", "bytes", "crc", "weight", F.array(*[
        F.shiftleft(f"c{i}", TIE_BITS) + tie for i in range(n_dims)]).alias("keys"))


def _table(like: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    """A small local table of the nodes: at most as many rows as shards."""
    names = [c.split()[0] for c in schema.split(", ")]
    local = pa.Table.from_pylist([dict(zip(names, r)) for r in rows])
    kinds = {c.split()[0]: c.split()[1] for c in schema.split(", ")}
    return like.sparkSession.createDataFrame(local).select(*[F.col(c).cast(k) for c, k in kinds.items()])


def _descend(rows: DataFrame, splits: list[tuple]) -> DataFrame:
    """Send the rows of split nodes to the left or right child. splits: (lo, axis, key, right lo)."""
    table = _table(rows, splits, "lo int, axis int, at bigint, right int")
    down = rows.join(F.broadcast(table), "lo", "left")
    return down.withColumn("lo", F.when(F.get("keys", F.col("axis")) >= F.col("at"), F.col("right"))
                           .otherwise(F.col("lo"))).drop("axis", "at", "right")


def _quantile_keys(rows: DataFrame, want: dict[int, tuple[int, float]]) -> dict[int, int]:
    """For each node lo -> (axis, weight wanted on the left): the key that parts it."""
    state = {lo: (axis, target, 0, 0.0) for lo, (axis, target) in want.items()}  # prefix, weight before it
    at: dict[int, int] = {}
    for r in range(ROUNDS):
        shift = DIGIT_BITS * (ROUNDS - 1 - r)
        table = _table(rows, [(lo, a, t, p, w) for lo, (a, t, p, w) in state.items()],
                       "lo int, axis int, target double, prefix bigint, before double")
        k = F.get("keys", F.col("axis"))
        digits = (rows.join(F.broadcast(table), "lo")
                  .where(F.shiftright(k, shift + DIGIT_BITS) == F.col("prefix"))
                  .groupBy("lo", "target", "before", F.shiftright(k, shift).alias("digit"))
                  .agg(F.sum("weight").alias("w")))
        run = Window.partitionBy("lo").orderBy("digit")
        upto = F.col("before") + F.sum("w").over(run.rowsBetween(Window.unboundedPreceding, 0))
        crossing = (digits.withColumn("upto", upto).where(F.col("upto") >= F.col("target"))
                    .groupBy("lo").agg(F.min(F.struct("digit", "upto", "w")).alias("m")).select("lo", "m.*").collect())
        for x in crossing:  # one row per node
            axis, target, _, _ = state[x.lo]
            state[x.lo] = (axis, target, x.digit, x.upto - x.w)
            if r == ROUNDS - 1:  # the crossing key goes to the nearer side
                at[x.lo] = x.digit + 1 if x.upto - target <= target - (x.upto - x.w) else x.digit
    return at


def split(rows: DataFrame, n_dims: int, n: int) -> DataFrame:
    """`rows` (weight, keys) with `lo`, the number of the shard among `n`."""
    rows, nodes = rows.withColumn("lo", F.lit(0)), {0: n}
    while any(m > 1 for m in nodes.values()):
        k = [F.shiftright(F.get("keys", F.lit(i)), TIE_BITS) for i in range(n_dims)]
        widths = (rows.groupBy("lo").agg(F.sum("weight").alias("w"),
                                         *[(F.max(x) - F.min(x)).alias(f"s{i}") for i, x in enumerate(k)]).collect())
        want = {}
        for x in widths:  # one row per node
            if (m := nodes[x.lo]) > 1:
                axis = max(range(n_dims), key=lambda i: (x[f"s{i}"], -i))
                want[x.lo] = (axis, x.w * (m // 2) / m)
        at = _quantile_keys(rows, want)
        rows = _descend(rows, [(lo, want[lo][0], key, lo + nodes[lo] // 2) for lo, key in at.items()])
        nodes = {c: s for lo, m in nodes.items()
                 for c, s in ((((lo, m // 2), (lo + m // 2, m - m // 2))) if m > 1 else ((lo, m),))}
    return rows


def kd_shards(docs: DataFrame, dims: list[str], n_shards: int | None = None, target_bytes: int | None = None,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, size (UTF-8 bytes + 1), text_crc32, shard, slot."""
    meta = materialise(_metadata(docs, id_col, text_col, dims), "kd-metadata").withColumn("weight", F.col("bytes") + 1)
    tot = meta.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("weight"), F.lit(0)).alias("w")).first()
    n = n_shards or max(1, math.ceil(tot.w / target_bytes))
    rows = split(_keys(meta, len(dims)), len(dims), n if tot.n else 1)
    slices = max(1, math.ceil(tot.n / SLICE_ROWS))
    placed = rows.select("id", "row", "crc", "weight", F.col("lo").alias("shard"),
                         F.pmod(F.xxhash64("row", "id"), F.lit(slices)).alias("slice"))
    counts = placed.groupBy("shard", "slice").agg(F.count(F.lit(1)).alias("c"))
    before = Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "slice", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("shard", "slice").orderBy("id", "row")) - 1
    return placed.withColumn("_i", inside).join(offsets, ["shard", "slice"]).select(
        F.col("id").alias(id_col), F.col("weight").alias("size"), F.col("crc").alias("text_crc32"), "shard",
        (F.col("offset") + F.col("_i")).cast("long").alias("slot"))
