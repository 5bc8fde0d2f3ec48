"""Exact dedup by skew-safe combining (DataFrame functions only).

Texts are equal when identical after lower-casing A-Z. The work is done in three combining
steps, each grouping by digest *and* full content:

1. local: Spark's partial aggregate merges equal texts inside each input task;
2. salted: the task results of a text meet in one of `salts` groups (salt = input partition
   modulo `salts`), so a text that fills a third of the table arrives at many tasks, one row
   from each input task;
3. global: at most `salts` winners of a text are merged by digest, then content.

Group rows carry only (digest, row that stays, size); they are written once and every document joins
them by digest.
Two different contents under one digest (impossible in practice with SHA-256, easy with the weak
digests of the tests) are told apart by joining on the content too.

Defined cases: NULL text counts as empty; empty texts are equal to one another; NULL ids never
win against a number and rows of a group with only NULL ids are all reported as kept; rows that
repeat an id with the same text are the same document: the report marks each of them kept, the
filter `drop_copies` keeps one row; an empty table gives an empty result; other columns are not
looked at and may have any name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from cumulo.llm.common import ascii_lower, materialise


def sha256_hex(norm: Column) -> Column:
    return F.sha2(norm, 256)


def normalised(text: Column) -> Column:
    return ascii_lower(F.coalesce(text, F.lit("")))


def content_groups(rows: DataFrame, salts: int) -> DataFrame:
    """(digest, norm) groups with the largest id and the number of rows. `rows`: _id, _norm, _digest."""
    salted = (rows.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
              .groupBy("_salt", "_digest", "_norm")
              .agg(F.max("_id").alias("_keep"), F.count(F.lit(1)).alias("_n")))
    return (salted.drop("_salt").repartition("_digest")
            .groupBy("_digest", "_norm")
            .agg(F.max("_keep").alias("_keep"), F.sum("_n").alias("_n")))


def _winners(docs: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column], salts: int):
    """rows (_id, _digest, _norm), the winners by digest (a written table: digest, number of different
    contents, id, size), and the content groups behind them where a digest has several contents, else None."""
    norm = normalised(F.col(f"`{text_col}`"))
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), norm.alias("_norm")).withColumn("_digest", digest(F.col("_norm")))
    groups = content_groups(rows, salts)
    by_digest = materialise(groups.groupBy("_digest").agg(
        F.count(F.lit(1)).alias("_variants"), F.max("_keep").alias("_keep"), F.max("_n").alias("_n")), "copy-groups")
    clash = by_digest.where("_variants > 1").select("_digest")
    return rows, by_digest, groups.join(clash, "_digest") if clash.head(1) else None


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 digest: Callable[[Column], Column] = sha256_hex, salts: int = 64) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256."""
    rows, by_digest, several = _winners(docs, id_col, text_col, digest, salts)
    single = by_digest.where("_variants = 1").drop("_variants")
    sha = F.col("_digest") if digest is sha256_hex else F.sha2("_norm", 256)
    found = rows.select("_id", "_digest", sha.alias("_sha")).join(single, "_digest")
    if several is not None:
        found = found.unionByName(rows.join(several, ["_digest", "_norm"]).select(
            "_digest", "_id", sha.alias("_sha"), "_keep", "_n"))
    return found.select(
        F.col("_id").alias(id_col), F.col("_keep").alias("keep_id"), F.col("_n").alias("group_size"),
        F.col("_id").eqNullSafe(F.col("_keep")).alias("kept"), F.col("_sha").alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                digest: Callable[[Column], Column] = sha256_hex, salts: int = 64) -> DataFrame:
    """`docs` with one row of every group of equal texts: the one with the largest id.

    Joined on (digest, id), so the rows of a hot text spread over all tasks."""
    _, by_digest, several = _winners(docs, id_col, text_col, digest, salts)
    # _o stands for the id in joins: NULL is a value of its own there
    order = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(-2**63))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), order(f"`{id_col}`").alias("_o"),
                        normalised(F.col(f"`{text_col}`")).alias("_norm")).withColumn("_digest", digest(F.col("_norm")))
    single = by_digest.where("_variants = 1").select("_digest", order("_keep").alias("_o"))
    stays = whole.withColumn("_norm", F.lit(None).cast("string")).join(single, ["_digest", "_o"])
    if several is not None:
        stays = stays.unionByName(whole.join(several.select("_digest", "_norm", order("_keep").alias("_o")),
                                             ["_digest", "_norm", "_o"]))
    once = Window.partitionBy("_digest", "_o", "_norm").orderBy(F.xxhash64("_row"))
    return stays.withColumn("_rn", F.row_number().over(once)).where("_rn = 1").select("_row.*")
