"""Benchmark decontamination by size-partitioned MinHash containment search (DataFrame functions only).

A text's set is its distinct shingles of `k` words (A-Z lower-cased; with fewer words the whole
sequence is its one shingle). Document D holds test item Q when |S(D) & S(Q)| >= threshold * |S(Q)|.

1. Items are partitioned by set size (powers of two). A size class has its own MinHash sketch: the
   K shingles of smallest hash, K = most shingles of that class that may be missing + 1 + `spare`.
2. Every shingle of every document looks its hash up in the sketches. If at most m of an item's
   shingles are missing from a document, at least K - m of its sketch are there, so a pair with
   fewer sketch hits cannot reach the threshold and none that can is lost, however long the
   document is: the sketch is the short side's, the long side is never sampled.
3. Candidate pairs are verified on the shingles themselves (strings, not hashes), exactly.

The sketches are broadcast only while they have at most `broadcast_rows` rows (counted first);
beyond that both sides are shuffled by hash, and hot shingles are split by adaptive skew joins.

Defined cases: NULL and blank texts have an empty set and match nothing; rows that share an id
(NULL included) are one document, whose set is the union; repeated items of one id likewise; empty
tables give an empty result (or leave all documents in); columns other than id and text may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cumulo.llm.common import ascii_lower, words

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20


def _at(i: Column, k: int) -> list[Column]:
    return [F.get("_w", i + j) for j in range(k)]


def shingle_positions(df: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """(_id, _w, _i): the words and one row for each shingle's first word."""
    w = df.select(F.col(f"`{id_col}`").alias("_id"), words(ascii_lower(F.col(f"`{text_col}`"))).alias("_w"))
    n = F.size("_w")
    return w.select("_id", "_w", F.explode(F.when(n > 0, F.sequence(F.lit(0), F.greatest(n - k, F.lit(0))))).alias("_i"))


def _needed(n: Column, threshold: float) -> Column:
    """Shingles that must be shared: the least integer >= threshold * n, in exact hundredths."""
    pct = round(threshold * 100)
    return F.floor((n * pct + 99) / 100).cast("long")


def item_shingles(items: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """Distinct shingles of the items: item, shingle (text), h (hash of its words), n (the item's set size)."""
    pos = shingle_positions(items, id_col, text_col, k)
    own = pos.select(F.col("_id").alias("item"), F.concat_ws(" ", *_at(F.col("_i"), k)).alias("shingle"),
                     F.xxhash64(*_at(F.col("_i"), k)).alias("h")).distinct()
    size = own.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    return own.join(size.withColumnRenamed("item", "_item"), F.col("item").eqNullSafe(F.col("_item"))).drop("_item")


def sketches(shingles: DataFrame, threshold: float, spare: int) -> DataFrame:
    """The K smallest hashes of each item: item, h, n, sketch (K), may_miss."""
    upper = F.pow(F.lit(2), F.floor(F.log2("n")) + 1).cast("long") - 1  # largest size of the class
    s = shingles.withColumn("may_miss", F.col("n") - _needed(F.col("n"), threshold)) \
                .withColumn("sketch", F.least("n", upper - _needed(upper, threshold) + 1 + spare))
    kept = s.groupBy("item", "n", "may_miss", "sketch").agg(F.sort_array(F.collect_set("h")).alias("hs"))
    # an item is short: its hashes are one small array
    return kept.select("item", "n", "may_miss", F.least(F.size("hs"), "sketch").alias("sketch"),
                       F.explode(F.slice("hs", F.lit(1), F.col("sketch").cast("int"))).alias("h"))


def _bounded(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


def contaminated_pairs(docs: DataFrame, items: DataFrame, k: int = 5, threshold: float = 0.8, spare: int = 3,
                       doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id",
                       item_text: str = "text", broadcast_rows: int = BROADCAST_ROWS, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per (document, item) that it holds: ids, n_item, n_shared, containment."""
    shingles = item_shingles(items, item_id, item_text, k)
    rows, size = shingles.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("shingle")), F.lit(0))).first()
    small = rows <= broadcast_rows and size <= broadcast_bytes
    sk = _bounded(sketches(shingles, threshold, spare), small)
    hashed = shingle_positions(docs, doc_id, doc_text, k).select("_id", F.xxhash64(*_at(F.col("_i"), k)).alias("h"))
    hits = (hashed.join(sk, "h").groupBy("_id", "item", "sketch", "may_miss")
            .agg(F.count_distinct("h").alias("hits")))
    cand = hits.where(F.col("hits") >= F.col("sketch") - F.col("may_miss")).select(
        F.col("_id").alias("_c"), F.col("item").alias("_q"))
    held = docs.select(F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{doc_text}`").alias("_t")).join(
        cand.select("_c").distinct(), F.col("_id").eqNullSafe(F.col("_c")), "left_semi")
    exact = shingle_positions(held, "_id", "_t", k).select(
        "_id", F.concat_ws(" ", *_at(F.col("_i"), k)).alias("shingle"))
    own = _bounded(shingles.select("item", "shingle", "n"), small)
    shared = exact.join(own, "shingle").groupBy("_id", "item", "n").agg(F.count_distinct("shingle").alias("shared"))
    found = shared.join(cand, F.col("_id").eqNullSafe(F.col("_c")) & F.col("item").eqNullSafe(F.col("_q")), "left_semi")
    return found.where(F.col("shared") >= _needed(F.col("n"), threshold)).select(
        F.col("_id").alias(doc_id), F.col("item").alias(item_id), F.col("n").alias("n_item"),
        F.col("shared").alias("n_shared"), (F.col("shared") / F.col("n")).alias("containment"))


def drop_contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", doc_text: str = "text",
                      **options) -> DataFrame:
    """`docs` without the documents that hold a test item."""
    bad = contaminated_pairs(docs, items, doc_id=doc_id, doc_text=doc_text, **options).select(
        F.col(f"`{doc_id}`").alias("_bad")).distinct()
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))  # column names cannot clash
    return whole.join(bad, F.col(f"_row.`{doc_id}`").eqNullSafe(F.col("_bad")), "left_anti").select("_row.*")
