"""MinHash near-dedup with sequential Bayesian verification.

A document's set is its distinct shingles of `k` words (A-Z lower-cased). Documents are linked when
the Jaccard similarity of their sets reaches `percent` / 100; components are what links connect.

1. Documents with equal sets are one class (number: 64 bits of the set's digest; n classes share a
   number by chance with probability below n * n / 2**65). One pass writes class and band keys.
2. Banding: classes that share a band key are candidates. Bands with the same members count once.
3. Pivots instead of pairs: in each band every member is paired with the pivot, the most central member
   (the one whose bands hold most members). The best match of each member is verified, and components
   are formed. Every other pair of a band is compared only if its sides are still in different
   components: bands of at most `SMALL` members give their pairs, larger ones are laid out in blocks of
   about `BLOCK` members by band and component, and pairs of blocks that share a band and do not lie in
   one component are compared as matrices. No pair of a large band becomes a row unless it is a link.
4. Sequential Bayesian verification: signatures are compared in batches of `BATCH` hashes; with m of
   n equal, the posterior of the similarity s under a uniform prior is Beta(m + 1, n - m + 1), and
   a pair is pruned once P(s >= threshold) falls below `miss`. Survivors are verified on the full
   shingle sets of the two texts.

A large band whose members resemble one another just below the threshold costs a number of block pairs
that grows with the square of its members over `BLOCK`: similarity just below the threshold can only be
told by comparing.

Misses: a pair at exactly 0.8 shares no band with probability (1 - 0.8**4)**25 = 2e-6, and pruning adds
at most `miss` for each batch; both matter only where no other chain of links connects the two.

Defined cases: a text with fewer than k words has its whole sequence as one shingle; NULL and blank
texts have an empty set, are linked with nothing and kept; rows with a NULL id are linked with
nothing and kept; rows that repeat an id are one document if their texts have one set (the report
has a row for each, `drop_near_copies` keeps one); the smallest id of a component stays; an empty
table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from cumulo.llm.common import materialise, tidy
from cumulo.llm.components import components
from cumulo.llm.word_arrays import shingle_set

ROWS, BANDS, HASHES, BATCH = 4, 25, 256, 32
SMALL, BLOCK, BLOCK_BYTES = 24, 512, 8 << 20
MISS = 1e-7
_FACTORS = np.random.default_rng(77).integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signature(shingles: np.ndarray, n: int = HASHES) -> np.ndarray:
    """n MinHash values (32 bits) of a non-empty set of 64-bit hashes."""
    low = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(shingles), 512):
        np.minimum(low, (shingles[a:a + 512, None] * _FACTORS[None, :n]).min(axis=0), out=low)
    return (low >> np.uint64(32)).astype(np.uint32)


def band_keys(sig: np.ndarray) -> np.ndarray:
    out = np.arange(1, BANDS + 1, dtype=np.uint64)
    for j in range(ROWS):
        out = (out + sig[j:ROWS * BANDS:ROWS]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out.view(np.int64)


def class_number(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def least_matches(threshold: float, miss: float) -> list[tuple[int, int]]:
    """(hashes compared, least equal ones to go on): P(s >= t | m of n) = P(Binomial(n + 1, t) <= m)."""
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        below, m = 0.0, 0
        while True:
            below += comb(n + 1, m) * threshold**m * (1 - threshold)**(n + 1 - m)
            if below >= miss:
                break
            m += 1
        out.append((n, m))
    return out


def _normal(text: str) -> bytes:
    return text.encode("utf-8").lower()  # bytes: A-Z only


def fingerprint(docs: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """One row per document: id, n_shingles, node (class number) and bands; empty sets have neither."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size, node, bands = [], [], []
            for text in b.column("t").to_pylist():
                s = shingle_set(_normal(text or ""), k)
                size.append(len(s))
                node.append(class_number(s) if len(s) else None)
                bands.append(band_keys(signature(s, ROWS * BANDS)) if len(s) else None)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(size, pa.int64()), pa.array(node, pa.int64()),
                                              pa.array(bands, pa.list_(pa.int64()))], ["id", "n_shingles", "node", "bands"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("t"))
    return rows.mapInArrow(tidy(run), "id long, n_shingles long, node long, bands array<long>")


def shared_bands(prints: DataFrame) -> DataFrame:
    """(band, node) of bands with several classes; of bands with the same members one is left."""
    members = prints.where("id IS NOT NULL AND node IS NOT NULL").select("node", F.explode("bands").alias("band")) \
        .groupBy("band", "node").agg(F.count(F.lit(1)).alias("_n")).select("band", "node")
    sizes = members.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("node")).alias("x"),
                                        F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y")).where("n > 1")
    kept = sizes.groupBy("n", "x", "y").agg(F.min("band").alias("band")).select("band", "n")
    return members.join(kept, "band").select("band", "node", "n")


def candidate_texts(docs: DataFrame, prints: DataFrame, nodes: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """Text and full signature of one document of each candidate class: node, text, sig."""
    one = prints.where("id IS NOT NULL").join(nodes, "node").groupBy("node").agg(F.min("id").alias("id"))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("t")).join(one, "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            node, text, sig = [], [], []
            for want, t in zip(b.column("node").to_pylist(), b.column("t").to_pylist()):
                s = shingle_set(_normal(t or ""), k)
                if len(s) and class_number(s) == want:  # an id may have come with other texts as well
                    node.append(want)
                    text.append(t)
                    sig.append(signature(s).astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(text, pa.string()),
                                              pa.array(sig, pa.binary())], ["node", "text", "sig"])

    return rows.select("node", "t").mapInArrow(tidy(run), "node long, text string, sig binary").dropDuplicates(["node"])


def posterior_survivors(pairs: DataFrame, sigs: DataFrame, threshold: float, miss: float) -> DataFrame:
    """Pairs that no batch prunes, with the number of equal hashes: a, b, equal."""
    steps = least_matches(threshold, miss)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), "<u4").reshape(n, HASHES) for c in ("sa", "sb"))
            alive, equal = np.arange(n), np.zeros(n, np.int64)
            for upto, least in steps:
                equal[alive] += (x[alive, upto - BATCH:upto] == y[alive, upto - BATCH:upto]).sum(axis=1)
                alive = alive[equal[alive] >= least]
            yield pa.RecordBatch.from_arrays([b.column("a").take(pa.array(alive)), b.column("b").take(pa.array(alive)),
                                              pa.array(equal[alive])], ["a", "b", "equal"])

    wide = pairs.join(sigs.select(F.col("node").alias("a"), F.col("sig").alias("sa")), "a") \
        .join(sigs.select(F.col("node").alias("b"), F.col("sig").alias("sb")), "b")
    return wide.select("a", "b", "sa", "sb").mapInArrow(tidy(run), "a long, b long, equal long")


def verified_links(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs whose full shingle sets reach the similarity: a, b."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last, s, ok = None, None, []
            for x, y in zip(batch.column("ta").to_pylist(), batch.column("tb").to_pylist()):
                if last != y:  # rows of one pivot follow one another
                    last, s = y, shingle_set(_normal(y), k)
                own = shingle_set(_normal(x), k)
                both = len(np.intersect1d(own, s, assume_unique=True))
                ok.append(100 * both >= percent * (len(own) + len(s) - both))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    wide = pairs.select("a", "b").join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a") \
        .join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b")
    return wide.select("a", "b", "ta", "tb").mapInArrow(tidy(run), "a long, b long")


def open_members(bands: DataFrame, comp: DataFrame) -> DataFrame:
    """band, node, comp, m of bands whose members lie in several components; m: members of the band."""
    here = bands.select("band", "node").join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    split = here.groupBy("band").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("m")) \
        .where("lo < hi").select("band", "m")
    return here.join(split, "band")


def small_band_pairs(members: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) of different components from bands of at most SMALL members."""
    few = members.where(F.col("m") <= SMALL)
    pairs = few.select("band", F.col("node").alias("a"), F.col("comp").alias("ca")).join(
        few.select("band", F.col("node").alias("b"), F.col("comp").alias("cb")), "band").where("a < b AND ca <> cb")
    return pairs.select("a", "b").distinct()


def blocks_of_large_bands(members: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(blocks: block, lo, hi, nodes, comps, sigs, texts; members: block, band) of the bands of more than SMALL members.

    A member is in one block, that of its largest band: a component with many members there has blocks of its own,
    the others share some; counts and bytes fix the number of blocks, a hash of node or component deals them out."""
    many = materialise(members.where(F.col("m") > SMALL), "large-bands")
    home = many.groupBy("node").agg(F.max(F.struct("m", "band")).alias("h"), F.min("comp").alias("comp")).select(
        "node", "comp", F.col("h.band").alias("home"))
    rows = materialise(home.join(texts, "node"), "large-band-texts")
    per = rows.groupBy("home", "comp").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text") + 4 * HASHES).alias("size"))
    slots = lambda n, size: F.greatest(F.ceil(n / BLOCK), F.ceil(size / BLOCK_BYTES))
    wide = (F.col("n") >= BLOCK // 2) | (F.col("size") >= BLOCK_BYTES // 2)
    rest = per.where(~wide).groupBy("home").agg(F.sum("n").alias("n"), F.sum("size").alias("size")).select(
        "home", slots(F.col("n"), F.col("size")).alias("shared"))
    plan = per.join(rest, "home", "left").select(
        "home", "comp", F.when(wide, F.col("comp")).alias("own"),
        F.when(wide, slots(F.col("n"), F.col("size"))).otherwise(F.col("shared")).alias("slots"))
    dealt = rows.join(plan, ["home", "comp"]).withColumn(
        "slot", F.pmod(F.when(F.col("own").isNull(), F.xxhash64("comp")).otherwise(F.xxhash64("node")), F.col("slots")))
    blocks = materialise(dealt.groupBy("home", "own", "slot").agg(
        F.min("node").alias("block"), F.min("comp").alias("lo"), F.max("comp").alias("hi"),
        F.collect_list(F.struct("node", "comp", "sig", "text")).alias("r")).select(
        "block", "lo", "hi", F.col("r.node").alias("nodes"), F.col("r.comp").alias("comps"), F.col("r.sig").alias("sigs"),
        F.col("r.text").alias("texts")), "blocks")
    of = blocks.select("block", F.explode("nodes").alias("node"))
    return blocks, many.select("band", "node").join(of, "node").select("band", "block").distinct()


def _equal_shingles(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Number of common elements of each set of x with each of y, as a product of two 0/1 matrices, columns at a time."""
    flat = np.concatenate([np.unique(np.concatenate(x)), np.unique(np.concatenate(y))])
    value, times = np.unique(flat, return_counts=True)
    value = value[times == 2]  # only what both sides have
    out = np.zeros((len(x), len(y)), np.float32)
    for a in range(0, len(value), 8192):
        some = value[a:a + 8192]
        sides = []
        for sets in (x, y):
            m = np.zeros((len(sets), len(some)), np.float32)
            for i, s in enumerate(sets):
                at = np.searchsorted(some, s)
                at[at == len(some)] = 0
                m[i, at[some[at] == s]] = 1
            sides.append(m)
        out += sides[0] @ sides[1].T
    return out.astype(np.int64)


def links_of_blocks(pairs: DataFrame, blocks: DataFrame, k: int, percent: int, miss: float) -> DataFrame:
    """Links (a, b) between components inside pairs of blocks, one for each two components of a block pair.

    Signatures are compared batch by batch for all pairs of the two blocks at once; rows and columns that
    are left are verified on their full sets."""
    steps = least_matches(percent / 100, miss)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                row = {c: batch.column(c)[r].as_py() for c in batch.schema.names}
                comp = [np.array(row[f"c{s}"]) for s in "ab"]
                sig = [np.frombuffer(b"".join(row[f"s{s}"]), "<u4").reshape(-1, HASHES) for s in "ab"]
                i, j = np.nonzero(comp[0][:, None] != comp[1][None, :])
                if row["a"] == row["b"]:
                    i, j = i[i < j], j[i < j]
                found = np.zeros((0, 2), np.int64)
                for part in range(0, len(i), 1 << 16):
                    x, y = i[part:part + (1 << 16)], j[part:part + (1 << 16)]
                    equal = np.zeros(len(x), np.int64)
                    for upto, least in steps:
                        equal = equal + (sig[0][x, upto - BATCH:upto] == sig[1][y, upto - BATCH:upto]).sum(axis=1)
                        keep = equal >= least
                        x, y, equal = x[keep], y[keep], equal[keep]
                    found = np.concatenate((found, np.stack((x, y), axis=1)))
                if not len(found):
                    continue
                left, right = np.unique(found[:, 0]), np.unique(found[:, 1])
                sets = [[shingle_set(_normal(row[f"t{s}"][p]), k) for p in at] for s, at in (("a", left), ("b", right))]
                both = _equal_shingles(*sets)[np.searchsorted(left, found[:, 0]), np.searchsorted(right, found[:, 1])]
                n = [np.array([len(x) for x in part]) for part in sets]
                union = n[0][np.searchsorted(left, found[:, 0])] + n[1][np.searchsorted(right, found[:, 1])] - both
                linked = found[100 * both >= percent * union]
                _, one = np.unique(np.stack((comp[0][linked[:, 0]], comp[1][linked[:, 1]]), axis=1), axis=0, return_index=True)
                linked = linked[one]
                if len(linked):
                    yield pa.RecordBatch.from_arrays([pa.array(np.array(row["na"])[linked[:, 0]]),
                                                      pa.array(np.array(row["nb"])[linked[:, 1]])], ["a", "b"])

    wide = pairs
    for s in "ab":
        wide = wide.join(blocks.select(F.col("block").alias(s), F.col("nodes").alias(f"n{s}"), F.col("comps").alias(f"c{s}"),
                                       F.col("sigs").alias(f"s{s}"), F.col("texts").alias(f"t{s}")), s)
    return wide.repartition("a", "b").mapInArrow(tidy(run), "a long, b long")


def link_classes(docs: DataFrame, prints: DataFrame, k: int, percent: int, miss: float, id_col: str,
                 text_col: str) -> DataFrame:
    """(node, comp) of the classes linked with another class; comp is the smallest node of the component."""
    bands = materialise(shared_bands(prints), "bands")
    central = bands.groupBy("node").agg(F.sum("n").alias("weight"))
    texts = materialise(candidate_texts(docs, prints, central.select("node"), k, id_col, text_col), "candidate-texts")
    # every member against the most central member of its bands
    weighed = bands.select("band", "node").join(central, "node")
    pivots = weighed.groupBy("band").agg(F.max(F.struct("weight", "node")).alias("p")).select("band", F.col("p.node").alias("b"))
    pairs = bands.select("band", F.col("node").alias("a")).join(pivots, "band").where("a <> b").select("a", "b") \
        .withColumn("lo", F.least("a", "b")).withColumn("hi", F.greatest("a", "b")) \
        .groupBy("lo", "hi").agg(F.max_by("a", F.col("b")).alias("a"), F.max("b").alias("b")).select("a", "b")
    found = posterior_survivors(pairs, texts.select("node", "sig"), percent / 100, miss)
    best = found.groupBy("a").agg(F.max(F.struct("equal", "b")).alias("m")).select("a", F.col("m.b").alias("b"))
    links = materialise(verified_links(best, texts, k, percent), "links")
    comp = components(links)
    # what is left in bands whose members are not all connected: pairs of small bands, blocks of large ones
    members = materialise(open_members(bands, comp), "open-bands")
    few = posterior_survivors(small_band_pairs(members), texts.select("node", "sig"), percent / 100, miss)
    more = materialise(verified_links(few.select("a", "b"), texts, k, percent), "links")
    if members.where(F.col("m") > SMALL).head(1):
        blocks, of = blocks_of_large_bands(members, texts)
        two = of.select("band", F.col("block").alias("a")).join(of.select("band", F.col("block").alias("b")), "band").where(
            "a <= b").select("a", "b").distinct()
        span = blocks.select("block", "lo", "hi")
        two = two.join(span.withColumnsRenamed({"block": "a", "lo": "la", "hi": "ha"}), "a").join(
            span.withColumnsRenamed({"block": "b", "lo": "lb", "hi": "hb"}), "b")
        # blocks that lie in one and the same component have nothing to connect
        two = two.where("NOT (la = ha AND lb = hb AND la = lb)").select("a", "b")
        more = more.union(materialise(links_of_blocks(two, blocks, k, percent, miss), "links"))
    return components(links.union(more))


def near_copies(docs: DataFrame, k: int = 5, percent: int = 80, miss: float = MISS, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept."""
    prints = materialise(fingerprint(docs, k, id_col, text_col), "fingerprints")
    return _labelled(docs, prints, k, percent, miss, id_col, text_col).select(
        F.col("id").alias(id_col), "n_shingles", F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"))


def _labelled(docs, prints, k, percent, miss, id_col, text_col) -> DataFrame:
    """id, n_shingles, component (smallest id; NULL for a NULL id)."""
    comp = link_classes(docs, prints, k, percent, miss, id_col, text_col)
    classes = prints.where("id IS NOT NULL AND node IS NOT NULL").groupBy("node").agg(F.min("id").alias("least"))
    of = classes.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    label = of.join(of.groupBy("comp").agg(F.min("least").alias("component")), "comp").select("node", "component")
    return prints.drop("bands").join(label, "node", "left").withColumn(
        "component", F.when(F.col("id").isNotNull(), F.coalesce("component", "id")))


def drop_near_copies(docs: DataFrame, k: int = 5, percent: int = 80, miss: float = MISS, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """`docs` with one document of each component, the one with the smallest id."""
    prints = materialise(fingerprint(docs, k, id_col, text_col), "fingerprints")
    order = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(-2**63))
    kept = _labelled(docs, prints, k, percent, miss, id_col, text_col).where("id <=> component").select(
        order("id").alias("_o")).distinct()
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), order(f"`{id_col}`").alias("_o"))
    stays = whole.join(kept, "_o", "left_semi")
    repeated = prints.where("id IS NOT NULL").groupBy("id", "node").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if repeated.head(1):  # else no row can repeat id and text
        same = Window.partitionBy("_o", F.xxhash64(F.col(f"_row.`{text_col}`"))).orderBy(F.xxhash64("_row"))
        stays = stays.withColumn("_rn", F.row_number().over(same)).where(F.col("_rn").eqNullSafe(1)
                                                                         | F.col(f"_row.`{id_col}`").isNull())
    return stays.select("_row.*")
