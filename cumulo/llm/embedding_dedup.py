"""Embedding near-dedup by NN-descent.

Vectors are compared only where labels are equal; two are linked when their cosine, in double
precision, reaches `threshold`. Components are what links connect.

1. Equal vectors of one label are one class with a multiplicity; classes are the nodes.
2. First neighbours: in each of `trees` random orders (nodes sorted by the signs of random projections, so
   that close vectors tend to share a long prefix) nodes are compared within overlapping windows.
3. NN-descent: a node's list holds its nearest nodes found so far, at most `k`. In each round the nodes
   of a list, and those whose lists hold the list's owner, are brought together and compared with one
   another (neighbours of neighbours), where at least one of the two entered its list in the last round.
   Entries below cos(2 * angle of the threshold) cannot lie between two linked nodes and are left out.
4. A list that is full of links is saturated: there may be more. Saturated lists are enlarged without
   writing pairs: the saturated nodes of a component are sorted into blocks of at most `BLOCK`, blocks
   are compared as matrices if a list links them, then if the blocks that they are linked with are, and
   so on; a comparison returns the number of links of each node.
5. Audit: for a sample of `audit` nodes the links are counted against all nodes, in blocks. If the lists have
   fewer than `target` of them, more trees are grown and steps 2 to 4 repeated, at most `passes` times;
   the result has the recall of the last audit.

A link of a node whose list is not saturated is in that list; links between two saturated nodes are
counted in the blocks. Every link that is reported has been computed in double precision.

Defined cases: vectors that are NULL, empty, zero or hold NULL or non-finite components, and those with a
NULL label or a NULL id, link with nothing and stand alone; vectors of different length do not link; rows that repeat an id
are vectors of their own; the smallest id of a component stays; an empty table gives an empty result;
other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from cumulo.llm.common import materialise
from cumulo.llm.components import components

K, TREES, WINDOW, BLOCK = 16, 8, 128, 128
AUDIT, TARGET, PASSES, ROUNDS = 1024, 0.999, 4, 8
_BITS = 62


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 in double precision (scaled by the largest component first: no overflow)."""
    x = x.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column whose lists are equally long."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def classes(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> tuple[DataFrame, DataFrame]:
    """(all rows: id, grp, x; classes: node, grp, x, m, least). grp is NULL where a row links with nothing."""
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("string").alias("lab"),
                          F.col(f"`{vec_col}`").alias("x"))
    sound = F.col("x").isNotNull() & ~F.coalesce(F.exists(
        "x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))), F.lit(False)) & F.exists("x", lambda v: v != 0)
    ok = F.col("id").isNotNull() & F.col("lab").isNotNull() & F.coalesce(sound, F.lit(False))
    rows = rows.select("id", F.when(ok, F.concat(F.size("x").cast("string"), F.lit(":"), "lab")).alias("grp"), "x")
    nodes = rows.where("grp IS NOT NULL").groupBy("grp", "x").agg(F.count(F.lit(1)).alias("m"), F.min("id").alias("least"))
    return rows, materialise(nodes.withColumn("node", F.monotonically_increasing_id()), "vector-classes")


# -- first neighbours -------------------------------------------------------------------------------

def _codes(x: np.ndarray, tree: int) -> np.ndarray:
    planes = np.random.default_rng(1000 + tree).standard_normal((x.shape[1], _BITS))
    bits = (x @ planes > 0).astype(np.int64)
    return bits @ (np.int64(1) << np.arange(_BITS - 1, -1, -1, dtype=np.int64))


def _by_length(column: pa.Array):
    """(positions, matrix) of the rows of each vector length."""
    n = np.asarray(column.value_lengths())
    for size in np.unique(n):
        at = np.flatnonzero(n == size)
        yield at, _matrix(column.take(pa.array(at)))


def sign_codes(nodes: DataFrame, trees: range) -> DataFrame:
    """tree, code, node, grp, x for each tree; the code's leading bits are the signs of the first projections."""
    kind = nodes.schema["x"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, x in _by_length(b.column("x")):
                part, x = b.take(pa.array(at)), unit(x)
                for t in trees:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), t, np.int32)), pa.array(_codes(x, t)), *part.columns],
                        ["tree", "code", "node", "grp", "x"])

    return nodes.select("node", "grp", "x").mapInArrow(run, f"tree int, code long, node long, grp string, x {kind}")


def _nearest(ids: np.ndarray, x: np.ndarray, floor: float, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sims = x @ x.T
    np.fill_diagonal(sims, -2)
    k = min(k, len(ids) - 1)
    best = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    s = np.take_along_axis(sims, best, axis=1)
    keep = s >= floor
    return np.repeat(ids, keep.sum(axis=1)), ids[best[keep]], s[keep]


def window_neighbours(nodes: DataFrame, trees: range, floor: float, k: int) -> DataFrame:
    """(v, u, sim): the nearest nodes of each node within the windows of each order."""
    def flush(rows: list, out: list) -> None:
        if len(rows) > 1:
            ids = np.array([r[0] for r in rows], np.int64)
            out.append(_nearest(ids, unit(np.stack([r[1] for r in rows])), floor, k))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, fresh = None, [], 0
        for b in batches:
            out: list = []
            vectors = [v.values.to_numpy(zero_copy_only=False) for v in b.column("x")]
            for t, g, node, x in zip(b.column("tree").to_pylist(), b.column("grp").to_pylist(), b.column("node").to_pylist(), vectors):
                if (t, g) != key:
                    if fresh:
                        flush(rows, out)
                    key, rows, fresh = (t, g), [], 0
                rows.append((node, x))
                fresh += 1
                if len(rows) == WINDOW:
                    flush(rows, out)
                    rows, fresh = rows[WINDOW // 2:], 0
            if out:
                yield _edges(out)
        if fresh:
            out = []
            flush(rows, out)
            if out:
                yield _edges(out)

    ordered = sign_codes(nodes, trees).repartitionByRange("tree", "grp", "code", "node").sortWithinPartitions("tree", "grp", "code", "node")
    return ordered.mapInArrow(run, "v long, u long, sim double")


def _edges(parts: list) -> pa.RecordBatch:
    v, u, s = (np.concatenate([p[i] for p in parts]) for i in range(3))
    return pa.RecordBatch.from_arrays([pa.array(v), pa.array(u), pa.array(s)], ["v", "u", "sim"])


# -- NN-descent -------------------------------------------------------------------------------------

def top_lists(edges: DataFrame, k: int) -> DataFrame:
    """The k nearest of each node: v, u, sim, new. Spark cuts the ranking to k rows a node before its shuffle."""
    once = edges.groupBy("v", "u").agg(F.max("sim").alias("sim"), F.bool_and("new").alias("new"))
    order = Window.partitionBy("v").orderBy(F.desc("sim"), "u")
    return once.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k).drop("_r")


def list_state(lists: DataFrame, threshold: float, k: int, floor: float) -> DataFrame:
    """v, saturated, worst (what a new entry has to exceed)."""
    s = lists.groupBy("v").agg(F.count(F.lit(1)).alias("n"), F.min("sim").alias("low"))
    full = F.col("n") >= k
    return s.select("v", (full & (F.col("low") >= threshold)).alias("saturated"),
                    F.when(full, F.col("low")).otherwise(F.lit(floor)).alias("worst"))


def neighbours_of_neighbours(lists: DataFrame, state: DataFrame, nodes: DataFrame, floor: float, k: int) -> DataFrame:
    """New (v, u, sim) for nodes whose lists are not saturated, from the nodes met in one list."""
    meet = lists.select(F.col("v").alias("w"), "u", "sim", "new").union(
        lists.select(F.col("u").alias("w"), F.col("v").alias("u"), "sim", "new"))
    met = top_lists(meet.withColumnsRenamed({"w": "v"}), k).withColumnRenamed("v", "w")
    told = met.join(state.select(F.col("v").alias("u"), "saturated", "worst"), "u", "left")
    useful = told.groupBy("w").agg(F.bool_or(~F.coalesce("saturated", F.lit(False))).alias("open"), F.bool_or("new").alias("any_new")) \
        .where("open AND any_new").select("w")
    with_vectors = told.join(useful, "w", "left_semi").join(
        nodes.select(F.col("node").alias("u"), "x"), "u")
    entry = F.struct("u", "new", F.coalesce("saturated", F.lit(False)).alias("full"),
                     F.coalesce("worst", F.lit(floor)).alias("worst"), "x")
    grouped = with_vectors.groupBy("w").agg(F.collect_list(entry).alias("e"))  # at most k entries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists_, out = b.column("e"), []
            flat = lists_.flatten()
            ids, new, full, worst = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("u", "new", "full", "worst"))
            vectors = flat.field("x")
            at = 0
            for n in lists_.value_lengths().to_pylist():
                here = slice(at, at + n)
                x = unit(_matrix(vectors.slice(at, n)))
                at += n
                if n < 2:
                    continue
                sims = x @ x.T
                fresh = new[here].astype(bool)
                want = (sims > worst[here][:, None]) & (sims >= floor) & (fresh[:, None] | fresh[None, :]) & ~full[here].astype(bool)[:, None]
                np.fill_diagonal(want, False)
                i, j = np.nonzero(want)
                out.append((ids[here][i], ids[here][j], sims[i, j]))
            if out:
                yield _edges(out)

    return grouped.select("e").mapInArrow(run, "v long, u long, sim double")


def refine(lists: DataFrame, nodes: DataFrame, threshold: float, k: int, floor: float) -> DataFrame:
    """Rounds of NN-descent until no list that is not saturated gains a link."""
    for _ in range(ROUNDS):
        state = list_state(lists, threshold, k, floor)
        found = neighbours_of_neighbours(lists, state, nodes, floor, k)
        lists = materialise(top_lists(lists.withColumn("new", F.lit(False)).union(
            found.withColumn("new", F.lit(True))), k), "neighbour-lists")
        if not lists.where((F.col("sim") >= threshold) & F.col("new")).head(1):
            break
    return lists


# -- saturated lists --------------------------------------------------------------------------------

def dense_blocks(dense: DataFrame) -> DataFrame:
    """block, ids, m, x (vectors one after the other) of sorted nodes of one component, at most BLOCK each.

    `dense`: comp, code, node, m, x."""
    kind = dense.schema["x"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []

        def block():
            return {"block": rows[0][0], "ids": [r[0] for r in rows], "m": [r[1] for r in rows], "x": np.concatenate([r[2] for r in rows])}

        schema = None
        for b in batches:
            schema = pa.schema([("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("m", pa.list_(pa.int64())),
                                ("x", b.column("x").type)])
            out = []
            vectors = [v.values.to_numpy(zero_copy_only=False) for v in b.column("x")]
            for comp, node, m, x in zip(b.column("comp").to_pylist(), b.column("node").to_pylist(), b.column("m").to_pylist(), vectors):
                if rows and (comp != key or len(rows) == BLOCK):
                    out.append(block())
                    rows = []
                key = comp
                rows.append((node, m, x))
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
        if rows:
            yield pa.RecordBatch.from_pylist([block()], schema)

    ordered = dense.repartitionByRange("comp", "code", "node").sortWithinPartitions("comp", "code", "node")
    return ordered.select("comp", "node", "m", "x").mapInArrow(run, f"block long, ids array<long>, m array<long>, x {kind}")


def compare_blocks(pairs: DataFrame, blocks: DataFrame, threshold: float) -> DataFrame:
    """(a, b, linked, ids, counts): per pair of blocks, how many vectors each node is linked with across it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in range(batch.num_rows):
                a, b = batch.column("a")[r].as_py(), batch.column("b")[r].as_py()
                side = {}
                for s in "ab":
                    ids = batch.column(f"i{s}")[r].values.to_numpy()
                    side[s] = (ids, batch.column(f"m{s}")[r].values.to_numpy(),
                               unit(batch.column(f"x{s}")[r].values.to_numpy(zero_copy_only=False).reshape(len(ids), -1)))
                hit = side["a"][2] @ side["b"][2].T >= threshold
                if a == b:
                    np.fill_diagonal(hit, False)
                    ids, counts = side["a"][0], hit @ side["a"][1]
                else:
                    ids = np.concatenate((side["a"][0], side["b"][0]))
                    counts = np.concatenate((hit @ side["b"][1], hit.T @ side["a"][1]))
                some = counts > 0
                out.append({"a": a, "b": b, "linked": bool(some.any()), "ids": ids[some].tolist(), "counts": counts[some].tolist()})
            if out:
                yield pa.RecordBatch.from_pylist(out, pa.schema([
                    ("a", pa.int64()), ("b", pa.int64()), ("linked", pa.bool_()), ("ids", pa.list_(pa.int64())),
                    ("counts", pa.list_(pa.int64()))]))

    wide = pairs
    for s in "ab":
        wide = wide.join(blocks.select(F.col("block").alias(s), F.col("ids").alias(f"i{s}"), F.col("m").alias(f"m{s}"),
                                       F.col("x").alias(f"x{s}")), s)
    return wide.select("a", "b", "ia", "ma", "xa", "ib", "mb", "xb").mapInArrow(
        run, "a long, b long, linked boolean, ids array<long>, counts array<long>")


def enlarge_saturated(lists: DataFrame, state: DataFrame, comp: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame | None:
    """(v, n): number of linked vectors among the saturated nodes, for each saturated node."""
    dense = state.where("saturated").select(F.col("v").alias("node")).join(comp, "node").join(nodes.select("node", "grp", "m", "x"), "node")
    coded = sign_codes(dense, range(1)).select("node", "code").join(dense, "node")
    blocks = materialise(dense_blocks(coded), "blocks")
    if not blocks.head(1):
        return None
    of = materialise(blocks.select("block", F.explode("ids").alias("node")), "block-of-node")
    links = lists.where(F.col("sim") >= threshold).select("v", "u") \
        .join(of.select(F.col("node").alias("v"), F.col("block").alias("a")), "v") \
        .join(of.select(F.col("node").alias("u"), F.col("block").alias("b")), "u")
    pairs = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).union(
        blocks.select(F.col("block").alias("a"), F.col("block").alias("b"))).distinct()
    done = None
    for round_ in range(2 * ROUNDS):
        now = materialise(compare_blocks(pairs, blocks, threshold), "block-links")
        done = now if done is None else done.unionByName(now)
        if round_ and not now.where("linked").head(1):
            break
        adjacent = done.where("linked AND a <> b").select("a", "b")
        adjacent = adjacent.union(adjacent.select("b", "a"))
        draw = F.xxhash64("b", F.lit(round_))  # another linked block to go through in each round
        hub = adjacent.groupBy("a").agg(F.min_by("b", draw).alias("hub"))
        far = hub.withColumnsRenamed({"a": "x"}).join(adjacent.withColumnsRenamed({"a": "hub"}), "hub").where("x <> b")
        pairs = far.select(F.least("x", "b").alias("a"), F.greatest("x", "b").alias("b")).distinct().join(
            done.select("a", "b"), ["a", "b"], "left_anti")
        pairs = materialise(pairs, "block-pairs")
        if not pairs.head(1):
            break
    return done.select(F.explode(F.arrays_zip("ids", "counts")).alias("z")).groupBy(F.col("z.ids").alias("v")).agg(
        F.sum("z.counts").alias("n"))


# -- whole operator -----------------------------------------------------------------------------------

def degrees(lists: DataFrame, nodes: DataFrame, threshold: float, k: int, floor: float) -> tuple[DataFrame, DataFrame]:
    """((node, n): linked vectors of other classes; (node, comp))."""
    links = materialise(lists.where(F.col("sim") >= threshold).select(
        F.least("v", "u").alias("a"), F.greatest("v", "u").alias("b")).distinct(), "links")
    comp = components(links)
    state = materialise(list_state(lists, threshold, k, floor), "list-state")
    full = state.where("saturated").select("v")
    both = links.join(full.select(F.col("v").alias("a"), F.lit(True).alias("fa")), "a", "left") \
        .join(full.select(F.col("v").alias("b"), F.lit(True).alias("fb")), "b", "left").where("fa IS NULL OR fb IS NULL")
    ends = both.select(F.col("a").alias("v"), F.col("b").alias("node")).union(both.select("b", "a"))
    counted = ends.join(nodes.select("node", "m"), "node").groupBy("v").agg(F.sum("m").alias("n"))
    dense = enlarge_saturated(lists, state, comp, nodes, threshold)
    if dense is not None:
        counted = counted.unionByName(dense).groupBy("v").agg(F.sum("n").alias("n"))
    return materialise(counted.withColumnRenamed("v", "node"), "degrees"), comp


def audited_recall(nodes: DataFrame, found: DataFrame, threshold: float, sample: int) -> float:
    """Share of the links of a sample of nodes that `found` (node, n) has, by counting them against all nodes."""
    kept = nodes.orderBy(F.xxhash64("node"), "node").limit(sample).select("node", "grp", "x").collect()
    groups: dict[str, tuple[list, np.ndarray]] = {}
    for r in kept:
        groups.setdefault(r.grp, ([], []))[0].append(r.node)
        groups[r.grp][1].append(r.x)
    asked = {g: (np.array(i, np.int64), unit(np.array(x))) for g, (i, x) in groups.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            grp = np.array(b.column("grp").to_pylist(), object)
            ids, m = b.column("node").to_numpy(), b.column("m").to_numpy()
            for g, (q, x) in asked.items():
                at = np.flatnonzero(grp == g)
                if len(at):
                    hit = x @ unit(_matrix(b.column("x").take(pa.array(at)))).T >= threshold
                    hit &= q[:, None] != ids[at][None, :]
                    n = hit @ m[at]
                    yield pa.RecordBatch.from_arrays([pa.array(q[n > 0]), pa.array(n[n > 0])], ["node", "true"])

    truth = nodes.select("node", "grp", "m", "x").mapInArrow(run, "node long, true long").groupBy("node").agg(F.sum("true").alias("true"))
    there, got = truth.join(found, "node", "left").agg(
        F.sum("true"), F.sum(F.least(F.coalesce("n", F.lit(0)), F.col("true")))).first()
    return 1.0 if not there else got / there


def near_vectors(vectors: DataFrame, threshold: float = 0.93, k: int = K, trees: int = TREES, audit: int = AUDIT,
                 target: float = TARGET, passes: int = PASSES, id_col: str = "vec_id", vec_col: str = "embedding",
                 label_col: str = "label") -> DataFrame:
    """One row per vector: id, n_links, component_id, kept, audited_recall (of the whole run)."""
    floor = max(2 * threshold * threshold - 1, 0.0)
    rows, nodes = classes(vectors, id_col, vec_col, label_col)
    lists = None
    for p in range(passes):
        first = window_neighbours(nodes, range(p * trees, (p + 1) * trees), floor, k).withColumn("new", F.lit(True))
        if lists is not None:
            first = first.union(lists.withColumn("new", F.lit(False)))
        lists = refine(materialise(top_lists(first, k), "neighbour-lists"), nodes, threshold, k, floor)
        counted, comp = degrees(lists, nodes, threshold, k, floor)
        recall = audited_recall(nodes, counted, threshold, audit)
        if recall >= target:
            break
    least = nodes.select("node", "least").join(comp, "node").groupBy("comp").agg(F.min("least").alias("component"))
    labelled = nodes.join(counted, "node", "left").join(comp, "node", "left").join(least, "comp", "left").select(
        "grp", "x", (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"), F.coalesce("component", "least").alias("component"))
    out = rows.where("grp IS NOT NULL").join(labelled, ["grp", "x"]).select("id", "n_links", "component").unionByName(
        rows.where("grp IS NULL").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component")))
    return out.select(F.col("id").alias(id_col), "n_links", F.col("component").alias("component_id"),
                      F.col("id").eqNullSafe(F.col("component")).alias("kept"), F.lit(recall).alias("audited_recall"))
