"""Substring dedup with prefix-partitioned suffix trees.

Repeats are found among the suffixes of all documents' word sequences (words `[^\\x20\\x09-\\x0D]+`).
A window is `length` consecutive words; a word is removed if a window that covers it also starts
earlier (smaller id, or same document and earlier start).

1. Every window elects one of its `seed`-word sequences, the one of smallest hash: equal windows
   elect equal seeds at equal offsets. A census counts the seeds of all documents; a window whose
   seed occurs once cannot be repeated. The seeds are the prefixes by which suffixes are parted.
2. Prefixes are of variable length: a seed with more than `group` occurrences is extended by one more
   word for every doubling, and what still exceeds a group (many copies of one passage) is dealt out by
   document. Prefixes are packed into groups of about `group` occurrences, small enough for a task.
3. In a group the suffixes that start at each window build a tree from the top: a node's suffixes
   are parted by their next words (`EDGE` at a time), suffixes left alone drop out. Internal nodes that
   reach depth `length` are the repeats; all but a node's first occurrence are marked. Prefixes that
   were extended or dealt out pass one winner for each distinct window on, and winners of
   equal windows are compared once more over all groups.
4. Marked windows go back to their documents, where runs of them are the maximal repeats.

Defined cases: NULL and blank texts have no words; a NULL id orders before all others; rows that
repeat id and text are one document (each row loses the same words), rows that repeat an id with
different texts are told apart by a hash of the text, and the same start of one id is not earlier;
documents shorter than a window lose nothing; an empty table gives an empty result; other columns
are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from cumulo.llm.common import materialise
from cumulo.llm.word_arrays import mix, sequence_hashes, word_hashes

SEED, EDGE, GROUP = 6, 4, 20_000
INDEX_BITS = 20


def elected(h: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(seed hash, position, first window, window after the last) of each elected seed of a document."""
    if len(h) < length:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none
    g = sequence_hashes(h, seed)
    wide = length - seed + 1
    if len(g) < 1 << INDEX_BITS:
        # the leftmost minimum: positions in the low bits of the hashes, windows doubled up to `wide`
        low = np.uint64((1 << INDEX_BITS) - 1)
        m, step = (g & ~low) | np.arange(len(g), dtype=np.uint64), 1
        while 2 * step <= wide:
            m, step = np.minimum(m[:-step], m[step:]), 2 * step
        n = len(g) - wide + 1
        at = (np.minimum(m[:n], m[wide - step:wide - step + n]) & low).astype(np.int64)
    else:
        g = g >> np.uint64(INDEX_BITS) << np.uint64(INDEX_BITS)
        at = np.lib.stride_tricks.sliding_window_view(g, wide).argmin(axis=1)
        at = at + np.arange(len(at))
    # `at` never decreases
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    return sequence_hashes(h, seed)[at[first]], at[first], first, np.append(first[1:], len(at))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, text, and the key of a document: o (orders like the id), t (hash of the text where ids repeat, else 0)."""
    text, o = F.col(f"`{text_col}`"), F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(-2**63))
    repeated = docs.groupBy(o.alias("o")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").head(1)
    t = F.xxhash64(text) if repeated else F.lit(0).cast("long")
    return docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text"), o.alias("o"), t.alias("t"))


def packed(keyed: DataFrame) -> DataFrame:
    """id, o, t, z: the text's UTF-8 bytes under zstd, for the way through a shuffle; NULL stays NULL."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(level=1)
        for b in batches:
            small = [None if t is None else z.compress(t.encode("utf-8")) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("o"), b.column("t"), pa.array(small, pa.binary())],
                                             ["id", "o", "t", "z"])

    kind = keyed.schema["id"].dataType.simpleString()
    return keyed.mapInArrow(run, f"id {kind}, o long, t long, z binary")


def seeds(keyed: DataFrame, length: int, seed: int) -> DataFrame:
    """One row per elected seed: seed (hash), o, t, pos."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [elected(word_hashes((t or "").encode("utf-8"))[0], length, seed)[:2] for t in b.column("text").to_pylist()]
            n = [len(x) for x, _ in found]
            which = pa.array(np.repeat(np.arange(len(n)), n))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([x for x, _ in found] or [[]]).astype(np.uint64).view(np.int64)),
                 b.column("o").take(which), b.column("t").take(which),
                 pa.array(np.concatenate([p for _, p in found] or [[]]).astype(np.int32))], ["seed", "o", "t", "pos"])

    return keyed.select("text", "o", "t").mapInArrow(run, "seed long, o long, t long, pos int")


def contexts(marked: DataFrame, length: int, seed: int, group: int, buckets: int) -> DataFrame:
    """The words around each marked seed, under the group they are dealt to.

    split: whether equal windows may be in other groups; lead: the seed's offset in the words;
    windows: how many start in them (the first one at `start`)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for b in batches:
            marks = b.column("marks")
            edge = marks.offsets.to_numpy()
            marked_pos, marked_n = (marks.values.field(c).to_numpy() for c in ("pos", "n"))
            out: dict[str, list] = {c: [] for c in ("bucket", "split", "which", "start", "lead", "windows")}
            words: list[bytes] = []
            for i, z in enumerate(b.column("z").to_pylist()):
                raw = unpack(z)
                h, begin, end = word_hashes(raw)
                hashes, pos, first, after = elected(h, length, seed)
                p, n = marked_pos[edge[i]:edge[i + 1]], marked_n[edge[i]:edge[i + 1]]
                at = np.searchsorted(pos, p)
                prefix = hashes[at]
                for j in np.flatnonzero(n > group):  # a longer prefix, and a part of it
                    more = -(-int(n[j]) // group)
                    longer = min(length, seed + (more - 1).bit_length(), len(h) - int(p[j]))
                    who = mix(np.array([(b.column("o")[i].as_py() * 31 + int(p[j])) & (2**64 - 1)], np.uint64))
                    prefix[j] = mix(sequence_hashes(h[p[j]:p[j] + longer], longer) ^ who % np.uint64(more))[0]
                s, e = first[at], after[at]
                for c, x in (("bucket", (mix(prefix) % np.uint64(buckets)).astype(np.int64)), ("split", n > group),
                             ("which", np.full(len(p), i)), ("start", s), ("lead", p - s), ("windows", e - s)):
                    out[c].append(x)
                words += [raw[x:y] for x, y in zip(begin[s].tolist(), end[e + length - 2].tolist())]
            flat = {c: np.concatenate(x) if x else np.zeros(0, np.int64) for c, x in out.items()}
            which = pa.array(flat["which"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(flat["bucket"], pa.int64()), pa.array(flat["split"].astype(bool), pa.bool_()), b.column("o").take(which),
                 b.column("t").take(which), *(pa.array(flat[c].astype(np.int32)) for c in ("start", "lead", "windows")),
                 pa.array(words, pa.binary())], ["bucket", "split", "o", "t", "start", "lead", "windows", "words"])

    return marked.select("z", "o", "t", "marks").mapInArrow(
        run, "bucket long, split boolean, o long, t long, start int, lead int, windows int, words binary")


def deep_nodes(node: np.ndarray, paths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes below internal nodes at full depth, and their node. node: where each suffix starts in the
    tree; paths: its edge labels (one column for each edge)."""
    alive = np.arange(len(node))
    for edge in range(paths.shape[1]):
        key = mix(node[alive].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ paths[alive, edge])
        _, child, size = np.unique(key, return_inverse=True, return_counts=True)
        inner = size[child] > 1
        alive = alive[inner]
        node = node.copy()
        node[alive] = child[inner]
    return alive, node[alive]


def subtree(length: int, seed: int):
    """Function of one group's contexts: marked windows (from, to: starts) and winners of split prefixes."""
    cols = ["o", "t", "from", "to", "x", "y"]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        raw = b" ".join(pdf["words"])
        h, _, _ = word_hashes(raw)
        windows = pdf["windows"].to_numpy().astype(np.int64)
        n_words = windows + length - 1
        row = np.repeat(np.arange(len(pdf)), windows)
        inside = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
        at = (np.cumsum(n_words) - n_words)[row] + inside  # first word of each window
        start = pdf["start"].to_numpy().astype(np.int64)[row] + inside
        o, t = pdf["o"].to_numpy()[row], pdf["t"].to_numpy()[row]
        edges = []
        for d in range(0, length, EDGE):
            step = min(EDGE, length - d)
            edges.append(sequence_hashes(h, step)[at + d])
        paths = np.stack(edges, axis=1)
        # suffixes of one prefix that start at the same distance before it hang below one node
        own = pdf["lead"].to_numpy().astype(np.int64)
        prefix = sequence_hashes(h, seed)[np.cumsum(n_words) - n_words + own]
        root = mix(prefix[row] ^ ((own[row] - inside).astype(np.uint64) << np.uint64(40)))
        _, root = np.unique(root, return_inverse=True)
        split = pdf["split"].to_numpy().astype(bool)[row]
        leaf, node = deep_nodes(root, paths)
        order = np.lexsort((start[leaf], o[leaf], node))
        leaf, node = leaf[order], node[order]
        head = np.concatenate(([True], node[1:] != node[:-1])) if len(node) else np.zeros(0, bool)
        first = leaf[np.flatnonzero(head)][np.cumsum(head) - 1] if len(node) else leaf
        later = (o[leaf] != o[first]) | (start[leaf] != start[first])
        marked = np.zeros(len(row), bool)
        marked[leaf[later]] = True
        # runs of marked windows of one context
        idx = np.flatnonzero(marked)
        new = np.concatenate(([True], (np.diff(idx) != 1) | (row[idx][1:] != row[idx][:-1]))) if len(idx) else np.zeros(0, bool)
        a = idx[new]
        b = idx[np.append(np.flatnonzero(new)[1:] - 1, len(idx) - 1)] if len(idx) else idx
        runs = pd.DataFrame({"o": o[a], "t": t[a], "from": start[a], "to": start[b] + 1, "x": None, "y": None}, columns=cols)
        # one winner of each distinct window: alone in its group, or first of its node
        wins = np.flatnonzero(split & ~marked)
        key = sequence_hashes(h, length), sequence_hashes(h, length, 1)
        winners = pd.DataFrame({"o": o[wins], "t": t[wins], "from": start[wins], "to": start[wins] + 1,
                                "x": key[0][at[wins]].view(np.int64), "y": key[1][at[wins]].view(np.int64)}, columns=cols)
        both = pd.concat([runs, winners], ignore_index=True)
        return both.astype({"x": "Int64", "y": "Int64"})

    return run


def repeated_windows(keyed: DataFrame, texts: DataFrame, length: int, seed: int, group: int) -> DataFrame:
    """Runs of marked windows: o, t, from, to (starts, `to` exclusive)."""
    found = seeds(keyed, length, seed)
    census = materialise(found.groupBy("seed").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "seed-census")
    total = census.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    marks = found.join(census, "seed").groupBy("o", "t").agg(F.collect_set(F.struct("pos", "n")).alias("marks"))
    marked = texts.join(marks, ["o", "t"])
    dealt = contexts(marked, length, seed, group, max(1, -(-total // group)))
    trees = materialise(dealt.groupBy("bucket").applyInPandas(
        subtree(length, seed), "o long, t long, `from` int, `to` int, x long, y long"), "repeats")
    winners = trees.where("x IS NOT NULL")
    best = winners.groupBy("x", "y").agg(F.min(F.struct("o", "from")).alias("w"))
    lost = winners.join(best, ["x", "y"]).where(F.struct("o", "from") > F.col("w"))
    return trees.where("x IS NULL").unionByName(lost.drop("w")).select("o", "t", "from", "to")


def remove_repeats(docs: DataFrame, length: int = 20, seed: int = SEED, group: int = GROUP, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One row per document: id, n_words, n_removed, spans (removed words: first, after), kept_text."""
    keyed = _keyed(docs, id_col, text_col)
    texts = packed(keyed)
    runs = repeated_windows(keyed, texts, length, seed, group).groupBy("o", "t").agg(
        F.collect_list(F.struct("from", "to")).alias("runs"))
    rows = texts.join(runs, ["o", "t"], "left").select("id", "z", "runs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for b in batches:
            out = {c: [] for c in ("n_words", "n_removed", "spans", "kept_text")}
            for z, runs in zip(b.column("z").to_pylist(), b.column("runs").to_pylist()):
                words = unpack(z).split() if z else []
                spans = []
                if runs:
                    edge = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edge, [r["from"] for r in runs], 1)
                    np.add.at(edge, [r["to"] - 1 + length for r in runs], -1)
                    gone = np.cumsum(edge)[:-1] > 0
                    cut = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).astype(np.int8)))
                    spans = [{"first": int(x), "after": int(y)} for x, y in zip(cut[::2], cut[1::2])]
                kept, at = [], 0
                for s in spans:
                    kept += words[at:s["first"]]
                    at = s["after"]
                kept += words[at:]
                out["n_words"].append(len(words))
                out["n_removed"].append(len(words) - len(kept))
                out["spans"].append(spans)
                out["kept_text"].append(b" ".join(kept).decode("utf-8"))
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(out["n_words"], pa.int64()), pa.array(out["n_removed"], pa.int64()),
                 pa.array(out["spans"], pa.list_(pa.struct([("first", pa.int32()), ("after", pa.int32())]))),
                 pa.array(out["kept_text"], pa.string())], ["id", "n_words", "n_removed", "spans", "kept_text"])

    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n_words long, n_removed long, "
                                "spans array<struct<first:int,after:int>>, kept_text string").withColumnRenamed("id", id_col)
