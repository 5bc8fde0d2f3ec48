"""Byte-level BPE encoding and decoding by corpus-level merge replay.

The new distinct pre-tokens of a block of text form a small corpus: one linked list of symbols over all
words, held in arrays. An inverted index has, for each position that begins a mergeable pair, the rank of
that pair. Merges are replayed in rank order: in each step every word that has entries gives the positions
of its lowest rank, all of them are merged at once, and only the pairs to the left and right of a
merged symbol are looked up anew and enter the index. That is the order in which a rank-file tokeniser
merges (lowest rank first, leftmost first) unless a merge brings up a pair of lower rank beside another
occurrence; such words are found and merged one pair at a time. A word that is a token stays whole, as in
the library.

Blocks hold at most `segments.PART` bytes (or one segment that is longer); segments seen before are kept,
bounded in bytes.

Decoding joins the byte strings of the ids; any sequence of known ids decodes.

Defined cases: NULL and empty texts give no ids and decode to empty bytes; ids of documents are
passed through, so repeated and NULL ids give one row each; a text without any break is one
segment of any length; an unknown token id raises; an empty table gives an empty result; other columns
are not looked at.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from cumulo.llm.common import tidy
from cumulo.llm.segments import SegmentTable


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


NEVER = np.iinfo(np.int32).max


class TokenBytes:
    """The bytes of every token, one after the other."""

    def __init__(self, ranks: dict[bytes, int]):
        token = {r: t for t, r in ranks.items()}
        top = max(token) + 1
        self.size = np.array([len(token.get(i, b"")) for i in range(top)], np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(token.get(i, b"") for i in range(top)), np.uint8)

    def join(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The bytes that each run of `counts` ids stands for."""
        if len(ids) and not (0 <= ids.min() and ids.max() < len(self.at) and (self.size[ids] > 0).all()):
            raise KeyError("unknown token id")
        size = self.size[ids]
        total = np.concatenate(([0], np.cumsum(size)))
        raw = self.bytes[np.arange(total[-1]) + np.repeat(self.at[ids] - total[:-1], size)].tobytes()
        edge = total[np.concatenate(([0], np.cumsum(counts)))].tolist()
        return [raw[a:b] for a, b in zip(edge, edge[1:])]


class MergeReplay:
    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        self.pattern = regex.compile(pattern)
        self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        # every way to put a token together from two others, as a sorted table
        left, right, made = [], [], []
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    made.append(rank)
        keys = np.array(left, np.int64) << 32 | np.array(right, np.int64)
        order = np.argsort(keys)
        self.keys, self.made = keys[order], np.array(made, np.int32)[order]
        if not len(keys):
            self.keys, self.made = np.array([-1]), np.array([NEVER], np.int32)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that each two tokens make, NEVER if there is none."""
        pairs = left.astype(np.int64) << 32 | right.astype(np.int64)
        at = np.minimum(np.searchsorted(self.keys, pairs), len(self.keys) - 1)
        return np.where(self.keys[at] == pairs, self.made[at], NEVER)

    def one_by_one(self, word: bytes) -> list[int]:
        """The plain form: the leftmost pair of the lowest rank, again and again."""
        symbol: list = self.of_byte[np.frombuffer(word, np.uint8)].tolist()
        n = len(symbol)
        after, before = [*range(1, n), -1], list(range(-1, n - 1))

        def rank(i: int) -> int:
            return int(self.pair_ranks(np.array([symbol[i]]), np.array([symbol[after[i]]]))[0]) if after[i] >= 0 else NEVER
        heap = [(rank(i), i) for i in range(n - 1)]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            if r == NEVER or symbol[i] is None or rank(i) != r:
                continue
            j = after[i]
            symbol[i], symbol[j], after[i] = r, None, after[j]
            if after[i] >= 0:
                before[after[i]] = i
                heapq.heappush(heap, (rank(i), i))
            if before[i] >= 0:
                heapq.heappush(heap, (rank(before[i]), before[i]))
        return [x for x in symbol if x is not None]

    def replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one after the other, how many of each word), for non-empty words."""
        size = np.array([len(w) for w in words], np.int64)
        if not len(size):
            return np.zeros(0, np.int32), size
        raw = np.frombuffer(b"".join(words), np.uint8)
        n, ends = len(raw), np.cumsum(size)
        word = np.repeat(np.arange(len(words)), size)
        symbol = self.of_byte[raw]
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[ends - 1], before[ends - size] = -1, -1
        # the index: the rank of the pair that begins at each position, and the positions that have one
        rank = np.full(n, NEVER, np.int32)
        inner = np.flatnonzero(after >= 0)
        rank[inner] = self.pair_ranks(symbol[inner], symbol[inner + 1])
        open_ = np.flatnonzero(rank < NEVER)
        live = np.ones(n, bool)
        odd: dict[int, list[int]] = {}
        while len(open_):
            r, w = rank[open_], word[open_]
            begin = np.flatnonzero(np.concatenate(([True], w[1:] != w[:-1])))
            low = np.repeat(np.minimum.reduceat(r, begin), np.diff(np.append(begin, len(w))))
            at = open_[r == low]
            # of overlapping occurrences (a run like aaa) the first, third, ... are merged
            fresh = np.ones(len(at), bool)
            fresh[1:] = after[at[:-1]] != at[1:]
            run = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - run) % 2 == 0]
            token, gone = rank[at], after[at]
            far = after[gone]
            several = np.zeros(len(at), bool)
            several[1:] = word[at[1:]] == word[at[:-1]]
            several[:-1] |= several[1:]
            # a pair of lower rank may come up between two merges of a word: it would go first
            check = np.flatnonzero(several & (far >= 0))
            early = check[self.pair_ranks(token[check], symbol[far[check]]) < token[check]]
            symbol[at], live[gone], rank[gone] = token, False, NEVER
            after[at] = far
            inside = far >= 0
            before[far[inside]] = at[inside]
            back = before[at]
            touched = np.concatenate((at, back[back >= 0]))
            right = after[touched]
            new = np.full(len(touched), NEVER, np.int32)
            there = right >= 0
            new[there] = self.pair_ranks(symbol[touched[there]], symbol[right[there]])
            rank[touched] = new
            from_merge = np.concatenate((np.arange(len(at)), np.flatnonzero(back >= 0)))
            lower = from_merge[new < token[from_merge]]
            for k in set(word[at[np.concatenate((early, lower[several[lower]]))]].tolist()):
                odd[k] = self.one_by_one(words[k])
                rank[ends[k] - size[k]:ends[k]] = NEVER
            if len(open_) > n >> 4:
                open_ = np.flatnonzero(rank < NEVER)
            else:
                open_ = np.union1d(open_, touched)
                open_ = open_[rank[open_] < NEVER]
        counts = np.add.reduceat(live.astype(np.int64), ends - size)
        ids = symbol[live]
        if odd:
            parts = np.split(ids, np.cumsum(counts)[:-1])
            for k, got in odd.items():
                parts[k], counts[k] = np.array(got, np.int32), len(got)
            ids = np.concatenate(parts)
        return ids, counts

    def segment_ids(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of each segment, how many)."""
        number: dict[str, int] = {}
        part, owner = [], []
        for i, s in enumerate(segments):
            for w in self.pattern.findall(s):
                part.append(number.setdefault(w, len(number)))
                owner.append(i)
        whole = [self.ranks.get(w.encode("utf-8")) for w in number]  # a word that is a token is that token
        ids, counts = self.replay([w.encode("utf-8") for w, t in zip(number, whole) if t is None])
        merged = np.array([t is None for t in whole], bool)
        n = np.ones(len(whole), np.int64)
        n[merged] = counts
        begin = np.cumsum(n) - n
        flat = np.zeros(n.sum(), np.int32)
        flat[begin[~merged]] = [t for t in whole if t is not None]
        flat[np.repeat(merged, n)] = ids
        part, owner = np.array(part, np.int64), np.array(owner, np.int64)
        each = n[part]
        total = np.cumsum(each) - each
        out = flat[np.repeat(begin[part] - total, each) + np.arange(each.sum())] if len(part) else flat[:0]
        lens = np.zeros(len(segments), np.int64)
        np.add.at(lens, owner, each)
        return out, lens


_REPLAYS: dict[tuple, tuple[MergeReplay, SegmentTable]] = {}  # bounded: the vocabulary and the table's own limits
_TOKENS: dict[str, TokenBytes] = {}


def _replay(path: str, pattern: str) -> SegmentTable:
    if (path, pattern) not in _REPLAYS:
        m = MergeReplay(path, pattern)
        _REPLAYS[path, pattern] = m, SegmentTable(m.segment_ids, "<i4")
    return _REPLAYS[path, pattern][1]


def _tokens(path: str) -> TokenBytes:
    if path not in _TOKENS:
        _TOKENS[path] = TokenBytes(read_ranks(path))
    return _TOKENS[path]


def _encoding(path: str, pattern: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, t) to (id, ids)."""
    cache = _replay(path, pattern)
    try:
        for b in batches:
            counts, flat = cache.encode(b.column("t").to_pylist())
            offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32, copy=False)))
            yield pa.RecordBatch.from_arrays([b.column("id"), ids], ["id", "ids"])
    finally:
        cache.forget()  # workers live on: what one task has learned is not kept through the stages that follow


def _decoding(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, ids) to (id, ids, decoded)."""
    tokens = _tokens(path)
    for b in batches:
        ids = b.column("ids")
        counts = ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = ids.flatten()
        if flat.null_count:
            raise KeyError("NULL token id")
        raw = tokens.join(flat.to_numpy(zero_copy_only=False).astype(np.int64), counts)
        yield pa.RecordBatch.from_arrays([b.column("id"), ids, pa.array(raw, pa.binary())], ["id", "ids", "decoded"])


def _texts(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("t"))
    return rows, docs.schema[id_col].dataType.simpleString()


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ids (array of int)."""
    rows, kind = _texts(docs, id_col, text_col)
    run = tidy(lambda batches: _encoding(path, pattern, batches))
    return rows.mapInArrow(run, f"id {kind}, ids array<int>").select(F.col("id").alias(id_col), "ids")


def decode(encoded: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id, ids, decoded (binary): the bytes that the ids stand for."""
    rows = encoded.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{ids_col}`").alias("ids"))
    kind = encoded.schema[id_col].dataType.simpleString()
    run = tidy(lambda batches: _decoding(path, batches))
    return rows.mapInArrow(run, f"id {kind}, ids array<int>, decoded binary").select(
        F.col("id").alias(id_col), "ids", "decoded")


def encode_and_decode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ids, decoded: `decode` of `encode`, one after the other in the same worker."""
    rows, kind = _texts(docs, id_col, text_col)
    run = tidy(lambda batches: _decoding(path, _encoding(path, pattern, batches)))
    return rows.mapInArrow(run, f"id {kind}, ids array<int>, decoded binary").select(
        F.col("id").alias(id_col), "ids", "decoded")
