"""Token counts by rank-synchronous array merging.

The pre-tokens of a batch are held as one ragged numpy array of symbols. In each round every
sequence finds its own lowest-rank pair (a segmented minimum), all sequences replace all
occurrences of theirs at once, and sequences without a mergeable pair leave with the number of
symbols they have left. Counting needs no ids.

The tokeniser file is a byte-level BPE `.json`; its special strings inside texts count as one token
each, as the tokenizers library does by default. Each worker counts a new segment of text once and
keeps a bounded number of counts (`SegmentTable`).

Defined cases: NULL and empty texts have 0 bytes and 0 tokens; ids are passed through, so repeated
and NULL ids give one row each; a text without any break is one segment of any length; an empty
table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import regex
from pyspark.sql import DataFrame, functions as F

from cumulo.llm.segments import SegmentTable, check_special

NEVER = np.int32(2**31 - 1)


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: visible Latin-1 bytes stand
    for themselves, the others are numbered from 256 in order."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return [chr(b) if b in visible else chr(256 + hidden.index(b)) for b in range(256)]


class MergeTable:
    """Ranks of symbol pairs. A symbol is a vocabulary id; pairs are looked up in a sorted array."""

    def __init__(self, path: str, pattern: str):
        spec = json.load(open(path, encoding="utf-8"))
        vocab = spec["model"]["vocab"]
        self.width = max(vocab.values()) + 1
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int32)
        keys = left * self.width + right
        order = np.argsort(keys)
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int32), made
        self.of_byte = np.array([vocab[s] for s in byte_symbols()], np.int32)
        born = {int(m): r for r, m in enumerate(made)}
        # merging all occurrences of one rank at once is right if a merge only makes pairs of higher rank
        if any(max(born.get(int(a), -1), born.get(int(b), -1)) >= r for r, (a, b) in enumerate(zip(left, right))):
            raise ValueError("merges are not in the order in which their parts are made")
        specials = [t["content"] for t in spec.get("added_tokens", [])]
        check_special(specials)
        self.special = regex.compile("|".join(map(regex.escape, sorted(specials, key=len, reverse=True)))) \
            if specials else None
        self.pattern = regex.compile(pattern)

    def pair_ranks(self, symbols: np.ndarray) -> np.ndarray:
        pairs = symbols[:-1].astype(np.int64) * self.width + symbols[1:]
        at = np.minimum(np.searchsorted(self.keys, pairs), len(self.keys) - 1)
        return np.where(self.keys[at] == pairs, self.ranks[at], NEVER).astype(np.int32)

    def counts(self, sequences: list[bytes]) -> np.ndarray:
        """Symbols left of each non-empty byte sequence after all its merges."""
        lens = np.array([len(s) for s in sequences], np.int64)
        out = np.zeros(len(sequences), np.int64)
        if not len(lens):
            return out
        symbols = self.of_byte[np.frombuffer(b"".join(sequences), np.uint8)]
        who = np.arange(len(sequences))
        while len(who):
            starts = np.cumsum(lens) - lens
            ranks = np.full(len(symbols), NEVER, np.int32)
            ranks[:-1] = self.pair_ranks(symbols)
            ranks[starts + lens - 1] = NEVER  # no pair reaches into the next sequence
            lowest = np.minimum.reduceat(ranks, starts)
            going = lowest < NEVER
            out[who[~going]] = lens[~going]
            if not going.any():
                break
            hits = np.flatnonzero((ranks == np.repeat(lowest, lens)) & (ranks < NEVER))
            # of overlapping occurrences (a run like aaa) the first, third, ... are merged
            fresh = np.ones(len(hits), bool)
            fresh[1:] = hits[1:] != hits[:-1] + 1
            run_start = np.maximum.accumulate(np.where(fresh, np.arange(len(hits)), 0))
            hits = hits[(np.arange(len(hits)) - run_start) % 2 == 0]
            symbols[hits] = self.made[ranks[hits]]
            keep = np.repeat(going, lens)
            keep[hits + 1] = False
            gone = np.zeros(len(symbols), np.int64)
            gone[hits + 1] = 1
            lens = (lens - np.add.reduceat(gone, starts))[going]
            symbols, who = symbols[keep], who[going]
        return out

    def segment_counts(self, segments: list[str]) -> list[int]:
        """Tokens of each segment: its special strings, and the symbols of its pre-tokens."""
        number: dict[str, int] = {}
        parts, owner = [], []
        fixed = np.zeros(len(segments), np.int64)
        for i, s in enumerate(segments):
            plain = [s]
            if self.special is not None and self.special.search(s):
                plain = self.special.split(s)
                fixed[i] = len(plain) - 1
            for p in plain:
                for w in self.pattern.findall(p):
                    parts.append(number.setdefault(w, len(number)))
                    owner.append(i)
        got = self.counts([w.encode("utf-8") for w in number])
        if owner:
            np.add.at(fixed, np.array(owner), got[np.array(parts)])
        return fixed.tolist()


_TABLES: dict[tuple, SegmentTable] = {}  # bounded: the vocabulary and the table's own limits


def _cache(path: str, pattern: str) -> SegmentTable:
    if (path, pattern) not in _TABLES:
        _TABLES[path, pattern] = SegmentTable(MergeTable(path, pattern).segment_counts, None)
    return _TABLES[path, pattern]


def count_tokens(docs: DataFrame, path: str, pattern: str, limit: int = 1024, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per document: id, n_bytes, n_tokens, over_limit (more than `limit` tokens)."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("t"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _cache(path, pattern)
        for b in batches:
            n, _ = cache.encode(b.column("t").to_pylist())
            size = pa.compute.binary_length(b.column("t")).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("id"), size, pa.array(n, pa.int64())], ["id", "n_bytes", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(count, f"id {kind}, n_bytes long, n_tokens long").select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
