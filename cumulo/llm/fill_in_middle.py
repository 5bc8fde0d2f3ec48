"""Fill-in-middle transformation with a Roaring-style set of cut places.

Every text is cut into units (lines with their line feed). The ends of the units, as byte offsets, form
a compressed integer set: chunks of 2**16 offsets, each kept in the smallest of three containers,

* array: the sorted low 16 bits,
* bitmap: one bit for each offset, with the number of bits set before each 64-bit word,
* runs: first value and length of each run of consecutive offsets,

and the chunks' cumulative cardinalities. `select(k)` finds the chunk by searching those, then the
offset inside its container; the two cuts of a text are two selects, whatever its length.

A text becomes prefix, middle and suffix, written in the order of one of two forms:

    psm:  <P>prefix<S>suffix<M>middle
    spm:  <S>suffix<P>prefix<M>middle

or stays as it is (plain): an empty text, a text that holds one of the three marks, and the share of
texts that `rate` leaves out. Cuts and form follow from the digest of seed and id alone.

Defined cases: a NULL text is empty; a NULL id has the digest of the seed with an empty id; rows that
repeat an id are cut by the same numbers, each in its own text; cuts may fall on both ends, so prefix,
middle and suffix may be empty; a text without a line feed is one unit of any length; an empty table
gives an empty result; other columns are not looked at, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
CHUNK = 1 << 16
ARRAY_MOST = 4096  # an array of more values is larger than a bitmap
_POPCOUNT = np.array([bin(i).count("1") for i in range(256)], np.uint8)


class ArrayContainer:
    """Sorted low halves."""

    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.low[k])


class BitmapContainer:
    """65,536 bits and, for each of the 1,024 words, how many bits stand before it."""

    def __init__(self, low: np.ndarray):
        bits = np.zeros(CHUNK, np.uint8)
        bits[low] = 1
        self.bytes = np.packbits(bits, bitorder="little")
        ones = _POPCOUNT[self.bytes].reshape(-1, 8).sum(axis=1, dtype=np.int64)
        self.before = np.cumsum(ones) - ones

    def select(self, k: int) -> int:
        word = int(np.searchsorted(self.before, k, side="right")) - 1
        bits = np.unpackbits(self.bytes[8 * word:8 * word + 8], bitorder="little")
        return 64 * word + int(np.flatnonzero(bits)[k - int(self.before[word])])


class RunContainer:
    """First value of each run of consecutive values and how many values stand before it."""

    def __init__(self, low: np.ndarray):
        begin = np.flatnonzero(np.concatenate(([True], np.diff(low) != 1)))
        self.first, self.before = low[begin].astype(np.uint16), begin.astype(np.int64)

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.before, k, side="right")) - 1
        return int(self.first[run]) + k - int(self.before[run])


def container(low: np.ndarray) -> ArrayContainer | BitmapContainer | RunContainer:
    """The smallest container for sorted distinct values below 2**16: 2 bytes a value, 8192 bytes or 4 bytes a run."""
    runs = 1 + int(np.count_nonzero(np.diff(low) != 1))
    if 4 * runs < min(2 * len(low), CHUNK // 8):
        return RunContainer(low)
    return ArrayContainer(low) if len(low) <= ARRAY_MOST else BitmapContainer(low)


class BoundarySet:
    """Sorted distinct offsets in containers by their high bits."""

    def __init__(self, offsets: np.ndarray):
        high = offsets // CHUNK
        begin = np.flatnonzero(np.concatenate(([True], np.diff(high) != 0))) if len(offsets) else np.zeros(0, np.int64)
        self.high = high[begin]
        self.before = np.append(begin, len(offsets))  # cumulative cardinalities
        self.containers = [container(offsets[a:b] - h * CHUNK)
                           for a, b, h in zip(begin, self.before[1:], self.high)]

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, k: int) -> int:
        """The k-th offset, counted from 0."""
        if not 0 <= k < len(self):
            raise IndexError(k)
        at = int(np.searchsorted(self.before, k, side="right")) - 1
        return int(self.high[at]) * CHUNK + self.containers[at].select(k - int(self.before[at]))


def line_ends(raw: bytes) -> np.ndarray:
    """Byte offset after each line `[^\\n]*\\n|[^\\n]+`."""
    ends = np.flatnonzero(np.frombuffer(raw, np.uint8) == 0x0A) + 1
    return ends if not raw or raw.endswith(b"\n") else np.append(ends, len(raw))


def draws(seed: int, key: str) -> tuple[int, ...]:
    """Four unsigned 32-bit numbers from the digest of `seed:key`."""
    digest = hashlib.sha256(f"{seed}:{key}".encode()).digest()
    return tuple(int.from_bytes(digest[4 * i:4 * i + 4], "big") for i in range(4))


def _chars(raw: bytes) -> int:
    return int(np.count_nonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80))


def cut(raw: bytes, key: str, seed: int, rate: int, spm: int) -> tuple[int, str, int | None, int | None, bytes]:
    """(units, form, characters of prefix and middle, output) of a text in UTF-8."""
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    h1, h2, h3, h4 = draws(seed, key)
    ends = BoundarySet(line_ends(raw))
    n = len(ends)
    if not raw or any(m in raw for m in marks) or h3 % 100 >= rate:
        return n, "plain", None, None, raw
    a, b = (ends.select(k - 1) if k else 0 for k in sorted((h1 % (n + 1), h2 % (n + 1))))
    before, inner, rest = raw[:a], raw[a:b], raw[b:]
    p, s, m = marks
    if h4 % 100 < spm:
        form, out = "spm", b"".join((s, rest, p, before, m, inner))
    else:
        form, out = "psm", b"".join((p, before, s, rest, m, inner))
    return n, form, _chars(before), _chars(inner), out


def fill_in_middle(docs: DataFrame, seed: int = 7, rate: int = 100, spm: int = 50, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One row per document: id, n (units), form, prefix_chars, middle_chars, output.

    `rate` per cent of the texts are transformed, `spm` per cent of those in the suffix-first form."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("k"),
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [cut(t.as_py(), k, seed, rate, spm) for t, k in zip(b.column("t"), b.column("k").to_pylist())]
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), *(pa.array([g[i] for g in got], kind) for i, kind in enumerate(kinds))],
                ["id", "n", "form", "prefix_chars", "middle_chars", "output"])

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, n long, form string, prefix_chars long, middle_chars long, output binary"
    return rows.mapInArrow(run, schema).select(
        F.col("id").alias(id_col), "n", "form", "prefix_chars", "middle_chars", F.col("output").cast("string").alias("output"))


def restore(transformed: DataFrame, output_col: str = "output", form_col: str = "form") -> DataFrame:
    """`transformed` with a column `restored`: the text that was cut, from output and form alone.

    No text that is cut holds a mark, and no mark can begin inside another one, so the marks are where
    the output splits."""
    parts = F.split(F.col(f"`{output_col}`"), "<[PSM]>", -1)
    psm, spm = (F.concat(parts[a], parts[3], parts[b]) for a, b in ((1, 2), (2, 1)))
    form = F.col(f"`{form_col}`")
    return transformed.withColumn(
        "restored", F.when(form == "psm", psm).when(form == "spm", spm).otherwise(F.col(f"`{output_col}`")))
