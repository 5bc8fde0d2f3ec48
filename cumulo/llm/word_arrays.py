"""Word hashes of whole texts as numpy arrays, without a Python object per word.

The hash of a word of at most `SHORT` bytes is the difference of two prefix sums of a polynomial over the
bytes, shifted back to position 0 (the base is odd, so it has an inverse modulo 2**64). Long words that
alternate in a regular way would get equal polynomials (a Thue-Morse word of 1,024 letters and its complement);
a longer word's hash is the sum of one mixed number for each byte and its place, in which no such structure
is left. Both are mixed with the length. Of n different words two share a hash with a probability of about
n * n / 2**65.
"""

from __future__ import annotations

import re

import numpy as np

SLICE = 1 << 20  # bytes hashed at once; slices end at a break
_BREAK = re.compile(rb"[\x20\x09-\x0D]")
_IS_BREAK = np.zeros(256, bool)
_IS_BREAK[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_TABLE = np.random.default_rng(20240501).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHORT = 64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, by doubling."""
    out = np.ones(max(n, 1), np.uint64)
    done, step = 1, base & (2**64 - 1)
    while done < n:
        take = min(done, n - done)
        out[done:done + take] = out[:take] * np.uint64(step)
        done, step = done + take, step * step & (2**64 - 1)
    return out


_POWERS: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, 1 << 16)
        _POWERS["up"] = powers(_BASE, size)
        _POWERS["down"] = powers(pow(_BASE, -1, 2**64), size)
    return _POWERS["up"], _POWERS["down"]


def _long_hashes(raw: np.ndarray, start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sum over the bytes of a span of a mixed number for byte and place."""
    first = np.cumsum(n) - n
    place = np.arange(first[-1] + n[-1]) - np.repeat(first, n)
    value = mix(_TABLE[raw[place + np.repeat(start, n)]] + place.astype(np.uint64) * np.uint64(_BASE))
    return np.add.reduceat(value, first)


def span_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes in each non-empty span; equal bytes have equal hashes wherever they stand."""
    up, down = _power_tables(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_TABLE[raw] * up[:len(raw)], out=sums[1:])
    n = end - start
    out = (sums[end] - sums[start]) * down[start]
    long = np.flatnonzero(n > SHORT)
    if len(long):
        out[long] = _long_hashes(raw, start[long], n[long])
    return mix(out + n.astype(np.uint64))


def _slice_words(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    word = ~_IS_BREAK[raw]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], word, [False])).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    return span_hashes(raw, start, end), start, end


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first byte, byte after the last) of each word `[^\\x20\\x09-\\x0D]+`, in order."""
    parts, pos = [], 0
    while pos < len(raw):
        end = min(pos + SLICE, len(raw))
        if end < len(raw):
            m = _BREAK.search(raw, end)
            end = m.start() if m else len(raw)
        h, a, b = _slice_words(np.frombuffer(raw, np.uint8, end - pos, pos))
        parts.append((h, a + pos, b + pos))
        pos = end
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*parts))


def sequence_hashes(h: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
    """Hash of every k consecutive words (empty if there are fewer)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, k + 7919 * salt, np.uint64)
    step = np.uint64((_BASE + 2 * 104729 * salt) & (2**64 - 1) | 1)
    for j in range(k):
        out = (out + h[j:j + n]) * step
    return mix(out)


def shingle_set(raw: bytes, k: int) -> np.ndarray:
    """Sorted distinct hashes of k-word shingles; with fewer words the whole sequence is the one shingle."""
    h, _, _ = word_hashes(raw)
    return np.unique(sequence_hashes(h, min(k, len(h)))) if len(h) else h
