"""Cutting texts into segments that a byte-level pre-tokeniser treats independently.

A pre-token pattern of the form "optional space + run of one class | white-space run" never
matches across a change from a visible character to a space or line feed, and its look-ahead
ends inside the white-space run. Nor does it match across a change from a letter to a punctuation mark. So a
text may be cut before every space or line feed whose left neighbour is not white space and before every
mark (of `MARKS`) whose left neighbour is an ASCII letter, and the tokens of the text are the tokens of its
segments in order. (A text may always be cut less often: where the left neighbour is not plainly visible
from its UTF-8 bytes there is no cut. A special string that a tokeniser looks for before it splits the text
must not hold a cut: see `check_special`.) Segments repeat far more often than texts do: a task computes each
new one once and keeps results and segments in numpy arrays, found by hash and compared byte by byte.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from cumulo.llm.word_arrays import SHORT, span_hashes

PART = 1 << 19  # bytes of text cut and hashed at once (a longer text makes a longer part)
#: Marks that often follow a word (special strings have other ones beside their letters: < > | [ ] _ -).
MARKS = b"!\"#$%&()*+,./:;?"
_MARK = np.zeros(256, bool)
_MARK[list(MARKS)] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_SPACE = np.zeros(256, bool)
_SPACE[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = True
_ASCII = np.arange(256) < 0x80
_TWO = (np.arange(256) >= 0xC3) & (np.arange(256) < 0xE0)  # leads of two-byte characters, without C2 (has white space)
_THREE = (np.arange(256) == 0xE0) | (np.arange(256) >= 0xE4) & (np.arange(256) < 0xF0)  # without E1, E2, E3
_FOUR = np.arange(256) >= 0xF0


def cuts(raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where segments begin: at `starts` (of texts), before breaks after a visible character and marks after a letter."""
    at = np.flatnonzero((raw == 0x20) | (raw == 0x0A))
    left = [raw[np.maximum(at - j, 0)] for j in (1, 2, 3, 4)]
    seen = _ASCII[left[0]] & ~_SPACE[left[0]]
    tail = ~_ASCII[left[0]]
    seen |= tail & (_TWO[left[1]] | ~_ASCII[left[1]] & (_THREE[left[2]] | ~_ASCII[left[2]] & _FOUR[left[3]]))
    first = np.zeros(len(raw), bool)
    first[1:] = _MARK[raw[1:]] & _LETTER[raw[:-1]]
    first[at[seen & (at > 0)]] = True
    first[starts] = True
    return np.flatnonzero(first)


def check_special(strings: list[str]) -> None:
    for s in strings:
        if s and len(cuts(np.frombuffer(s.encode("utf-8"), np.uint8), np.zeros(1, np.int64))) > 1:
            raise ValueError(f"texts would be cut within the special string {s}")


def _eights(a: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, one row each."""
    return np.lib.stride_tricks.as_strided(a, (len(a) - 7, 8), (1, 1), writeable=False)


class SegmentTable:
    """Token counts and ids of segments, kept between batches.

    `compute` gets distinct new segments and returns for each its ids as bytes of `dtype`, or all ids in one array and
    their counts, or, with `dtype` None, token counts. A segment is found by the hash of its bytes and known by its bytes: one whose hash
    belongs to another segment gets an entry of its own, without a place in the table. The table grows with its
    entries. Between two parts of text, beyond `limit` segments or `room` bytes of arrays, those that no later part
    met again are forgotten, or all if the others take more than a third of that."""

    def __init__(self, compute: Callable[[list[str]], list], dtype: str | None, limit: int = 1_000_000,
                 room: int = 32 << 20):
        self.compute, self.dtype, self.limit, self.room = compute, dtype, limit, room
        self.forget()

    def forget(self) -> None:
        self.mask = (1 << 12) - 1
        self.keys = np.zeros(self.mask + 1, np.uint64)  # 0: free
        self.slot = np.zeros(self.mask + 1, np.int32)
        self.placed = 0
        self.n, self.used, self.held = 0, 0, 0
        self.lens = np.zeros(1 << 12, np.int32)
        self.begin = np.zeros(1 << 12, np.int64)
        self.ids = np.zeros(1 << 14, self.dtype or "u1")
        self.size = np.zeros(1 << 12, np.int32)
        self.at = np.zeros(1 << 12, np.int64)
        self.again = np.zeros(1 << 12, bool)  # met in a later part
        self.bytes = np.zeros(1 << 14, np.uint8)  # eight more than are held, at least

    def room_taken(self) -> int:
        return sum(a.nbytes for a in (self.keys, self.slot, self.lens, self.begin, self.ids, self.size, self.at, self.again,
                                      self.bytes))

    def thin(self) -> None:
        """Forget the entries that were not met again, or all."""
        at = np.flatnonzero(self.keys)
        at = at[self.again[self.slot[at]]]
        hashes, entry = self.keys[at], self.slot[at]
        kept = np.zeros(self.n, bool)
        kept[entry] = True
        lens, size = self.lens[:self.n][kept], self.size[:self.n][kept]
        flat = self.ids[:self.used][np.repeat(kept, self.lens[:self.n])] if self.dtype else self.ids[:0]
        raw = self.bytes[:self.held][np.repeat(kept, self.size[:self.n])]
        number = np.cumsum(kept) - 1
        self.forget()
        if 3 * len(lens) <= self.limit and 3 * (flat.nbytes + len(raw) + 80 * len(lens)) <= self.room:  # grown, they take twice that
            self._add(lens, flat, size, raw)
            self._place(hashes, number[entry])

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Entry of each hash, -1 if unknown."""
        out = np.full(len(h), -1, np.int64)
        left, at = np.arange(len(h)), (h & np.uint64(self.mask)).astype(np.int64)
        while len(left):
            key = self.keys[at]
            hit = key == h[left]
            out[left[hit]] = self.slot[at[hit]]
            go = ~hit & (key != 0)
            left, at = left[go], (at[go] + 1) & self.mask
        return out

    def _place(self, h: np.ndarray, entry: np.ndarray) -> None:
        """Put distinct new hashes into the table; at most half of its places are ever taken."""
        if 2 * (self.placed + len(h)) > len(self.keys):
            known = np.flatnonzero(self.keys)
            h, entry = np.concatenate((self.keys[known], h)), np.concatenate((self.slot[known], entry))
            self.mask, self.placed = (1 << (4 * len(h) - 1).bit_length()) - 1, 0
            self.keys, self.slot = np.zeros(self.mask + 1, np.uint64), np.zeros(self.mask + 1, np.int32)
        self.placed += len(h)
        at = (h & np.uint64(self.mask)).astype(np.int64)
        left = np.arange(len(h))
        while len(left):
            free = np.flatnonzero(self.keys[at] == 0)
            first = free[np.unique(at[free], return_index=True)[1]]  # one of those that want the same place
            self.keys[at[first]] = h[left[first]]
            self.slot[at[first]] = entry[left[first]]
            rest = np.ones(len(left), bool)
            rest[first] = False
            left, at = left[rest], (at[rest] + 1) & self.mask

    @staticmethod
    def _grown(a: np.ndarray, n: int) -> np.ndarray:
        return a if len(a) >= n else np.concatenate((a, np.zeros(max(n, 2 * len(a)) - len(a), a.dtype)))

    def _learn(self, segments: list[bytes]) -> np.ndarray:
        """New entries for the segments; returns their numbers."""
        got = self.compute([s.decode("utf-8") for s in segments])
        if self.dtype is None:
            lens, flat = np.array(got, np.int64), self.ids[:0]
        elif isinstance(got, tuple):
            flat, lens = got
        else:
            flat = np.frombuffer(b"".join(got), self.dtype)
            lens = np.array([len(g) for g in got], np.int64) // np.dtype(self.dtype).itemsize
        return self._add(lens, flat, np.array([len(s) for s in segments], np.int64),
                         np.frombuffer(b"".join(segments), np.uint8))

    def _add(self, lens: np.ndarray, flat: np.ndarray, size: np.ndarray, raw: np.ndarray) -> np.ndarray:
        end = self.n + len(lens)
        for name in ("lens", "begin", "size", "at", "again"):
            setattr(self, name, self._grown(getattr(self, name), end))
        self.ids, self.bytes = self._grown(self.ids, self.used + len(flat)), self._grown(self.bytes, self.held + len(raw) + 8)
        self.lens[self.n:end], self.size[self.n:end], self.again[self.n:end] = lens, size, False
        self.begin[self.n:end] = self.used + np.cumsum(lens) - lens
        self.at[self.n:end] = self.held + np.cumsum(size) - size
        self.ids[self.used:self.used + len(flat)] = flat
        self.bytes[self.held:self.held + len(raw)] = raw
        entry = np.arange(self.n, end)
        self.n, self.used, self.held = end, self.used + len(flat), self.held + len(raw)
        return entry

    def _others(self, raw: np.ndarray, begin: np.ndarray, size: np.ndarray, entry: np.ndarray) -> np.ndarray:
        """Segments whose bytes are not those of their entry; `raw` has eight bytes more."""
        odd = self.size[entry] != size
        long = np.flatnonzero(~odd & (size > SHORT))
        left, done = np.flatnonzero(~odd & (size <= SHORT)), 0
        here, there = _eights(raw), _eights(self.bytes)
        while len(left):
            differ = (here[begin[left] + done] ^ there[self.at[entry[left]] + done]).view("<u8")[:, 0]
            beyond = np.maximum(8 - (size[left] - done), 0).astype(np.uint64)  # bytes of the eight that follow the segment
            odd[left[differ << (np.uint64(8) * beyond) != 0]] = True
            done += 8
            left = left[size[left] > done]
        n = size[long]
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        wrong = raw[np.repeat(begin[long], n) + place] != self.bytes[np.repeat(self.at[entry[long]], n) + place]
        odd[np.repeat(long, n)[wrong]] = True
        return np.flatnonzero(odd)

    def _part(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        whole = b"".join(texts)
        sizes = np.array([len(t) for t in texts], np.int64)
        counts = np.zeros(len(texts), np.int64)
        if not len(whole):
            return counts, self.ids[:0]
        padded = np.frombuffer(whole + bytes(8), np.uint8)
        raw = padded[:-8]
        starts = np.cumsum(sizes) - sizes
        begin = cuts(raw, starts[sizes > 0])
        end = np.append(begin[1:], len(raw))
        h = span_hashes(raw, begin, end)
        h[h == 0] = 1
        entry = self._find(h)
        unknown = np.flatnonzero(entry < 0)
        self.again[entry[entry >= 0]] = True
        if len(unknown):
            new, first, number = np.unique(h[unknown], return_index=True, return_inverse=True)
            first = unknown[first]
            made = self._learn([whole[a:b] for a, b in zip(begin[first].tolist(), end[first].tolist())])
            self._place(new, made)
            entry[unknown] = made[number]
        odd = self._others(padded, begin, end - begin, entry)
        if len(odd):
            parts = [whole[a:b] for a, b in zip(begin[odd].tolist(), end[odd].tolist())]
            number = {s: i for i, s in enumerate(dict.fromkeys(parts))}
            entry[odd] = self._learn(list(number))[[number[s] for s in parts]]
        lens = self.lens[entry]
        total = np.concatenate(([0], np.cumsum(lens)))
        edge = np.searchsorted(begin, np.append(starts, len(raw)))
        counts = total[edge[1:]] - total[edge[:-1]]
        if self.dtype is None:
            return counts, self.ids[:0]
        at = np.repeat(self.begin[entry] - total[:-1], lens) + np.arange(total[-1])
        return counts, self.ids[at]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(tokens of each text, ids of all texts one after the other; no ids if `dtype` is None)."""
        counts, flat, part, size = [], [], [], 0
        for i, text in enumerate(texts):
            part.append(text.encode("utf-8"))
            size += len(part[-1])
            if size >= PART or i == len(texts) - 1:
                if self.n > self.limit or self.room_taken() > self.room:
                    self.thin()
                c, f = self._part(part)
                counts.append(c)
                flat.append(f)
                part, size = [], 0
        if not counts:
            return np.zeros(0, np.int64), self.ids[:0]
        return np.concatenate(counts), np.concatenate(flat)
