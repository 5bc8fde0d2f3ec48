"""Plain Python versions of the operators, for small tables."""

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lower(text):
    return (text or "").translate(LOW)


def shingles(text, k):
    w = WORD.findall(lower(text))
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def components(rows, k, percent):
    """id -> smallest id reachable, for rows with distinct ids."""
    sets = {i: shingles(t, k) for i, t in rows}
    label = {i: i for i in sets}
    shared = Counter()
    by = {}
    for i, s in sets.items():
        for x in s:
            for j in by.get(x, ()):
                shared[j, i] += 1
            by.setdefault(x, []).append(i)

    def root(i):
        while label[i] != i:
            i = label[i]
        return i
    for (i, j), n in shared.items():
        if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
            a, b = root(i), root(j)
            label[max(a, b)] = min(a, b)
    return {i: root(i) for i in sets}


def without_repeats(rows, length):
    """id -> (words, removed, digest of what is kept), rows in id order, ids distinct."""
    seen, out = set(), {}
    for i, text in rows:
        w = WORD.findall(text or "")
        gone = [False] * len(w)
        for a in range(len(w) - length + 1):
            key = tuple(w[a:a + length])
            if key in seen:
                gone[a:a + length] = [True] * length
            seen.add(key)
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[i] = len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()
    return out
