"""Fill-in-middle: the compressed set against a sorted list, the transformation against plain Python."""

import hashlib
import re

import numpy as np
import pytest

from cumulo.llm import fill_in_middle as fim
from tests.llm.conftest import TRICKY


def _plain(key, text, seed=7, rate=100, spm=50):
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    d = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    h = [int(d[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(lines) + 1), h[1] % (len(lines) + 1)))
    p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(lines), "plain", None, None, text
    if h[3] % 100 < spm:
        return len(lines), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(lines), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("kind", ["sparse", "dense", "runs", "mixed", "edges", "empty"])
def test_select_equals_sorted_list(kind):
    rng = np.random.default_rng(3)
    offsets = {
        "sparse": np.unique(rng.integers(0, 10**7, 900)), "dense": np.unique(rng.integers(0, 200_000, 150_000)),
        "runs": np.concatenate([np.arange(a, a + 3000) for a in (5, 65_000, 131_072, 400_000)]),
        "mixed": np.unique(np.concatenate((np.arange(70_000), rng.integers(70_000, 2**20, 9000), [2**33, 2**33 + 2**16]))),
        "edges": np.array([0, 1, 65_535, 65_536, 131_071, 131_072]), "empty": np.zeros(0, np.int64)}[kind]
    s = fim.BoundarySet(offsets)
    assert len(s) == len(offsets)
    ks = range(len(offsets)) if len(offsets) < 5000 else rng.integers(0, len(offsets), 3000).tolist() + [0, len(offsets) - 1]
    assert all(s.select(int(k)) == offsets[k] for k in ks)
    for k in (-1, len(offsets)):
        with pytest.raises(IndexError):
            s.select(k)


def test_smallest_container():
    assert isinstance(fim.container(np.arange(60_000)), fim.RunContainer)
    assert isinstance(fim.container(np.arange(0, 8000, 2)), fim.ArrayContainer)
    assert isinstance(fim.container(np.arange(0, 60_000, 3)), fim.BitmapContainer)


@pytest.mark.parametrize("rate,spm", [(100, 50), (40, 0), (100, 100), (0, 50)])
def test_transformed_and_restored(spark_llm, tricky, rate, spm):
    more = [(20 + i, t) for i, t in enumerate((
        "\n", "\n\n\n", "a\n", "a\nb", "a\r\nb c\x0bd\ne", "<P>\nx", "x<S", "<\n<\n<P\nS>\nM>", "<M", "é\n中\n😀\n" * 50,
        "line\n" * 70_000, "x\n" * 40_000 + "y" * 300_000, "\n" * 140_000))]
    df = tricky.select("doc_id", "text", "n", "seed").unionByName(
        spark_llm.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    rows = [(i, t) for i, t, _ in TRICKY] + more
    got = fim.restore(fim.fill_in_middle(df, rate=rate, spm=spm)).collect()
    want = [(i, *_plain("" if i is None else i, t or "", 7, rate, spm), t or "") for i, t in rows]
    have = [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored) for r in got]
    assert sorted(have, key=repr) == sorted(want, key=repr)


def test_empty(empty):
    assert fim.restore(fim.fill_in_middle(empty)).count() == 0
