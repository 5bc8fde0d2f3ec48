"""Embedding near-dedup and connected components against brute force."""

import random

import numpy as np
import pytest

from cumulo.llm import embedding_dedup as ed
from cumulo.llm.components import components

SCHEMA = "vec_id long, embedding array<float>, label int, node long, x string, grp int, n long"


def _brute(rows, threshold=0.93):
    """[(id, links, component)] of rows (id, vector, label); a vector that is not sound stands alone."""
    def sound(r):
        return r[0] is not None and r[2] is not None and r[1] and all(v is not None and np.isfinite(v) for v in r[1]) and any(r[1])
    unit = [np.array(r[1], "f4").astype("f8") / np.linalg.norm(np.array(r[1], "f4").astype("f8")) if sound(r) else None for r in rows]
    n, label = [0] * len(rows), list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            a, b = unit[i], unit[j]
            if a is not None and b is not None and rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b >= threshold:
                n[i] += 1
                n[j] += 1
                label[root(i)] = root(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root(i)] = min(r[0], least.get(root(i), r[0]))
    return sorted(((r[0], n[i], least.get(root(i)) if r[0] is not None else None) for i, r in enumerate(rows)), key=repr)


def _got(spark, rows, **how):
    df = spark.createDataFrame([(*r, 1, "y", 2, 3) for r in rows], SCHEMA).repartition(3)
    out = ed.near_vectors(df, **how).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in out)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in out), key=repr), out


def _near(rng, x, cos):
    """A vector at the given cosine to the unit vector x."""
    y = rng.standard_normal(len(x))
    y -= (y @ x) * x
    return cos * x + np.sqrt(1 - cos * cos) * y / np.linalg.norm(y)


def _mixed(seed):
    rng, rows = np.random.default_rng(seed), []

    def fresh():
        x = rng.standard_normal(24)
        return x / np.linalg.norm(x)
    for label in (1, 2):
        rows += [(fresh(), label) for _ in range(300)]
        for _ in range(40):  # pairs on both sides of the threshold
            x = fresh()
            rows += [(x, label), (_near(rng, x, rng.uniform(0.90, 0.96)), label)]
        x = fresh()
        for _ in range(60):  # a chain
            rows.append((x, label))
            x = _near(rng, x, 0.95)
    hub = fresh()
    rows += [(_near(rng, hub, rng.uniform(0.955, 0.999)), 1) for _ in range(400)]  # a dense group with a rim
    rows += [(_near(rng, hub, 0.99), 2) for _ in range(30)] + [(hub, 1)] * 50
    order = rng.permutation(len(rows))
    return [(int(i), [float(v) for v in rows[j][0]], rows[j][1]) for i, j in enumerate(order)]


@pytest.mark.parametrize("k,block", [(16, 128), (4, 7)])
def test_links_match_brute_force(spark_llm, monkeypatch, k, block):
    monkeypatch.setattr(ed, "BLOCK", block)
    rows = _mixed(5)
    got, out = _got(spark_llm, rows, k=k)
    want = _brute(rows)
    have, true = sum(g[1] for g in got), sum(w[1] for w in want)
    assert have <= true and have >= 0.998 * true
    assert all(g[1] <= w[1] for g, w in zip(sorted(got), sorted(want)))  # none below the threshold
    assert out[0].audited_recall >= 0.99
    if have == true:
        assert got == want


def test_audit_sees_missing_links(spark_llm):
    rows = _mixed(6)
    df = spark_llm.createDataFrame([(*r, 1, "y", 2, 3) for r in rows], SCHEMA)
    _, nodes = ed.classes(df, "vec_id", "embedding", "label")
    nothing = nodes.select("node", (nodes.m * 0).alias("n"))
    assert ed.audited_recall(nodes, nothing, 0.93, 4000) == 0.0
    true = {i: n for i, n, _ in _brute(rows)}
    full = {r.node: true[r.least] - (r.m - 1) for r in nodes.collect()}
    found = spark_llm.createDataFrame(list(full.items()), "node long, n long")
    assert ed.audited_recall(nodes, found, 0.93, 4000) == 1.0


def test_odd_vectors(spark_llm):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [], 1), (7, [0.0, 0.0], 1),
            (8, [1.0, None], 1), (9, [nan, 1.0], 1), (10, [inf, 1.0], 1), (11, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.0], 1),
            (1, [1.0, 0.0], 1), (12, [3e38, 1e30], 1), (13, [1e-38, 1e-45], 1), (14, [-1.0, 0.0], 1), (14, [0.0, 5.0], 1), (15, [-0.0, 7.0], 1)]
    got, _ = _got(spark_llm, rows)
    assert got == _brute(rows)


def test_no_vectors(spark_llm):
    df = spark_llm.createDataFrame([], SCHEMA)
    assert ed.near_vectors(df).count() == 0
    only_bad = spark_llm.createDataFrame([(1, None, None, 1, "y", 2, 3)], SCHEMA)
    assert [tuple(r)[:4] for r in ed.near_vectors(only_bad).collect()] == [(1, 0, 1, True)]


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark_llm, seed):
    rnd = random.Random(seed)
    edges = [(rnd.randrange(400), rnd.randrange(400)) for _ in range(300)] + [(5000 + i, 5001 + i) for i in range(200)] \
        + [(9000, 9001 + i) for i in range(300)] + [(7, 7), (8888, 8888)]
    label = {x: x for e in edges for x in e}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i
    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        label[b] = a
    want = {x: root(x) for a, b in edges for x in (a, b) if a != b}
    got = components(spark_llm.createDataFrame(edges, "a long, b long")).collect()
    assert len(got) == len(want) and {r.node: r.comp for r in got} == want
    assert components(spark_llm.createDataFrame([], "a long, b long")).count() == 0
