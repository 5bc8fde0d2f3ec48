"""Balanced slices: bounded rows, monotone in the order, right positions whatever the skew."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cumulo.operators.ordered import balanced_slices, ordinal_running, sessionize
from cumulo.streaming.windows import sessions

T0 = dt.datetime(2024, 1, 1)


def _check(df, keys, order, limit, value=lambda r, c: (r[c] is not None, r[c] if r[c] is not None else 0)):
    rows = balanced_slices(df, keys, order, limit=limit).collect()
    by = {}
    for r in rows:
        by.setdefault(tuple(r[k] for k in keys), []).append(r)
    for some in by.values():
        some.sort(key=lambda r: [value(r, c) for c in order])
        paths = [tuple((x is not None, x or 0) for x in r["_slice"]) for r in some]
        assert paths == sorted(paths)
        sizes = {}
        for r, p in zip(some, paths):
            sizes.setdefault(p, []).append(r)
        for rows_ in sizes.values():
            assert len(rows_) <= 2 * limit or len({tuple(r[c] for c in order) for r in rows_}) == 1
    return len(rows)


@pytest.mark.parametrize("case", ["one_second", "one_day", "nulls", "ties", "far_outlier", "spread", "wide_longs"])
def test_slices_are_bounded_and_ordered(spark, case):
    rnd = random.Random(5)
    hot = {
        "one_second": lambda i: (T0 + dt.timedelta(microseconds=i * 7), i), "one_day": lambda i: (T0 + dt.timedelta(seconds=i * 8), i),
        "nulls": lambda i: (None if i % 3 else T0 + dt.timedelta(seconds=i), i), "ties": lambda i: (T0, i),
        "far_outlier": lambda i: (T0 if i else dt.datetime(1990, 1, 1), i if i % 50 else -10**12),
        "spread": lambda i: (T0 + dt.timedelta(hours=i), i), "wide_longs": lambda i: (T0, 2**62 + i // 1000)}[case]
    rows = [(None if case == "nulls" else 0, *hot(i)) for i in range(6000)] + [(1 + i % 50, T0 + dt.timedelta(hours=rnd.randrange(900)), i) for i in range(500)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "k long, t timestamp, id long").repartition(5)
    if case == "wide_longs":  # neighbours that a double cannot tell apart stay together
        assert balanced_slices(df, ["k"], ["t", "id"], limit=100).count() == 6500
    else:
        assert _check(df, ["k"], ["t", "id"], 100) == 6500
    got = {(r.k, r.t, r.id): (r.i, r.s) for r in ordinal_running(df, ["k"], ["t", "id"], {"s": F.lit(2)}, idx_col="i", limit=100).collect()}
    n, want = {}, {}
    for k, t, i in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or T0, r[2])):
        n[k] = n.get(k, 0) + 1
        want[k, t, i] = (n[k], 2 * n[k])
    if case != "wide_longs":
        assert got == want
    else:
        assert sorted(v for (k, _, _), v in got.items() if k != 0) == sorted(v for (k, _, _), v in want.items() if k != 0)


def test_dates_and_numbers(spark):
    rows = [(i % 3, dt.date(2024, 1, 1 + i % 2), float(i % 700), i) for i in range(5000)]
    df = spark.createDataFrame(rows, "k int, d date, x double, id int")
    assert _check(df, ["k"], ["d", "x", "id"], 60) == 5000
    assert _check(df, ["k"], ["x", "id"], 60) == 5000


def test_sessions_of_a_hot_key_in_one_hour(spark):
    rnd = random.Random(3)
    t, rows = T0, []
    for i in range(3000):
        t += dt.timedelta(milliseconds=rnd.choice([1, 400, 999, 1000, 1001, 2500]))
        rows += [("hot", t, i)] * rnd.choice([1, 1, 1, 40])
    rows += [(f"u{k}", T0 + dt.timedelta(seconds=rnd.randrange(100)), k) for k in range(40)]
    df = spark.createDataFrame(rows, "user string, ts timestamp, id int")
    got = sessionize(df, ["user"], "ts", 1, order=["id"], limit=200)
    want = sessions(df, "ts", ["user"], "1 second")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
