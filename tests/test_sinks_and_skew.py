"""Streams feeding several sinks, late rows, and the join over heavy keys."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from cumulo.operators import joins as J
from cumulo.streaming import runner as R
from cumulo.streaming import windows as SW

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "id long, host string, ts timestamp"


def _run(spark, landing, checkpoint, writer, name):
    q = R.start(spark.readStream.schema(SCHEMA).parquet(landing), name, batch_writer=writer, checkpoint=checkpoint, available_now=True)
    q.awaitTermination()


def test_a_batch_that_fails_between_two_sinks_is_repeated(spark, scratch):
    landing, cp = os.path.join(scratch, "in"), os.path.join(scratch, "cp")
    paths = {n: os.path.join(scratch, n) for n in ("a", "b")}
    fail = {"on": False}

    def second(batch, batch_id):
        if fail["on"]:
            raise RuntimeError("sink b is down")
        return batch.select("id", "host")
    writer = R.sinks_writer(paths, {"a": lambda b, _: SW.tumbling_counts(b, "ts", ["host"]), "b": second})
    rows = [(i, "ab"[i % 2], T0 + dt.timedelta(seconds=i * 40)) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    df.where("id < 100").write.mode("append").parquet(landing)
    _run(spark, landing, cp, writer, "sinks-1")
    df.where("id >= 100 AND id < 200").write.mode("append").parquet(landing)
    fail["on"] = True
    with pytest.raises(Exception):
        _run(spark, landing, cp, writer, "sinks-2")
    assert spark.read.parquet(paths["a"]).agg(F.sum("num_hits")).first()[0] == 200  # the first sink has the batch already
    fail["on"] = False
    df.where("id >= 200").write.mode("append").parquet(landing)
    _run(spark, landing, cp, writer, "sinks-3")
    got = spark.read.parquet(paths["a"]).groupBy("window_start", "host").agg(F.sum("num_hits").alias("n")).collect()
    want = SW.tumbling_counts(df, "ts", ["host"]).collect()
    assert sorted((r.window_start, r.host, r.n) for r in got) == sorted((r.window_start, r.host, r.num_hits) for r in want)
    assert sorted(r.id for r in spark.read.parquet(paths["b"]).collect()) == list(range(300))


def test_late_and_counted_rows_add_up(spark, scratch):
    landing, cp, root = (os.path.join(scratch, n) for n in ("in", "cp", "out"))
    writer = R.late_rows_writer(spark, root, "ts", 15, 300, ["host"])
    at = lambda m, s=0: T0 + dt.timedelta(minutes=m, seconds=s)
    parts = [[(1, "a", at(0)), (2, "a", at(7)), (3, "b", None)],       # watermark before: none
             [(4, "a", at(4, 59)), (5, "b", at(5)), (6, "a", at(30))],  # 6:45: the window 0-5 is over, 5-10 is not
             [(7, "a", at(24)), (8, "a", at(25)), (9, None, at(29, 44))],  # 29:45: 20-25 is over
             [(10, "a", at(25)), (11, "b", at(60))]]
    for i, part in enumerate(parts):
        spark.createDataFrame(part, SCHEMA).write.mode("append").parquet(landing)
        _run(spark, landing, cp, writer, f"late-{i}")
    counts = {(r.window_start, r.host, r.batch_id): r.num_hits for r in spark.read.parquet(f"{root}/counts").collect()}
    late = {(r.window_start, r.host, r.batch_id): r.num_late for r in spark.read.parquet(f"{root}/late").collect()}
    assert sum(counts.values()) + sum(late.values()) == 11
    assert late == {(None, "b", 0): 1, (at(0), "a", 1): 1, (at(20), "a", 2): 1}
    assert counts[at(5), "b", 1] == 1 and counts[at(25), None, 2] == 1 and counts[at(25), "a", 3] == 1


def _facts(spark):
    rows = [(i, 7 if i % 3 == 0 else None if i % 11 == 0 else i % 40, "b" if i % 5 else None) for i in range(3000)]
    return spark.createDataFrame(rows, "id long, k long, j string").repartition(4)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("limit", [100_000, 0])
@pytest.mark.parametrize("keys", [["k"], ["k", "j"]])
def test_same_rows_as_the_plain_join(spark, how, limit, keys):
    facts = _facts(spark)
    dim = spark.createDataFrame([(k, j, f"{k}{j}{n}") for k in [*range(0, 35), None, 99] for j in ("b", None) for n in range(2)],
                                "k long, j string, name string")
    if keys == ["k"]:
        dim = dim.drop("j")
    got = J.heavy_hitter_join(facts, dim, keys, how, share=20, rows_per_task=100, broadcast_rows=limit)
    want = facts.join(dim, keys, how)
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    assert sorted(map(repr, got.select(cols).collect())) == sorted(map(repr, want.select(cols).collect()))


def test_heavy_keys_are_few_and_complete(spark):
    got = {r.k: r.n for r in J.heavy_keys(_facts(spark), ["k"], share=20).collect()}
    assert set(got) == {7} and got[7] > 1000
    assert J.heavy_keys(_facts(spark).where("false"), ["k"]).count() == 0
    with pytest.raises(ValueError):
        J.heavy_hitter_join(_facts(spark), _facts(spark), ["k"], "full")
