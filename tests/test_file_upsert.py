"""File-wise upsert: rows as a plain replace, untouched files keep their names, failed versions are not seen."""

import os

import pytest
from pyspark.sql import functions as F

from cumulo.sources import file_upsert as U


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_untouched_files_keep_their_names(spark, scratch):
    path = os.path.join(scratch, "t")
    base = spark.range(4000).select("id", (F.col("id") * 2).alias("v"))
    U.create(base, path, ["id"], buckets=4, per_file=100)
    before = {r.file: r for r in U.live_files(spark, path).collect()}
    assert len(before) >= 40 and sum(r.n for r in before.values()) == 4000
    assert _rows(U.read(spark, path)) == _rows(base)
    updates = spark.createDataFrame([(77, -1), (78, -2), (9999, -3)], "id long, v long")
    replaced = U.upsert(spark, path, updates, ["id"], buckets=4, per_file=100)
    after = {r.file for r in U.live_files(spark, path).collect()}
    assert len(replaced) <= 3 and set(before) - after == set(replaced)
    want = dict(_rows(base)) | {77: -1, 78: -2, 9999: -3}
    assert dict(_rows(U.read(spark, path))) == want
    for f in after & set(before):
        assert os.path.exists(f.removeprefix("file:"))


def test_filter_admits_every_key_and_few_others(spark, scratch):
    path = os.path.join(scratch, "t")
    U.create(spark.range(0, 60_000, 2).select("id"), path, ["id"], buckets=2, per_file=7000)
    n = U.live_files(spark, path).count()
    inside = U.touched_files(spark, path, spark.range(0, 60_000, 2).select("id"), ["id"], buckets=2)
    assert inside.count() == n
    wrong = sum(U.touched_files(spark, path, spark.range(i, i + 1).select("id"), ["id"], buckets=2).count()
                for i in range(1, 2001, 100))  # ids that are not there
    assert wrong <= 2


def test_null_keys_repeats_and_two_columns(spark, scratch):
    path = os.path.join(scratch, "t")
    schema = "host string, month date, n int"
    base = spark.createDataFrame([("a", None, 1), (None, None, 2), ("b", None, 3), ("b", None, 4)], schema)
    U.create(base, path, ["host", "month"], buckets=3)
    U.upsert(spark, path, spark.createDataFrame([(None, None, 20), ("b", None, 30), ("b", None, 31), ("c", None, 5)], schema),
             ["host", "month"], buckets=3)
    assert sorted(r.n for r in U.read(spark, path).collect()) == [1, 5, 20, 30, 31]
    assert U.upsert(spark, path, base.where("false"), ["host", "month"], buckets=3) == []
    assert U.version(spark, path) == 2 and sorted(r.n for r in U.read(spark, path).collect()) == [1, 5, 20, 30, 31]


def test_incomplete_version_is_not_seen(spark, scratch):
    path = os.path.join(scratch, "t")
    df = spark.createDataFrame([(1, "a")], "id long, v string")
    U.create(df, path, ["id"])
    broken = df.select("id", F.expr("raise_error('no')").cast("string").alias("v"))
    with pytest.raises(Exception):
        U.upsert(spark, path, broken, ["id"])
    assert U.version(spark, path) == 0 and _rows(U.read(spark, path)) == [(1, "a")]
    U.upsert(spark, path, df.select("id", F.lit("b").alias("v")), ["id"])
    assert _rows(U.read(spark, path)) == [(1, "b")]
