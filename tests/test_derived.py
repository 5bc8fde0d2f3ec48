"""Derived partitions: conditions on source columns prune, and never change the rows."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from cumulo.sources import derived as D
from cumulo.sources.io import plan_text

SCHEMA = "id long, at timestamp, n long, s string"
ROWS = [(i, None if i % 17 == 0 else dt.datetime(2020 + i % 3, 1 + i % 12, 1 + i % 28, i % 24), None if i % 13 == 0 else i * 7 - 500,
         f"x{i % 5}") for i in range(400)]
SPEC = [D.Transform("at", "year"), D.Transform("at", "month"), D.Transform("n", "truncate", 1000), D.Transform("s", "bucket", 3)]


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = os.path.join(tmp_path_factory.mktemp("derived"), "t")
    D.write(spark.createDataFrame(ROWS, SCHEMA), path, SPEC)
    return path


@pytest.mark.parametrize("where", [
    [("at", ">=", dt.datetime(2021, 5, 3))], [("at", "<", dt.datetime(2021, 5, 3)), ("at", ">", dt.datetime(2020, 7, 1))],
    [("at", "=", dt.datetime(2021, 2, 2, 1))], [("at", "is null")], [("n", "<=", -3)], [("n", ">", 999), ("s", "=", "x2")],
    [("s", "in", ["x0", "x4", "none"])], [("n", "in", [-500, 207])], [("id", "<", 50), ("s", ">", "x1")], [("s", "=", "absent")], []])
def test_rows_are_those_of_the_plain_filter(spark, table, where):
    plain = spark.createDataFrame(ROWS, SCHEMA)
    for column, op, *value in where:
        c = F.col(column)
        plain = plain.where(c.isNull() if op == "is null" else c.isin(value[0]) if op == "in" else D.OPS[op](c, F.lit(value[0])))
    got = D.scan(spark, table, where)
    assert got.columns == ["id", "at", "n", "s"]
    assert sorted(map(repr, got.collect())) == sorted(map(repr, plain.collect()))


@pytest.mark.parametrize("where,column", [([("at", ">=", dt.datetime(2021, 5, 3))], "at_month"), ([("s", "=", "x2")], "s_bucket3"),
                                          ([("n", "<", 0)], "n_truncate1000"), ([("at", "is null")], "at_year")])
def test_partitions_are_pruned(spark, table, where, column):
    df = D.scan(spark, table, where)
    filters = [line for line in plan_text(df).splitlines() if line.startswith("PartitionFilters")]
    assert filters and column in filters[0]
    assert 0 < len({r.f for r in df.select(F.col("_metadata.file_path").alias("f")).distinct().collect()}) < len(
        spark.read.parquet(table).inputFiles())


def test_spec_is_stored(spark, table):
    assert D.transforms_of(spark, table) == SPEC
