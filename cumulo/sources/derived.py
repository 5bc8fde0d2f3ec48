"""Tables partitioned by values derived from columns, read with predicates on the columns themselves.

A partition column is derived from a source column by one of the transforms below. `write` stores the list of
transforms beside the data; `scan` takes conditions on source columns and adds, for each, the
condition on the derived column that it implies, so that Spark prunes partitions (and still applies
the given condition to the rows). A derived condition never excludes a row that the given one admits:

    year, month, day (of a date or timestamp): =, <, <=, >, >=, in, is null   (the transforms do not decrease)
    bucket (hash of the value, modulo n):      =, in, is null
    truncate (of a number, to a multiple of n):  =, <, <=, >, >=, in, is null

Defined cases: NULL source values lie in the partition of NULL and meet no condition but `is null`; a condition
on a column without a transform is applied to the rows only; a predicate on another type than the
column's is cast as Spark casts it.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ORDERED = {"year", "month", "day", "truncate"}
OPS = {"=": lambda a, b: a == b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b, ">": lambda a, b: a > b,
       ">=": lambda a, b: a >= b}


@dataclass(frozen=True)
class Transform:
    source: str
    kind: str
    n: int = 0

    @property
    def column(self) -> str:
        return f"{self.source}_{self.kind}" + (str(self.n) if self.n else "")

    def of(self, value: Column) -> Column:
        """The derived value; NULL of NULL."""
        if self.kind == "bucket":
            return F.when(value.isNotNull(), F.pmod(F.xxhash64(value), F.lit(self.n)).cast("int"))
        if self.kind == "truncate":
            return (value - F.pmod(value, F.lit(self.n))).cast("bigint")
        if self.kind == "day":
            return F.to_date(value)
        month = F.year(value) * 100 + F.month(value)
        return {"year": F.year(value), "month": month}[self.kind].cast("int")

    def implied(self, op: str, value: Column | list[Column] | None) -> Column | None:
        """What a condition on the source says about the derived column, None if nothing."""
        col = F.col(self.column)
        if op == "is null":
            return col.isNull()
        if op == "in":
            out = F.lit(False)
            for v in value:
                out = out | (col == self.of(v))
            return out
        if op == "=":
            return col == self.of(value)
        if self.kind not in ORDERED:
            return None
        return col <= self.of(value) if op in ("<", "<=") else col >= self.of(value)


def _spec(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_transforms/spec")


def write(df: DataFrame, path: str, transforms: Sequence[Transform], mode: str = "overwrite") -> None:
    """`df` partitioned by the derived columns; rows of one partition lie together, and adaptive execution splits large ones."""
    spark, names = df.sparkSession, [t.column for t in transforms]
    wide = df.withColumns({t.column: t.of(F.col(t.source)) for t in transforms})
    wide.hint("rebalance", *names).write.mode(mode).partitionBy(*names).parquet(path)
    at = _spec(spark, path)
    out = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at, True)
    try:
        out.write(bytearray(json.dumps([asdict(t) for t in transforms]).encode()))
    finally:
        out.close()


def transforms_of(spark: SparkSession, path: str) -> list[Transform]:
    at = _spec(spark, path)
    text = spark._jvm.org.apache.hadoop.fs.Path(at.toString())
    fs = text.getFileSystem(spark._jsc.hadoopConfiguration())
    reader = fs.open(text)
    try:
        raw = bytes(reader.readAllBytes())
    finally:
        reader.close()
    return [Transform(**t) for t in json.loads(raw)]


def scan(spark: SparkSession, path: str, where: Sequence[tuple] = (), keep_derived: bool = False) -> DataFrame:
    """Rows that meet all conditions (column, op, value); ops: = < <= > >= in `is null`. Values are literals."""
    specs = transforms_of(spark, path)
    df = spark.read.parquet(path)
    for column, op, *value in where:
        kind = df.schema[column].dataType
        lit = lambda v: F.lit(v).cast(kind)
        given = None if op == "is null" else [lit(v) for v in value[0]] if op == "in" else lit(value[0])
        for t in specs:
            if t.source == column and (implied := t.implied(op, given)) is not None:
                df = df.where(implied)
        c = F.col(column)
        df = df.where(c.isNull() if op == "is null" else c.isin(given) if op == "in" else OPS[op](c, given))
    return df if keep_derived else df.drop(*[t.column for t in specs])
