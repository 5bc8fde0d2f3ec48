"""Stored-table queries write the whole history, not a prefix of it."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from cumulo.plans import adapters as A
from tests.conftest import SF_SMALL


def test_every_event_day_is_stored_and_returned(spark):
    act = A.web_events(spark, SF_SMALL).filter(F.col("user_id").isNotNull())
    lo, hi = act.agg(F.min("event_date"), F.max("event_date")).first()
    n = (hi - lo).days + 1
    assert n > 4
    per_day = E.queries()["snapshot_days"](spark, SF_SMALL).groupBy("date").agg(F.sum("num_users").alias("n")).collect()
    assert len(per_day) == n and max(r.n for r in per_day) == act.select("user_id").distinct().count()
    out = E.queries()["snapshot_all_days"](spark, SF_SMALL)
    assert out.select("date").distinct().count() == n
    assert out.select("user_id").distinct().count() == act.select("user_id").distinct().count()


def test_orders_are_dealt_by_customer(spark):
    out = E.queries()["orders_by_customer"](spark, SF_SMALL).withColumn("file", F.input_file_name())
    assert out.select("file").distinct().count() == 8
    assert out.groupBy("o_custkey").agg(F.count_distinct("file").alias("n")).where("n > 1").count() == 0


def test_orders_are_in_one_order_over_all_files(spark):
    out = E.queries()["orders_sorted"](spark, SF_SMALL).withColumn("part", F.regexp_extract(F.input_file_name(), "part-([0-9]+)", 1).cast("int"))
    rows = out.withColumn("row", F.monotonically_increasing_id()).collect()
    rows = [(r.o_custkey, r.o_orderkey) for r in sorted(rows, key=lambda r: (r.part, r.row))]
    assert rows == sorted(rows)
