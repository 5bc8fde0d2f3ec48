"""Sizes of one task's share of a scan and of a shuffle: set where unset, a cluster's own choice stays."""

import __spark_entry__ as entry

SIZES = {"spark.sql.files.maxPartitionBytes": "32m", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m"}


def test_task_sizes(spark):
    before = {k: spark.conf.get(k, None) for k in SIZES}
    try:
        for k in SIZES:
            spark.conf.unset(k)
        entry._prepare(spark)
        assert {k: spark.conf.get(k) for k in SIZES} == SIZES
        for k in SIZES:
            spark.conf.set(k, "5m")
        entry._prepare(spark)
        assert {spark.conf.get(k) for k in SIZES} == {"5m"}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
