"""Sources and sinks: CSV + typed projection, upsert, idempotent partition writes, contracts."""

import os

from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType
from pyspark.testing import assertDataFrameEqual

from cumulo.operators.growth import growth_accounting_backfill
from cumulo.sources import io
from cumulo.sources.specs import GROWTH_STATES, TableSpec


def test_csv_and_apply_schema(spark, scratch):
    p = os.path.join(scratch, "maps.csv")
    with open(p, "w") as f:
        f.write("mapid,name,size\nm1,Alpha,10\nm2,Beta,x\n")
    raw = io.read_csv(spark, p)
    typed = io.apply_schema(raw, StructType([StructField("mapid", StringType()), StructField("size", LongType())]))
    assert [tuple(r) for r in typed.orderBy("mapid").collect()] == [("m1", 10), ("m2", None)]


def test_upsert_replaces_keys(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    u = spark.createDataFrame([(2, "B"), (3, "C")], "k long, v string")
    assertDataFrameEqual(io.upsert(t, u, ["k"]),
                         spark.createDataFrame([(1, "a"), (2, "B"), (3, "C")], "k long, v string"))


def test_partition_overwrite_is_idempotent(spark, scratch):
    path = os.path.join(scratch, "snap")
    d1 = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-01")], "k long, date string")
    d2 = spark.createDataFrame([(1, "2024-01-02")], "k long, date string")
    io.write_partitioned(d1, path, ["date"])
    io.write_partitioned(d2, path, ["date"])
    io.write_partitioned(d2, path, ["date"])     # re-run of one day replaces only that day
    assert spark.read.parquet(path).groupBy("date").count().orderBy("date").collect()[1]["count"] == 1
    assert spark.read.parquet(path).count() == 3


def test_table_spec_contract(spark):
    days = spark.createDataFrame([(1, "2024-01-01"), (1, "2024-01-02"), (2, "2024-01-02")],
                                 "user_id long, d string").select("user_id", F.to_date("d").alias("event_date"))
    g = growth_accounting_backfill(days, "user_id", "2024-01-03")
    spec = TableSpec("users_growth_accounting",
                     StructType([StructField("user_id", LongType()), StructField("date", DateType()),
                                 StructField("daily_active_state", StringType())]),
                     key=("user_id", "date"), allowed={"daily_active_state": GROWTH_STATES})
    assert spec.violations(spec.conform(g)).count() == 0
    bad = g.withColumn("daily_active_state", F.lit("Gone")).unionByName(g)
    issues = {r.issue for r in spec.violations(bad).collect()}
    assert issues == {"duplicate_key", "bad_daily_active_state"}


def test_layout_and_catalog_helpers(spark, scratch):
    df = spark.range(100).withColumn("g", F.col("id") % 3)
    io.ensure_database(spark, "cumulo_t")
    assert "cumulo_t" in {d.name for d in spark.catalog.listDatabases()}
    io.create_table_as(df, "t_ctas")
    assert "t_ctas" in {r.name for r in io.list_tables(spark).collect()}
    io.insert_into(df.select("g", "id"), "t_ctas")   # reordered by name before the positional insert
    assert spark.table("t_ctas").count() == 100
    io.drop_table(spark, "t_ctas")
    rep = io.layout_report({"a": spark.read.parquet(io.write_partitioned(df, os.path.join(scratch, "l"), ["g"])
                                                    or os.path.join(scratch, "l"))})
    assert rep.first().num_files >= 3


def test_scale_settings():
    from cumulo.session import scale_settings
    s = scale_settings(100 * 1024 ** 4)
    assert int(s["spark.sql.shuffle.partitions"]) == 409_600
    assert int(scale_settings(10 * 1024 ** 3)["spark.sql.shuffle.partitions"]) == 40


def test_year_partition_pruning(spark, scratch):
    from cumulo.plans import adapters as A
    from tests.conftest import SF_SMALL
    path = os.path.join(scratch, "matches_by_year")
    m = io.with_year_partition(A.matches(spark, SF_SMALL), "completion_date")
    io.write_partitioned(m, path, ["year"])
    q = spark.read.parquet(path).filter(F.col("year") == 1996)
    assert "PartitionFilters: [isnotnull(year" in io.plan_text(q) and "(year" in io.plan_text(q)
    assert q.count() == m.filter(F.col("year") == 1996).count()


def test_schema_drift_rows(spark):
    from cumulo.operators.health import schema_drift
    df = spark.createDataFrame([(1, "a", 2.0)], "id long, name string, extra double")
    spec = StructType([StructField("id", StringType()), StructField("name", StringType()),
                       StructField("missing", LongType())])
    got = {(r.column, r.issue) for r in schema_drift(spark, df, spec).collect()}
    assert got == {("id", "type_changed"), ("missing", "missing"), ("extra", "unexpected")}


def test_exposures_and_cells(spark):
    from cumulo.operators.experiment import assign_cells, exposures
    users = spark.range(2000).withColumnRenamed("id", "user_id")
    cells = assign_cells(users, "user_id", "exp1", (("control", 50), ("treatment", 50)))
    counts = {r.cell: r["count"] for r in cells.groupBy("cell").count().collect()}
    assert set(counts) == {"control", "treatment"} and 850 < counts["control"] < 1150
    again = assign_cells(users, "user_id", "exp1", (("control", 50), ("treatment", 50)))
    assert cells.exceptAll(again).count() == 0                  # deterministic
    other = assign_cells(users, "user_id", "exp2", (("control", 50), ("treatment", 50)))
    assert cells.join(other, "user_id").filter(cells.cell != other.cell).count() > 0   # independent salt
    ev = spark.createDataFrame([(1, "click"), (1, "view"), (5, "view")], "user_id long, kind string")
    assert exposures(ev, cells, "user_id").count() == 3


def test_checkpoint_dir_comes_from_the_session(spark):
    from cumulo.session import ensure_checkpoint_dir
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert configured and ensure_checkpoint_dir(spark) == configured
    assert spark.sparkContext._jsc.sc().getCheckpointDir().get().startswith("file:" + configured) or \
        spark.sparkContext._jsc.sc().getCheckpointDir().get().startswith(configured)
