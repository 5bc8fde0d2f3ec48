"""Experiment readout statistics on a known fixture; the command-line listing."""

import math

from cumulo.operators.experiment import experiment_readout


def test_readout_two_proportion_z(spark):
    rows = [(i, "control", 1 if i < 10 else 0, 100) for i in range(100)]
    rows += [(100 + i, "treatment", 1 if i < 20 else 0, 300 if i < 50 else 100) for i in range(100)]
    users = spark.createDataFrame(rows, "user_id long, cell string, converted int, value_cents long")
    r = {x.cell: x for x in experiment_readout(users).collect()}
    c, t = r["control"], r["treatment"]
    assert (c.users, c.conversions, t.conversions) == (100, 10, 20)
    assert math.isclose(t.lift, 1.0) and c.z is None
    pool = 30 / 200
    z = (0.2 - 0.1) / math.sqrt(pool * (1 - pool) * (2 / 100))
    assert math.isclose(t.z, z, rel_tol=1e-12)
    assert math.isclose(t.mean_value, 2.0) and math.isclose(c.var_value, 0.0, abs_tol=1e-12)
    # sample variance of 50 x 3.0 and 50 x 1.0
    assert math.isclose(t.var_value, (100 * 1.0) / 99, rel_tol=1e-12)


def test_cli_lists_queries(capsys):
    from cumulo.__main__ import main
    assert main(["list"]) == 0
    out = capsys.readouterr().out
    assert "scd2_backfill" in out and len(out.strip().splitlines()) >= 60


def test_large_amounts_neither_overflow_nor_cancel(spark):
    from pyspark.sql import functions as F

    from cumulo.operators import health as H
    from cumulo.operators.experiment import experiment_readout
    li = spark.range(50).selectExpr("'A' AS g", "1e15 AS l_extendedprice", "0.0D AS l_discount", "1.0D AS l_quantity")
    r = H.profit_kpi(li, ["g"]).first()
    assert abs(r.revenue / 5e16 - 1) < 1e-12
    users = spark.range(100).selectExpr("'control' AS cell", "0 AS converted", "10000000000 + (id % 2) AS value_cents")
    assert math.isclose(experiment_readout(users).first().var_value, 0.25 * 100 / 99 / 10_000, rel_tol=1e-6)
    lags = spark.createDataFrame([(d,) for d in [1] * 8 + [5, 9]] + [(None,)], "d int").select(
        F.lit("2024-01-01").cast("date").alias("e"), F.date_add(F.lit("2024-01-01").cast("date"), F.col("d")).alias("l"))
    got = H.late_arrival(lags, "e", "l", late_days=4).first()
    assert (got.num_rows, got.num_late, got.max_lag_days, got.mean_lag_days, got.p90_lag_days) == (11, 2, 9, 2.2, 5)
