"""Pipeline health checks (O1-O7), each returning rows that describe issues."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cumulo.functions.columns import safe_ratio
from cumulo.operators.sketches import day_bitmaps, rolling_active


def missing_partitions(df: DataFrame, date_col: str, start: Column, end: Column,
                       out: str = "missing_date") -> DataFrame:
    """O1: expected days in [start, end] with no rows.

    The expected calendar is `explode(sequence(start, end))` (bounds may be
    scalar subqueries over the data); present days are a distinct
    aggregate; the anti join is on the date.
    """
    present = df.select(F.col(date_col).alias(out)).distinct()
    cal = df.sparkSession.range(1).select(F.explode(F.sequence(start, end)).alias(out))
    return cal.join(present, on=out, how="left_anti")


def duplicate_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """O2: keys occurring more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("num_rows")).filter(F.col("num_rows") > 1)


def schema_drift(spark: SparkSession, df: DataFrame, spec: StructType) -> DataFrame:
    """O3: columns missing, unexpected or of another type than the spec
    (metadata only: compares two schemas)."""
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    want = {f.name: f.dataType.simpleString() for f in spec.fields}
    rows = []
    for c, t in want.items():
        if c not in have:
            rows.append((c, t, None, "missing"))
        elif have[c] != t:
            rows.append((c, t, have[c], "type_changed"))
    for c, t in have.items():
        if c not in want:
            rows.append((c, None, t, "unexpected"))
    return spark.createDataFrame(rows, "column string, expected string, actual string, issue string")


def late_arrival(df: DataFrame, event_col: str, load_col: str, group: Sequence[str] = (),
                 late_days: int = 60) -> DataFrame:
    """Delay between event and arrival in days: count, late count, max,
    mean and the exact 90th percentile (the smallest delay that at least 90%
    of the rows with a delay do not exceed).

    Rows are counted per delay first, so a group's percentile is found among
    its distinct delays, not among its rows.
    """
    lag = F.datediff(F.col(load_col), F.col(event_col))
    seen = df.groupBy(*group, lag.alias("_lag")).agg(F.count(F.lit(1)).alias("_c"))
    known = F.when(F.col("_lag").isNotNull(), F.col("_c"))
    w = Window.partitionBy(*group)
    upto = F.sum(known).over(w.orderBy("_lag").rowsBetween(Window.unboundedPreceding, 0))
    ranked = seen.withColumn("_p", F.when(upto * 10 >= F.sum(known).over(w) * 9, F.col("_lag")))
    return ranked.groupBy(*group).agg(
        F.sum("_c").alias("num_rows"), F.sum(F.when(F.col("_lag") > late_days, F.col("_c")).otherwise(0)).alias("num_late"),
        F.max("_lag").alias("max_lag_days"),
        (F.sum(F.col("_lag") * F.col("_c")).cast("double") / F.sum(known)).alias("mean_lag_days"),
        F.min("_p").alias("p90_lag_days"))


def segment_coverage(df: DataFrame, dim: str, expected: Sequence[str], out: str = "missing_segment") -> DataFrame:
    """Expected segment values with no rows (e.g. a platform that stopped reporting)."""
    spark = df.sparkSession
    exp = spark.createDataFrame([(v,) for v in expected], f"{out} string")
    present = df.select(F.col(dim).alias(out)).distinct()
    return exp.join(present, on=out, how="left_anti")


def null_contract(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULL count per column that must not be NULL, one scan, one row per column."""
    agg = df.agg(F.count(F.lit(1)).alias("num_rows"),
                 *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return agg.unpivot(["num_rows"], list(cols), "column_name", "null_count")


def engagement_kpi(events: DataFrame, user: str, day: str) -> DataFrame:
    """Per day events and active users of 1, 7 and 28 days (exact, from daily bitmaps), events per active user
    and stickiness (daily over monthly active users); events without a user are not counted."""
    known = events.where(F.col(user).isNotNull())
    active = rolling_active(day_bitmaps(known, user, day), day, {"daily_active": 1, "weekly_active": 7, "monthly_active": 28})
    per_day = known.groupBy(day).agg(F.count(F.lit(1)).alias("num_events"))
    j = active.join(per_day, day, "left").withColumn("num_events", F.coalesce("num_events", F.lit(0)))
    return j.select(day, "num_events", "daily_active", "weekly_active", "monthly_active",
                    safe_ratio(F.col("num_events"), F.col("daily_active")).alias("events_per_user"),
                    safe_ratio(F.col("daily_active"), F.col("monthly_active")).alias("stickiness"))


def profit_kpi(lineitem: DataFrame, group: Sequence[str]) -> DataFrame:
    """revenue = price x (1 - discount), summed exactly in cents x percent.

    Cents are split into millions and the rest, both multiplied and summed as 64-bit integers, so no decimal
    is made per row; the sums stay in range for 9e10 rows of a group with the rest alone and, for prices up to a
    million, 9e14 rows with the millions; beyond it they raise an error, they do not wrap."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    pct = F.round(F.col("l_discount") * 100).cast("bigint")
    g = lineitem.withColumns({"_cents": cents, "_pct": F.lit(100) - pct}).groupBy(*group).agg(
        F.count(F.lit(1)).alias("num_items"),
        F.sum(F.expr("_cents div 1000000") * F.col("_pct")).alias("_high"),
        F.sum(F.col("_cents") % 1000000 * F.col("_pct")).alias("_low"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("units"))
    whole = F.col("_high").cast("decimal(38,0)") * F.lit(1000000).cast("decimal(7,0)") + F.col("_low").cast("decimal(38,0)")
    rev = whole.cast("double") / 10000.0
    return g.select(*group, "num_items", "units", rev.alias("revenue"),
                    (rev / F.col("units").cast("double")).alias("revenue_per_unit"))
