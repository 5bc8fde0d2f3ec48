"""Experiment assignment and readout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cumulo.functions.columns import safe_ratio, stable_bucket


def assign_cells(df: DataFrame, id_col: str, experiment: str,
                 weights: Sequence[tuple[str, float]] = (("control", 50), ("treatment", 50)),
                 out: str = "cell") -> DataFrame:
    """Deterministic cell per id from a hash salted by the experiment name.

    The bucket (0..9999) is compared with cumulative weights; the same id
    always lands in the same cell of an experiment, independently across
    experiments.
    """
    total = float(sum(w for _, w in weights))
    bucket = stable_bucket(id_col, experiment, 10000)
    expr, acc = None, 0.0
    for name, w in weights:
        acc += w
        cond = bucket < F.lit(int(round(acc / total * 10000)))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return df.withColumn(out, expr.otherwise(F.lit(weights[-1][0])))


def exposures(events: DataFrame, cells: DataFrame, id_col: str, cell: str = "cell") -> DataFrame:
    """Every event of an assigned user, tagged with the user's cell
    (a key join; `cells` has one row per user)."""
    return events.join(cells.select(id_col, cell), on=id_col, how="inner")


def per_user_outcomes(events: DataFrame, user: str, convert_when: Column, value_cents: Column) -> DataFrame:
    """One row per user: converted flag and total value (in cents, exact)."""
    return events.groupBy(user).agg(F.max(F.when(convert_when, 1).otherwise(0)).alias("converted"),
                                    F.sum(value_cents.cast("decimal(28,0)")).cast("bigint").alias("value_cents"))


def experiment_readout(users: DataFrame, cell: str = "cell", control: str = "control") -> DataFrame:
    """Per cell users, conversions, rate, mean and sample variance of the
    value, lift over control and the two-proportion z statistic.

    The sum is exact (decimals), the variance is Spark's `var_samp`, which
    merges partial moments without cancellation; the cross-cell
    step is a window over the per-cell table, whose size is the number of
    cells.
    """
    g = users.groupBy(cell).agg(
        F.count(F.lit(1)).alias("users"), F.sum("converted").cast("bigint").alias("conversions"),
        F.sum(F.col("value_cents").cast("decimal(28,0)")).alias("_s"),
        (F.var_samp("value_cents") / 10000.0).alias("_var"))
    n = F.col("users").cast("double")
    rate = F.col("conversions").cast("double") / n
    mean = F.col("_s").cast("double") / n / 100.0
    g = g.select(cell, "users", "conversions", rate.alias("conversion_rate"), mean.alias("mean_value"),
                 F.col("_var").alias("var_value"))
    w = Window.partitionBy()
    c_n = F.max(F.when(F.col(cell) == control, F.col("users"))).over(w).cast("double")
    c_k = F.max(F.when(F.col(cell) == control, F.col("conversions"))).over(w).cast("double")
    c_rate = c_k / c_n
    pool = (F.col("conversions").cast("double") + c_k) / (F.col("users").cast("double") + c_n)
    se = F.sqrt(pool * (1.0 - pool) * (1.0 / F.col("users").cast("double") + 1.0 / c_n))
    return g.select(cell, "users", "conversions", "conversion_rate", "mean_value", "var_value",
                    (safe_ratio(F.col("conversion_rate"), c_rate) - 1.0).alias("lift"),
                    F.when(F.col(cell) != control, safe_ratio(F.col("conversion_rate") - c_rate, se)).alias("z"))


def cell_engagement(events: DataFrame, sessions: DataFrame, cells: DataFrame, user: str = "user_id", day: str = "event_date",
                    cell: str = "cell", after_days: Sequence[int] = (1, 7)) -> DataFrame:
    """Per cell users, sessions, mean session length in seconds, and the share of users who were active again
    exactly n days after their first day, of those whose n-th day is not after the last day of the data.

    `sessions` has a row per session with its user and seconds; `cells` one row per user. Every step is a partial
    aggregate per user, so a user with many events or sessions costs one row."""
    last = events.agg(F.max(day)).scalar()
    days = events.where(F.col(user).isNotNull()).groupBy(user, day).agg(F.lit(1).alias("_one"))
    first = days.groupBy(user).agg(F.min(day).alias("_first"))
    again = days.join(first, user).groupBy(user).agg(
        F.min("_first").alias("_first"),
        *[F.max(F.when(F.datediff(day, "_first") == n, 1).otherwise(0)).alias(f"_d{n}") for n in after_days])
    per = sessions.groupBy(user).agg(F.count(F.lit(1)).alias("_s"), F.sum("seconds").alias("_len"))
    u = cells.join(again, user).join(per, user, "left")
    eligible = {n: F.date_add("_first", n) <= last for n in after_days}
    g = u.groupBy(cell).agg(
        F.count(F.lit(1)).alias("users"), F.coalesce(F.sum("_s"), F.lit(0)).alias("num_sessions"), F.sum("_len").alias("_len"),
        *[F.count_if(eligible[n]).alias(f"_e{n}") for n in after_days],
        *[F.sum(F.when(eligible[n], F.col(f"_d{n}"))).alias(f"_r{n}") for n in after_days])
    return g.select(cell, "users", "num_sessions", safe_ratio(F.col("_len"), F.col("num_sessions")).alias("mean_session_seconds"),
                    *[safe_ratio(F.col(f"_r{n}"), F.col(f"_e{n}")).alias(f"retention_{n}") for n in after_days])


def daily_kpis(events: DataFrame, user: str, kind: str, date_col: str = "event_date",
               click: str = "click", view: str = "view", purchase: str = "purchase") -> DataFrame:
    """Daily active users, events, click-through and purchases per day."""
    k = F.col(kind)
    return events.groupBy(date_col).agg(
        F.count_distinct(user).alias("dau"), F.count(F.lit(1)).alias("events"),
        F.count_if(k == click).alias("clicks"), F.count_if(k == view).alias("views"),
        safe_ratio(F.count_if(k == click), F.count_if(k == view)).alias("ctr"),
        F.count_if(k == purchase).alias("purchases"))
