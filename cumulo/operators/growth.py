"""Growth accounting, retention and funnels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType

from cumulo.functions.columns import safe_ratio


def _d(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x).cast("date")


def _daily_state(prev_exists: Column, prev_last: Column, prev_date: Column, today: Column) -> Column:
    """Daily state; first match wins (order matters, T20). `today` is NULL when inactive."""
    return (F.when(~prev_exists, "New")
            .when(prev_last == F.date_sub(today, 1), "Retained")
            .when(prev_last < F.date_sub(today, 1), "Resurrected")
            .when(today.isNull() & (prev_last == prev_date), "Churned")
            .otherwise("Stale"))


def _weekly_state(prev_exists: Column, prev_last: Column, prev_date: Column, today: Column) -> Column:
    return (F.when(~prev_exists, "New")
            .when(prev_last < F.date_sub(today, 7), "Resurrected")
            .when(today.isNull() & (prev_last == F.date_sub(prev_date, 7)), "Churned")
            .when(F.date_add(F.coalesce(today, prev_last), 7) >= prev_date, "Retained")
            .otherwise("Stale"))


def growth_accounting_step(prev: DataFrame | None, active: DataFrame, key: str, date,
                           date_col: str = "event_date") -> DataFrame:
    """yesterday's growth table + today's active users -> today's rows.

    `active` has (key, date_col) rows (any multiplicity). Full outer join on
    the key; states as in the reference; the date list is appended
    null-safely.
    """
    d = _d(date)
    t = active.filter(F.col(date_col) == d).select(key).distinct().withColumn("_today", d)
    empty = F.array().cast(ArrayType(DateType()))
    if prev is None:
        j = t.select(key, "_today", *[F.lit(None).cast(tp).alias(c) for c, tp in
                                      (("_pf", "date"), ("_pl", "date"), ("_pd", "date"), ("_pa", "array<date>"))])
    else:
        p = prev.select(key, F.col("first_active_date").alias("_pf"), F.col("last_active_date").alias("_pl"),
                        F.col("date").alias("_pd"), F.col("dates_active").alias("_pa"))
        j = p.join(t, on=key, how="full")
    exists = F.col("_pd").isNotNull()
    today = F.col("_today")
    return j.select(
        key,
        F.coalesce(F.col("_pf"), today).alias("first_active_date"),
        F.coalesce(today, F.col("_pl")).alias("last_active_date"),
        _daily_state(exists, F.col("_pl"), F.col("_pd"), today).alias("daily_active_state"),
        _weekly_state(exists, F.col("_pl"), F.col("_pd"), today).alias("weekly_active_state"),
        F.concat(F.coalesce(F.col("_pa"), empty),
                 F.when(today.isNotNull(), F.array(today)).otherwise(empty)).alias("dates_active"),
        F.coalesce(today, F.date_add(F.col("_pd"), 1)).alias("date"))


def growth_accounting_as_of(active: DataFrame, key: str, day, date_col: str = "event_date") -> DataFrame:
    """The backfilled table's rows of one day, from one aggregate per key (no grid of days)."""
    d = _d(day)
    g = (active.filter(F.col(date_col) <= d).groupBy(key)
         .agg(F.array_sort(F.collect_set(date_col)).alias("dates_active")))
    last = F.element_at("dates_active", -1)
    before = F.when(last == d, F.try_element_at("dates_active", F.lit(-2))).otherwise(last)
    first = F.element_at("dates_active", 1)
    exists, today = d > first, F.when(last == d, d)
    prev_date = F.date_sub(d, 1)
    return g.select(key, first.alias("first_active_date"), last.alias("last_active_date"),
                    _daily_state(exists, before, prev_date, today).alias("daily_active_state"),
                    _weekly_state(exists, before, prev_date, today).alias("weekly_active_state"),
                    "dates_active", d.alias("date"))


def growth_accounting_backfill(active: DataFrame, key: str, last_date, date_col: str = "event_date",
                               with_dates: bool = True) -> DataFrame:
    """P18 backfill: every (user, day) from the first active day to `last_date`.

    From the distinct active days alone: one window per user over its
    active days (lag, first day, running date list; bounded by the number
    of days), then `fill_gaps` generates the inactive days in between.
    No spine join. Equal to folding `growth_accounting_step` day by day.
    """
    from cumulo.operators.cumulative import fill_gaps
    days = active.select(key, date_col).distinct()
    w = Window.partitionBy(key).orderBy(date_col)
    upto_now = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cols = [key, date_col,
            F.min(date_col).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
             .alias("first_active_date"),
            F.lag(date_col).over(w).alias("_prev_active")]
    if with_dates:
        cols.append(F.collect_list(date_col).over(upto_now).alias("dates_active"))
    marked = days.select(*cols)
    dense = fill_gaps(marked, [key], date_col, _d(last_date), src_col="_src", step="date")
    g = F.col(date_col)
    today = F.when(g == F.col("_src"), g)
    prev_last = F.when(g == F.col("_src"), F.col("_prev_active")).otherwise(F.col("_src"))
    exists = g > F.col("first_active_date")
    prev_date = F.date_sub(g, 1)
    out = [key, "first_active_date", F.col("_src").alias("last_active_date"),
           _daily_state(exists, prev_last, prev_date, today).alias("daily_active_state"),
           _weekly_state(exists, prev_last, prev_date, today).alias("weekly_active_state")]
    if with_dates:
        out.append("dates_active")
    out.append(g.alias("date"))
    return dense.select(*out)


def retention_curve(growth: DataFrame) -> DataFrame:
    """Share of users active by days since first activity (the J curve)."""
    active = F.col("daily_active_state").isin("Retained", "Resurrected", "New")
    return (growth.groupBy(F.datediff("date", "first_active_date").alias("days_since_first_active"))
            .agg(safe_ratio(F.count_if(active), F.count(F.lit(1))).alias("pct_active"),
                 F.count(F.lit(1)).alias("num_users")))


def funnel(events: DataFrame, key: str, step_col: str, target, time_col: str = "event_time",
           extra_dedup: Sequence[str] = ("host",), min_n: int = 100) -> DataFrame:
    """P20: per step value, the share of events followed the same day by a target event.

    Events are deduplicated on (step, extra, key, time) and must have some
    later event of the same key that day (T13, as in the reference). The
    reference's same-day self join is replaced by two per-(key, day) maxima
    joined back: partial aggregates, no pairs, skew-safe.
    """
    ev = (events.filter(F.col(key).isNotNull())
          .select(step_col, *extra_dedup, key, time_col).distinct()
          .withColumn("_day", F.to_date(time_col)))
    per_day = ev.groupBy(key, "_day").agg(
        F.max(time_col).alias("_last"),
        F.max(F.when(F.col(step_col) == F.lit(target), F.col(time_col))).alias("_last_target"))
    rows = (ev.join(per_day, on=[key, "_day"], how="inner")
            .filter(F.col(time_col) < F.col("_last"))
            .select(key, time_col, step_col,
                    F.when(F.col(time_col) < F.col("_last_target"), 1).otherwise(0).alias("_conv"))
            .distinct())
    g = rows.groupBy(step_col).agg(F.count(F.lit(1)).alias("num_events"),
                                   safe_ratio(F.sum("_conv"), F.count(F.lit(1))).alias("pct_converted"))
    return g.filter((F.col("pct_converted") > 0) & (F.col("num_events") > min_n))


