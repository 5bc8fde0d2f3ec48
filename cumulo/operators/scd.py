"""Slowly changing dimension, type 2.

An SCD row is (key, tracked attributes, start, end): a run of consecutive
periods with unchanged attributes. The backfill reads the dense snapshot
table (one row per entity and period); the step extends yesterday's SCD
with one new period and must agree with the backfill on dense input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cumulo.functions.columns import attrs_struct


def scd2_backfill(snap: DataFrame, key: Sequence[str], period_col: str, attrs: Sequence[str],
                  start_col: str = "start_period", end_col: str = "end_period") -> DataFrame:
    """Streak-start flag -> running sum -> min / max period per streak.

    Null-safe comparison of the attribute struct, so a NULL attribute never
    makes a row disappear (T8). The windows are per entity over its
    periods: at most one row per period, so the partition is bounded by the
    number of periods, whatever the skew of the raw facts.
    """
    key, attrs = list(key), list(attrs)
    w = Window.partitionBy(*key).orderBy(period_col)
    cur = attrs_struct(attrs)
    prev = F.lag(cur, 1).over(w)
    flagged = snap.select(*key, *attrs, period_col,
                          F.when(prev.isNull() | ~cur.eqNullSafe(prev), 1).otherwise(0).alias("_chg"))
    streaks = flagged.withColumn(
        "_streak", F.sum("_chg").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return (streaks.groupBy(*key, "_streak", *attrs)
            .agg(F.min(period_col).alias(start_col), F.max(period_col).alias(end_col))
            .drop("_streak"))


def scd2_backfill_as_of(snap: DataFrame, key, period_col: str, attrs, cutoff,
                        current_col: str = "current_period", **kw) -> DataFrame:
    """Backfill up to a cut-off period, every row labelled with it."""
    out = scd2_backfill(snap.filter(F.col(period_col) <= F.lit(cutoff)), key, period_col, attrs, **kw)
    return out.withColumn(current_col, F.lit(cutoff))


def scd2_step(scd: DataFrame, today: DataFrame, key: Sequence[str], attrs: Sequence[str], period,
              *, start_col: str = "start_period", end_col: str = "end_period",
              current_col: str = "current_period", open_by: str = "end") -> DataFrame:
    """Add period `period` to an SCD table.

    open rows: the row of each key that can still be extended
      - `open_by="end"` (P8): rows whose end is period - 1,
      - `open_by="latest"` (P9): each key's latest row (row_number by start).
    Then one full outer join of open rows with today's rows on the key:
      same attributes     -> open row extended to `period`
      changed attributes  -> open row as is + new row [period, period]
      key only today      -> new row [period, period]
      key only in history -> open row kept (T10: it is closed, not dropped)
    Rows that are not open pass through. Every row gets `current_col`. Running
    a period again gives the same table: rows that began with it are dropped
    and rows that it extended end a period earlier before the step.
    """
    key, attrs = list(key), list(attrs)
    p = F.lit(period)
    # a re-run of `period` starts from the table as it was after period - 1
    base = (scd.filter(F.col(start_col) < p)
            .select(*key, *attrs, start_col, F.least(F.col(end_col), p - 1).alias(end_col)))
    if open_by == "end":
        marked = base.withColumn("_open", F.col(end_col) == p - 1)
    elif open_by == "latest":
        w = Window.partitionBy(*key).orderBy(F.col(start_col).desc(), F.col(end_col).desc())
        marked = base.withColumn("_open", F.row_number().over(w) == 1)
    else:
        raise ValueError(open_by)
    hist = marked.select(*[F.col(k).alias(f"_h_{k}") for k in key], F.struct(*attrs).alias("_o_a"),
                         F.col(start_col).alias("_o_s"), F.col(end_col).alias("_o_e"), "_open")
    t = today.select(*key, F.struct(*attrs).alias("_t_a"))
    # One full outer join: today's row can only match the key's open row;
    # closed rows come out unmatched and pass through unchanged.
    cond = [F.col(f"_h_{k}").eqNullSafe(F.col(k)) for k in key] + [F.col("_open")]
    j = hist.join(t, on=cond, how="full")

    def row(a, s, e):
        return F.struct(*[F.coalesce(F.col(f"_h_{k}"), F.col(k)).alias(k) for k in key],
                        *[a[x].alias(x) for x in attrs], s.alias(start_col), e.alias(end_col))

    has_o = F.col("_o_a").isNotNull() & F.col("_open")
    has_t = F.col("_t_a").isNotNull()
    same = F.col("_o_a").eqNullSafe(F.col("_t_a"))
    old = row(F.col("_o_a"), F.col("_o_s"), F.col("_o_e"))
    extended = row(F.col("_o_a"), F.col("_o_s"), p)
    new = row(F.col("_t_a"), p, p)
    rows = (F.when(~has_t, F.array(old))
            .when(has_o & same, F.array(extended))
            .when(has_o, F.array(old, new))
            .otherwise(F.array(new)))
    return j.select(F.inline(rows)).withColumn(current_col, p)


def scd_intervals_valid(scd: DataFrame, key: Sequence[str], start_col: str = "start_period",
                        end_col: str = "end_period") -> DataFrame:
    """Invariant check: rows of a key whose interval overlaps the previous one."""
    w = Window.partitionBy(*key).orderBy(start_col)
    return (scd.withColumn("_prev_end", F.lag(end_col).over(w))
            .filter(F.col("_prev_end") >= F.col(start_col)).drop("_prev_end"))
