"""Cumulative history tables.

A cumulative table has one row per (entity, snapshot period) and carries
the entity's whole history as an array of per-period structs. The array
holds at most one element per period, so its length is bounded by the
number of periods, never by the number of raw fact rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from cumulo.functions.columns import classify


def _empty_like(df: DataFrame, struct_col: str) -> Column:
    return F.array().cast(ArrayType(df.schema[struct_col].dataType))


def cumulate_step(prev: DataFrame, today: DataFrame, key: Sequence[str], period,
                  *, struct_cols: Sequence[str], carry: Sequence[str] = (),
                  measure: str, thresholds, default_class: str,
                  history: str = "history", class_col: str = "scoring_class",
                  period_col: str = "current_period") -> DataFrame:
    """Merge yesterday's snapshot with today's facts (one row per key).

    Full outer join on the key; both sides have one row per key. Stored
    with `plans.jobs.run_step_table` (bucketed by key) the previous
    snapshot is read in its buckets and only today's rows shuffle. History gets
    today's struct appended; carried columns prefer the previous snapshot;
    the class comes from today's measure, else stays as it was.
    """
    key = list(key)
    t = today.select(*key, *[F.col(c).alias(f"_t_{c}") for c in carry],
                     F.struct(*struct_cols).alias("_t_new"),
                     classify(measure, thresholds, default_class).alias("_t_cls"))
    empty = _empty_like(t, "_t_new")
    p = prev.select(*key, *[F.col(c).alias(f"_p_{c}") for c in carry],
                    F.col(history).alias("_p_hist"), F.col(class_col).alias("_p_cls"),
                    F.col("years_since_last_active").alias("_p_ysla"))
    j = p.join(t, on=key, how="full")
    active = F.col("_t_new").isNotNull()
    return j.select(
        *key,
        *[F.coalesce(F.col(f"_p_{c}"), F.col(f"_t_{c}")).alias(c) for c in carry],
        F.concat(F.coalesce(F.col("_p_hist"), empty),
                 F.when(active, F.array(F.col("_t_new"))).otherwise(empty)).alias(history),
        F.coalesce(F.col("_t_cls"), F.col("_p_cls")).alias(class_col),
        F.when(active, F.lit(0)).otherwise(F.coalesce(F.col("_p_ysla"), F.lit(0)) + 1)
         .cast("int").alias("years_since_last_active"),
        active.alias("is_active"),
        F.lit(period).alias(period_col),
    )


def group_period(facts: DataFrame, key: Sequence[str], period_col: str, period,
                 measure: str, count_col: str = "n_items", mean_col: str = "mean_measure",
                 extra_sums: Sequence[str] = ()) -> DataFrame:
    """P2 first half: many rows per key in one period -> one row per key.

    The reference collects every row of the period into an array; that array
    is unbounded (one key may own a large share of the rows), so the period
    is summarised with partial aggregates instead (map-side combine, skew
    safe). The summary struct then joins the history like P1.
    """
    agg = [F.count(F.lit(1)).alias(count_col), F.avg(measure).alias(mean_col)]
    agg += [F.sum(c).alias(f"sum_{c}") for c in extra_sums]
    return (facts.filter(F.col(period_col) == F.lit(period))
            .groupBy(*key).agg(*agg)
            .withColumn(period_col, F.lit(period)))


def cumulate_group_step(prev: DataFrame, facts: DataFrame, key: Sequence[str], period_col: str,
                        period, *, measure: str, thresholds, default_class: str,
                        history: str = "history", class_col: str = "quality_class",
                        snapshot_col: str = "current_period", extra_sums: Sequence[str] = ()) -> DataFrame:
    """P1 over a period summary; inactive keys keep their previous class."""
    today = group_period(facts, key, period_col, period, measure, extra_sums=extra_sums)
    struct_cols = [period_col, "n_items", "mean_measure", *[f"sum_{c}" for c in extra_sums]]
    return cumulate_step(prev, today, key, period, struct_cols=struct_cols, measure="mean_measure",
                         thresholds=thresholds, default_class=default_class, history=history,
                         class_col=class_col, period_col=snapshot_col)


def fill_gaps(active: DataFrame, key: Sequence[str], period_col: str, last_period,
              src_col: str = "_src", step=None) -> DataFrame:
    """Dense (entity, period) rows generated from the active rows alone.

    Each active row is repeated for its own period and every following
    period up to the entity's next active period (or `last_period`), so
    the grid comes out of one window (lead) per entity plus a generator:
    no spine table and no join back to the facts. `src_col` keeps the
    active period the row was copied from. Integer periods by default;
    pass `step="date"` for day periods.
    """
    key = list(key)
    last = last_period if isinstance(last_period, Column) else F.lit(last_period)
    w = Window.partitionBy(*key).orderBy(period_col)
    nxt = F.lead(period_col).over(w)
    if step == "date":
        upto = F.coalesce(F.date_sub(nxt, 1), last.cast("date"))
    else:
        upto = F.coalesce(nxt - 1, last.cast("int"))
    others = [c for c in active.columns if c != period_col]
    marked = active.filter(F.col(period_col) <= last).select(*others, F.col(period_col).alias(src_col),
                                                             upto.alias("_upto"))
    return marked.select(*others, src_col, F.explode(F.sequence(F.col(src_col), F.col("_upto"))).alias(period_col))


def cumulate_backfill(facts: DataFrame, key: Sequence[str], period_col: str, *,
                      struct_cols: Sequence[str], measure: str, thresholds, default_class: str,
                      last_period=None, static: DataFrame | None = None,
                      history: str = "history", class_col: str = "scoring_class") -> DataFrame:
    """Every snapshot in one pass.

    A running `collect_list` per entity over its active periods, then
    `fill_gaps` repeats each snapshot over the inactive periods that follow
    it. Both windows are one entity's periods (bounded by the number of
    periods) and share one exchange on the key. Static attributes come
    from `static` (one row per key) by a key join.
    """
    key = list(key)
    if last_period is None:
        last_period = facts.agg(F.max(period_col)).scalar()
    w = (Window.partitionBy(*key).orderBy(period_col)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    hist = facts.select(*key, period_col, F.col(measure).alias("_m"),
                        F.collect_list(F.struct(*struct_cols)).over(w).alias(history))
    dense = fill_gaps(hist, key, period_col, last_period)
    out = dense.select(
        *key, history,
        classify("_m", thresholds, default_class).alias(class_col),
        (F.col(period_col) - F.col("_src")).cast("int").alias("years_since_last_active"),
        (F.col("_src") == F.col(period_col)).alias("is_active"),
        F.col(period_col).alias("current_period"))
    if static is not None:
        out = out.join(static, on=key, how="left")
    return out


def snapshot_as_of(facts: DataFrame, key: Sequence[str], period_col: str, period, *, struct_cols: Sequence[str],
                   measure: str, thresholds, default_class: str, static: DataFrame | None = None,
                   history: str = "history", class_col: str = "scoring_class") -> DataFrame:
    """The snapshot of one period, without the periods before it.

    One aggregate per key over the facts up to `period` (a literal or a scalar subquery): the history is the
    sorted list of the key's periods, class and activity follow from its last element. Equal to
    `cumulate_backfill` filtered to the period."""
    key = list(key)
    period = period if isinstance(period, Column) else F.lit(period)
    item = F.struct(F.col(period_col).alias("_p"), F.col(measure).alias("_m"), F.struct(*struct_cols).alias("_s"))
    g = facts.where(F.col(period_col) <= period).groupBy(*key).agg(F.sort_array(F.collect_list(item)).alias("_h"))
    last = F.element_at("_h", -1)
    out = g.select(*key, F.col("_h._s").alias(history), classify(last["_m"], thresholds, default_class).alias(class_col),
                   (period - last["_p"]).cast("int").alias("years_since_last_active"), (last["_p"] == period).alias("is_active"),
                   period.cast(facts.schema[period_col].dataType).alias("current_period"))
    return out if static is None else out.join(static, on=key, how="left")


def static_attributes(facts: DataFrame, key: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """P3 static columns: one value per key by `max` (partial aggregation)."""
    return facts.groupBy(*key).agg(*[F.max(c).alias(c) for c in cols])


def unnest_history(df: DataFrame, keep: Sequence[str], history: str = "history") -> DataFrame:
    """History array back to rows; array order is period order."""
    return df.select(*keep, F.inline(F.col(history)))


def first_last_ratio(df: DataFrame, keep: Sequence[str], field: str,
                     history: str = "history", out: str = "ratio_last_to_first") -> DataFrame:
    """P5: latest value over first value; a zero first value divides by 1."""
    first = F.try_element_at(F.col(history), F.lit(1))[field]
    last = F.try_element_at(F.col(history), F.lit(-1))[field]
    den = F.when(first == 0, F.lit(1.0)).otherwise(first)
    return df.select(*keep, (last / den).alias(out))


def snapshot_states(facts: DataFrame, key: Sequence[str], period_col: str, *, measure: str,
                    thresholds, default_class: str, last_period=None,
                    class_col: str = "scoring_class") -> DataFrame:
    """Dense (entity, period) snapshot without the history array.

    The class is the one of the latest active period (carried forward while
    inactive) and `is_active` says whether the entity has facts in the
    period: the columns an SCD reads from the cumulative table, computed
    without materialising arrays.
    """
    key = list(key)
    if last_period is None:
        last_period = facts.agg(F.max(period_col)).scalar()
    dense = fill_gaps(facts.select(*key, period_col, F.col(measure).alias("_m")), key, period_col, last_period)
    return dense.select(*key, period_col, classify("_m", thresholds, default_class).alias(class_col),
                        (F.col("_src") == F.col(period_col)).alias("is_active"))
