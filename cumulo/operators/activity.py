"""Activity facts: date lists, 32-day activity words and month arrays.

Every array here is bounded by the calendar - at most one element per day
(date lists) or per day of a month (month arrays) - never by row counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType

from cumulo.functions.columns import LAST7_MASK, PREV7_MASK, activity_word, word_bits


def _lit_date(d) -> Column:
    return d if isinstance(d, Column) else F.lit(d).cast("date")


def run_date(df: DataFrame, date_col: str = "event_date") -> Column:
    """Latest date present, as a scalar subquery: the run parameter for a
    daily step when the caller does not pass one. NULL on an empty table."""
    return df.agg(F.max(date_col)).scalar()


def _full_join(prev: DataFrame, today: DataFrame, keys: Sequence[str], null_keys: bool) -> DataFrame:
    """Full outer join, one row per key on each side. With `null_keys` the
    keys are compared as one struct, in which NULL equals NULL; without, a
    bucketed table is read in its buckets."""
    if not null_keys:
        return prev.join(today, on=list(keys), how="full")
    def as_struct(df):
        return df.select(F.struct(*keys).alias("_k"), *[c for c in df.columns if c not in keys])
    return as_struct(prev).join(as_struct(today), on="_k", how="full").select("_k.*", "*").drop("_k")


def active_days(events: DataFrame, keys: Sequence[str], date_col: str = "event_date",
                drop_null_keys: bool = True, value: Column | None = None,
                value_name: str = "num_hits") -> DataFrame:
    """One row per key and active day, with the day's hit count (partial aggregate)."""
    keys = list(keys)
    e = events
    if drop_null_keys:
        cond = None
        for k in keys:
            c = F.col(k).isNotNull()
            cond = c if cond is None else cond & c
        e = e.filter(cond)
    agg = F.count(F.lit(1)) if value is None else value
    return e.groupBy(*keys, date_col).agg(agg.alias(value_name))


def datelist_step(prev: DataFrame | None, today: DataFrame, keys: Sequence[str], date,
                  *, list_col: str = "dates_active", snap_col: str = "date",
                  date_col: str = "event_date", null_keys: bool = True) -> DataFrame:
    """P10: yesterday's date lists + the keys active on `date`.

    Today's date is appended (lists stay ascending); keys not seen today
    carry their list; the snapshot date is `date` for all rows (the
    reference's `prev.date + 1`, equal on consecutive runs). Both sides are
    null-safe (T2: a NULL list concatenated with today would be NULL).
    """
    keys = list(keys)
    d = _lit_date(date)
    t = today.filter(F.col(date_col) == d).select(*keys).distinct().withColumn("_seen", F.lit(True))
    empty = F.array().cast(ArrayType(DateType()))
    if prev is None:
        j = t.withColumn("_prev", F.lit(None).cast(ArrayType(DateType())))
    else:
        p = prev.select(*keys, F.col(list_col).alias("_prev"))
        j = _full_join(p, t, keys, null_keys)
    return j.select(*keys,
                    F.concat(F.coalesce(F.col("_prev"), empty),
                             F.when(F.col("_seen"), F.array(d)).otherwise(empty)).alias(list_col),
                    d.alias(snap_col))


def datelist_backfill(events: DataFrame, keys: Sequence[str], as_of, *,
                      list_col: str = "dates_active", snap_col: str = "date",
                      date_col: str = "event_date") -> DataFrame:
    """P10 backfill: every key's sorted distinct active dates up to `as_of`.

    `collect_set` of dates is combined map-side and bounded by the number
    of days.
    """
    d = _lit_date(as_of)
    return (events.filter(F.col(date_col) <= d)
            .groupBy(*keys).agg(F.array_sort(F.collect_set(date_col)).alias(list_col))
            .withColumn(snap_col, d))


def datelist_int(df: DataFrame, keys: Sequence[str], as_of, *, list_col: str = "dates_active",
                 out: str = "datelist_int") -> DataFrame:
    """32-day activity word per key (bit 31 = as-of day; T1 fixed).
    `as_of` is the run date (a date) or the name of a date column."""
    return df.select(*keys, activity_word(list_col, as_of).alias(out))


def datelist_metrics(df: DataFrame, keys: Sequence[str], word: str = "datelist_int") -> DataFrame:
    """Monthly / weekly activity from the word."""
    return df.select(
        *keys,
        (word_bits(word) > 0).alias("monthly_active"),
        word_bits(word).alias("l32"),
        (word_bits(word, LAST7_MASK) > 0).alias("weekly_active"),
        word_bits(word, LAST7_MASK).alias("l7"),
        (word_bits(word, PREV7_MASK) > 0).alias("weekly_active_previous_week"))


def month_array_step(prev: DataFrame | None, today: DataFrame, keys: Sequence[str], date,
                     measures: Sequence[tuple[str, str]], *, pad=None, month_col: str = "month_start",
                     first_found_col: str | None = "first_found_date", snap_col: str = "date_partition",
                     date_col: str = "event_date", null_keys: bool = True) -> DataFrame:
    """Append today's value to each month array.

    `measures` pairs (array column, today's value column). Slot i is day i+1
    of the month: a key first seen on day k gets k-1 leading `pad` slots
    (NULL for P13, 0 for P14/P15); a known key unseen today appends `pad`, and
    days that no step ran for are padded first. A key whose array already covers the day is left as is, so a re-run of
    one day does not append twice (T5).
    """
    keys = list(keys)
    d = _lit_date(date)
    month = F.trunc(d, "month")
    idx = F.datediff(d, month)
    t = today.filter(F.col(date_col) == d).select(*keys, *[F.col(v).alias(f"_t_{a}") for a, v in measures],
                                                   F.lit(True).alias("_seen"))
    if prev is None:
        cols = [F.lit(None).cast(ArrayType(t.schema[f"_t_{a}"].dataType)).alias(f"_p_{a}") for a, _ in measures]
        j = t.select("*", *cols, F.lit(None).cast("date").alias("_p_first"))
    else:
        p = prev.filter(F.col(month_col) == month).select(
            *keys, *[F.col(a).alias(f"_p_{a}") for a, _ in measures],
            (F.col(first_found_col) if first_found_col else F.lit(None).cast("date")).alias("_p_first"))
        j = _full_join(p, t, keys, null_keys)
    out = [*keys]
    for a, _ in measures:
        et = j.schema[f"_t_{a}"].dataType
        padv = F.lit(pad).cast(et)
        held = F.coalesce(F.col(f"_p_{a}"), F.array().cast(ArrayType(et)))
        prev_arr = F.concat(held, F.array_repeat(padv, F.greatest(idx - F.size(held), F.lit(0))))
        today_v = F.when(F.col("_seen"), F.col(f"_t_{a}")).otherwise(padv)
        arr = F.when(F.size(F.col(f"_p_{a}")) > idx, F.col(f"_p_{a}")).otherwise(
            F.concat(prev_arr, F.array(today_v)))
        out.append(arr.alias(a))
    out.append(month.alias(month_col))
    if first_found_col:
        # T4: keep the earlier date even when the key is inactive today.
        out.append(F.least(F.col("_p_first"), F.when(F.col("_seen"), d)).alias(first_found_col))
    out.append(d.alias(snap_col))
    return j.select(*out)


def month_array_backfill(daily: DataFrame, keys: Sequence[str], as_of, measures: Sequence[tuple[str, str]],
                         *, pad=None, month_col: str = "month_start",
                         first_found_col: str | None = "first_found_date", snap_col: str = "date_partition",
                         date_col: str = "event_date") -> DataFrame:
    """Month arrays of every month up to `as_of` in one pass (twin of `month_array_step`).

    Per key and month, the month's daily values are collected into a map (at
    most 31 entries) and laid out by day, `pad` where a day has no value. A
    month before that of `as_of` has its full length.
    """
    keys = list(keys)
    d = _lit_date(as_of)
    m = (daily.filter(F.col(date_col) <= d)
         .groupBy(*keys, F.trunc(F.col(date_col), "month").alias("_month")).agg(
             *[F.map_from_entries(F.collect_list(F.struct(F.col(date_col), F.col(v)))).alias(f"_m_{a}")
               for a, v in measures],
             F.min(date_col).alias("_first")))
    month = F.col("_month")
    # a scalar subquery may not stand inside transform(): the length is a column of its own
    m = m.withColumn("_n", F.datediff(F.least(F.last_day(month), d), month) + 1)
    out = [*keys]
    for a, v in measures:
        vt = daily.schema[v].dataType
        padv = F.lit(pad).cast(vt)
        out.append(F.transform(F.sequence(F.lit(0), F.col("_n") - 1), _slot_value(f"_m_{a}", month, padv)).alias(a))
    out.append(month.alias(month_col))
    if first_found_col:
        out.append(F.col("_first").alias(first_found_col))
    out.append(d.alias(snap_col))
    return m.select(*out)


def _slot_value(map_col: str, month: Column, padv: Column):
    def f(i):
        return F.coalesce(F.element_at(F.col(map_col), F.date_add(month, i)), padv)
    return f


def slot_totals(df: DataFrame, array_col: str, group: Sequence[str], slots: Sequence[int],
                names: Sequence[str]) -> DataFrame:
    """Positional totals of an array column, NULL / missing slots as 0."""
    return df.groupBy(*group).agg(*[
        F.sum(F.coalesce(F.get(F.col(array_col), F.lit(i)), F.lit(0))).alias(n)
        for i, n in zip(slots, names)])


def metric_array_to_daily(df: DataFrame, group: Sequence[str], array_col: str = "metric_array",
                          month_col: str = "month_start", out_date: str = "event_date",
                          out_value: str = "value") -> DataFrame:
    """Sum arrays position by position, then position -> date.

    Exploding with the position and grouping by (group, month, position)
    works for any array length and combines map-side.
    """
    e = df.select(*group, month_col, F.posexplode(F.col(array_col)).alias("_pos", "_v"))
    g = e.groupBy(*group, month_col, "_pos").agg(F.sum("_v").alias(out_value))
    return g.select(*group, F.date_add(F.col(month_col), F.col("_pos")).alias(out_date), out_value)
