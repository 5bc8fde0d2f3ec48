"""Date lists, activity words and month arrays."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from cumulo.operators import activity as AC
from cumulo.plans import adapters as A
from tests.conftest import SF_SMALL

D = dt.date


def test_month_array_slot_totals(spark):
    # normal rows, an empty array (must count 0, not raise), another partition
    rows = [("2023-03-01", [1, 2, 3], "2023-03-31"), ("2023-03-01", [1, 2, 3], "2023-03-31"),
            ("2023-03-01", [], "2023-03-31"), ("2023-04-01", [1, 2, 3], "2023-04-30")]
    df = spark.createDataFrame(rows, "month_start string, hit_array array<long>, date_partition string")
    out = AC.slot_totals(df.filter(F.col("date_partition") == "2023-03-31"), "hit_array", ["month_start"],
                         [0, 1, 2], ["num_hits_first_day", "num_hits_second_day", "num_hits_third_day"])
    expected = spark.createDataFrame([("2023-03-01", 2, 4, 6)],
                                     "month_start string, num_hits_first_day long, num_hits_second_day long, "
                                     "num_hits_third_day long")
    assertDataFrameEqual(out, expected)


def test_activity_word_bits(spark):
    asof = D(2023, 1, 31)
    dates = [asof - dt.timedelta(days=k) for k in (0, 6, 7, 60)]
    df = spark.createDataFrame([(1, dates)], "user_id long, dates_active array<date>")
    w = AC.datelist_int(df, ["user_id"], asof)
    m = AC.datelist_metrics(w, ["user_id"]).first()
    assert (m.l32, m.l7, m.weekly_active_previous_week, m.monthly_active) == (3, 2, True, True)
    word = w.first().datelist_int
    assert word >> 31 == 1  # T1: activity on the as-of day is kept


def test_datelist_fold_equals_backfill(spark):
    web = A.web_events(spark, SF_SMALL)
    days = AC.active_days(web, ["user_id"]).cache()
    hi = days.agg(F.max("event_date")).first()[0]
    d = hi - dt.timedelta(days=3)
    snap = AC.datelist_backfill(days, ["user_id"], d - dt.timedelta(days=1))
    while d <= hi:  # backfill to d0 + steps == backfill to the last day
        snap = AC.datelist_step(snap, days, ["user_id"], d).checkpoint(eager=True)
        d += dt.timedelta(days=1)
    assertDataFrameEqual(snap, AC.datelist_backfill(days, ["user_id"], hi))


def test_month_array_step_equals_backfill_and_rerun(spark):
    web = A.web_events(spark, SF_SMALL)
    daily = AC.active_days(web, ["user_id"]).cache()
    hi = daily.agg(F.max("event_date")).first()[0]
    for pad in (None, 0):
        # from nothing on the 1st, then the last three days on top of the backfill
        first = AC.month_array_step(None, daily, ["user_id"], hi.replace(day=1), [("hit_array", "num_hits")], pad=pad)
        assertDataFrameEqual(first, AC.month_array_backfill(daily, ["user_id"], hi.replace(day=1),
                                                            [("hit_array", "num_hits")], pad=pad))
        d = hi - dt.timedelta(days=2)
        snap = AC.month_array_backfill(daily, ["user_id"], d - dt.timedelta(days=1), [("hit_array", "num_hits")],
                                       pad=pad)
        while d <= hi:
            snap = AC.month_array_step(snap, daily, ["user_id"], d, [("hit_array", "num_hits")],
                                       pad=pad).checkpoint(eager=True)
            d += dt.timedelta(days=1)
        assertDataFrameEqual(snap, AC.month_array_backfill(daily, ["user_id"], hi, [("hit_array", "num_hits")],
                                                           pad=pad))
        # T5: running the last day again does not append a second slot
        again = AC.month_array_step(snap, daily, ["user_id"], hi, [("hit_array", "num_hits")], pad=pad)
        assertDataFrameEqual(again, snap)


def test_first_found_kept_when_inactive(spark):
    prev = spark.createDataFrame([(1, [None, 3], D(2023, 3, 1), D(2023, 3, 2), D(2023, 3, 2))],
                                 "user_id long, hit_array array<long>, month_start date, first_found_date date, "
                                 "date_partition date")
    today = spark.createDataFrame([(2, D(2023, 3, 3), 5)], "user_id long, event_date date, num_hits long")
    out = {r.user_id: r for r in AC.month_array_step(prev, today, ["user_id"], D(2023, 3, 3),
                                                     [("hit_array", "num_hits")]).collect()}
    assert out[1].hit_array == [None, 3, None] and out[1].first_found_date == D(2023, 3, 2)
    assert out[2].hit_array == [None, None, 5] and out[2].first_found_date == D(2023, 3, 3)


def test_metric_array_to_daily(spark):
    df = spark.createDataFrame([("hits", D(2023, 3, 1), [1, 2]), ("hits", D(2023, 3, 1), [3, 4, 5])],
                               "metric_name string, month_start date, metric_array array<long>")
    out = AC.metric_array_to_daily(df, ["metric_name"])
    assert sorted((r.event_date.day, r.value) for r in out.collect()) == [(1, 4), (2, 6), (3, 5)]


def test_activity_word_accepts_iso_string_and_column(spark):
    df = spark.createDataFrame([(1, [D(2023, 1, 31), D(2023, 1, 30)], D(2023, 1, 31))],
                               "user_id long, dates_active array<date>, as_of date")
    a = AC.datelist_int(df, ["user_id"], "2023-01-31").first().datelist_int
    b = AC.datelist_int(df, ["user_id"], "as_of").first().datelist_int
    assert a == b == (1 << 31) + (1 << 30)


def test_null_host_is_one_key(spark):
    rows = [(None, D(2023, 1, 1)), (None, D(2023, 1, 2)), ("a", D(2023, 1, 1))]
    days = spark.createDataFrame(rows, "host string, event_date date")
    prev = AC.datelist_backfill(days, ["host"], D(2023, 1, 1))
    assertDataFrameEqual(AC.datelist_step(prev, days, ["host"], D(2023, 1, 2)),
                         AC.datelist_backfill(days, ["host"], D(2023, 1, 2)))
    daily = days.groupBy("host", "event_date").agg(F.count(F.lit(1)).alias("n"))
    prev = AC.month_array_backfill(daily, ["host"], D(2023, 1, 1), [("a", "n")], pad=0)
    assertDataFrameEqual(AC.month_array_step(prev, daily, ["host"], D(2023, 1, 2), [("a", "n")], pad=0),
                         AC.month_array_backfill(daily, ["host"], D(2023, 1, 2), [("a", "n")], pad=0))


def test_month_array_pads_skipped_days_and_keeps_earlier_months(spark):
    rows = [(1, D(2023, 1, 30), 3), (1, D(2023, 2, 1), 5), (1, D(2023, 2, 3), 7), (2, D(2023, 1, 2), 9)]
    daily = spark.createDataFrame(rows, "k int, event_date date, n long")
    ms = [("a", "n")]
    one = AC.month_array_backfill(daily, ["k"], D(2023, 2, 1), ms, pad=0)
    third = AC.month_array_step(one, daily, ["k"], D(2023, 2, 3), ms, pad=0)
    assert [r.a for r in third.filter("k = 1").collect()] == [[5, 0, 7]]
    full = {(r.k, r.month_start): r.a for r in AC.month_array_backfill(daily, ["k"], D(2023, 2, 3), ms, pad=0).collect()}
    assert full[1, D(2023, 2, 1)] == [5, 0, 7] and len(full[1, D(2023, 1, 1)]) == 31 and sum(full[1, D(2023, 1, 1)]) == 3
    assert full[2, D(2023, 1, 1)][1] == 9 and set(full) == {(1, D(2023, 1, 1)), (1, D(2023, 2, 1)), (2, D(2023, 1, 1))}


def test_run_date_of_empty_table(spark):
    empty = spark.createDataFrame([], "user_id long, event_date date")
    assert AC.datelist_backfill(empty, ["user_id"], AC.run_date(empty)).count() == 0
