"""Daily sums, ratios, dimensions, facts and summaries on hand-made rows."""

from __future__ import annotations

import datetime as dt
import hashlib
from decimal import Decimal

import pytest

from millwright.functions.calendar import date_spine
from millwright.functions.keys import surrogate_key
from millwright.plans import marts
from millwright.plans.build import compose
from rows import CC, JUNK, NO, PM, RUN, START, event, raw_tables

HOUR = dt.timedelta(hours=1)


def daily(spark, rows, targets=()):
    return compose(raw_tables(spark, rows, targets)).fact_oee_daily.collect()


def test_day_with_only_orderless_time_has_no_row(spark):
    assert daily(spark, [event(NO, 60)]) == []


def test_orderless_time_is_outside_planned_but_a_stop(spark):
    (row,) = daily(spark, [event(NO, 60), event(CC, 40, start=START + HOUR)])
    assert (row.planned_time_min, row.downtime_min, row.run_time_min) == (40, 40, 0)
    assert row.major_stoppage_min == 100
    assert row.total_biscuits_made == 200


def test_no_run_time(spark):
    (row,) = daily(spark, [event(PM, 60)], [("M1", "P1", 50)])
    assert (row.availability, row.performance, row.oee) == (0.0, 1.0, 0.0)


def test_no_output_counts_as_full_quality(spark):
    (row,) = daily(spark, [event(RUN, 60, total=0, good=0)])
    assert row.quality == 1.0


def test_no_target_counts_as_full_performance(spark):
    (row,) = daily(spark, [event(RUN, 60, total=1)])
    assert row.target_biscuits_per_hour is None and row.performance == 1.0


def test_good_above_total_is_capped(spark):
    (row,) = daily(spark, [event(RUN, 60, total=20, good=30)])
    assert row.quality == 1.0


def test_unknown_time_counts_as_run(spark):
    (row,) = daily(spark, [event(JUNK, 30)])
    assert (row.planned_time_min, row.run_time_min, row.major_stoppage_min) == (30, 30, 30)


def test_outliers_leave_times_and_counters(spark):
    (row,) = daily(spark, [event(RUN, 60, total=10), event(RUN, 1441, total=99, start=START + HOUR)])
    assert (row.planned_time_min, row.total_biscuits_made) == (60, 10)


def test_ratios(spark):
    rows = [event(RUN, 30, total=20, good=15), event(CC, 20, total=0, good=0, start=START + HOUR),
            event(PM, 10, total=0, good=0, start=START + 2 * HOUR)]
    (row,) = daily(spark, rows, [("M1", "P1", 80)])
    assert (row.planned_time_min, row.downtime_min, row.changeover_time_min, row.pm_downtime_min) == (
        60, 30, 20, 10)
    assert row.availability == 0.5
    assert row.performance == 0.5  # 20 pieces in half an hour, 80 per hour expected
    assert row.quality == 0.75
    assert row.oee == pytest.approx(0.1875)


def test_day_outside_the_calendar_keeps_its_row(spark):
    raw = raw_tables(spark, [event()])
    spine = date_spine(spark, dt.date(2022, 1, 1), dt.date(2022, 2, 1))
    row = compose(raw, spine=spine).fact_oee_daily.first()
    assert row.is_weekend is None and row.planned_time_min == 10


@pytest.mark.parametrize("day, iso, weekend, week", [
    (dt.date(2021, 7, 1), 4, False, 1), (dt.date(2021, 7, 7), 3, False, 1),
    (dt.date(2021, 7, 8), 4, False, 2), (dt.date(2021, 7, 31), 6, True, 5),
    (dt.date(2021, 8, 1), 7, True, 1), (dt.date(2021, 8, 2), 1, False, 1)])
def test_calendar(spark, day, iso, weekend, week):
    row = marts.dim_date(spark, day, day + dt.timedelta(days=1)).first()
    assert (row.day_of_week_iso, row.is_weekend, row.week_of_month) == (iso, weekend, week)
    assert (row.day_name, row.year_month) == (day.strftime("%A"), day.strftime("%Y-%m"))
    assert row.day_of_month == day.day


def test_spine_excludes_its_end(spark):
    days = [r[0] for r in date_spine(spark, dt.date(2021, 7, 1), dt.date(2021, 8, 1)).collect()]
    assert len(days) == 31 and max(days) == dt.date(2021, 7, 31)
    assert date_spine(spark, dt.date(2021, 7, 1), dt.date(2021, 7, 1)).count() == 0


def test_spine_defaults_to_the_months_of_the_events(spark):
    rows = [event(start=dt.datetime(2021, 6, 30, 23)), event(start=dt.datetime(2021, 8, 2))]
    days = compose(raw_tables(spark, rows)).dim_date
    assert days.count() == 30 + 31 + 31


def test_surrogate_key(spark):
    df = spark.createDataFrame([(None, "a"), ("", "a"), ("x", None)], "k string, v string")
    keys = [r[0] for r in df.select(surrogate_key("k", "v")).collect()]
    assert len(set(keys)) == 3
    assert keys[1] == hashlib.md5(b"-a").hexdigest()
    assert keys[0] == hashlib.md5(b"_dbt_utils_surrogate_key_null_-a").hexdigest()


def test_event_key_text(spark):
    fact = compose(raw_tables(spark, [event(minutes=10)])).fact_machine_events.first()
    text = "M1-2021-07-01 08:00:00-2021-07-01 08:10:00-P1"
    assert fact.event_id == hashlib.md5(text.encode()).hexdigest()


def test_unknown_machine_has_no_key(spark):
    fact = compose(raw_tables(spark, [event(machine="M9")])).fact_machine_events.first()
    assert fact.machine_key is None and fact.product_key is not None


def test_whatif(spark):
    rows = [event(PM, 100, total=0, good=0)]
    (row,) = compose(raw_tables(spark, rows)).mart_whatif_pm_reduction.collect()
    assert row.pm_downtime_reduced_min == 15 and row.extra_run_hours == 0.25
    assert row.avg_throughput_per_hour is None and row.extra_products_estimated is None


def test_whatif_reduction_is_an_argument(spark):
    rows = [event(PM, 60, total=0, good=0), event(RUN, 30, total=40, start=START + 2 * HOUR)]
    fact = compose(raw_tables(spark, rows)).fact_oee_daily
    (row,) = marts.whatif_pm(fact, Decimal("0.5")).collect()
    assert row.pm_downtime_reduced_min == 30 and row.avg_throughput_per_hour == 80
    assert row.extra_products_estimated == 40


def test_summary_from_sums_differs_from_row_mean(spark):
    rows = [event(RUN, 90, total=90, good=90), event(CC, 10, total=0, good=0, start=START + 2 * HOUR),
            event(RUN, 10, total=10, good=0, product="P2")]
    raw = raw_tables(spark, rows, [("M1", "P1", 120)], products=("P1", "P2"))
    (row,) = compose(raw).mart_oee_monthly_summary.collect()
    assert row.year_month == "2021-07"
    assert row.availability == pytest.approx(100 / 110)
    # the product without a target adds output but no expected pieces: 100 / (120 * 1.5)
    assert row.performance == pytest.approx(100 / 180)
    assert row.quality == 0.9
    assert row.oee == pytest.approx(100 / 110 * 100 / 180 * 0.9)
    # run-weighted: P1 has A .9, P .5, Q 1 over 90 min, P2 has Q 0
    assert row.oee_weighted_avg == pytest.approx(0.45 * 0.9)


def test_summary_has_one_row_per_month(spark):
    rows = [event(start=dt.datetime(2021, m, 5)) for m in (6, 7)]
    summary = compose(raw_tables(spark, rows)).mart_oee_monthly_summary
    assert sorted(r.year_month for r in summary.collect()) == ["2021-06", "2021-07"]


def test_whole_plant_summary_of_nothing(spark):
    fact = compose(raw_tables(spark, [event(NO)])).fact_oee_daily
    (row,) = marts.monthly_summary(fact, label="2021-07").collect()
    assert (row.year_month, row.availability, row.performance, row.quality, row.oee) == (
        "2021-07", None, 1.0, 1.0, 0.0)
    assert marts.monthly_summary(fact).count() == 0


def test_counters_beyond_a_long(spark):
    big = 2**62
    rows = [event(total=big, good=big, start=START + n * dt.timedelta(days=1)) for n in range(4)]
    (row,) = compose(raw_tables(spark, rows)).mart_oee_monthly_summary.collect()
    assert row.total_biscuits_made == 4 * big
