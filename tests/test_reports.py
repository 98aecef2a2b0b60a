"""Reports: filters, order, ties, empty input."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from millwright.plans import reports
from millwright.plans.build import build_scratch, compose
from millwright.plans.reports import Filters, page, report
from rows import CC, JUNK, NO, PM, RUN, START, event, raw_tables

HOUR = dt.timedelta(hours=1)
DAY = dt.timedelta(days=1)


@pytest.fixture(scope="module")
def plant(spark):
    rows = []
    for d in range(4):
        for i, machine in enumerate(("M1", "M2", "M3")):
            at = START + d * DAY
            rows += [
                event(RUN, 60 + i, total=100, good=100 - 10 * i - d, machine=machine, start=at),
                event(CC, 10 * (i + 1), total=0, good=0, machine=machine, start=at + 2 * HOUR),
                event(PM, 5, total=0, good=0, machine=machine, start=at + 3 * HOUR, product="P2"),
                event(NO, 20, total=0, good=0, machine=machine, start=at + 4 * HOUR),
            ]
    rows.append(event(JUNK, 2000, machine="M1", start=START + 5 * HOUR))
    raw = raw_tables(spark, rows, [("M1", "P1", 200), ("M2", "P1", 50)],
                     products=("P1", "P2"), machines=("M1", "M2", "M3"))
    return build_scratch(raw)


def test_every_report_has_rows_and_a_key_order(plant):
    for key in reports.REPORTS:
        assert report(key, plant).count() > 0, key


def test_order_of_metric(plant):
    by_machine = report("oee_machine", plant).collect()
    assert [r.oee_pct for r in by_machine] == sorted(r.oee_pct for r in by_machine)
    waste = [r.waste_pct for r in report("waste_product", plant).collect()]
    assert waste == sorted(waste, reverse=True)


def test_breakdown_is_sorted_by_quality(plant):
    quality = [r.quality_pct for r in report("apq_machine", plant).collect()]
    assert quality == sorted(quality, reverse=True)


def test_weekdays_come_in_the_order_of_their_first_date(plant):
    rows = report("oee_dow", plant).collect()
    assert [r.day_name for r in rows] == ["Thursday", "Friday", "Saturday", "Sunday"]
    assert [r.day_group for r in rows] == ["Ngày thường"] * 2 + ["Cuối tuần"] * 2


def test_reasons_text(plant):
    text = {r.machine: r.main_stop_reasons for r in report("oee_machine", plant).collect()}
    # 2000 junk minutes, 80 orderless, 40 changeover, 20 maintenance
    assert text["M1"] == "0: 33.3h · NO (No Order): 1.3h · CC (Changeover Cleaning): 0.7h"
    bare = reports.top_reasons(plant.fact_machine_events, include_outliers=False)
    assert {r.machine: r.main_stop_reasons for r in bare.collect()}["M1"] == (
        "NO (No Order): 1.3h · CC (Changeover Cleaning): 0.7h · PM (Maintenance): 0.3h")


def test_reasons_ignore_page_filters(plant):
    wide = {r.machine: r.main_stop_reasons for r in report("oee_machine", plant).collect()}
    one_day = Filters((START.date(), START.date()), "M1")
    (row,) = report("oee_machine", plant, one_day).collect()
    assert row.main_stop_reasons == wide["M1"]


def test_null_category_takes_a_rank_but_no_text(spark):
    rows = [event(None, 600), event(CC, 60, start=START + HOUR), event(PM, 30, start=START + 2 * HOUR),
            event(NO, 6, start=START + 3 * HOUR)]
    marts_ = compose(raw_tables(spark, rows))
    (row,) = report("oee_machine", marts_).collect()
    assert row.main_stop_reasons == "CC (Changeover Cleaning): 1.0h · PM (Maintenance): 0.5h"


def test_machine_that_only_ran_has_no_reasons(spark):
    (row,) = report("oee_machine", compose(raw_tables(spark, [event()]))).collect()
    assert row.main_stop_reasons is None


def test_equal_machines_are_ordered_by_name(spark):
    rows = [event(machine=m) for m in ("M3", "M1", "M2")]
    marts_ = compose(raw_tables(spark, rows))
    assert [r.machine for r in report("stability", marts_).collect()] == ["M1", "M2", "M3"]
    assert report("worst_machine", marts_).first().machine == "M1"


def test_one_day_has_no_deviation(spark):
    assert report("stability", compose(raw_tables(spark, [event()]))).first().oee_stddev_pct is None


def test_null_speed_sorts_last_and_null_gain_first(spark):
    rows = [event(PM, 60, machine="M1"), event(RUN, 60, machine="M2")]
    marts_ = compose(raw_tables(spark, rows))
    assert [r.machine for r in report("speed_machine", marts_).collect()] == ["M2", "M1"]
    assert [r.machine for r in report("whatif_products", marts_).collect()] == ["M1", "M2"]


def test_display_rounding_is_half_away_from_zero(spark):
    # 1/32 of 100 % = 3.125 %; gap 3.125 - 85 = -81.875
    rows = [event(RUN, 60, total=32, good=1)]
    marts_ = compose(raw_tables(spark, rows))
    assert report("kpi_oee", marts_).first().oee_pct == 3.13
    assert report("kpi_worldclass", marts_).first().gap_points == -81.88


def test_gap_report_keeps_twenty_rows(spark):
    products = [f"P{n:02d}" for n in range(25)]
    rows = [event(product=p) for p in products]
    marts_ = compose(raw_tables(spark, rows, products=products))
    assert [r["product"] for r in report("perf_gap", marts_).collect()] == products[:20]


def test_empty_selection(plant):
    nobody = Filters(machine="nobody")
    assert report("kpi_oee", plant, nobody).first().oee_pct is None
    assert report("worst_machine", plant, nobody).count() == 0


def test_filters(plant):
    first = START.date()
    both = Filters((first, first + DAY), ["M1", "M2"], "P1")
    days = reports.apply_filters(plant.fact_oee_daily, both)
    assert days.count() == 4
    assert report("oee_trend", plant, Filters((first, first + DAY))).count() == 2


def test_unknown_filter_is_an_error(plant):
    with pytest.raises(ValueError):
        report("cc_pct", plant, Filters(product="P1"))
    with pytest.raises(ValueError):
        report("whatif_hours", plant, Filters(date_range=(START.date(), START.date())))


def test_page_passes_on_only_bound_filters(plant):
    everything = Filters((START.date(), START.date()), "M1", "P1")
    overview = page(1, plant, everything)
    assert set(overview) == {"kpi_oee", "kpi_availability", "kpi_performance", "kpi_quality",
                             "kpi_worldclass", "oee_trend", "oee_dow"}
    trend = report("oee_trend", plant, Filters((START.date(), START.date())))
    assert overview["oee_trend"].collect() == trend.collect()
    assert {n: len(page(n, plant)) for n in range(1, 6)} == {1: 7, 2: 4, 3: 5, 4: 3, 5: 3}


def test_drill_day(plant):
    rows = page(2, plant, reports.drill_day(START.date()))["stability"].collect()
    assert len(rows) == 3
    # two day rows per machine: P1, and P2 with maintenance only
    assert all(r.oee_stddev_pct is not None for r in rows)


def test_hours_are_rounded_once(spark):
    # 2.999999 min = 0.04999998 h stays 0.0
    rows = [event(CC, Decimal("2.999999")), event(PM, 3, start=START + HOUR)]
    marts_ = compose(raw_tables(spark, rows))
    hours = {r.oee_category_raw: r.hours for r in report("downtime_cat", marts_).collect()}
    assert hours == {CC: 0.0, PM: 0.1}
