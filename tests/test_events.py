"""Staging, deduplication and classification of single events."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millwright.config import Settings
from millwright.plans import intermediate, staging
from rows import CC, JUNK, NO, RUN, START, event, raw_fact, raw_tables
from millwright.plans.build import compose


def classified(spark, rows, **settings):
    staged = staging.stg_events(raw_fact(spark, rows))
    return intermediate.events_classified(staged, Settings(**settings))


def test_padded_names_join_after_trim(spark):
    raw = raw_tables(spark, [event(machine="M1 ", product=" P1")], [("M1", "P1", 50)])
    row = compose(raw).fact_oee_daily.first()
    assert (row.machine, row.product) == ("M1", "P1")
    assert row.target_biscuits_per_hour == 50
    assert row.machine_key is not None and row.product_key is not None


def test_trim_removes_spaces_only(spark):
    row = staging.trim_events(raw_fact(spark, [event(machine=" \tM1\t ")])).first()
    assert row.machine == "\tM1\t"


@pytest.mark.parametrize("totals, kept", [((5, 9), 9), ((None, 9), None), ((7, 7), 7)])
def test_dedup_keeps_highest_total_null_first(spark, totals, kept):
    rows = [event(total=t) for t in totals]
    assert [r.total_biscuits_made for r in staging.stg_events(raw_fact(spark, rows)).collect()] == [kept]


def test_dedup_runs_after_trim(spark):
    rows = [event(machine="M1 ", total=1), event(machine="M1", total=2)]
    assert staging.stg_events(raw_fact(spark, rows)).count() == 1


def test_dedup_keeps_rows_that_end_differently(spark):
    rows = [event(minutes=5), event(minutes=6)]
    assert staging.stg_events(raw_fact(spark, rows)).count() == 2


def test_dedup_tie_does_not_depend_on_partitioning(spark):
    rows = [event(total=7, good=g, category=c) for g in (1, 2, 3) for c in (RUN, CC, None)]
    seen = set()
    for n in (1, 3, 8):
        df = raw_fact(spark, rows).repartition(n).orderBy(F.rand(n))
        seen.add(tuple(staging.stg_events(df).first()))
    assert len(seen) == 1
    # a NULL category ranks first among equal totals and good counts
    assert next(iter(seen))[5:7] == (3, None)


@pytest.mark.parametrize("category, group", [
    ("run time x", "RUN"), ("Run Time", "RUN"), ("CC", "CHANGEOVER"), ("pm", "PLANNED_DOWNTIME_PM"),
    ("No Order", "NO_ORDER"), ("NOTHING", "NO_ORDER"), ("0", "UNKNOWN"), (None, "UNKNOWN"),
    ("XYZ", "UNKNOWN"), ("", "UNKNOWN"), (" cc ", "CHANGEOVER"), ("xcc", "UNKNOWN"),
])
def test_status_group_by_prefix(spark, category, group):
    assert classified(spark, [event(category)]).first().oee_status_group == group


@pytest.mark.parametrize("category, unknown", [("0", True), ("", True), (None, True), ("XYZ", False)])
def test_unknown_flag_is_narrower_than_the_group(spark, category, unknown):
    assert classified(spark, [event(category)]).first().is_unknown_category is unknown


@pytest.mark.parametrize("minutes, outlier", [
    (1440, False), (Decimal("1440.01"), True), (None, None)])
def test_outlier_is_strictly_longer(spark, minutes, outlier):
    assert classified(spark, [event(minutes=minutes)]).first().is_duration_outlier is outlier


@pytest.mark.parametrize("category, minutes, stop", [
    (CC, Decimal("2.99"), "MINOR"), (CC, 3, "MAJOR"), (NO, 1, "MINOR"), (JUNK, 30, "MAJOR"),
    (RUN, 1, None), (RUN, 100, None), (CC, None, None)])
def test_stoppage_class(spark, category, minutes, stop):
    assert classified(spark, [event(category, minutes)]).first().stoppage_class == stop


def test_thresholds_are_settings(spark):
    row = classified(spark, [event(CC, 50)], outlier_minutes=40, major_minutes=60).first()
    assert (row.is_duration_outlier, row.stoppage_class) == (True, "MINOR")


def test_event_day_is_the_start_day(spark):
    late = event(start=dt.datetime(2021, 7, 1, 23, 50), end=dt.datetime(2021, 7, 2, 0, 30), minutes=40)
    daily = compose(raw_tables(spark, [late])).int_daily_machine_product.collect()
    assert [(r.event_date, r.planned_time_min) for r in daily] == [(dt.date(2021, 7, 1), 40)]


def test_null_duration_leaves_the_daily_sums(spark):
    rows = [event(minutes=None, total=5), event(minutes=10, total=7, start=START + dt.timedelta(hours=1))]
    daily = compose(raw_tables(spark, rows)).int_daily_machine_product.first()
    assert (daily.planned_time_min, daily.total_biscuits_made) == (10, 7)


def test_bad_cast_raises(spark):
    bad = raw_fact(spark, [event()]).withColumn("duration", F.lit("ten"))
    with pytest.raises(PySparkException):
        staging.stg_events(bad).collect()
