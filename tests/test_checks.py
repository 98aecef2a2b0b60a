"""Data-quality checks pass on good data and fail on corrupted data."""

from __future__ import annotations

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millwright.plans import checks
from millwright.plans.build import build_scratch, compose
from rows import CC, JUNK, NO, RUN, START, event, raw_fact, raw_tables

HOUR = dt.timedelta(hours=1)


@pytest.fixture(scope="module")
def models(spark):
    rows = [event(c, 30, start=START + n * HOUR) for n, c in enumerate((RUN, CC, NO, JUNK))]
    return build_scratch(raw_tables(spark, rows, [("M1", "P1", 50)])).tables()


def failures(result):
    return {(r.table_name, r.check_kind, r.column_name): r.failures for r in result.collect() if r.failures}


def test_declared_checks():
    kinds = Counter(c.kind for c in checks.DECLARED)
    assert kinds == {"not_null": 37, "expression_is_true": 14, "unique": 10, "relationships": 6,
                     "accepted_values": 3, "accepted_range": 2}
    assert Counter(c.table for c in checks.DECLARED) == {
        "stg_fact_events": 9, "stg_target_speeds": 4, "stg_product": 3, "stg_machine": 2,
        "int_events_classified": 4, "int_daily_machine_product": 10, "dim_machine": 5,
        "dim_product": 5, "dim_date": 3, "fact_machine_events": 9, "fact_oee_daily": 10,
        "mart_oee_monthly_summary": 5, "mart_whatif_pm_reduction": 3}


def test_good_data_passes(models):
    result = checks.run_suite(models)
    assert result.count() == 72 and failures(result) == {}
    assert {r.status for r in result.collect()} == {"pass"}


BAD = {
    ("stg_fact_events", "not_null", "machine"): ("machine", "cast(null as string)"),
    ("stg_fact_events", "accepted_range", "duration_minutes"): ("duration_minutes", "cast(-1 as decimal(18,6))"),
    ("int_events_classified", "accepted_values", "oee_status_group"): ("oee_status_group", "'IDLE'"),
    ("fact_machine_events", "unique", "event_id"): ("event_id", "'same'"),
    ("fact_machine_events", "relationships", "machine_key"): ("machine_key", "'nobody'"),
    ("fact_oee_daily", "expression_is_true", "oee"): ("oee", "1.5D"),
}


@pytest.mark.parametrize("expected", BAD, ids="-".join)
def test_corrupted_data_fails(models, expected):
    table, _, _ = expected
    column, value = BAD[expected]
    corrupted = models | {table: models[table].withColumn(column, F.expr(value))}
    assert expected in failures(checks.run_suite(corrupted))


def test_orphan_rows_are_counted_not_keys(models):
    bad = models["fact_machine_events"].withColumn("machine_key", F.lit("nobody"))
    result = failures(checks.run_suite(models | {"fact_machine_events": bad}))
    assert result[("fact_machine_events", "relationships", "machine_key")] == 4


def test_null_passes_everything_but_not_null(spark):
    df = spark.createDataFrame([(None, None), (None, None)], "k string, n int")
    parent = spark.createDataFrame([("a",)], "k string")
    assert checks.check_not_null(df, "k").count() == 2
    assert checks.check_unique(df, "k").count() == 0
    assert checks.check_accepted_values(df, "k", ["a"]).count() == 0
    assert checks.check_relationships(df, "k", parent).count() == 0
    assert checks.check_accepted_range(df, "n", 1).count() == 0
    assert checks.check_expression(df, "n > 1").count() == 0


def test_range_includes_its_minimum(spark):
    df = spark.createDataFrame([(0,), (1,)], "n int")
    assert [r.n for r in checks.check_accepted_range(df, "n", 1).collect()] == [0]


def test_repeated_target_pair_is_found(models):
    twice = models["stg_target_speeds"].unionAll(models["stg_target_speeds"])
    found = checks.extra_unique_failures(models | {"stg_target_speeds": twice})
    assert {r.table_name: r.failures for r in found.collect()} == {
        "stg_target_speeds": 1, "fact_oee_daily": 0}


def test_quality_profile(spark):
    rows = [
        event(RUN, 30, total=5), event(RUN, 30, total=9),  # repeated reading
        event(JUNK, 2000, total=1, good=2, start=START + HOUR),
        event(NO, 10, total=1, good=2, machine="M2"),
    ]
    raw = raw_fact(spark, rows)
    classified = compose(raw_tables(spark, rows)).int_events_classified
    row = checks.quality_profile(raw, classified).first()
    assert row.asDict() == {
        "raw_rows": 4, "event_rows": 3, "duplicate_rows": 1, "outlier_rows": 1, "unknown_rows": 1,
        "no_order_rows": 1, "good_above_total_rows": 3, "day_groups": 2, "dropped_day_groups": 1}


def test_suite_counts_values_keys_and_rows(spark):
    """Every kind of check in one pass, against plain counting."""
    child = spark.createDataFrame(
        [("a", "x", 1, "p"), ("a", "y", 2, "p"), ("b", "z", -1, "q"), (None, "z", None, None),
         ("b", "w", 5, "r"), ("b", None, 5, "r")], "k string, v string, n int, f string")
    parent = spark.createDataFrame([("p",), ("p",), ("q",), (None,)], "f string")
    suite = [
        checks.Check("child", "unique", "k"), checks.Check("child", "unique", ("k", "n")),
        checks.Check("child", "accepted_values", "v", values=("x", "y")),
        checks.Check("child", "relationships", "f", parent="parent"),
        checks.Check("child", "not_null", "n"), checks.Check("child", "accepted_range", "n", minimum=0),
        checks.Check("child", "expression_is_true", "n", expression="< 5"),
        checks.Check("parent", "unique", "f"),
    ]
    found = checks.run_suite({"child": child, "parent": parent}, suite).collect()
    assert {(r.table_name, r.check_kind, r.column_name): r.failures for r in found} == {
        ("child", "unique", "k"): 2, ("child", "unique", "k, n"): 1,
        ("child", "accepted_values", "v"): 2, ("child", "relationships", "f"): 2,
        ("child", "not_null", "n"): 1, ("child", "accepted_range", "n"): 1,
        ("child", "expression_is_true", "n"): 2, ("parent", "unique", "f"): 1}
    values = checks.check_accepted_values(child, "v", ("x", "y"))
    assert sorted(map(tuple, values.collect())) == [("w", 1), ("z", 2)]


def test_composite_keys_are_not_confused(spark):
    df = spark.createDataFrame([("1:a", "b"), ("1", "a1:b"), ("a", ""), ("", "a")], "x string, y string")
    suite = [checks.Check("t", "unique", ("x", "y"))]
    assert checks.run_suite({"t": df}, suite).first().failures == 0


def test_suite_over_empty_tables_passes(spark, models):
    empty = {name: df.limit(0) for name, df in models.items()}
    result = checks.run_suite(empty)
    assert result.count() == 72 and failures(result) == {}
