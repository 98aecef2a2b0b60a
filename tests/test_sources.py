"""Reading, preparing, loading and storing tables."""

from __future__ import annotations

import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millwright import schemas
from millwright.plans import build, reports, staging
from millwright.sources import load, raw, tables
from rows import CC, RUN, START, event, raw_fact, raw_tables


@pytest.mark.parametrize("heading, name", [
    ("Target (per/hour)", "target__per_hour_"), (" OEE Category ", "oee_category"),
    ("Good-Made", "good_made"), ("StartDateTime", "startdatetime")])
def test_normalize_name(heading, name):
    assert raw.normalize_name(heading) == name


def test_drop_by_prefix_reports_what_it_dropped(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["Product", "Bsicuits Per Pallet", "Biscuits Per Pallet"])
    kept, dropped = raw.drop_by_prefix(df)
    assert kept.columns == ["Product", "Biscuits Per Pallet"]
    assert dropped == ["Bsicuits Per Pallet"]


def test_csv_sheet(spark, tmp_path):
    path = tmp_path / "product.csv"
    path.write_text(
        "Product Name,Biscuits Per Pack,Biscuits Per Case,Bsicuits Per Pallet,Biscuits Per Pallet\n"
        " Creams ,10,120,999,4800\n"
    )
    df = raw.read_raw(spark, str(path), "raw_product", "csv")
    assert df.schema.simpleString() == schemas.RAW_PRODUCT.simpleString()
    assert tuple(df.first()) == (" Creams ", 10, 120, 4800)


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_other_formats(spark, tmp_path, fmt):
    rows = spark.createDataFrame([("M1 ", "P1", Decimal("12.5"))], schemas.RAW_TARGET_SPEEDS)
    rows.write.format(fmt).save(str(tmp_path / fmt))
    df = raw.read_raw(spark, str(tmp_path / fmt), "raw_target_speeds", fmt)
    assert [tuple(r) for r in df.collect()] == [("M1 ", "P1", Decimal("12.500000"))]


@pytest.mark.parametrize("given, counter", [
    (3.7, 4), (2.5, 2), (3.5, 4), (float("nan"), None), ("2.6", 3), (Decimal("9007199254740993.4"), 9007199254740993)])
def test_fractional_counters_are_rounded(spark, given, counter):
    df = raw_fact(spark, [event()]).withColumn("totalbiscuitsmade", F.lit(given))
    assert raw.prepare(df, "raw_fact")[0].first().totalbiscuitsmade == counter
    assert staging.trim_events(df).first().total_biscuits_made == counter


def test_bad_timestamp_raises(spark):
    df = raw_fact(spark, [event()]).withColumn("startdatetime", F.lit("yesterday"))
    with pytest.raises(PySparkException):
        raw.prepare(df, "raw_fact")[0].collect()


def machines(spark, *names):
    return spark.createDataFrame([(n, "Baking") for n in names], schemas.RAW_MACHINE)


def test_reload_is_idempotent_and_replaces(spark):
    for names in (("M1", "M2"), ("M1", "M2"), ("M3",), ("M4", "M5", "M6")):
        stored = tables.write_table(machines(spark, *names), "raw_machine", "raw_reload")
        assert sorted(r[0] for r in stored.collect()) == sorted(names)
        assert spark.table("raw_reload.raw_machine").count() == len(names)


def test_failed_reload_keeps_the_old_rows(spark):
    tables.write_table(machines(spark, "M1"), "raw_machine", "raw_failed")
    bad = machines(spark, "x").withColumn(
        "machine_type", F.raise_error(F.lit("broken source")).cast("string"))
    with pytest.raises(PySparkException):
        tables.write_table(bad, "raw_machine", "raw_failed")
    assert [r[0] for r in spark.table("raw_failed.raw_machine").collect()] == ["M1"]


def test_load_counts_in_the_write(spark):
    stored, report = load.load_table(machines(spark, "M1", "M2"), "raw_machine", "raw_load", expected=2)
    assert (report.n_rows, report.status, stored.count()) == (2, load.OK, 2)
    _, report = load.load_table(machines(spark, "M1"), "raw_machine", "raw_load", expected=2)
    assert (report.n_rows, report.status) == (1, load.DIFFERS)


def test_reconcile(spark):
    rows = machines(spark, "M1", "M2")
    found = [load.reconcile(rows, "t", n).first().status for n in (None, 2, 3)]
    assert found == [load.OK, load.OK, load.DIFFERS]


def test_strict_load_keeps_the_old_table(spark):
    load.load_table(machines(spark, "M1", "M2"), "raw_machine", "raw_strict")
    with pytest.raises(load.RowCountMismatch):
        load.load_table(machines(spark, "M1"), "raw_machine", "raw_strict", expected=2, strict=True)
    assert spark.table("raw_strict.raw_machine").count() == 2


def test_load_all_reports_dropped_columns(spark, tmp_path):
    (tmp_path / "p.csv").write_text(
        "Product Name,Biscuits Per Pack,Biscuits Per Case,Biscuits Per Pallet,Bsicuits Per Pallet\nA,1,2,3,4\n")
    (tmp_path / "m.csv").write_text("Machine Name,Machine Type\nM1,Baking\nM2,Mixing\n")
    reports = load.load_all(
        spark, {"raw_product": str(tmp_path / "p.csv"), "raw_machine": str(tmp_path / "m.csv")})
    assert [(r.table, r.n_rows, r.dropped_columns) for r in reports] == [
        ("raw_product", 1, ("Bsicuits Per Pallet",)), ("raw_machine", 2, ())]
    counted = load.verify_counts({t: spark.table(f"raw.{t}") for t in ("raw_product", "raw_machine")})
    assert sorted(map(tuple, counted.collect())) == [("raw_machine", 2), ("raw_product", 1)]


@pytest.mark.parametrize("days, status", [(10, "pass"), (20, "pass"), (21, "warn"), (31, "error")])
def test_freshness(spark, days, status):
    as_of = START + dt.timedelta(days=days)
    row = load.freshness(raw_fact(spark, [event()]), "startdatetime", as_of, 20, 30).first()
    assert (row.age_days, row.status) == (days, status)


def test_freshness_of_nothing_is_an_error(spark):
    assert load.freshness(raw_fact(spark, []), "startdatetime", START).first().status == "error"


def test_layers():
    assert tables.layer_name(tables.layer_of("raw_fact"), "raw_fact") == "raw.raw_fact"
    assert [tables.layer_of(t) for t in ("stg_machine", "int_events_classified", "dim_date", "fact_oee_daily")] == [
        "staging", "intermediate", "marts", "marts"]


def month_rows():
    return [
        event(c, 30, start=dt.datetime(2021, m, d), machine=k)
        for c in (RUN, CC) for m in (6, 7) for d in (1, 2) for k in ("M1", "M2")
    ]


def test_catalog_build_equals_lazy_build(spark):
    raw_ = raw_tables(spark, month_rows(), [("M1", "P1", 50)], machines=("M1", "M2"))
    lazy = build.compose(raw_).tables()
    for _ in range(2):
        stored = build.build_catalog(raw_).tables()
        for name, df in lazy.items():
            got = stored[name].select(*df.columns)
            assert sorted(map(str, got.collect())) == sorted(map(str, df.collect())), name
    assert spark.table("marts.fact_oee_daily").count() == lazy["fact_oee_daily"].count()
    assert spark.sql("SHOW PARTITIONS marts.fact_oee_daily").count() == 2


def test_date_filter_prunes_months(spark):
    models = build.build_catalog(raw_tables(spark, month_rows()))
    july = reports.Filters((dt.date(2021, 7, 1), dt.date(2021, 7, 31)))
    for fact in (models.fact_oee_daily, models.fact_machine_events):
        filtered = reports.apply_filters(fact, july)
        plan = filtered._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PartitionFilters: \[[^\]]*year_month#\d+ >= 2021-07", plan)
        assert filtered.count() == fact.count() / 2


def test_load_by_day_keeps_rows_and_order(spark):
    rows = raw_fact(spark, month_rows()).repartition(5)
    stored, report = load.load_table(rows, "raw_fact", "raw_by_day", by_day="startdatetime")
    assert report.n_rows == stored.count() == len(month_rows())
    starts = [r.startdatetime for r in stored.collect()]
    assert starts == sorted(starts)  # one small file


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_one_month_is_replaced_alone(spark):
    fact = build.build_catalog(raw_tables(spark, month_rows())).fact_oee_daily
    june = rows_of(fact.filter("year_month = '2021-06'"))
    changed = tables.materialize(fact.withColumn("oee", F.lit(0.5)), "changed")
    after = tables.replace_months(changed, ["2021-07"], "fact_oee_daily")
    assert rows_of(after.filter("year_month = '2021-06'")) == june
    assert {r.oee for r in after.filter("year_month = '2021-07'").collect()} == {0.5}
    assert after.count() == 2 * len(june)


def test_month_without_rows_becomes_empty(spark):
    fact = build.build_catalog(raw_tables(spark, month_rows())).fact_oee_daily
    nothing = tables.materialize(fact.filter("false"), "nothing")
    after = tables.replace_months(nothing, ["2021-07"], "fact_oee_daily")
    assert {r.year_month for r in after.select("year_month").collect()} == {"2021-06"}


def test_monthly_refreshes_add_up_to_a_full_build(spark):
    for name in build.MONTHLY:
        spark.sql(f"DROP TABLE IF EXISTS marts.{name}")
    raw_ = raw_tables(spark, month_rows(), [("M1", "P1", 50)], machines=("M1", "M2"))
    for month in (6, 7):
        day = dt.date(2021, month, 15)
        stored = build.refresh_months(raw_, day, day).tables()
    late = event(RUN, 20, start=dt.datetime(2021, 6, 9), machine="M2")
    undated = tuple(None if isinstance(v, dt.datetime) else v for v in late)
    raw_ = raw_tables(spark, [*month_rows(), late, undated], [("M1", "P1", 50)], machines=("M1", "M2"))
    stored = build.refresh_months(raw_, dt.date(2021, 6, 9), dt.date(2021, 6, 9)).tables()
    whole = build.compose(raw_).tables()
    for name in ("fact_machine_events", "fact_oee_daily", "dim_date",
                 "mart_oee_monthly_summary", "mart_whatif_pm_reduction"):
        assert rows_of(stored[name].select(*whole[name].columns)) == rows_of(whole[name]), name


def test_from_csv_sheets_to_a_report(spark, tmp_path):
    sheets = {
        "raw_fact": (
            "Machine,StartDateTime,EndDateTime,Duration,TotalBiscuitsMade,GoodMadeBiscuits,OEE Category,Product",
            "M1 ,2021-07-01 08:00:00,2021-07-01 09:00:00,60,100,80,Run Time,P1",
            "M1 ,2021-07-01 08:00:00,2021-07-01 09:00:00,60,90,80,Run Time,P1",
            "M1,2021-07-01 10:00:00,2021-07-01 10:20:00,20.0,0.0,0,CC (Changeover Cleaning), P1",
        ),
        "raw_target_speeds": ("Machine,Product,Target Biscuits Per Hour", "M1,P1,200"),
        "raw_product": (
            "Product Name,Biscuits Per Pack,Biscuits Per Case,Bsicuits Per Pallet,Biscuits Per Pallet",
            "P1,10,120,,4800",
        ),
        "raw_machine": ("Machine Name,Machine Type", "M1 ,Baking"),
    }
    for name, lines in sheets.items():
        (tmp_path / f"{name}.csv").write_text("\n".join(lines) + "\n")
    paths = {name: str(tmp_path / f"{name}.csv") for name in sheets}
    loaded = load.load_all(spark, paths, expected={"raw_fact": 4})
    assert [(r.n_rows, r.status) for r in loaded] == [(3, load.DIFFERS), (1, load.OK), (1, load.OK), (1, load.OK)]
    models = build.build_catalog(load.stored_raw(spark))
    (row,) = models.fact_oee_daily.collect()
    assert (row.planned_time_min, row.run_time_min, row.total_biscuits_made) == (80, 60, 100)
    assert (row.availability, row.performance, row.quality) == (0.75, 0.5, 0.8)
    (shown,) = reports.report("oee_machine", models).collect()
    assert tuple(shown) == ("M1", 30.0, "CC (Changeover Cleaning): 0.3h")
