"""Snapshot switches, persistent views by layer, and the load log."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millwright import fixtures, schemas
from millwright.config import Settings
from millwright.plans import build, views
from millwright.scratch import scratch_database
from millwright.sources import load, tables
from rows import CC, JUNK, NO, PM, RUN, START, event, raw_fact, raw_tables


def machines(spark, *names):
    return spark.createDataFrame([(n, "Baking") for n in names], schemas.RAW_MACHINE)


def names(df):
    return sorted(r[0] for r in df.collect())


def folders(spark, layer, table):
    return os.listdir(tables.table_folder(spark, table, layer).removeprefix("file:"))


def rows_of(df):
    return sorted(map(str, df.collect()))


# --- full reload --------------------------------------------------------------------


def test_a_reader_that_began_before_the_reload_finishes_on_the_old_rows(spark):
    layer = scratch_database(spark)
    tables.write_table(machines(spark, "old"), "raw_machine", layer)
    reader = spark.table(f"{layer}.raw_machine")
    half_read = reader.toLocalIterator()
    tables.write_table(machines(spark, "new1", "new2"), "raw_machine", layer)
    assert [r[0] for r in half_read] == ["old"] == names(reader)
    assert names(spark.table(f"{layer}.raw_machine")) == ["new1", "new2"]
    assert names(spark.newSession().table(f"{layer}.raw_machine")) == ["new1", "new2"]


def test_a_stop_between_write_and_switch_leaves_the_old_rows(spark):
    layer = scratch_database(spark)
    tables.write_table(machines(spark, "old"), "raw_machine", layer)
    tables.stage_write(machines(spark, "lost"), "raw_machine", layer)  # and the job dies
    assert names(spark.table(f"{layer}.raw_machine")) == ["old"]
    tables.write_table(machines(spark, "new"), "raw_machine", layer)
    assert names(spark.table(f"{layer}.raw_machine")) == ["new"]
    assert len(folders(spark, layer, "raw_machine")) == 2  # live and the one before


def test_only_the_live_snapshot_and_the_one_before_it_are_kept(spark):
    layer = scratch_database(spark)
    for n in range(5):
        tables.write_table(machines(spark, f"M{n}"), "raw_machine", layer)
    assert len(folders(spark, layer, "raw_machine")) == 2
    assert names(spark.table(f"{layer}.raw_machine")) == ["M4"]


def test_a_reload_may_change_columns(spark):
    layer = scratch_database(spark)
    tables.write_table(machines(spark, "M1"), "t", layer)
    tables.write_table(spark.range(3), "t", layer)
    assert names(spark.table(f"{layer}.t")) == [0, 1, 2]


# --- partition switch ---------------------------------------------------------------


def facts(spark, *rows):
    return spark.createDataFrame(rows, "machine string, date_key date, oee double")


JUNE, JULY, AUGUST = (dt.date(2021, m, 3) for m in (6, 7, 8))


def test_months_are_switched_each_in_one_step(spark):
    layer = scratch_database(spark)
    first = facts(spark, ("a", JUNE, 0.1), ("a", JULY, 0.1), ("u", None, 0.1))
    tables.write_mart(first, "f", layer, "year_month")
    reader = spark.table(f"{layer}.f").where("year_month = '2021-07'")
    reader._jdf.queryExecution().executedPlan()  # files are chosen
    late = facts(spark, ("b", JULY, 0.2), ("c", AUGUST, 0.2), ("d", JUNE, 0.9))
    after = tables.replace_months(late, ["2021-07", "2021-08"], "f", layer)
    assert rows_of(after.select("machine", "year_month")) == rows_of(spark.createDataFrame(
        [("a", "2021-06"), ("b", "2021-07"), ("c", "2021-08")], "machine string, year_month string"))
    assert names(reader) == ["a"]


def test_a_stop_before_the_switch_changes_no_month(spark):
    layer = scratch_database(spark)
    tables.write_mart(facts(spark, ("a", JUNE, 0.1), ("a", JULY, 0.1)), "f", layer, "year_month")
    bad = facts(spark, ("b", JULY, 0.2)).withColumn(
        "oee", F.raise_error(F.lit("broken")).cast("double"))
    with pytest.raises(PySparkException):
        tables.replace_months(bad, ["2021-07"], "f", layer)
    staged = facts(spark, ("x", JULY, 0.3)).withColumn("year_month", F.lit("2021-07"))
    tables.stage_write(staged, "f", layer, ["year_month"])
    assert names(spark.table(f"{layer}.f")) == ["a", "a"]
    assert names(tables.replace_months(
        facts(spark, ("b", JULY, 0.2)), ["2021-07"], "f", layer)) == ["a", "b"]


def test_refreshes_leave_at_most_two_snapshots_of_a_month(spark):
    layer = scratch_database(spark)
    tables.write_mart(facts(spark, ("a", JUNE, 0.1), ("a", JULY, 0.1)), "f", layer, "year_month")
    for n in range(4):
        tables.replace_months(facts(spark, (f"b{n}", JULY, 0.2)), ["2021-07"], "f", layer)
    base = tables.table_folder(spark, "f", layer).removeprefix("file:")
    found = [m for v in os.listdir(base) for m in os.listdir(f"{base}/{v}") if "=" in m]
    assert sorted(found) == ["year_month=2021-06", "year_month=2021-07", "year_month=2021-07"]
    assert names(spark.table(f"{layer}.f")) == ["a", "b3"]


def test_full_reload_of_a_partitioned_mart_drops_months_without_rows(spark):
    layer = scratch_database(spark)
    tables.write_mart(facts(spark, ("a", JUNE, 0.1), ("a", None, 0.1)), "f", layer, "year_month")
    after = tables.write_mart(facts(spark, ("b", JULY, 0.1)), "f", layer, "year_month")
    assert names(after) == ["b"]


# --- views by layer -----------------------------------------------------------------


def scratch_layers(spark):
    return {layer: scratch_database(spark, layer) for layer in views.LAYERS}


def store_raw(spark, raw, layers):
    for name, df in raw.items():
        tables.write_table(df, name, layers["raw"])


def messy(spark):
    rows = [
        event(c, m, t, g, machine=k, start=s, end=START)
        for c in (RUN, CC, PM, NO, JUNK, "", "run TIME x", None, "100%")
        for m in (None, 0, 2, 3, 1440, 1441)
        for t, g, k, s in ((100, 90, " M1", START), (None, 5, "M2 ", START),
                           (7, None, None, START + dt.timedelta(days=3)), (8, 9, "M1", None))
    ]
    return raw_tables(spark, rows + rows[:20], [("M1", "P1", 50), (" M2", "P1 ", 0)],
                      machines=("M1", " M2"))


@pytest.mark.parametrize("settings", [
    Settings(), Settings(status_prefixes=(("cc", "CHANGEOVER"), ("p", "PLANNED_DOWNTIME_PM")),
                         junk_categories=("it's", "100%"), outlier_minutes=3, major_minutes=1)])
def test_persistent_views_equal_the_models(spark, settings):
    layers, raw = scratch_layers(spark), messy(spark)
    store_raw(spark, raw, layers)
    created = views.create_views(spark, settings, layers)
    other = spark.newSession()
    models = build.compose(raw, settings)
    assert len(created) == 6
    for name in created:
        model = getattr(models, name.split(".")[1])
        view = other.table(name)
        assert dict(view.dtypes) == dict(model.dtypes), name
        assert rows_of(view.select(*model.columns)) == rows_of(model), name


def test_layers_hold_every_model_and_follow_a_reload(spark, sf_dir):
    layers, raw = scratch_layers(spark), fixtures.raw_tables(spark, sf_dir)
    store_raw(spark, raw, layers)
    build.build_layers(spark, layers=layers)
    lazy = build.compose(raw).tables()
    name = views.named(layers)
    other = spark.newSession()
    for model, df in lazy.items():
        # sums of doubles depend on their order in the last digit
        doubles = {c: F.round(c, 9) for c, kind in df.dtypes if kind == "double"}
        found = other.table(name(model)).select(*df.columns).withColumns(doubles)
        assert rows_of(found) == rows_of(df.withColumns(doubles)), model
    kinds = {t.name: t.tableType for l in layers.values()
             for t in spark.catalog.listTables(l) if not t.isTemporary}
    assert {n for n, kind in kinds.items() if kind == "VIEW"} == set(views.VIEWS)
    tables.write_table(raw.raw_machine.limit(0), "raw_machine", layers["raw"])
    other.catalog.refreshTable(name("raw_machine"))  # it has read the table before
    assert other.table(name("stg_machine")).count() == 0


# --- load log -----------------------------------------------------------------------


def test_log_keeps_every_load_and_the_last_one_counts(spark):
    layer = scratch_database(spark)
    source = machines(spark, "M1", "M2")
    load.load_table(source, "raw_machine", layer, expected=2)
    load.load_table(source.union(source), "raw_machine", layer, expected=2)
    with pytest.raises(load.RowCountMismatch):
        load.load_table(source.limit(1), "raw_machine", layer, expected=2, strict=True)
    log = load.load_log(spark, layer).orderBy("loaded_at").collect()
    assert [(r.n_rows, r.status, r.live) for r in log] == [
        (2, "OK", True), (4, "DIFFERS", True), (1, "DIFFERS", False)]
    assert [tuple(r) for r in load.logged_counts(spark, layer).collect()] == [("raw_machine", 4)]
    assert spark.table(f"{layer}.raw_machine").count() == 4


def test_counts_and_freshness_come_without_a_scan(spark):
    layer = scratch_database(spark)
    rows = raw_fact(spark, [event(), event(start=START - dt.timedelta(days=5)), event(start=None, end=START)])
    stored, report = load.load_table(rows, "raw_fact", layer)
    assert (report.newest, report.n_rows) == (START, 3)
    for days, status in ((10, "pass"), (21, "warn"), (31, "error")):
        as_of = START + dt.timedelta(days=days)
        fresh = load.logged_freshness(spark, "raw_fact", as_of, 20, 30, layer)
        assert fresh.first() == load.freshness(stored, "startdatetime", as_of, 20, 30).first()
        assert fresh.first().status == status
        plan = fresh._jdf.queryExecution().executedPlan().toString()
        assert "load_log" in plan and f"{layer}/raw_fact" not in plan
    assert load.logged_freshness(spark, "raw_product", START, layer=layer).first().status == "error"
    load.load_table(rows.limit(0), "raw_fact", layer)
    assert load.logged_freshness(spark, "raw_fact", START, layer=layer).first().status == "error"


def test_log_names_dropped_columns(spark):
    layer = scratch_database(spark)
    sheet = spark.createDataFrame([("A", 1, 2, 3, 4)], [
        "Product Name", "Biscuits Per Pack", "Biscuits Per Case", "Biscuits Per Pallet",
        "Bsicuits Per Pallet"])
    load.load_table(sheet, "raw_product", layer)
    assert load.last_loads(spark, layer).first().dropped_columns == ["Bsicuits Per Pallet"]
