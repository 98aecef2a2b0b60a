"""States of a rollup merge in any grouping and order to the same figures."""

from __future__ import annotations

import datetime as dt
import random
import statistics
import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from millwright import fixtures, scratch
from millwright.functions.calendar import year_month
from millwright.plans import build, reports, rollup
from rows import CC, RUN, START, event, raw_tables


@pytest.fixture(scope="module")
def plant(spark, sf_dir):
    return build.build_scratch(fixtures.line_tables(spark, sf_dir))


def figures(rows, *keys):
    out = rows.groupBy(*keys).agg(
        F.sum("n_rows").alias("n"), F.round(rollup.mean("oee"), 9).alias("mean"),
        F.round(rollup.sample_deviation(), 7).alias("dev"), F.min("oee_min"), F.max("oee_max"),
        F.max("target_biscuits_per_hour"), F.sum("run_time_min").cast("double"),
        F.sum("target_output").cast("double"), F.sum("total_biscuits_made").cast("long"),
    )
    return sorted(map(str, out.collect()))


def test_ways_to_merge_agree(plant):
    days = plant.mart_day_rollup.withColumn("month", year_month("date_key"))
    direct = figures(days, "machine")
    months = rollup.merged(days, ["month", "machine", "product"])
    assert figures(months, "machine") == direct
    years = rollup.merged(rollup.merged(months, ["month", "machine"]), ["machine"])
    assert figures(years, "machine") == direct
    assert set(rollup.merged(months, ["machine"]).dtypes) == set(years.dtypes)


def test_figures_equal_the_fact(plant):
    fact = {}
    for row in plant.fact_oee_daily.select("machine", "oee").collect():
        fact.setdefault(row.machine, []).append(row.oee)
    out = plant.mart_day_rollup.groupBy("machine").agg(
        rollup.mean("oee").alias("mean"), rollup.sample_deviation().alias("dev"))
    rows = out.collect()
    assert len(rows) == len(fact)
    for row in rows:
        values = fact[row.machine]
        assert row["mean"] == pytest.approx(statistics.fmean(values))
        if len(values) > 1:
            assert row.dev == pytest.approx(statistics.stdev(values), abs=1e-7)
        else:
            assert row.dev is None


def test_any_range_and_filter(plant):
    rng = random.Random(5)
    days = [r[0] for r in plant.fact_oee_daily.select("date_key").distinct().collect()]
    for _ in range(4):
        first, last = sorted(rng.sample(days, 2))
        wanted = reports.Filters((first, last))
        found = reports.report("kpi_oee", plant, wanted).first().oee_pct
        mean = reports.apply_filters(plant.fact_oee_daily, wanted).agg(F.avg("oee")).first()[0]
        assert found == pytest.approx(mean * 100, abs=0.0051)


def test_stop_rollup_keeps_minutes_and_events(plant):
    for condition in ("true", "stoppage_class IS NULL", "is_duration_outlier"):
        events = plant.fact_machine_events.where(condition)
        stops = plant.mart_stop_rollup.where(condition)
        assert stops.agg(F.sum("n_events"), F.sum("minutes")).first()[:] == (
            events.count() or None, events.agg(F.sum("duration_minutes")).first()[0])


def test_undated_rows_and_empty_rollups(spark, plant):
    none = plant.mart_day_rollup.limit(0)
    row = none.agg(rollup.mean("oee").alias("m"), rollup.sample_deviation().alias("d")).first()
    assert (row.m, row.d) == (None, None)
    late = reports.Filters((dt.date(2100, 1, 1), dt.date(2100, 1, 2)))
    assert reports.report("kpi_oee", plant, late).first().oee_pct is None


def shuffle_files(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager()
    files = blocks.diskBlockManager().getAllFiles()
    names = [files.apply(i).getName() for i in range(files.size())]
    return {n for n in names if n.startswith("shuffle_")}


def writes(stored):
    return len({f.split("/part-")[1].split("-", 1)[1] for f in stored.inputFiles()})


def test_sliced_rollups_hold_every_row_once(spark, tmp_path, monkeypatch):
    rng = random.Random(8)
    names = ["M1", " M1", "M2", "M3 ", None]
    events = [
        event(rng.choice([RUN, CC, None]), rng.choice([5, 2000, None]), rng.randint(0, 9), 3,
              machine=rng.choice(names), product=rng.choice(["P1", "P2 ", None]),
              start=START + dt.timedelta(hours=rng.randint(0, 60)), end=START)
        for _ in range(300)
    ]
    raw = raw_tables(spark, events, [("M1 ", "P1", 60), ("M2", "P2", 80)], ["P1", "P1", "P2"],
                     ["M1", "M2", "M2", "M3"])
    raw.raw_fact.write.parquet(f"{tmp_path}/fact")
    raw = replace(raw, raw_fact=spark.read.schema(raw.raw_fact.schema).parquet(f"{tmp_path}/fact"))
    assert build.slices_of(raw.raw_fact) == 1
    whole = build.report_scratch(raw).built()
    size = sum(f.stat().st_size for f in (tmp_path / "fact").glob("*.parquet"))
    monkeypatch.setattr(build, "SLICE_BYTES", size / 3.5)
    assert build.slices_of(raw.raw_fact) == 4
    assert sum(build.pair_slice(raw, i, 4).raw_fact.count() for i in range(4)) == len(events)
    sliced = build.report_scratch(raw)
    for name in build.Models.ROLLUPS:
        expected = sorted(map(repr, getattr(whole, name).collect()))
        assert expected and sorted(map(repr, getattr(sliced, name).collect())) == expected
        assert [writes(getattr(kind, name)) for kind in (whole, sliced)] == [1, 4]


def test_a_stored_table_leaves_no_shuffle_files(spark):
    setting = spark.conf.get(scratch.SHUFFLE_CLEANUP, None)
    held = spark.range(1000).groupBy(F.col("id") % 7).count()
    held.collect()
    before = shuffle_files(spark)
    stored = scratch.store(held.withColumn("n", F.lit(1)), "left")
    for _ in range(100):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert stored.count() == 7 and spark.conf.get(scratch.SHUFFLE_CLEANUP, None) == setting
