"""Late extracts merged into bucketed months: plans, rows, stops."""

from __future__ import annotations

import datetime as dt
import random
import re
from functools import partial

import pytest
from pyspark.sql import functions as F

from millwright import fixtures
from millwright.plans import build, staging
from millwright.scratch import scratch_database
from millwright.sources import event_store
from rows import CC, JUNK, PM, RUN, event, raw_fact, raw_tables


def rows_of(df):
    return sorted(map(str, df.collect()))


def staged_rows(df):
    return rows_of(df.select(*sorted(c for c in df.columns if c != "year_month")))


def random_events(rng, n, months=(5, 6, 7)):
    out = []
    for _ in range(n):
        start = rng.choice([None, *(dt.datetime(2021, m, d, rng.randrange(3))
                                    for m in months for d in (1, 15))])
        out.append(event(
            rng.choice([RUN, CC, PM, JUNK, None, ""]), rng.choice([None, 1, 5, 2000]),
            total=rng.choice([None, 1, 2, 3]), good=rng.choice([None, 1, 2]),
            machine=rng.choice(["A", "A-B", " B", None]), product=rng.choice(["P", "B-P", "", None]),
            start=start, end=dt.datetime(2021, 7, 20),
        ))
    return out


def test_merges_equal_a_full_build(spark):
    rng = random.Random(1)
    first, *extracts = (random_events(rng, n, m) for n, m in (
        (300, (5, 6, 7)), (120, (6,)), (80, (7, 8)), (40, (5, 8)), (0, ())))
    layer = scratch_database(spark)
    event_store.create_store(raw_fact(spark, first), layer, buckets=4)
    seen = list(first)
    for extract in extracts:
        seen += extract
        months = event_store.merge(raw_fact(spark, extract), layer)
        assert months == sorted(
            {f"{e[1]:%Y-%m}" if e[1] else None for e in extract}, key=str)
        whole = staging.stg_events(raw_fact(spark, seen))
        assert staged_rows(event_store.stored_events(spark, layer)) == staged_rows(whole)


def test_merging_twice_changes_nothing_more(spark):
    rng = random.Random(2)
    layer = scratch_database(spark)
    event_store.create_store(raw_fact(spark, random_events(rng, 100)), layer, buckets=2)
    late = raw_fact(spark, random_events(rng, 50))
    event_store.merge(late, layer)
    once = staged_rows(event_store.stored_events(spark, layer))
    event_store.merge(late, layer)
    assert staged_rows(event_store.stored_events(spark, layer)) == once


@pytest.mark.parametrize("partitions", ["3", "64"])
def test_the_stored_side_is_not_exchanged(spark, sf_dir, partitions):
    raw = fixtures.raw_tables(spark, sf_dir)
    layer = scratch_database(spark)
    event_store.create_store(raw.raw_fact, layer, buckets=8)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        merged = event_store.merged_months(raw.raw_fact.limit(100), ["2024-01"], layer)
        text = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    join = text.index("SortMergeJoin")
    stored = text.index("stg_event_store")
    assert "Bucketed: true" in text and "SelectedBucketsCount: 8 out of 8" in text
    # between the join and the stored scan there is no exchange; the extract has its own
    assert "Exchange" not in text[join:stored], text
    assert re.search(r"PartitionFilters: \[[^\]]*year_month", text)


def test_models_on_the_store_have_no_deduplication(spark, sf_dir):
    raw = fixtures.raw_tables(spark, sf_dir)
    layer = scratch_database(spark)
    events = event_store.create_store(raw.raw_fact, layer, buckets=4)
    models = build.Models(raw, staged=events)
    text = models.fact_machine_events._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in text and "Exchange hashpartitioning" not in text
    lazy = build.compose(raw)
    for name in ("fact_machine_events", "fact_oee_daily"):
        assert rows_of(getattr(models, name)) == rows_of(getattr(lazy, name)), name


def test_marts_follow_a_merged_extract(spark):
    rng = random.Random(3)
    targets, names = [("A", "P", 50), ("B", "P", 60)], ("A", "B", "A-B")
    first, late = random_events(rng, 200), random_events(rng, 60, (6,))
    raw = raw_tables(spark, first, targets, machines=names)
    staging_layer, layer = scratch_database(spark), scratch_database(spark)
    events = event_store.create_store(raw.raw_fact, staging_layer, buckets=4)
    build.Models(raw, staged=events, store=partial(build.store_mart, layer=layer)).built()
    months = build.merge_extract(
        raw, raw_fact(spark, late), staging_layer=staging_layer, layer=layer)
    assert "2021-06" in months
    whole = build.compose(raw_tables(spark, first + late, targets, machines=names))
    for name in (*build.Models.NAMES[6:], *build.Models.ROLLUPS):
        want = getattr(whole, name)
        found = spark.table(f"{layer}.{name}").select(*want.columns)
        # sums of doubles depend on their order in the last digit
        doubles = {c: F.round(c, 9) for c, kind in want.dtypes if kind == "double"}
        assert rows_of(found.withColumns(doubles)) == rows_of(want.withColumns(doubles)), name


def test_a_stop_before_the_switch_leaves_the_store(spark):
    rng = random.Random(4)
    layer = scratch_database(spark)
    event_store.create_store(raw_fact(spark, random_events(rng, 80)), layer, buckets=2)
    before = staged_rows(event_store.stored_events(spark, layer))
    late = raw_fact(spark, random_events(rng, 30, (6,)))
    rows = event_store.merged_months(late, ["2021-06", None], layer)
    event_store._write(rows, 2, layer)  # and the job dies
    assert staged_rows(event_store.stored_events(spark, layer)) == before
    tables = {t.name for t in spark.catalog.listTables(layer) if not t.isTemporary}
    assert tables == {event_store.STORE}


def test_a_hot_event_is_cut_before_it_is_exchanged(spark):
    layer = scratch_database(spark)
    hot = raw_fact(spark, [event(total=1)]).crossJoin(spark.range(3000)).withColumn(
        "totalbiscuitsmade", F.col("id")).drop("id")
    events = event_store.create_store(hot, layer, buckets=2)
    assert [r.total_biscuits_made for r in events.collect()] == [2999]
