"""Physical plans: exchanges, pushdown, pruning, joins, and results under skew."""

from __future__ import annotations

import datetime as dt
import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from millwright import fixtures
from millwright.operators.dedup import dedup_events
from millwright.operators.joins import lookup_join, orphans
from millwright.plans import build, checks, reports, staging
from millwright.sources.raw import RawTables
from rows import CC, RUN, START, event, raw_fact


@pytest.fixture(scope="module")
def raw(spark, sf_dir):
    return fixtures.raw_tables(spark, sf_dir)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@contextmanager
def conf(spark, **settings):
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_daily_fact_exchanges_events_once(raw):
    text = plan(build.compose(raw).int_daily_machine_product)
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 2  # dedup, then partial day sums
    assert text.count("WindowGroupLimit") == 2
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert "Python" not in text and "CartesianProduct" not in text


def test_no_query_uses_python_or_a_cross_join(raw):
    models = build.compose(raw)
    frames = [*models.tables().values(), *(reports.report(k, models) for k in reports.REPORTS)]
    for df in frames:
        text = plan(df)
        assert not re.search(r"Python|Pandas|CartesianProduct|NestedLoop", text)


def test_day_filter_passes_the_dedup_down_to_the_scan(spark, raw):
    day = dt.date(2024, 1, 10)
    fact = build.compose(raw).fact_oee_daily.filter(F.col("date_key") == F.lit(day))
    assert "GreaterThanOrEqual(ts,2024-01-10T00:00)" in plan(fact)
    part = build.in_days(raw.raw_fact, day, day)
    assert "LessThan(ts,2024-01-11T00:00)" in plan(part)


def test_machine_filter_does_not_wait_for_the_join(raw):
    fact = build.compose(raw).fact_machine_events.filter("machine = 'Machine 3'")
    text = plan(fact)
    assert text.index("Window") < text.rindex("Machine 3"), text


def test_outlier_filter_stays_above_the_dedup(raw):
    text = plan(build.compose(raw).int_daily_machine_product)
    assert text.index("1440") < text.index("WindowGroupLimit")


def test_reports_read_only_their_columns(spark, raw):
    stored = build.build_scratch(raw)
    text = plan(reports.report("oee_trend", stored, reports.Filters(
        (dt.date(2024, 1, 1), dt.date(2024, 1, 3)))))
    assert "ReadSchema: struct<date_key:date,oee_n:bigint,oee_sum:double>" in text
    assert "GreaterThanOrEqual(date_key,2024-01-01)" in text
    text = plan(reports.report("worst_machine", stored))
    assert "TakeOrderedAndProject" in text


def test_stored_reports_read_rollups_only(spark, raw):
    stored = build.build_scratch(raw)
    for key in reports.REPORTS:
        text = plan(reports.report(key, stored))
        assert not re.search("fact_machine_events|fact_oee_daily|raw_fact|events.parquet", text), key
        assert "WindowGroupLimit" not in text or key == "oee_machine", key


def test_lazy_filtered_reports_scan_events_with_their_filter(raw):
    day = dt.date(2024, 1, 10)
    for key in ("kpi_oee", "oee_trend", "downtime_cat", "perf_gap"):
        text = plan(reports.report(key, build.compose(raw), reports.Filters((day, day))))
        scans = re.findall(r"FileScan parquet \[[^\]]*\bts#.*", text)
        assert len(scans) == 1 and "GreaterThanOrEqual(ts,2024-01-10T00:00)" in scans[0], key


def test_lazy_daily_fact_scans_the_events_once(raw):
    text = plan(build.compose(raw).fact_oee_daily)
    assert len(re.findall(r"FileScan parquet \[[^\]]*\bts#", text)) == 1


def test_profile_deduplicates_once(raw):
    text = plan(checks.quality_profile(raw.raw_fact, build.compose(raw).int_events_classified))
    assert text.count("WindowGroupLimit") == 2  # one deduplication, on both sides of its exchange


def test_suite_scans_each_table_once_with_one_exchange_of_findings(spark, raw):
    stored = build.build_scratch(raw, events_stored=True)
    text = plan(checks.run_suite(stored.tables()))
    assert text.count("FileScan parquet") == len(build.Models.NAMES) == 13
    assert "events.parquet" not in text
    assert len(re.findall(r"Exchange hashpartitioning\(check#\d+, key#\d+", text)) == 1
    assert "Window" not in text


def test_big_lookups_are_not_broadcast_and_give_the_same_rows(spark, raw):
    small = rows_of(build.compose(raw).fact_oee_daily)
    with conf(spark, **{
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }):
        fact = build.compose(raw).fact_oee_daily
        assert "SortMergeJoin" in plan(fact) and "Broadcast" not in plan(fact)
        assert rows_of(fact) == small


def test_hot_machine_is_split_where_the_lookup_is_not_broadcast(spark):
    """A third of the events is of one machine; adaptive execution splits its partition."""
    rows = spark.range(60000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("m"), F.col("id"))).alias("machine"),
        F.md5(F.col("id").cast("string")).alias("payload"),
    ).repartition(8)
    machines = spark.createDataFrame([("hot", "k1"), ("m1", "k2")], "machine_name string, machine_key string")
    with conf(spark, **{
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }):
        joined = lookup_join(rows, machines, {"machine": "machine_name"})
        counted = joined.agg(F.count("*"), F.count("machine_key"), F.max("payload"))
        assert tuple(counted.collect()[0])[:2] == (60000, 20001)
        assert "skew=true" in plan(counted)


@pytest.mark.parametrize("partitions", ["1", "3", "17"])
def test_partitioning_does_not_change_results(spark, raw, partitions):
    expected = rows_of(build.compose(raw).fact_oee_daily)
    shuffled = RawTables(**{n: df.repartition(int(partitions)) for n, df in raw.items()})
    with conf(spark, **{"spark.sql.shuffle.partitions": partitions}):
        assert rows_of(build.compose(shuffled).fact_oee_daily) == expected


def test_hot_key_is_cut_before_the_exchange(spark):
    """A third of the rows repeats one reading; each task passes on one row of it."""
    hot = raw_fact(spark, [event(total=1)]).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(20000))))
    hot = hot.withColumn("totalbiscuitsmade", F.col("n").cast("bigint")).drop("n")
    cold = raw_fact(spark, [event()]).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(40000))))
    cold = cold.withColumn("machine", F.concat(F.lit("C"), F.col("n").cast("string"))).drop("n")
    df = staging.trim_events(hot.unionAll(cold).repartition(6))
    result = dedup_events(df)
    assert result.count() == 40001
    assert result.filter("machine = 'M1'").first().total_biscuits_made == 20000
    text = plan(result)
    exchange, limits = text.index("Exchange"), [m.start() for m in re.finditer("WindowGroupLimit", text)]
    assert len(limits) == 2 and limits[0] < exchange < limits[1]


def test_dedup_matches_brute_force(spark):
    import random

    rng = random.Random(7)
    rows = [
        event(rng.choice([RUN, CC, None]), rng.choice([1, 2]), total=rng.choice([None, 1, 2, 3]),
              good=rng.choice([None, 1, 2]), machine=rng.choice(["A", "B"]),
              start=START + dt.timedelta(minutes=rng.randrange(3)), end=START)
        for _ in range(300)
    ]
    def rank(r):
        machine, start, end, minutes, total, good, category, product = r
        # a NULL ranks above every value
        return [(v is None, 0 if v is None else v) for v in (total, minutes, good)] + [
            (category is None, category or "")]
    best = {}
    for r in rows:
        key = (r[0], r[1], r[2], r[7])
        if key not in best or rank(r) > rank(best[key]):
            best[key] = r
    expected = sorted(str((r[0], r[1], r[4], r[5], r[6])) for r in best.values())
    found = staging.stg_events(raw_fact(spark, rows)).select(
        "machine", "start_datetime", "total_biscuits_made", "good_biscuits_made", "oee_category_raw")
    assert sorted(str(tuple(r)) for r in found.collect()) == expected


def test_orphans_count_rows_per_key(spark):
    child = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string")
    parent = spark.createDataFrame([("a",)], "k string")
    assert [tuple(r) for r in orphans(child, "k", parent).collect()] == [("b", 2)]


def test_lookup_join_keeps_every_fact(spark):
    facts = spark.createDataFrame([("a", 1), ("x", 2), (None, 3)], "k string, n int")
    lookup = spark.createDataFrame([("a", "A")], "name string, label string")
    joined = lookup_join(facts, lookup, {"k": "name"})
    assert sorted(joined.collect(), key=lambda r: r.n) == [("a", 1, "A"), ("x", 2, None), (None, 3, None)]


def test_targets_that_outgrow_a_broadcast_are_exchanged(spark, sf_dir):
    """A part file of a few bytes a row gives ten rows of text each."""
    def speeds(n):
        return fixtures.raw_target_speeds(spark.range(n).withColumnRenamed("id", "p_partkey"))

    def daily(n):
        raw = RawTables(**dict(fixtures.raw_tables(spark, sf_dir).items()) | {
            "raw_target_speeds": speeds(n)})
        return build.compose(raw).int_daily_machine_product

    few, many = daily(200), daily(fixtures.BROADCAST_PAIRS)
    assert "BroadcastHashJoin" in plan(few) and "SortMergeJoin" not in plan(few)
    assert "SortMergeJoin" in plan(many) and "Broadcast" not in plan(many)
    assert rows_of(many) == rows_of(few)


def scratch_tables(spark) -> set[str]:
    from millwright import scratch

    return {path.rsplit("/", 1)[1].rsplit("-", 1)[0] for path in scratch._WRITTEN}


@pytest.mark.parametrize("twice", [False, True])
@pytest.mark.parametrize("tables", [fixtures.raw_tables, fixtures.line_tables])
def test_reports_and_checks_write_only_what_they_read(spark, sf_dir, tables, twice, monkeypatch):
    from millwright import scratch

    raw = tables(spark, sf_dir)
    if twice:  # products with two rows double their events, here as in the stored build
        raw = RawTables(**dict(raw.items()) | {"raw_product": raw.raw_product.unionAll(raw.raw_product)})
    whole = build.build_scratch(raw, events_stored=True)
    monkeypatch.setattr(scratch, "_WRITTEN", {})
    reported = build.report_scratch(raw)
    for key in ("kpi_oee", "total_downtime", "perf_gap", "stability"):
        found = rows_of(reports.report(key, reported))
        assert found == rows_of(reports.report(key, whole)), key
    assert scratch_tables(spark) == {"mart_day_rollup"}
    assert rows_of(reports.report("downtime_cat", reported)) == rows_of(
        reports.report("downtime_cat", whole))
    assert scratch_tables(spark) == {"mart_day_rollup", "mart_stop_rollup"}
    monkeypatch.setattr(scratch, "_WRITTEN", {})
    checked = build.check_scratch(raw)
    assert rows_of(checks.run_suite(checked.tables())) == rows_of(checks.run_suite(whole.tables()))
    assert scratch_tables(spark) == set(build.CHECKED)
    for name in build.Models.NAMES:
        assert "WindowGroupLimit" not in plan(getattr(checked, name)), name


def test_findings_are_compiled_and_events_hashed_after_their_lookups(spark, raw):
    text = plan(checks.run_suite(build.check_scratch(raw).tables()))
    assert "lambda" not in text
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        text = plan(build.compose(raw).fact_machine_events)
    joins = [m.start() for m in re.finditer("SortMergeJoin", text)]
    assert len(joins) == 2 and text.index("AS event_id") < joins[0]
