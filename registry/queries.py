"""One registered query per operator of the inventory, keyed by its ID.

Every query runs over the whole given tables, seen as raw plant tables by
``millwright.fixtures``. Decimals leave as doubles or longs, so that any client
compares plain numbers.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace
from decimal import Decimal
from functools import cached_property, partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millwright import fixtures, schemas
from millwright.config import DEFAULTS
from millwright.functions import calendar as cal
from millwright.functions import numeric as num
from millwright.functions.keys import surrogate_key
from millwright.operators import aggregates as agg
from millwright.operators.dedup import dedup_events
from millwright.operators.joins import orphans
from millwright.operators.ranking import ranked, top_per_group
from millwright.plans import (
    build, checks, intermediate, marts, reports, rollup, staging, views,
)
from millwright.schemas import EVENT_KEY
from millwright.scratch import scratch_database, scratch_path
from millwright.sources import event_store, load, raw, tables
from millwright.sources.raw import RawTables

AS_OF = dt.datetime(2024, 2, 1)
# fixed values: the row counts of the source's own extracts
EXPECTED = {"raw_fact": 8044, "raw_target_speeds": 72, "raw_product": 18, "raw_machine": 10}
JANUARY = (dt.date(2024, 1, 8), dt.date(2024, 1, 21))
MACHINE = "Machine 3"
PRODUCT = "Product 5"
DRILL_DAY = dt.date(2024, 1, 10)
DAILY_KEY = ("machine", "product", "date_key")


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, whole decimals as longs."""
    columns = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            kind = "double" if field.dataType.scale else "bigint"
            column = column.cast(kind).alias(field.name)
        columns.append(column)
    return df.select(*columns)


_STORED: dict[tuple, build.Models] = {}


class Plant:
    """The raw tables of one folder and the models composed from them."""

    def __init__(self, spark: SparkSession, sf_dir: str, raw_tables=fixtures.raw_tables):
        self.spark = spark
        self.folder = sf_dir
        self.name = (raw_tables.__name__, sf_dir)
        self.raw = raw_tables(spark, sf_dir)

    @cached_property
    def models(self) -> build.Models:
        return build.compose(self.raw)

    def _once(self, made: Callable[[RawTables], build.Models]) -> build.Models:
        """Once per session and folder."""
        key = (self.spark.sparkContext.applicationId, self.name, made.__name__)
        if key not in _STORED:
            _STORED[key] = made(self.raw)
        return _STORED[key]

    @cached_property
    def stored(self) -> build.Models:
        """The rollups that reports read, each written once when first asked for."""
        return self._once(build.report_scratch)

    @cached_property
    def checked(self) -> build.Models:
        """All models as the checks scan them, the large ones over stored intermediate rows."""
        return self._once(build.check_scratch)

    @cached_property
    def staged(self) -> DataFrame:
        return self.models.stg_fact_events

    @cached_property
    def classified(self) -> DataFrame:
        return self.models.int_events_classified

    @cached_property
    def groups(self) -> DataFrame:
        return intermediate.day_groups(self.classified)

    @cached_property
    def daily(self) -> DataFrame:
        return self.models.int_daily_machine_product

    @cached_property
    def fact(self) -> DataFrame:
        return self.models.fact_oee_daily

    @cached_property
    def events(self) -> DataFrame:
        return self.models.fact_machine_events


Query = Callable[[Plant], DataFrame]
QUERIES: dict[str, Query] = {}


def query(key: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[key] = fn
        return fn

    return register


# --- sources, sinks, load checks ---------------------------------------------------

# fixed values: the headings of the source's sheet
SHEET_HEADINGS = {
    "machine": "Machine", "startdatetime": "StartDateTime", "enddatetime": "EndDateTime",
    "duration": "Duration", "totalbiscuitsmade": "TotalBiscuitsMade",
    "goodmadebiscuits": "GoodMadeBiscuits", "oee_category": "OEE Category", "product": "Product",
}


def _write_sheet(p: Plant, df: DataFrame, name: str) -> str:
    path = scratch_path(p.spark, name)
    text = df.select(*[F.col(f"`{c}`").cast("string") for c in df.columns])
    text.write.csv(
        path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    return path


def _scratch_layer(p: Plant) -> str:
    return scratch_database(p.spark)


def _loaded(p: Plant) -> str:
    """A raw layer that the four sheets were loaded into; the product sheet has a misspelt copy.

    Products and machines are expected as the driver's part and supplier tables count them,
    events and targets as the source's own extracts do, which differ from the test tables.
    """
    layer = _scratch_layer(p)
    sheets = dict(p.raw.items())
    sheets["raw_product"] = sheets["raw_product"].withColumn("Bsicuits Per Pallet", F.lit(0))
    expected = EXPECTED | {
        "raw_product": fixtures.part(p.spark, p.folder).count(),
        "raw_machine": fixtures.supplier(p.spark, p.folder).count(),
    }
    paths = {name: _write_sheet(p, df, name) for name, df in sheets.items()}
    load.load_all(p.spark, paths, "csv", expected, layer=layer)
    return layer


def _layers(p: Plant) -> dict[str, str]:
    """Databases for all layers, the raw tables stored in theirs."""
    layers = {layer: _scratch_layer(p) for layer in views.LAYERS}
    for name, df in p.raw.items():
        tables.write_table(df, name, layers[tables.RAW])
    return layers


@query("a1_read_raw")
def _(p):
    sheet = p.raw.raw_fact.withColumnsRenamed(SHEET_HEADINGS)
    return raw.read_raw(p.spark, _write_sheet(p, sheet, "sheet"), "raw_fact", "csv")


@query("a2_normalize_columns")
def _(p):
    sheet = p.raw.raw_target_speeds.toDF(" Machine", "Product-Name", "Target (per/hour)")
    return raw.normalize_columns(sheet)


@query("a3_coerce_ts")
def _(p):
    text = p.raw.raw_fact.withColumns(
        {c: F.col(c).cast("string") for c in raw.TIMESTAMP_COLUMNS}
    )
    return raw.coerce_ts(text)


@query("a4_drop_by_prefix")
def _(p):
    sheet = p.raw.raw_product.withColumn("Bsicuits Per Pallet", F.lit(0))
    kept, dropped = raw.drop_by_prefix(sheet)
    return kept.withColumn("dropped", F.lit(", ".join(dropped)))


@query("a5_full_reload")
def _(p):
    layer = _scratch_layer(p)
    tables.write_table(p.raw.raw_fact, "raw_fact", layer)
    return tables.write_table(p.raw.raw_fact, "raw_fact", layer)


@query("a6_reconcile")
def _(p):
    parts = [load.reconcile(df, name, EXPECTED[name]) for name, df in p.raw.items()]
    return reduce(DataFrame.unionByName, parts)


@query("a6_load_report")
def _(p):
    """The log of a load of all four sheets: counts, dropped columns and newest event."""
    return load.last_loads(p.spark, _loaded(p)).select(
        "table_name", "n_rows", "expected", "status", "newest",
        F.array_join("dropped_columns", ", ").alias("dropped"),
    )


@query("a7_verify_counts")
def _(p):
    return load.verify_counts(dict(p.raw.items()))


@query("a7_logged_counts")
def _(p):
    """Counts taken in the writes, read from the log."""
    return load.logged_counts(p.spark, _loaded(p))


@query("a8_logged_freshness")
def _(p):
    layer = _scratch_layer(p)
    load.load_table(p.raw.raw_fact, "raw_fact", layer)
    return load.logged_freshness(p.spark, "raw_fact", AS_OF, 0, 30, layer)


@query("a8_freshness")
def _(p):
    limits = {"default": (3650, 7300), "tight": (0, 30), "strict": (0, 0)}
    parts = [
        load.freshness(p.raw.raw_fact, "startdatetime", AS_OF, warn, error).withColumn(
            "limits", F.lit(name)
        )
        for name, (warn, error) in limits.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query("a9_register_view")
def _(p):
    tables.register_view(p.models.stg_target_speeds, "stg_target_speeds")
    return p.spark.sql(
        "SELECT machine, count(*) AS n_targets, max(target_biscuits_per_hour) AS best"
        " FROM stg_target_speeds GROUP BY machine"
    )


def _view(p: Plant, model: str) -> DataFrame:
    """A persistent view over stored raw tables, as another session sees it."""
    layers = _layers(p)
    views.create_views(p.spark, layers=layers)
    return p.spark.newSession().table(views.named(layers)(model))


for _name in views.VIEWS:
    QUERIES[f"a9_view_{_name}"] = partial(_view, model=_name)


@query("a10_write_mart")
def _(p):
    return tables.write_mart(p.fact, "fact_oee_daily", _scratch_layer(p), "year_month")


@query("a10_switched_months")
def _(p):
    """A mart stored without two weeks, whose month is then written whole and switched."""
    layer = _scratch_layer(p)
    early = p.fact.filter(~F.col("date_key").between(*JANUARY))
    tables.write_mart(early, "fact_oee_daily", layer, "year_month")
    return tables.replace_months(p.fact, ["2024-01"], "fact_oee_daily", layer)


@query("a11_layer_names")
def _(p):
    """Rows of all 17 models, each read from the database of its layer."""
    layers = _layers(p)
    build.build_layers(p.spark, layers=layers)
    name = views.named(layers)
    return load.verify_counts({
        tables.layer_name(tables.layer_of(model), model): p.spark.table(name(model))
        for model in (*schemas.RAW, *build.Models.NAMES)
    })


# --- projections, filters, predicates ----------------------------------------------


@query("b1_stg_events")
def _(p):
    return staging.trim_events(p.raw.raw_fact)


@query("b1_half_counters")
def _(p):
    """Counters with halves, negative ones too, are rounded away from zero."""
    halves = {
        c: (F.col(c).cast("decimal(18,1)") / 2 - 100).cast("decimal(18,1)")
        for c in ("totalbiscuitsmade", "goodmadebiscuits")
    }
    return staging.trim_events(p.raw.raw_fact.withColumns(halves))


@query("b2_stg_target_speeds")
def _(p):
    return p.models.stg_target_speeds


@query("b3_stg_product")
def _(p):
    return p.models.stg_product


@query("b4_stg_machine")
def _(p):
    return p.models.stg_machine


def _event_column(df: DataFrame, column: str) -> DataFrame:
    return df.select(*EVENT_KEY, "oee_category_raw", "duration_minutes", column)


@query("b5_classify_status")
def _(p):
    return _event_column(intermediate.classify_status(p.staged), "oee_status_group")


@query("b6_flag_outlier")
def _(p):
    return _event_column(intermediate.flag_outlier(p.staged), "is_duration_outlier")


@query("b7_flag_unknown")
def _(p):
    return _event_column(intermediate.flag_unknown(p.staged), "is_unknown_category")


@query("b8_classify_stoppage")
def _(p):
    grouped = intermediate.classify_status(p.staged)
    return _event_column(intermediate.classify_stoppage(grouped), "stoppage_class")


@query("b9_exclude_outliers")
def _(p):
    return intermediate.exclude_outliers(p.classified)


@query("b10_event_date")
def _(p):
    return intermediate.with_event_date(p.staged).select(*EVENT_KEY, "event_date")


def _daily_columns(p: Plant, columns: tuple[str, ...]) -> DataFrame:
    return p.daily.select("machine", "product", "event_date", *columns)


for _key, _columns in {
    "b11_run_time": ("planned_time_min", "downtime_min", "run_time_min"),
    "b12_availability": ("run_time_min", "planned_time_min", "availability"),
    "b13_performance": ("total_biscuits_made", "target_biscuits_per_hour", "performance"),
    "b14_quality": ("good_biscuits_made", "total_biscuits_made", "quality"),
}.items():
    QUERIES[_key] = partial(_daily_columns, columns=_columns)


@query("b15_oee")
def _(p):
    return p.fact.select(*DAILY_KEY, "availability", "performance", "quality", "oee")


@query("b16_surrogate_key")
def _(p):
    """Keys over a column that is NULL for running time, and empty for junk."""
    category = F.when(F.col("oee_category_raw") == "0", "").when(
        F.col("oee_category_raw") != "Run Time", F.col("oee_category_raw")
    )
    return p.staged.select("start_datetime", "machine", category.alias("category")).withColumn(
        "key", surrogate_key("category", "machine", "start_datetime")
    )


@query("b17_whatif_reduction")
def _(p):
    return marts.whatif_pm(p.fact, Decimal("0.30"))


for _share in ("1", "0.12345"):
    QUERIES[f"b17_whatif_reduction_{_share.replace('.', '_')}"] = (
        lambda p, share=_share: marts.whatif_pm(p.fact, Decimal(share))
    )


@query("b18_apply_filters")
def _(p):
    wanted = reports.Filters(JANUARY, [MACHINE, "Machine 4"], [PRODUCT, "Product 6"])
    return reports.apply_filters(p.fact, wanted).select(*DAILY_KEY, "oee")


@query("b19_non_run")
def _(p):
    return reports.non_run(p.events).groupBy("oee_status_group").agg(
        F.count("*").alias("n_events"), F.sum("duration_minutes").alias("minutes")
    )


@query("b19_stops_only")
def _(p):
    return reports.stops_only(p.events).groupBy("stoppage_class").agg(
        F.count("*").alias("n_events"), F.sum("duration_minutes").alias("minutes")
    )


@query("b20_drill_day")
def _(p):
    return reports.report("stability", p.stored, reports.drill_day(DRILL_DAY))


# --- joins -------------------------------------------------------------------------


@query("c1_join_targets")
def _(p):
    joined = intermediate.join_targets(
        intermediate.planned_only(p.groups), p.models.stg_target_speeds
    )
    return joined.select("machine", "product", "event_date", "target_biscuits_per_hour")


@query("c2_events_machine")
def _(p):
    return p.events.select("event_id", "machine", "machine_key")


@query("c3_events_product")
def _(p):
    return p.events.select("event_id", "product", "product_key")


@query("c4_daily_machine")
def _(p):
    return p.fact.select(*DAILY_KEY, "machine_key")


@query("c5_daily_product")
def _(p):
    return p.fact.select(*DAILY_KEY, "product_key")


@query("c6_daily_date")
def _(p):
    m = p.models
    fact = marts.fact_oee_daily(p.daily, m.dim_machine, m.dim_product, m.dim_date)
    return fact.select(*DAILY_KEY, "is_weekend", "day_name")


@query("c7_top_reasons")
def _(p):
    return reports.top_reasons(p.events)


@query("c7_top_reasons_no_outliers")
def _(p):
    return reports.top_reasons(p.events, include_outliers=False)


@query("c8_orphans")
def _(p):
    """Parents are the machines of one type, so the others' events are orphans."""
    baking = p.models.dim_machine.filter(F.col("machine_type") == "Baking")
    return orphans(p.events, "machine_key", baking)


# --- aggregations ------------------------------------------------------------------


@query("d1_day_sums")
def _(p):
    return p.groups


@query("d2_planned_only")
def _(p):
    return intermediate.planned_only(p.groups).select(
        "machine", "product", "event_date", "planned_time_min"
    )


@query("d3_summary_sums")
def _(p):
    return marts.summary_sums(p.fact).drop("target_biscuits_total", "oee_weighted_avg")


def _summary_column(p: Plant, column: str) -> DataFrame:
    value = num.rounded(column, 6).alias(column)
    return marts.summary_sums(p.fact).select("year_month", value)


QUERIES["d4_target_total"] = partial(_summary_column, column="target_biscuits_total")
QUERIES["d5_run_weighted_oee"] = partial(_summary_column, column="oee_weighted_avg")


@query("d6_summary_ratios")
def _(p):
    return marts.monthly_summary(p.fact).select(
        "year_month", "availability", "performance", "quality", "oee"
    )


@query("d7_machine_sums")
def _(p):
    return p.fact.groupBy("machine").agg(
        *agg.measure_sums(("pm_downtime_min", "run_time_min", "total_biscuits_made"))
    )


@query("d8_mean_pct")
def _(p):
    return p.fact.groupBy("product").agg(
        *[num.pct(c, 2).alias(f"{c}_pct") for c in ("availability", "performance", "quality", "oee")]
    )


@query("d9_max_target")
def _(p):
    return p.fact.groupBy("machine").agg(F.max("target_biscuits_per_hour").alias("target"))


@query("d10_first_date")
def _(p):
    return p.fact.groupBy("day_name").agg(F.min("date_key").alias("first_date"))


@query("d11_stddev")
def _(p):
    return p.fact.groupBy("machine", "product").agg(
        num.rounded(F.stddev_samp("oee"), 6).alias("oee_stddev")
    )


@query("d12_ratio_of_sums")
def _(p):
    return p.fact.groupBy("product").agg(
        num.ratio(F.sum("changeover_time_min"), F.sum("downtime_min")).alias("changeover_share"),
        num.per_hour(num.counter_sum("total_biscuits_made"), F.sum("run_time_min")).alias("speed"),
    )


@query("d13_ordered_text")
def _(p):
    """The status groups seen on a machine, at most five, as one ordered text."""
    seen = p.events.select("machine", "oee_status_group").distinct()
    return seen.groupBy("machine").agg(
        F.expr(
            "listagg(oee_status_group, ' · ') within group (order by oee_status_group)"
        ).alias("groups")
    )


@query("d14_count")
def _(p):
    return p.events.agg(F.count("*").alias("n_rows"))


@query("d15_repeated_keys")
def _(p):
    return checks.check_unique(staging.trim_events(p.raw.raw_fact), *EVENT_KEY)


@query("d16_hours")
def _(p):
    return p.events.groupBy("machine", "oee_category_raw").agg(
        num.hours("duration_minutes", 1).alias("hours")
    )


# --- window, sorts, top-k ----------------------------------------------------------


@query("e1_dedup_events")
def _(p):
    return p.staged


@query("e1_dedup_other_key")
def _(p):
    """The same operator with another key: the best reading of a product per machine."""
    trimmed = staging.trim_events(p.raw.raw_fact)
    return dedup_events(trimmed, ("machine", "product"), "total_biscuits_made")


def _late(p: Plant) -> tuple[DataFrame, DataFrame]:
    """Raw events as first loaded, and a late extract: two weeks, and every seventh repeated."""
    start = F.col("startdatetime")
    late = F.to_date(start).between(*JANUARY)
    repeated = F.pmod(F.xxhash64("machine", "product", start), F.lit(7)) == 0
    first = p.raw.raw_fact.filter(~late | start.isNull())
    return first, p.raw.raw_fact.filter(late | repeated)


@query("e1_merged_extract")
def _(p):
    """The event store after a late extract was merged into its months."""
    layer = _scratch_layer(p)
    first, late = _late(p)
    event_store.create_store(first, layer, buckets=8)
    event_store.merge(late, layer)
    return event_store.stored_events(p.spark, layer).drop("year_month")


@query("g7_merged_extract")
def _(p):
    """The daily fact of marts whose months were rebuilt from the merged store."""
    staging_layer, layer = _scratch_layer(p), _scratch_layer(p)
    first, late = _late(p)
    events = event_store.create_store(first, staging_layer, buckets=8)
    store = partial(build.store_mart, layer=layer)
    build.Models(replace(p.raw, raw_fact=first), store=store, staged=events).built()
    build.merge_extract(p.raw, late, staging_layer=staging_layer, layer=layer)
    return p.spark.table(f"{layer}.fact_oee_daily").drop("year_month")


@query("f3_ranked")
def _(p):
    by_pair = p.fact.groupBy("machine", "product").agg(num.pct("quality", 1).alias("quality_pct"))
    return ranked(by_pair, "quality_pct", ascending=False, tie=["machine", "product"])


@query("f4_bottom_1")
def _(p):
    by_product = p.fact.groupBy("product").agg(num.pct("oee", 2).alias("oee_pct"))
    return ranked(by_product, "oee_pct", ascending=True, limit=1, tie=["product"])


@query("f5_bottom_20")
def _(p):
    return ranked(
        p.fact.select(*DAILY_KEY, "oee", "run_time_min"), "run_time_min", False, 20, DAILY_KEY
    )


@query("f6_top3_per_group")
def _(p):
    totals = reports.non_run(p.events).groupBy("machine", "oee_category_raw").agg(
        F.sum("duration_minutes").alias("minutes")
    )
    return top_per_group(totals, ["machine"], "minutes", 3, ["oee_category_raw"])


# --- mart builders -----------------------------------------------------------------

for _key, _model in {
    "g1_dim_machine": "dim_machine",
    "g2_dim_product": "dim_product",
    "g3_dim_date": "dim_date",
    "g4_events_classified": "int_events_classified",
    "g5_daily_machine_product": "int_daily_machine_product",
    "g6_fact_machine_events": "fact_machine_events",
    "g7_fact_oee_daily": "fact_oee_daily",
    "g9_whatif_pm": "mart_whatif_pm_reduction",
}.items():
    QUERIES[_key] = lambda p, model=_model: getattr(p.models, model)


@query("g8_monthly_summary")
def _(p):
    return p.models.mart_oee_monthly_summary.withColumn(
        "oee_weighted_avg", num.rounded("oee_weighted_avg", 6)
    )


@query("g8_whole_plant")
def _(p):
    return marts.monthly_summary(p.fact, label="all").withColumn(
        "oee_weighted_avg", num.rounded("oee_weighted_avg", 6)
    )


@query("g7_stored_build")
def _(p):
    """The daily fact of a build that stores the event fact first and reads it back."""
    return build.build_scratch(p.raw).fact_oee_daily


@query("g7_day_range")
def _(p):
    """The daily fact of some days, rebuilt from their raw events alone."""
    part = replace(p.raw, raw_fact=build.in_days(p.raw.raw_fact, *JANUARY))
    return build.compose(part).fact_oee_daily


@query("g6_refreshed")
def _(p):
    """The event fact after a build of some months and the refresh of one with all its events."""
    layers = _layers(p)
    partial_raw = replace(
        load.stored_raw(p.spark, layers[tables.RAW]),
        raw_fact=p.raw.raw_fact.filter(~F.to_date("startdatetime").between(*JANUARY)),
    )
    store = partial(build.store_mart, layer=layers[tables.MARTS])
    build.Models(partial_raw, store=store).built()
    fresh = build.refresh_months(p.raw, *JANUARY, layer=layers[tables.MARTS])
    return fresh.fact_machine_events.drop("year_month")


@query("g10_month_rollup")
def _(p):
    """Day states merged into months by machine, and what is read off them."""
    months = rollup.merged(
        p.stored.mart_day_rollup.withColumn("year_month", cal.year_month("date_key")),
        ["year_month", "machine"],
    )
    whole = rollup.merged(months, ["machine"])
    return whole.groupBy("machine").agg(
        F.sum("n_rows").alias("n_rows"),
        num.rounded(rollup.mean("oee"), 6).alias("oee_mean"),
        num.rounded(rollup.sample_deviation(), 6).alias("oee_stddev"),
        F.min("oee_min").alias("oee_min"), F.max("oee_max").alias("oee_max"),
        F.sum("planned_time_min").cast("double").alias("planned_time_min"),
    )


@query("g11_stop_rollup")
def _(p):
    stops = rollup.merged(p.stored.mart_stop_rollup, ["machine", "oee_category_raw"])
    return stops.withColumn("minutes", F.col("minutes").cast("double"))


# --- scalar functions --------------------------------------------------------------


@query("h_scalar_functions")
def _(p):
    start = F.col("start_datetime")
    category = F.col("oee_category_raw")
    return p.staged.select(
        *EVENT_KEY,
        F.trim(F.concat(F.lit("  "), category, F.lit(" "))).alias("h1_trim"),
        F.col("duration_minutes").cast("double").cast("string").cast("double").alias("h2_cast"),
        F.when(category == "0", "junk").otherwise("named").alias("h3_case"),
        category.ilike("run TIME%").alias("h4_ilike"),
        (category.isin("0", "") | category.isNull()).alias("h5_in"),
        F.coalesce(F.nullif(category, F.lit("0")), F.lit("none")).alias("h6_h7_coalesce_nullif"),
        num.capped(num.ratio("good_biscuits_made", "total_biscuits_made")).alias("h8_least"),
        num.rounded(num.hours_exact("duration_minutes"), 1).alias("h9_round"),
        F.concat(F.col("machine"), F.lit(": "), F.col("product")).alias("h10_concat"),
        F.to_date(F.date_trunc("day", start)).alias("h11_day"),
        cal.iso_weekday("start_datetime").alias("h12_iso_weekday"),
        F.dayofmonth(start).alias("h13_day_of_month"),
        cal.day_name("start_datetime").alias("h14_day_name"),
        cal.year_month("start_datetime").alias("h15_year_month"),
        cal.week_of_month("start_datetime").alias("h16_week_of_month"),
        cal.is_weekend("start_datetime").alias("h17_weekend"),
        surrogate_key("machine").alias("h18_key"),
        (F.col("total_biscuits_made") - F.col("good_biscuits_made")).alias("h20_waste"),
    ).withColumn(
        "h21_label",
        cal.weekday_label("h17_weekend", DEFAULTS.weekend_label, DEFAULTS.weekday_label),
    )


@query("h19_date_spine")
def _(p):
    return cal.date_spine_of(p.raw.raw_fact, F.to_date("startdatetime"))


# --- checks ------------------------------------------------------------------------


class Corrupted:
    """The models with defects put in, so that checks have something to find."""

    def __init__(self, models: build.Models):
        self.models = models
        staged = self.models.stg_fact_events
        self.staged = staged.withColumn(
            "product", F.when(F.col("duration_minutes") <= 500, F.col("product"))
        ).withColumn(
            "duration_minutes",
            F.when(F.col("oee_category_raw") == "0", -F.col("duration_minutes")).otherwise(
                F.col("duration_minutes")
            ),
        )
        self.classified = self.models.int_events_classified.replace(
            {"UNKNOWN": "IDLE"}, subset=["oee_status_group"]
        )
        self.fact = self.models.fact_oee_daily.withColumn(
            "machine_key",
            F.when(F.col("quality") < 1.0, F.md5("product")).otherwise(F.col("machine_key")),
        ).withColumn("oee", F.col("oee") + F.col("performance"))
        self.products = self.models.dim_product.withColumn(
            "product_name", F.concat(F.lit("Pack "), F.col("biscuits_per_pack").cast("string"))
        )

    def tables(self) -> dict[str, DataFrame]:
        return self.models.tables() | {
            "stg_fact_events": self.staged,
            "int_events_classified": self.classified,
            "fact_oee_daily": self.fact,
            "dim_product": self.products,
        }


@query("k1_not_null")
def _(p):
    return checks.check_not_null(Corrupted(p.models).staged, "product")


@query("k2_unique")
def _(p):
    return checks.check_unique(Corrupted(p.models).products, "product_name")


@query("k2_unique_composite")
def _(p):
    return checks.check_unique(p.staged, "machine", "product", "oee_category_raw")


@query("k3_accepted_values")
def _(p):
    return checks.check_accepted_values(
        Corrupted(p.models).classified, "oee_status_group", checks.STATUS_GROUPS
    )


@query("k4_relationships")
def _(p):
    bad = Corrupted(p.models)
    return checks.check_relationships(bad.fact, "machine_key", bad.models.dim_machine)


@query("k5_accepted_range")
def _(p):
    return checks.check_accepted_range(Corrupted(p.models).staged, "duration_minutes", 0)


@query("k6_expression_is_true")
def _(p):
    return checks.check_expression(Corrupted(p.models).fact, "oee <= 1").select(*DAILY_KEY, "oee")


@query("k7_run_suite")
def _(p):
    return checks.run_suite(p.checked.tables())


@query("k7_run_suite_corrupted")
def _(p):
    return checks.run_suite(Corrupted(p.checked).tables())


@query("k7_extra_keys")
def _(p):
    return checks.extra_unique_failures(p.models.tables())


@query("k8_quality_profile")
def _(p):
    return checks.quality_profile(p.raw.raw_fact, p.classified)


# --- reports -----------------------------------------------------------------------

ALL_FILTERS = reports.Filters(JANUARY, MACHINE, PRODUCT)


def _report(p: Plant, key: str, filters: reports.Filters) -> DataFrame:
    return reports.report(key, p.stored, filters)


for _number, (_key, _spec) in enumerate(reports.REPORTS.items(), start=1):
    QUERIES[f"q{_number}_{_key}"] = partial(_report, key=_key, filters=reports.Filters())
    QUERIES[f"q{_number}_{_key}_filtered"] = partial(
        _report, key=_key, filters=ALL_FILTERS.only(_spec.accepts)
    )


# --- the same over order lines -----------------------------------------------------

LINES = "_lines"
OVER_LINES = (
    "c1_join_targets", "c8_orphans", "d1_day_sums", "d15_repeated_keys", "e1_dedup_events",
    "g3_dim_date", "g6_fact_machine_events", "g7_fact_oee_daily", "g8_monthly_summary",
    "g9_whatif_pm", "k7_run_suite", "k8_quality_profile", "q1_kpi_oee", "q6_oee_trend",
    "q7_oee_dow", "q8_oee_machine", "q11_stability", "q13_downtime_cat", "q14_minor_major",
    "q17_waste_product", "q18_perf_gap", "q19_speed_machine", "q20_whatif_table",
)


def keys() -> list[str]:
    return [*QUERIES, *(key + LINES for key in OVER_LINES)]


def run(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    if key.endswith(LINES):
        plant = Plant(spark, sf_dir, fixtures.line_tables)
        return plain(QUERIES[key.removesuffix(LINES)](plant))
    return plain(QUERIES[key](Plant(spark, sf_dir)))
