"""The 22 report queries, their filters and the five pages they belong to."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, replace
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.config import DEFAULTS, RUN, Settings
from millwright.functions.calendar import weekday_label
from millwright.functions.numeric import (
    counter_sum,
    hours,
    hours_double,
    hours_exact,
    per_hour,
    ratio,
    rounded,
)
from millwright.operators.joins import lookup_join
from millwright.operators.ranking import ranked, top_per_group
from millwright.plans.rollup import mean, mean_pct, sample_deviation


class Marts(Protocol):
    """What the reports read: the two rollups and the what-if mart, never facts or events."""

    mart_day_rollup: DataFrame
    mart_stop_rollup: DataFrame
    mart_whatif_pm_reduction: DataFrame


@dataclass(frozen=True)
class Filters:
    """Page filters. None means no predicate; both ends of the date range count."""

    date_range: tuple[dt.date, dt.date] | None = None
    machine: str | Sequence[str] | None = None
    product: str | Sequence[str] | None = None

    def given(self) -> set[str]:
        return {name for name, value in vars(self).items() if value is not None}

    def only(self, names: Iterable[str]) -> Filters:
        return replace(self, **{name: None for name in self.given() - set(names)})


def apply_filters(df: DataFrame, filters: Filters) -> DataFrame:
    """Add the given predicates; a table stored by month is also pruned by month."""
    if filters.date_range is not None:
        first, last = filters.date_range
        df = df.filter(F.col("date_key").between(F.lit(first), F.lit(last)))
        if "year_month" in df.columns:
            df = df.filter(F.col("year_month").between(f"{first:%Y-%m}", f"{last:%Y-%m}"))
    for name in ("machine", "product"):
        wanted = getattr(filters, name)
        if wanted is not None:
            values = [wanted] if isinstance(wanted, str) else list(wanted)
            df = df.filter(F.col(name).isin(*values))
    return df


def drill_day(day: dt.date) -> Filters:
    """A day picked on the trend becomes the day filter of the machine page."""
    return Filters(date_range=(day, day))


def non_run(events: DataFrame) -> DataFrame:
    return events.filter(F.col("oee_status_group") != RUN)


def stops_only(events: DataFrame) -> DataFrame:
    return events.filter(F.col("stoppage_class").isNotNull())


def _counted(events: DataFrame, include_outliers: bool) -> DataFrame:
    return events if include_outliers else events.filter(~F.col("is_duration_outlier"))


def _kpi(measure: str):
    def report(marts: Marts, filters: Filters, settings: Settings) -> DataFrame:
        rows = apply_filters(marts.mart_day_rollup, filters)
        return rows.agg(mean_pct(measure, 2).alias(f"{measure}_pct"))

    return report


def kpi_worldclass(marts: Marts, filters: Filters, settings: Settings) -> DataFrame:
    rows = apply_filters(marts.mart_day_rollup, filters)
    gap = mean("oee") * 100 - float(settings.world_class_pct)
    return rows.agg(rounded(gap, 2).alias("gap_points"))


def oee_trend(marts: Marts, filters: Filters, settings: Settings) -> DataFrame:
    rows = apply_filters(marts.mart_day_rollup, filters)
    by_day = rows.groupBy("date_key").agg(mean_pct("oee", 2).alias("oee_pct"))
    return ranked(by_day, "date_key", ascending=True)


def oee_dow(marts: Marts, filters: Filters, settings: Settings) -> DataFrame:
    """Weekdays in the order of their first date."""
    label = weekday_label("is_weekend", settings.weekend_label, settings.weekday_label)
    by_weekday = (
        apply_filters(marts.mart_day_rollup, filters)
        .groupBy("day_name", label.alias("day_group"))
        .agg(mean_pct("oee", 2).alias("oee_pct"), F.min("date_key").alias("first_date"))
    )
    return ranked(by_weekday, "first_date", ascending=True).drop("first_date")


def top_reasons(
    events: DataFrame,
    settings: Settings = DEFAULTS,
    include_outliers: bool = True,
    minutes: str = "duration_minutes",
) -> DataFrame:
    """Per machine, the categories with most stopped time as one text.

    ``events`` are events or their rollup, with the ``minutes`` to sum. Categories are
    summed first; only their totals meet in the per-machine ranking.
    A NULL category takes a rank but adds no text.
    """
    totals = (
        _counted(non_run(events), include_outliers)
        .groupBy("machine", "oee_category_raw")
        .agg(F.sum(minutes).alias("minutes"))
    )
    best = top_per_group(
        totals, ["machine"], "minutes", settings.reason_count, tie=["oee_category_raw"]
    )
    shown = F.round(hours_exact("minutes"), 1).cast("string")
    texts = best.withColumn(
        "reason", F.concat(F.col("oee_category_raw"), F.lit(": "), shown, F.lit("h"))
    )
    separator = settings.reason_separator.replace("'", "''")
    joined = F.expr(f"listagg(reason, '{separator}') within group (order by rank)")
    return texts.groupBy("machine").agg(joined.alias("main_stop_reasons"))


def oee_machine(marts: Marts, filters: Filters, settings: Settings) -> DataFrame:
    """The reasons column covers all events: page filters do not reach it."""
    rows = apply_filters(marts.mart_day_rollup, filters)
    by_machine = rows.groupBy("machine").agg(mean_pct("oee", 2).alias("oee_pct"))
    reasons = top_reasons(marts.mart_stop_rollup, settings, minutes="minutes")
    joined = lookup_join(by_machine, reasons, {"machine": "machine"})
    return ranked(joined, "oee_pct", ascending=True, tie=["machine"])


def _apq(digits: int = 1) -> list[Column]:
    return [mean_pct(m, digits).alias(f"{m}_pct") for m in ("availability", "performance", "quality")]


def apq_machine(marts: Marts, filters: Filters, settings: Settings) -> DataFrame:
    rows = apply_filters(marts.mart_day_rollup, filters)
    by_machine = rows.groupBy("machine").agg(*_apq())
    return ranked(by_machine, "quality_pct", ascending=False, tie=["machine"])


def worst_machine(marts: Marts, filters: Filters, settings: Settings) -> DataFrame:
    rows = apply_filters(marts.mart_day_rollup, filters)
    by_machine = rows.groupBy("machine").agg(mean("oee").alias("mean_oee"))
    return ranked(by_machine, "mean_oee", True, limit=1, tie=["machine"]).select("machine")


def stability(marts: Marts, filters: Filters, settings: Settings) -> DataFrame:
    """Mean and sample deviation of OEE; a machine with one day row has no deviation."""
    rows = apply_filters(marts.mart_day_rollup, filters)
    by_machine = rows.groupBy("machine").agg(
        mean_pct("oee", 2).alias("oee_pct"),
        rounded(sample_deviation() * 100, 2).alias("oee_stddev_pct"),
        *_apq(),
    )
    return ranked(by_machine, "oee_pct", ascending=False, tie=["machine"])


def total_downtime(marts: Marts, filters: Filters, settings: Settings) -> DataFrame:
    rows = apply_filters(marts.mart_day_rollup, filters)
    return rows.agg(hours("downtime_min", 1).alias("downtime_hours"))


def downtime_cat(
    marts: Marts, filters: Filters, settings: Settings, include_outliers: bool = True
) -> DataFrame:
    rows = apply_filters(marts.mart_stop_rollup, filters)
    by_category = (
        _counted(non_run(rows), include_outliers)
        .groupBy("oee_category_raw")
        .agg(hours("minutes", 1).alias("hours"))
    )
    return ranked(by_category, "hours", ascending=False, tie=["oee_category_raw"])


def minor_major(
    marts: Marts, filters: Filters, settings: Settings, include_outliers: bool = True
) -> DataFrame:
    rows = apply_filters(marts.mart_stop_rollup, filters)
    by_class = (
        _counted(stops_only(rows), include_outliers)
        .groupBy("stoppage_class")
        .agg(hours("minutes", 1).alias("hours"))
    )
    return ranked(by_class, "hours", ascending=False, tie=["stoppage_class"])


def cc_pct(marts: Marts, filters: Filters, settings: Settings) -> DataFrame:
    rows = apply_filters(marts.mart_day_rollup, filters)
    share = ratio(F.sum("changeover_time_min"), F.sum("downtime_min")) * 100
    return rows.agg(rounded(share, 1).alias("changeover_pct"))


def cc_machine(marts: Marts, filters: Filters, settings: Settings) -> DataFrame:
    rows = apply_filters(marts.mart_day_rollup, filters)
    by_machine = rows.groupBy("machine").agg(
        hours("changeover_time_min", 1).alias("changeover_hours")
    )
    return ranked(by_machine, "changeover_hours", ascending=False, tie=["machine"])


def waste_product(marts: Marts, filters: Filters, settings: Settings) -> DataFrame:
    rows = apply_filters(marts.mart_day_rollup, filters)
    by_product = rows.groupBy("product").agg(
        rounded((F.lit(1.0) - mean("quality")) * 100, 2).alias("waste_pct")
    )
    return ranked(by_product, "waste_pct", ascending=False, tie=["product"])


def _actual_speed() -> Column:
    speed = per_hour(counter_sum("total_biscuits_made"), F.sum("run_time_min"))
    return rounded(speed, 0).alias("actual_per_hour")


def perf_gap(marts: Marts, filters: Filters, settings: Settings) -> DataFrame:
    rows = apply_filters(marts.mart_day_rollup, filters)
    by_pair = rows.groupBy("machine", "product").agg(
        rounded(F.max("target_biscuits_per_hour"), 0).alias("target_per_hour"),
        _actual_speed(),
        mean_pct("performance", 1).alias("performance_pct"),
    )
    return ranked(
        by_pair, "performance_pct", True, limit=settings.gap_rows, tie=["machine", "product"]
    )


def speed_machine(marts: Marts, filters: Filters, settings: Settings) -> DataFrame:
    rows = apply_filters(marts.mart_day_rollup, filters)
    target = ratio(hours_double(F.sum("target_output")), hours_double(F.sum("run_time_min")))
    by_machine = rows.groupBy("machine").agg(
        _actual_speed(), rounded(target, 0).alias("target_per_hour")
    )
    return ranked(by_machine, "actual_per_hour", ascending=True, tie=["machine"])


def whatif_table(marts: Marts, filters: Filters, settings: Settings) -> DataFrame:
    rows = apply_filters(marts.mart_whatif_pm_reduction, filters)
    shown = rows.select(
        "machine",
        rounded(hours_exact("pm_downtime_min"), 1).alias("pm_hours"),
        rounded(hours_double("pm_downtime_reduced_min"), 2).alias("saved_hours"),
        rounded("extra_run_hours", 2).alias("extra_run_hours"),
        rounded("extra_products_estimated", 0).alias("extra_products"),
    )
    return ranked(shown, "extra_run_hours", ascending=False, tie=["machine"])


def whatif_hours(marts: Marts, filters: Filters, settings: Settings) -> DataFrame:
    rows = apply_filters(marts.mart_whatif_pm_reduction, filters)
    shown = rows.select("machine", rounded("extra_run_hours", 2).alias("extra_run_hours"))
    return ranked(shown, "extra_run_hours", ascending=False, tie=["machine"])


def whatif_products(marts: Marts, filters: Filters, settings: Settings) -> DataFrame:
    rows = apply_filters(marts.mart_whatif_pm_reduction, filters)
    shown = rows.select("machine", rounded("extra_products_estimated", 0).alias("extra_products"))
    return ranked(shown, "extra_products", ascending=False, tie=["machine"])


D, M, P = "date_range", "machine", "product"


@dataclass(frozen=True)
class Report:
    """A report, the filters its query accepts, and those its page passes on."""

    build: Callable[[Marts, Filters, Settings], DataFrame]
    accepts: tuple[str, ...]
    page: int
    binds: tuple[str, ...]


REPORTS: dict[str, Report] = {
    "kpi_oee": Report(_kpi("oee"), (D, M, P), 1, (D, M, P)),
    "kpi_availability": Report(_kpi("availability"), (D, M, P), 1, (D, M, P)),
    "kpi_performance": Report(_kpi("performance"), (D, M, P), 1, (D, M, P)),
    "kpi_quality": Report(_kpi("quality"), (D, M, P), 1, (D, M, P)),
    "kpi_worldclass": Report(kpi_worldclass, (D, M, P), 1, (D, M, P)),
    "oee_trend": Report(oee_trend, (D, M, P), 1, (D,)),
    "oee_dow": Report(oee_dow, (D, M, P), 1, (D,)),
    "oee_machine": Report(oee_machine, (D, M, P), 2, (D, M, P)),
    "apq_machine": Report(apq_machine, (D, M, P), 2, (D, M, P)),
    "worst_machine": Report(worst_machine, (D, M, P), 2, (D, M, P)),
    "stability": Report(stability, (D, M, P), 2, (D, M, P)),
    "total_downtime": Report(total_downtime, (D, M, P), 3, (D, M)),
    "downtime_cat": Report(downtime_cat, (D, M, P), 3, (D, M)),
    "minor_major": Report(minor_major, (D, M, P), 3, (D, M)),
    "cc_pct": Report(cc_pct, (D, M), 3, (D, M)),
    "cc_machine": Report(cc_machine, (D, M), 3, (D, M)),
    "waste_product": Report(waste_product, (D, M, P), 4, (D, P)),
    "perf_gap": Report(perf_gap, (D, M, P), 4, (D, M, P)),
    "speed_machine": Report(speed_machine, (D, M, P), 4, (D, M)),
    "whatif_table": Report(whatif_table, (M,), 5, (M,)),
    "whatif_hours": Report(whatif_hours, (M,), 5, (M,)),
    "whatif_products": Report(whatif_products, (M,), 5, (M,)),
}


def report(
    key: str, marts: Marts, filters: Filters = Filters(), settings: Settings = DEFAULTS
) -> DataFrame:
    """Run one report. A filter its query does not know is an error."""
    spec = REPORTS[key]
    unknown = filters.given() - set(spec.accepts)
    if unknown:
        raise ValueError(f"report {key} has no filter {sorted(unknown)}")
    return spec.build(marts, filters, settings)


def page(
    number: int, marts: Marts, filters: Filters = Filters(), settings: Settings = DEFAULTS
) -> dict[str, DataFrame]:
    """All reports of a page; each gets the page filters that are bound to it."""
    return {
        key: report(key, marts, filters.only(spec.binds), settings)
        for key, spec in REPORTS.items()
        if spec.page == number
    }
