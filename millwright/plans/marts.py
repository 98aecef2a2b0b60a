"""Mart layer: three dimensions, two facts, two summaries."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.config import DEFAULTS
from millwright.functions import calendar as cal
from millwright.functions.keys import surrogate_key
from millwright.functions.numeric import capped, per_hour, ratio
from millwright.functions.status import event_day
from millwright.operators.aggregates import measure_sums, run_weighted, target_output
from millwright.operators.joins import lookup_join
from millwright.schemas import COUNTERS, EVENT_KEY, MINUTE_MEASURES


def dim_machine(stg_machine: DataFrame) -> DataFrame:
    return stg_machine.select(
        surrogate_key("machine_name").alias("machine_key"), "machine_name", "machine_type"
    )


def dim_product(stg_product: DataFrame) -> DataFrame:
    return stg_product.select(
        surrogate_key("product_name").alias("product_key"),
        "product_name",
        "biscuits_per_pack",
        "biscuits_per_case",
        "biscuits_per_pallet",
    )


def dim_date_of(spine: DataFrame) -> DataFrame:
    day = "date_key"
    return spine.select(F.col("date_day").cast("date").alias(day)).select(
        day,
        cal.iso_weekday(day).alias("day_of_week_iso"),
        cal.day_name(day).alias("day_name"),
        F.dayofmonth(day).alias("day_of_month"),
        cal.is_weekend(day).alias("is_weekend"),
        cal.week_of_month(day).alias("week_of_month"),
        cal.year_month(day).alias("year_month"),
    )


def dim_date(spark: SparkSession, start: dt.date, end_exclusive: dt.date) -> DataFrame:
    return dim_date_of(cal.date_spine(spark, start, end_exclusive))


def fact_machine_events(
    classified: DataFrame, machines: DataFrame, products: DataFrame
) -> DataFrame:
    """Every event with its keys, outliers and junk categories included.

    The event key is hashed after the lookups: a hash need not travel where they are exchanged.
    """
    events = classified.withColumn("date_key", event_day())
    events = lookup_join(
        events, machines.select("machine_name", "machine_key"), {"machine": "machine_name"}
    )
    events = lookup_join(
        events, products.select("product_name", "product_key"), {"product": "product_name"}
    )
    return events.select(
        surrogate_key(*EVENT_KEY).alias("event_id"), "machine_key", "product_key", "date_key",
        "machine", "product", "start_datetime", "end_datetime", "duration_minutes",
        "oee_category_raw", "oee_status_group", "stoppage_class",
        "total_biscuits_made", "good_biscuits_made",
        "is_duration_outlier", "is_unknown_category",
    )


def oee() -> Column:
    """Product of the three ratios; a missing one counts as 0."""
    a, p, q = (F.coalesce(F.col(c), F.lit(0.0)) for c in ("availability", "performance", "quality"))
    return a * p * q


def fact_oee_daily(
    daily: DataFrame, machines: DataFrame, products: DataFrame, dates: DataFrame | None
) -> DataFrame:
    """The daily rows with their keys. Without a date dimension its columns are computed."""
    rows = daily.withColumnRenamed("event_date", "date_key")
    rows = lookup_join(
        rows, machines.select("machine_name", "machine_key"), {"machine": "machine_name"}
    )
    rows = lookup_join(
        rows, products.select("product_name", "product_key"), {"product": "product_name"}
    )
    if dates is None:
        rows = rows.withColumns({
            "is_weekend": cal.is_weekend("date_key"), "day_name": cal.day_name("date_key"),
        })
    else:
        rows = lookup_join(
            rows, dates.select("date_key", "is_weekend", "day_name"), {"date_key": "date_key"}
        )
    return rows.select(
        "machine", "product", "date_key", "machine_key", "product_key",
        "is_weekend", "day_name",
        *MINUTE_MEASURES, *COUNTERS,
        "target_biscuits_per_hour", "availability", "performance", "quality",
        oee().alias("oee"),
    )


def summary_sums(fact_daily: DataFrame, label: str | None = None) -> DataFrame:
    """Sums per month, or over all rows as one month called ``label``."""
    sums = [
        *measure_sums(),
        target_output().alias("target_biscuits_total"),
        run_weighted("oee").alias("oee_weighted_avg"),
    ]
    if label is not None:
        return fact_daily.agg(*sums).withColumn("year_month", F.lit(label))
    return fact_daily.groupBy(cal.year_month("date_key").alias("year_month")).agg(*sums)


def monthly_summary(fact_daily: DataFrame, label: str | None = None) -> DataFrame:
    """Plant-wide ratios computed from sums, next to the run-weighted daily mean."""
    sums = summary_sums(fact_daily, label).withColumns({
        "availability": ratio("run_time_min", "planned_time_min"),
        "performance": capped(ratio("total_biscuits_made", "target_biscuits_total")),
        "quality": capped(ratio("good_biscuits_made", "total_biscuits_made")),
    })
    return sums.select(
        "year_month", *MINUTE_MEASURES, *COUNTERS,
        "availability", "performance", "quality",
        oee().alias("oee"),
        "oee_weighted_avg",
    )


def whatif_pm(fact_daily: DataFrame, reduction: Decimal = DEFAULTS.pm_reduction) -> DataFrame:
    """Per machine: what a cut of the maintenance time by ``reduction`` would yield."""
    sums = fact_daily.groupBy("machine").agg(
        *measure_sums(("pm_downtime_min", "run_time_min", "total_biscuits_made"))
    )
    # a share keeps eight digits; 28,6 x 9,8 digits multiply to exactly 38,14
    saved = F.col("pm_downtime_min").cast("decimal(28,6)") * F.lit(reduction).cast("decimal(9,8)")
    throughput = per_hour("total_biscuits_made", "run_time_min")
    extra_hours = F.col("pm_downtime_reduced_min").cast("double") / 60
    return (
        sums.withColumn("pm_downtime_reduced_min", saved)
        .withColumn("extra_run_hours", extra_hours)
        .withColumn("avg_throughput_per_hour", throughput)
        .select(
            "machine", "pm_downtime_min", "pm_downtime_reduced_min", "extra_run_hours",
            "avg_throughput_per_hour",
            (F.col("extra_run_hours") * F.col("avg_throughput_per_hour")).alias(
                "extra_products_estimated"
            ),
        )
    )
