"""Intermediate layer: classified events and the daily aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.config import DEFAULTS, Settings
from millwright.functions import status
from millwright.functions.numeric import capped, hours_double, ratio
from millwright.operators.aggregates import day_sums, with_run_time
from millwright.operators.joins import lookup_join
from millwright.schemas import DAY_KEY, MINUTE_MEASURES


def classify_status(df: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return df.withColumn("oee_status_group", status.status_group(settings=settings))


def flag_outlier(df: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return df.withColumn("is_duration_outlier", status.duration_outlier(settings=settings))


def flag_unknown(df: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return df.withColumn("is_unknown_category", status.unknown_category(settings=settings))


def classify_stoppage(df: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return df.withColumn("stoppage_class", status.stoppage_class(settings=settings))


def events_classified(staged: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Staged events with group, stop class and both quality flags."""
    flagged = staged.withColumns({
        "oee_status_group": status.status_group(settings=settings),
        "is_duration_outlier": status.duration_outlier(settings=settings),
        "is_unknown_category": status.unknown_category(settings=settings),
    })
    return classify_stoppage(flagged, settings)


def exclude_outliers(classified: DataFrame) -> DataFrame:
    """Drop outliers; a NULL duration has a NULL flag and drops out too."""
    return classified.filter(~F.col("is_duration_outlier"))


def with_event_date(df: DataFrame) -> DataFrame:
    return df.withColumn("event_date", status.event_day())


def availability() -> Column:
    return ratio("run_time_min", "planned_time_min")


def performance() -> Column:
    """Output per run hour against the target, at most 1; 1 where either is missing."""
    speed = ratio("total_biscuits_made", hours_double("run_time_min"))
    return capped(ratio(speed, "target_biscuits_per_hour"))


def quality() -> Column:
    """Good share of the output, at most 1; 1 where nothing was counted."""
    return capped(ratio("good_biscuits_made", "total_biscuits_made"))


def day_groups(classified: DataFrame) -> DataFrame:
    """Sums per machine, product and day, before the planned-time condition."""
    return with_run_time(day_sums(with_event_date(exclude_outliers(classified))))


def planned_only(groups: DataFrame) -> DataFrame:
    return groups.filter(F.col("planned_time_min") > 0)


def join_targets(groups: DataFrame, targets: DataFrame) -> DataFrame:
    return lookup_join(groups, targets, {"machine": "machine", "product": "product"})


def daily_machine_product(classified: DataFrame, targets: DataFrame) -> DataFrame:
    """One row per machine, product and day with planned time, and its three ratios.

    The groups are small by now, so the target join moves day rows, never events.
    """
    daily = join_targets(planned_only(day_groups(classified)), targets)
    return daily.select(
        *DAY_KEY,
        *MINUTE_MEASURES,
        "total_biscuits_made",
        "good_biscuits_made",
        "target_biscuits_per_hour",
        availability().alias("availability"),
        performance().alias("performance"),
        quality().alias("quality"),
    )
