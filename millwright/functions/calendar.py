"""Calendar columns of a day, and day spines."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def iso_weekday(day: str) -> Column:
    """1 = Monday .. 7 = Sunday."""
    return (F.weekday(F.col(day)) + 1).cast("int")


def day_name(day: str) -> Column:
    return F.date_format(F.col(day), "EEEE")


def is_weekend(day: str) -> Column:
    return F.weekday(F.col(day)) >= 5


def week_of_month(day: str) -> Column:
    """Days 1-7 are week 1, 8-14 week 2, and so on."""
    return F.ceil(F.dayofmonth(F.col(day)) / 7).cast("int")


def year_month(day: str) -> Column:
    return F.date_format(F.col(day), "yyyy-MM")


def weekday_label(flag: str, weekend: str, weekday: str) -> Column:
    """Label of a weekend flag; a NULL flag counts as a weekday."""
    return F.when(F.col(flag), weekend).otherwise(weekday)


def date_spine(spark: SparkSession, start: dt.date, end_exclusive: dt.date) -> DataFrame:
    """One row per day from start up to, but not including, the end."""
    days = (end_exclusive - start).days
    return spark.range(max(days, 0)).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias("date_day")
    )


def date_spine_of(df: DataFrame, day: str | Column) -> DataFrame:
    """Whole months that cover the days found in ``df``."""
    value = F.col(day) if isinstance(day, str) else day
    bounds = df.agg(
        F.trunc(F.min(value), "month").alias("first"), F.last_day(F.max(value)).alias("last")
    )
    return bounds.select(F.explode(F.sequence("first", "last")).alias("date_day"))
