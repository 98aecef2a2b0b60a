"""Columns that classify one event."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from millwright.config import DEFAULTS, MAJOR, MINOR, RUN, UNKNOWN, Settings


def status_group(category: str = "oee_category_raw", settings: Settings = DEFAULTS) -> Column:
    """Group of the status text by case-insensitive prefix; UNKNOWN if none fits or NULL."""
    text = F.col(category)
    first, *rest = settings.status_prefixes
    chain = reduce(
        lambda acc, item: acc.when(text.ilike(item[0] + "%"), item[1]),
        rest,
        F.when(text.ilike(first[0] + "%"), first[1]),
    )
    return chain.otherwise(UNKNOWN)


def duration_outlier(duration: str = "duration_minutes", settings: Settings = DEFAULTS) -> Column:
    """Strictly longer than the limit; NULL for a NULL duration."""
    return F.col(duration) > settings.outlier_minutes


def unknown_category(category: str = "oee_category_raw", settings: Settings = DEFAULTS) -> Column:
    """NULL or a junk value. Narrower than the UNKNOWN group."""
    text = F.col(category)
    return text.isNull() | text.isin(*settings.junk_categories)


def stoppage_class(
    group: str = "oee_status_group",
    duration: str = "duration_minutes",
    settings: Settings = DEFAULTS,
) -> Column:
    """MINOR below the limit, MAJOR from it on; NULL for running time or NULL duration."""
    length = F.col(duration)
    size = F.when(length < settings.major_minutes, MINOR).when(
        length >= settings.major_minutes, MAJOR
    )
    return F.when(F.col(group) != RUN, size)


def event_day(start: str = "start_datetime") -> Column:
    """Day of the start; an event is never split at midnight."""
    return F.to_date(F.col(start))
