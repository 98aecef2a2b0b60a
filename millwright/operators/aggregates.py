"""Grouped sums behind the marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.config import CHANGEOVER, MAINTENANCE, MAJOR, MINOR, NO_ORDER
from millwright.functions.numeric import counter_sum, hours_double, ratio
from millwright.schemas import COUNTERS, DAY_KEY, MINUTE_MEASURES


def minutes_where(condition: Column, duration: str = "duration_minutes") -> Column:
    return F.sum(F.when(condition, F.col(duration)).otherwise(F.lit(0)))


def day_sums(events: DataFrame, keys: Sequence[str] = DAY_KEY) -> DataFrame:
    """Minutes by kind and counters per group.

    Stops count as minor or major whatever their group, orderless time included.
    Sums are partial before the exchange, so a group with very many events sends one
    row per task.
    """
    group, stop = F.col("oee_status_group"), F.col("stoppage_class")
    return events.groupBy(*keys).agg(
        minutes_where(group != NO_ORDER).alias("planned_time_min"),
        minutes_where(group == CHANGEOVER).alias("changeover_time_min"),
        minutes_where(group == MAINTENANCE).alias("pm_downtime_min"),
        minutes_where(stop == MINOR).alias("minor_stoppage_min"),
        minutes_where(stop == MAJOR).alias("major_stoppage_min"),
        *[F.sum(c).alias(c) for c in COUNTERS],
    )


def with_run_time(sums: DataFrame) -> DataFrame:
    """Downtime is changeover plus maintenance; the rest of planned time counts as run."""
    downtime = F.col("changeover_time_min") + F.col("pm_downtime_min")
    return sums.withColumn("downtime_min", downtime).withColumn(
        "run_time_min", F.col("planned_time_min") - F.col("downtime_min")
    )


def measure_sums(columns: Sequence[str] = (*MINUTE_MEASURES, *COUNTERS)) -> list[Column]:
    return [
        (counter_sum(c) if c in COUNTERS else F.sum(c)).alias(c)
        for c in columns
    ]


def target_output() -> Column:
    """Expected pieces for the minutes run; a row without a target adds 0.

    A target keeps its declared 18,6 digits. 18,6 x 19,6 digits multiply to exactly 38,12, so
    nothing is rounded before the sum; a day group would need 10**13 minutes to pass that.
    """
    target = F.col("target_biscuits_per_hour").cast("decimal(18,6)")
    run = F.col("run_time_min").cast("decimal(19,6)")
    return hours_double(F.sum(F.coalesce(target * run, F.lit(0).cast("decimal(38,12)"))))


def run_weighted(value: str) -> Column:
    """Mean of a daily value weighted by the minutes run; NULL if none ran."""
    run = F.coalesce(F.col("run_time_min").cast("double"), F.lit(0.0))
    return ratio(F.sum(F.coalesce(F.col(value), F.lit(0.0)) * run), F.sum("run_time_min"))
