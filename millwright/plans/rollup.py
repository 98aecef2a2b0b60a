"""Mergeable rollups from which every report is answered.

A rollup row holds *states*: counts, sums, sums of squares and extremes. States of any rows add
up to the state of all of them, so days merge into months and months into any range, and a
mean, a sample deviation, a ratio of sums or a maximum is read off at the end. Minutes and
counters are exact decimals; sums of ratios are doubles, as ratios have no bound, and the noise
in their last digits is below what reports show.

``day_rollup`` has a row per day, machine and product of the daily fact, ``stop_rollup`` one
per day, machine, product and kind of event, which is the only thing reports ask of events.
``merged`` rolls either up further.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.functions.numeric import rounded
from millwright.schemas import COUNTERS, MINUTE_MEASURES

RATIOS = ("availability", "performance", "quality", "oee")
DAY_KEYS = ("date_key", "machine", "product", "is_weekend", "day_name")
STOP_KEYS = ("date_key", "machine", "product", "oee_category_raw", "oee_status_group",
             "stoppage_class", "is_duration_outlier")
TARGET = "target_biscuits_per_hour"

# state column -> how states of it are merged
DAY_STATES = {
    "n_rows": F.sum,
    **{f"{r}_n": F.sum for r in RATIOS},
    **{f"{r}_sum": F.sum for r in RATIOS},
    "oee_sq": F.sum,
    "oee_min": F.min,
    "oee_max": F.max,
    **{c: F.sum for c in (*MINUTE_MEASURES, *COUNTERS)},
    TARGET: F.max,
    "target_output": F.sum,
}
STOP_STATES = {"n_events": F.sum, "minutes": F.sum}


def _typed(states: dict, name: str) -> str | None:
    """Sums keep the type of their states, so that rollups of rollups have one schema."""
    if name.endswith("_sum") or name == "oee_sq":
        return "double"
    if name in MINUTE_MEASURES or name == "minutes":
        return "decimal(38,6)"
    if name == "target_output":
        return "decimal(38,12)"
    if name in COUNTERS:
        return "decimal(38,0)"
    return "bigint" if states[name] is F.sum else None


def merged(rollup: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A rollup by fewer keys; ``keys`` may name columns added to it, a month for example."""
    states = DAY_STATES if "oee_sq" in rollup.columns else STOP_STATES
    out = []
    for name, how in states.items():
        column, kind = how(name), _typed(states, name)
        out.append((column.cast(kind) if kind else column).alias(name))
    return rollup.groupBy(*keys).agg(*out)


def day_states(fact_daily: DataFrame) -> DataFrame:
    """Each row of the daily fact as a state."""
    run = F.col("run_time_min").cast("decimal(19,6)")
    # 18,6 x 19,6 digits multiply to exactly 38,12
    target = F.coalesce(F.col(TARGET).cast("decimal(18,6)") * run, F.lit(0).cast("decimal(38,12)"))
    columns = {
        "n_rows": F.lit(1).cast("bigint"),
        **{f"{r}_n": F.when(F.col(r).isNotNull(), 1).otherwise(0).cast("bigint") for r in RATIOS},
        **{f"{r}_sum": F.col(r) for r in RATIOS},
        "oee_sq": F.col("oee") * F.col("oee"),
        "oee_min": F.col("oee"),
        "oee_max": F.col("oee"),
        **{c: F.col(c).cast("decimal(38,6)") for c in MINUTE_MEASURES},
        **{c: F.col(c).cast("decimal(38,0)") for c in COUNTERS},
        TARGET: F.col(TARGET),
        "target_output": target,
    }
    return fact_daily.select(*DAY_KEYS, *[columns[c].alias(c) for c in DAY_STATES])


def day_rollup(fact_daily: DataFrame) -> DataFrame:
    """Day states by machine and product. The fact has one row for each, so nothing moves."""
    return day_states(fact_daily)


def stop_rollup(events: DataFrame) -> DataFrame:
    """Minutes and events by day, machine, product and kind; partial before the exchange."""
    return events.groupBy(*STOP_KEYS).agg(
        F.count("*").alias("n_events"),
        F.sum("duration_minutes").cast("decimal(38,6)").alias("minutes"),
    )


# --- what is read off merged states; each is an aggregate over rollup rows -------------


def mean(ratio: str) -> Column:
    """Mean of the values that are not NULL."""
    count = F.nullif(F.sum(f"{ratio}_n"), F.lit(0)).cast("double")
    return F.sum(f"{ratio}_sum").cast("double") / count


def mean_pct(ratio: str, digits: int) -> Column:
    return rounded(mean(ratio) * 100, digits)


def sample_deviation() -> Column:
    """Of OEE; NULL for fewer than two values. Equal values may leave noise, never below zero."""
    n = F.sum("oee_n").cast("double")
    total, squares = F.sum("oee_sum").cast("double"), F.sum("oee_sq").cast("double")
    variance = (squares - total * total / n) / (n - 1)
    return F.when(F.sum("oee_n") > 1, F.sqrt(F.greatest(variance, F.lit(0.0))))
