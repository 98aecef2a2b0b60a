"""Column builders for ratios, percentages and display rounding.

Sums stay exact (decimal or long) and are divided once, in double. Display
rounding is half away from zero on a decimal, so the noise a double average
carries in its last digits never decides a rounded value, whatever the
partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ROUNDING = "decimal(38,9)"
# 28 integer digits: leaves decimal division 9 fraction digits for hours.
MINUTE_SUM = "decimal(34,6)"
COUNTER_SUM = "decimal(20,0)"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """numerator / denominator in double; NULL where the denominator is 0 or NULL."""
    return col(numerator).cast("double") / F.nullif(col(denominator).cast("double"), F.lit(0.0))


def capped(value: Column) -> Column:
    """At most 1. A NULL value gives 1.0, because ``least`` skips NULLs."""
    return F.least(value, F.lit(1.0))


def rounded(value: str | Column, digits: int) -> Column:
    return F.round(col(value).cast(ROUNDING), digits).cast("double")


def whole(value: str | Column, given: str) -> Column:
    """A counter of type ``given`` as a long, rounded.

    Halves of decimals are rounded away from zero; those of floating columns, and of text,
    which stands for them, to even.

    A NaN, which is how a missing value of a floating column arrives, becomes NULL.
    """
    counter = col(value)
    if given in ("float", "double"):
        counter = F.when(~F.isnan(counter), F.rint(counter))
    elif given == "string":
        counter = F.bround(counter.cast("decimal(38,6)"), 0)
    elif given.startswith("decimal"):
        counter = F.round(counter, 0)
    return counter.cast("bigint")


def pct(value: str | Column, digits: int) -> Column:
    """Mean of a 0..1 column as a rounded percentage."""
    return rounded(F.avg(col(value)) * 100, digits)


def hours_exact(minutes: str | Column) -> Column:
    return col(minutes).cast(MINUTE_SUM) / F.lit(60)


def hours(minutes: str | Column, digits: int) -> Column:
    """Sum of minutes as rounded hours."""
    return rounded(hours_exact(F.sum(col(minutes))), digits)


def counter_sum(counter: str | Column) -> Column:
    """Sum of counters that cannot overflow a long across days."""
    return F.sum(col(counter).cast(COUNTER_SUM))


def per_hour(total: str | Column, minutes: str | Column) -> Column:
    """Output per hour; NULL where no minute was run."""
    return ratio(total, hours_double(minutes))


def hours_double(minutes: str | Column) -> Column:
    return col(minutes).cast("double") / 60
