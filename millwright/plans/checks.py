"""Data-quality checks. A check passes when it finds no failing row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.config import NO_ORDER, STATUS_GROUPS, STOPPAGE_CLASSES
from millwright.operators.joins import orphans
from millwright.plans.intermediate import with_event_date
from millwright.schemas import DAY_KEY, EVENT_KEY

NOT_NULL = "not_null"
UNIQUE = "unique"
ACCEPTED_VALUES = "accepted_values"
RELATIONSHIPS = "relationships"
ACCEPTED_RANGE = "accepted_range"
EXPRESSION = "expression_is_true"


def _not_null(column: str) -> Column:
    return F.col(column).isNull()


def _not_accepted(column: str, values: Sequence) -> Column:
    return ~F.col(column).isin(*values)


def _below(column: str, minimum) -> Column:
    return F.col(column) < F.lit(minimum)


def _not_true(expression: str) -> Column:
    return ~F.expr(expression)


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(_not_null(column))


def check_accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values that are not accepted, with the number of rows that carry each; NULL passes."""
    wrong = df.filter(_not_accepted(column, values))
    return wrong.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n_rows"))


def check_accepted_range(df: DataFrame, column: str, minimum) -> DataFrame:
    """Rows below the minimum, which itself is allowed."""
    return df.filter(_below(column, minimum))


def check_expression(df: DataFrame, expression: str) -> DataFrame:
    """Rows for which the expression is false; NULL passes."""
    return df.filter(_not_true(expression))


def check_unique(df: DataFrame, *columns: str) -> DataFrame:
    """Values, or combinations without a NULL, that occur more than once."""
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return (
        df.filter(present)
        .groupBy(*columns)
        .agg(F.count("*").alias("n_rows"))
        .filter(F.col("n_rows") > 1)
    )


def check_relationships(
    df: DataFrame, column: str, parent: DataFrame, parent_column: str | None = None
) -> DataFrame:
    """Key values without a parent, with the number of rows that carry them."""
    return orphans(df, column, parent, parent_column)


@dataclass(frozen=True)
class Check:
    """``column`` may be a tuple of columns where a combination has to be unique."""

    table: str
    kind: str
    column: str | tuple[str, ...]
    values: tuple = ()
    minimum: int | None = None
    expression: str = ""
    parent: str = ""

    @property
    def detail(self) -> str:
        if self.kind == EXPRESSION:
            return self.expression
        if self.kind == ACCEPTED_RANGE:
            return f">= {self.minimum}"
        if self.kind == RELATIONSHIPS:
            return self.parent
        return ", ".join(self.values)

    def failing(self) -> Column:
        """Condition of a failing row, for the kinds that look at one row at a time."""
        if self.kind == NOT_NULL:
            return _not_null(self.column)
        if self.kind == ACCEPTED_RANGE:
            return _below(self.column, self.minimum)
        return _not_true(f"`{self.column}` {self.expression}")


    @property
    def columns(self) -> tuple[str, ...]:
        return (self.column,) if isinstance(self.column, str) else self.column

    def key(self) -> Column:
        """Text that two rows share exactly if the checked values are equal; NULL if one is."""
        first, *rest = (F.col(c).cast("string") for c in self.columns)
        if not rest:
            return first
        # lengths keep ('a-b', 'c') and ('a', 'b-c') apart
        return F.concat(*[F.concat(F.length(c), F.lit(":"), c) for c in (first, *rest)])

    def finding(self, number: int) -> Column:
        """(check, key) of a row that counts for this check, NULL of any other.

        Row checks count rows under one key; the others count rows by value.
        """
        if self.kind in (UNIQUE, RELATIONSHIPS):
            key, counts = self.key(), self.key().isNotNull()
        elif self.kind == ACCEPTED_VALUES:
            key, counts = self.key(), _not_accepted(self.column, self.values)
        else:
            key, counts = F.lit(None).cast("string"), self.failing()
        return F.when(counts, F.struct(F.lit(number).alias("check"), key.alias("key")))


def _checks(table: str, kind: str, columns: Sequence[str], **args) -> list[Check]:
    return [Check(table, kind, c, **args) for c in columns]


_RATIOS = ("availability", "performance", "quality")
_DIM_OF_KEY = {"machine_key": "dim_machine", "product_key": "dim_product", "date_key": "dim_date"}


def _foreign_keys(table: str) -> list[Check]:
    return [
        c
        for key, parent in _DIM_OF_KEY.items()
        for c in (Check(table, NOT_NULL, key), Check(table, RELATIONSHIPS, key, parent=parent))
    ]


def _keys(table: str, *columns: str) -> list[Check]:
    return _checks(table, NOT_NULL, columns) + _checks(table, UNIQUE, columns)


DECLARED: tuple[Check, ...] = (
    *_checks(
        "stg_fact_events",
        NOT_NULL,
        (*EVENT_KEY, "duration_minutes", "total_biscuits_made", "good_biscuits_made",
         "oee_category_raw"),
    ),
    Check("stg_fact_events", ACCEPTED_RANGE, "duration_minutes", minimum=0),
    *_checks(
        "stg_target_speeds", NOT_NULL, ("machine", "product", "target_biscuits_per_hour")
    ),
    Check("stg_target_speeds", ACCEPTED_RANGE, "target_biscuits_per_hour", minimum=1),
    *_keys("stg_product", "product_name"),
    Check("stg_product", NOT_NULL, "biscuits_per_pallet"),
    *_keys("stg_machine", "machine_name"),
    Check("int_events_classified", ACCEPTED_VALUES, "oee_status_group", values=STATUS_GROUPS),
    Check("int_events_classified", ACCEPTED_VALUES, "stoppage_class", values=STOPPAGE_CLASSES),
    *_checks("int_events_classified", NOT_NULL, ("is_duration_outlier", "is_unknown_category")),
    *_checks(
        "int_daily_machine_product",
        NOT_NULL,
        ("machine", "product", "event_date", "planned_time_min"),
    ),
    Check("int_daily_machine_product", EXPRESSION, "planned_time_min", expression="> 0"),
    *_checks(
        "int_daily_machine_product", EXPRESSION, ("run_time_min", "downtime_min"),
        expression=">= 0",
    ),
    *_checks("int_daily_machine_product", EXPRESSION, _RATIOS, expression="<= 1"),
    *_keys("dim_machine", "machine_key", "machine_name"),
    Check("dim_machine", NOT_NULL, "machine_type"),
    *_keys("dim_product", "product_key", "product_name"),
    Check("dim_product", NOT_NULL, "biscuits_per_pallet"),
    *_keys("dim_date", "date_key"),
    Check("dim_date", NOT_NULL, "is_weekend"),
    *_keys("fact_machine_events", "event_id"),
    *_foreign_keys("fact_machine_events"),
    Check("fact_machine_events", ACCEPTED_VALUES, "oee_status_group", values=STATUS_GROUPS),
    *_foreign_keys("fact_oee_daily"),
    *_checks("fact_oee_daily", EXPRESSION, (*_RATIOS, "oee"), expression="<= 1"),
    *_keys("mart_oee_monthly_summary", "year_month"),
    *_checks("mart_oee_monthly_summary", EXPRESSION, _RATIOS, expression="<= 1"),
    *_keys("mart_whatif_pm_reduction", "machine"),
    Check(
        "mart_whatif_pm_reduction", EXPRESSION, "pm_downtime_reduced_min", expression=">= 0"
    ),
)


# Two keys that are relied on but not among the declared checks: a repeated target pair would
# multiply daily rows, and the daily fact is one row per machine, product and day.
EXTRA_KEYS = (
    Check("stg_target_speeds", UNIQUE, ("machine", "product")),
    Check("fact_oee_daily", UNIQUE, ("machine", "product", "date_key")),
)


def extra_unique_failures(tables: Mapping[str, DataFrame]) -> DataFrame:
    return run_suite(tables, EXTRA_KEYS).select("table_name", "column_name", "failures")


def _findings(table: str, df: DataFrame, checks: Sequence[Check]) -> DataFrame | None:
    """(check, key, child, parent) of one table, from one scan.

    A row gives an entry per row check it fails, wrong value it holds and key it carries,
    and one per check that looks for its key as a parent.
    """
    found = [c.finding(i) for i, c in enumerate(checks) if c.table == table]
    asked = [
        F.when(F.col(c.column).isNotNull(), F.struct(
            F.lit(i).alias("check"), F.col(c.column).cast("string").alias("key")))
        for i, c in enumerate(checks) if c.kind == RELATIONSHIPS and c.parent == table
    ]
    both = [(f, True) for f in found] + [(a, False) for a in asked]
    if not both:
        return None
    entries = F.array(*[
        F.when(entry.isNotNull(), F.struct(
            entry.getField("check").alias("check"), entry.getField("key").alias("key"),
            F.lit(int(child)).cast("bigint").alias("child"),
            F.lit(not child).alias("parent"),
        ))
        for entry, child in both
    ])
    # rows with nothing to say, most rows of a table without keys, build no array; the rows of
    # NULLs that other entries become are dropped by compiled code, array_compact is not compiled
    saying = reduce(lambda a, b: a | b, [entry.isNotNull() for entry, _ in both])
    return df.filter(saying).select(F.inline(entries)).filter(F.col("check").isNotNull())


def run_suite(
    tables: Mapping[str, DataFrame], checks: Sequence[Check] = DECLARED
) -> DataFrame:
    """One row per check with the number of failures and pass / fail.

    Failures are rows for row checks and orphans, and values for repeated keys and values
    that are not accepted. Run it on stored tables: each is scanned once, whatever the
    number of its checks. What the rows have to say is counted by (check, key) in a single
    exchange for all tables; counts are partial before it, so a hot value or a check that
    fails everywhere sends one row per task, and foreign keys travel as often as they
    differ.
    """
    parts = [
        part
        for name in dict.fromkeys([*(c.table for c in checks), *(c.parent for c in checks if c.parent)])
        if (part := _findings(name, tables[name], checks)) is not None
    ]
    groups = reduce(DataFrame.unionByName, parts).groupBy("check", "key").agg(
        F.sum("child").alias("n_rows"), F.bool_or("parent").alias("parent")
    )
    kind = F.get(F.array(*[F.lit(c.kind) for c in checks]), F.col("check"))
    failures = (
        F.when(kind == UNIQUE, (F.col("n_rows") > 1).cast("bigint"))
        .when(kind == ACCEPTED_VALUES, F.lit(1).cast("bigint"))
        .when(kind == RELATIONSHIPS, F.when(~F.col("parent"), F.col("n_rows")))
        .otherwise(F.col("n_rows"))
    )
    counted = groups.select("check", failures.alias("n")).groupBy("check").agg(
        F.sum("n").alias("n")
    )
    spark = next(iter(tables.values())).sparkSession
    listed = spark.createDataFrame(
        [(i, c.table, c.kind, ", ".join(c.columns), c.detail) for i, c in enumerate(checks)],
        "check int, table_name string, check_kind string, column_name string, detail string",
    )
    result = listed.join(counted, "check", "left").withColumn(
        "failures", F.coalesce("n", F.lit(0).cast("bigint"))
    )
    status = F.when(F.col("failures") == 0, "pass").otherwise("fail")
    return result.select(
        "table_name", "check_kind", "column_name", "detail", "failures", status.alias("status")
    )


PROFILE_COUNTERS = ("event_rows", "outlier_rows", "unknown_rows", "no_order_rows",
                    "good_above_total_rows")


def profiled_groups(classified: DataFrame) -> DataFrame:
    """Day groups of all events: sums of those that are no outliers, and counters of all.

    One grouping gives both, so the events are deduplicated and exchanged once.
    ``counted_rows`` tells groups that hold outliers only, which are no day groups.
    """
    whole = ~F.col("is_duration_outlier")
    rows = with_event_date(classified).withColumns({
        "counted": F.when(whole, F.lit(1)),
        "planned": F.when(whole & (F.col("oee_status_group") != NO_ORDER), F.col("duration_minutes")),
    })
    return rows.groupBy(*DAY_KEY).agg(
        F.count("*").alias("event_rows"),
        F.count("counted").alias("counted_rows"),
        F.coalesce(F.sum("planned"), F.lit(0)).alias("planned_time_min"),
        F.count_if("is_duration_outlier").alias("outlier_rows"),
        F.count_if("is_unknown_category").alias("unknown_rows"),
        F.count_if(F.col("oee_status_group") == NO_ORDER).alias("no_order_rows"),
        F.count_if(F.col("good_biscuits_made") > F.col("total_biscuits_made")).alias(
            "good_above_total_rows"
        ),
    )


def quality_profile(raw_fact: DataFrame, classified: DataFrame) -> DataFrame:
    """One row of counters over the raw rows, the events and their day groups."""
    raw = raw_fact.agg(F.count("*").alias("raw_rows"))
    counted = F.col("counted_rows") > 0
    events = profiled_groups(classified).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in PROFILE_COUNTERS],
        F.count_if(counted).alias("day_groups"),
        F.count_if(counted & (F.col("planned_time_min") <= 0)).alias("dropped_day_groups"),
    )
    found = raw.unionByName(events, True)
    counters = found.agg(*[F.max(c).alias(c) for c in found.columns])
    return counters.select(
        "raw_rows",
        "event_rows",
        (F.col("raw_rows") - F.col("event_rows")).alias("duplicate_rows"),
        "outlier_rows",
        "unknown_rows",
        "no_order_rows",
        "good_above_total_rows",
        "day_groups",
        "dropped_day_groups",
    )
