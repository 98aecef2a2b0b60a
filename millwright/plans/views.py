"""Staging and intermediate models as persistent catalog views, one database per layer.

A view is SQL text in the catalog, so any session and any SQL client of the same catalog reads
``staging.stg_fact_events`` over the raw tables as they were last loaded; nothing is stored.
The text says the same as the DataFrame models in ``staging`` and ``intermediate``; tests
compare the rows of both.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import SparkSession

from millwright.config import (
    CHANGEOVER, DEFAULTS, MAINTENANCE, MAJOR, MINOR, NO_ORDER, RUN, UNKNOWN, Settings,
)
from millwright.schemas import COUNTERS, MINUTE_MEASURES
from millwright.sources.tables import (
    INTERMEDIATE, MARTS, RAW, STAGING, ensure_layer, layer_of,
)

LAYERS = {layer: layer for layer in (RAW, STAGING, INTERMEDIATE, MARTS)}
Name = Callable[[str], str]


def text(value: str) -> str:
    """A string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def stg_fact_events(name: Name, settings: Settings) -> str:
    order = ("total_biscuits_made", "duration_minutes", "good_biscuits_made", "oee_category_raw")
    ranking = ", ".join(f"{c} DESC NULLS FIRST" for c in order)
    columns = ("machine", "start_datetime", "end_datetime", "duration_minutes", *COUNTERS,
               "oee_category_raw", "product")
    return f"""
        SELECT {', '.join(columns)}
        FROM (SELECT *, row_number() OVER (PARTITION BY start_datetime, end_datetime, machine,
                        product ORDER BY {ranking}) AS place
              FROM (SELECT trim(machine) AS machine, startdatetime AS start_datetime,
                           enddatetime AS end_datetime, duration AS duration_minutes,
                           totalbiscuitsmade AS total_biscuits_made,
                           goodmadebiscuits AS good_biscuits_made,
                           trim(oee_category) AS oee_category_raw, trim(product) AS product
                    FROM {name('raw_fact')}))
        WHERE place = 1"""


def stg_target_speeds(name: Name, settings: Settings) -> str:
    return f"""
        SELECT trim(machine) AS machine, trim(product) AS product, target_biscuits_per_hour
        FROM {name('raw_target_speeds')}"""


def stg_product(name: Name, settings: Settings) -> str:
    return f"""
        SELECT trim(product_name) AS product_name, biscuits_per_pack, biscuits_per_case,
               biscuits_per_pallet
        FROM {name('raw_product')}"""


def stg_machine(name: Name, settings: Settings) -> str:
    return f"""
        SELECT trim(machine_name) AS machine_name, trim(machine_type) AS machine_type
        FROM {name('raw_machine')}"""


def int_events_classified(name: Name, settings: Settings) -> str:
    groups = " ".join(
        f"WHEN oee_category_raw ILIKE {text(prefix + '%')} THEN {text(group)}"
        for prefix, group in settings.status_prefixes
    )
    junk = ", ".join(text(c) for c in settings.junk_categories)
    return f"""
        SELECT *, CASE WHEN oee_status_group <> '{RUN}' THEN
                  CASE WHEN duration_minutes < {settings.major_minutes} THEN '{MINOR}'
                       WHEN duration_minutes >= {settings.major_minutes} THEN '{MAJOR}' END
                  END AS stoppage_class
        FROM (SELECT *, CASE {groups} ELSE '{UNKNOWN}' END AS oee_status_group,
                     duration_minutes > {settings.outlier_minutes} AS is_duration_outlier,
                     oee_category_raw IS NULL OR oee_category_raw IN ({junk})
                       AS is_unknown_category
              FROM {name('stg_fact_events')})"""


def int_daily_machine_product(name: Name, settings: Settings) -> str:
    def minutes(condition: str) -> str:
        return f"sum(CASE WHEN {condition} THEN duration_minutes ELSE 0 END)"

    def ratio(a: str, b: str) -> str:
        return f"CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0D)"

    speed = f"CAST(total_biscuits_made AS DOUBLE) / nullif({ratio('run_time_min', '60')}, 0D)"
    columns = (*MINUTE_MEASURES, *COUNTERS)
    return f"""
        SELECT d.machine, d.product, event_date, {', '.join(columns)},
               t.target_biscuits_per_hour,
               {ratio('run_time_min', 'planned_time_min')} AS availability,
               least(({speed}) / nullif(CAST(t.target_biscuits_per_hour AS DOUBLE), 0D), 1D)
                 AS performance,
               least({ratio('good_biscuits_made', 'total_biscuits_made')}, 1D) AS quality
        FROM (SELECT *, planned_time_min - downtime_min AS run_time_min
              FROM (SELECT *, changeover_time_min + pm_downtime_min AS downtime_min
                    FROM (SELECT machine, product, CAST(start_datetime AS DATE) AS event_date,
                                 {minutes(f"oee_status_group <> '{NO_ORDER}'")} AS planned_time_min,
                                 {minutes(f"oee_status_group = '{CHANGEOVER}'")}
                                   AS changeover_time_min,
                                 {minutes(f"oee_status_group = '{MAINTENANCE}'")}
                                   AS pm_downtime_min,
                                 {minutes(f"stoppage_class = '{MINOR}'")} AS minor_stoppage_min,
                                 {minutes(f"stoppage_class = '{MAJOR}'")} AS major_stoppage_min,
                                 sum(total_biscuits_made) AS total_biscuits_made,
                                 sum(good_biscuits_made) AS good_biscuits_made
                          FROM {name('int_events_classified')}
                          WHERE NOT is_duration_outlier
                          GROUP BY ALL))
              WHERE planned_time_min > 0) d
        LEFT JOIN {name('stg_target_speeds')} t ON d.machine = t.machine AND d.product = t.product"""


# each after those it reads
VIEWS: dict[str, Callable[[Name, Settings], str]] = {
    "stg_fact_events": stg_fact_events,
    "stg_target_speeds": stg_target_speeds,
    "stg_product": stg_product,
    "stg_machine": stg_machine,
    "int_events_classified": int_events_classified,
    "int_daily_machine_product": int_daily_machine_product,
}


def named(layers: Mapping[str, str] = LAYERS) -> Name:
    """Qualified name of a model, its layer being a database of ``layers``."""
    return lambda model: f"{layers[layer_of(model)]}.{model}"


def create_views(
    spark: SparkSession, settings: Settings = DEFAULTS, layers: Mapping[str, str] = LAYERS
) -> list[str]:
    """Create or replace the views over the stored raw tables; their names in order."""
    name = named(layers)
    for layer in (STAGING, INTERMEDIATE):
        ensure_layer(spark, layers[layer])
    for model, body in VIEWS.items():
        spark.sql(f"CREATE OR REPLACE VIEW {name(model)} AS {body(name, settings)}")
    return [name(model) for model in VIEWS]
