"""DuckDB statements that give the same rows as the registered queries.

The shared CTEs rebuild the raw tables and the models from the driver's views. They
are written against the meaning of each model, not generated from the Spark code.
"""

from __future__ import annotations

from collections.abc import Iterable

from registry import oracle_checks
from registry.queries import LINES, OVER_LINES

NULL_TEXT = "_dbt_utils_surrogate_key_null_"


def rnd(expression: str, digits: int) -> str:
    return f"CAST(round(CAST({expression} AS DECIMAL(38,9)), {digits}) AS DOUBLE)"


def dbl(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns)


def div(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0))"


def key_text(column: str) -> str:
    return f"coalesce(CAST({column} AS VARCHAR), '{NULL_TEXT}')"


MINUTES = (
    "planned_time_min", "run_time_min", "downtime_min", "changeover_time_min",
    "pm_downtime_min", "minor_stoppage_min", "major_stoppage_min",
)
COUNTERS = ("total_biscuits_made", "good_biscuits_made")
MINUTE_LIST = dbl(*MINUTES)
COUNTER_LIST = ", ".join(COUNTERS)
EVENT_KEY = "machine, start_datetime, end_datetime, product"

CTES: dict[str, str] = {
    "readings": """
        SELECT ts, user_id % 10 AS m, (event_id * 7 + user_id) % 18 AS p, event_id % 2000 AS t,
               CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k, event_type,
               CAST(CAST(value AS DECIMAL(18,2)) * 5 AS DECIMAL(18,6)) AS duration, copy
        FROM events, (VALUES (0), (1)) copies(copy)
        WHERE copy = 0 OR event_id % 97 = 0""",
    "raw_fact": """
        SELECT concat('Machine ', m, ' ') AS machine, ts AS startdatetime,
               ts + to_microseconds(CAST(duration * 60000000 AS BIGINT)) AS enddatetime,
               duration, t + copy AS totalbiscuitsmade, (t * k) // 50 AS goodmadebiscuits,
               names.category AS oee_category, concat(' Product ', p) AS product
        FROM readings
        LEFT JOIN (VALUES ('click', 'Run Time'), ('view', 'CC (Changeover Cleaning)'),
                          ('purchase', 'PM (Maintenance)'), ('signup', 'NO (No Order)'),
                          ('error', '0')) names(kind, category) ON event_type = kind""",
    "raw_machine": """
        SELECT concat('Machine ', s_suppkey, ' ') AS machine_name,
               CASE s_suppkey % 3 WHEN 0 THEN ' Mixing' WHEN 1 THEN ' Baking' ELSE ' Packing' END
                 AS machine_type
        FROM supplier""",
    "raw_product": """
        SELECT concat(' Product ', p_partkey) AS product_name, p_size AS biscuits_per_pack,
               p_size * 12 AS biscuits_per_case, p_size * 480 AS biscuits_per_pallet
        FROM part""",
    "raw_target_speeds": """
        SELECT concat('Machine ', m, ' ') AS machine, concat(' Product ', p_partkey) AS product,
               CAST(200 + 20 * m + 10 * p_partkey AS DECIMAL(18,6)) AS target_biscuits_per_hour
        FROM part, range(10) numbers(m)
        WHERE (m + p_partkey) % 5 <> 0""",
    "trimmed": """
        SELECT trim(machine) AS machine, startdatetime AS start_datetime,
               enddatetime AS end_datetime, duration AS duration_minutes,
               totalbiscuitsmade AS total_biscuits_made, goodmadebiscuits AS good_biscuits_made,
               trim(oee_category) AS oee_category_raw, trim(product) AS product
        FROM raw_fact""",
    "stg_fact_events": """
        SELECT * FROM trimmed
        QUALIFY 1 = row_number() OVER (
            PARTITION BY machine, product, start_datetime, end_datetime
            ORDER BY total_biscuits_made DESC NULLS FIRST, duration_minutes DESC NULLS FIRST,
                     good_biscuits_made DESC NULLS FIRST, oee_category_raw DESC NULLS FIRST)""",
    "stg_target_speeds": """
        SELECT trim(machine) AS machine, trim(product) AS product, target_biscuits_per_hour
        FROM raw_target_speeds""",
    "stg_product": """
        SELECT * REPLACE (trim(product_name) AS product_name) FROM raw_product""",
    "stg_machine": """
        SELECT trim(machine_name) AS machine_name, trim(machine_type) AS machine_type
        FROM raw_machine""",
    "grouped": """
        SELECT *, CASE WHEN oee_category_raw ILIKE 'run time%' THEN 'RUN'
                       WHEN oee_category_raw ILIKE 'cc%' THEN 'CHANGEOVER'
                       WHEN oee_category_raw ILIKE 'pm%' THEN 'PLANNED_DOWNTIME_PM'
                       WHEN oee_category_raw ILIKE 'no%' THEN 'NO_ORDER'
                       ELSE 'UNKNOWN' END AS oee_status_group
        FROM stg_fact_events""",
    "int_events_classified": """
        SELECT *, duration_minutes > 1440 AS is_duration_outlier,
               coalesce(oee_category_raw, '') IN ('', '0') AS is_unknown_category,
               CASE WHEN oee_status_group = 'RUN' OR duration_minutes IS NULL THEN NULL
                    WHEN duration_minutes >= 3 THEN 'MAJOR' ELSE 'MINOR' END AS stoppage_class
        FROM grouped""",
    "counted": """
        SELECT * FROM int_events_classified WHERE duration_minutes <= 1440""",
    "group_sums": """
        SELECT machine, product, CAST(start_datetime AS DATE) AS event_date,
               coalesce(sum(duration_minutes) FILTER (oee_status_group <> 'NO_ORDER'), 0)
                 AS planned_time_min,
               coalesce(sum(duration_minutes) FILTER (oee_status_group = 'CHANGEOVER'), 0)
                 AS changeover_time_min,
               coalesce(sum(duration_minutes) FILTER (oee_status_group = 'PLANNED_DOWNTIME_PM'), 0)
                 AS pm_downtime_min,
               coalesce(sum(duration_minutes) FILTER (stoppage_class = 'MINOR'), 0)
                 AS minor_stoppage_min,
               coalesce(sum(duration_minutes) FILTER (stoppage_class = 'MAJOR'), 0)
                 AS major_stoppage_min,
               CAST(sum(total_biscuits_made) AS BIGINT) AS total_biscuits_made,
               CAST(sum(good_biscuits_made) AS BIGINT) AS good_biscuits_made
        FROM counted GROUP BY ALL""",
    "day_groups": """
        SELECT *, changeover_time_min + pm_downtime_min AS downtime_min,
               planned_time_min - (changeover_time_min + pm_downtime_min) AS run_time_min
        FROM group_sums""",
    "int_daily_machine_product": f"""
        SELECT g.*, s.target_biscuits_per_hour,
               {div('run_time_min', 'planned_time_min')} AS availability,
               least(CAST(total_biscuits_made AS DOUBLE)
                       / nullif(CAST(run_time_min AS DOUBLE) / 60, 0)
                       / nullif(CAST(s.target_biscuits_per_hour AS DOUBLE), 0), 1.0) AS performance,
               least({div('good_biscuits_made', 'total_biscuits_made')}, 1.0) AS quality
        FROM day_groups g LEFT JOIN stg_target_speeds s USING (machine, product)
        WHERE planned_time_min > 0""",
    "dim_machine": f"""
        SELECT md5({key_text('machine_name')}) AS machine_key, * FROM stg_machine""",
    "dim_product": f"""
        SELECT md5({key_text('product_name')}) AS product_key, * FROM stg_product""",
    "days": """
        SELECT CAST(unnest(generate_series(date_trunc('month', min(startdatetime)),
                    CAST(last_day(CAST(max(startdatetime) AS DATE)) AS TIMESTAMP),
                    INTERVAL 1 DAY)) AS DATE) AS date_day
        FROM raw_fact""",
    "dim_date": """
        SELECT date_day AS date_key, CAST(isodow(date_day) AS INTEGER) AS day_of_week_iso,
               dayname(date_day) AS day_name, CAST(day(date_day) AS INTEGER) AS day_of_month,
               isodow(date_day) > 5 AS is_weekend,
               CAST((day(date_day) + 6) // 7 AS INTEGER) AS week_of_month,
               strftime(date_day, '%Y-%m') AS year_month
        FROM days""",
    "fact_machine_events": f"""
        SELECT md5({key_text('e.machine')} || '-' || {key_text('start_datetime')} || '-' ||
                   {key_text('end_datetime')} || '-' || {key_text('e.product')}) AS event_id,
               machine_key, product_key, CAST(start_datetime AS DATE) AS date_key,
               e.machine, e.product, start_datetime, end_datetime, duration_minutes,
               oee_category_raw, oee_status_group, stoppage_class, total_biscuits_made,
               good_biscuits_made, is_duration_outlier, is_unknown_category
        FROM int_events_classified e
        LEFT JOIN dim_machine ON machine = machine_name
        LEFT JOIN dim_product ON product = product_name""",
    "fact_oee_daily": f"""
        SELECT machine, product, event_date AS date_key, machine_key, product_key, is_weekend,
               day_name, {', '.join(MINUTES)}, {COUNTER_LIST}, target_biscuits_per_hour,
               availability, performance, quality,
               coalesce(availability, 0) * coalesce(performance, 0) * coalesce(quality, 0) AS oee
        FROM int_daily_machine_product
        LEFT JOIN dim_machine ON machine = machine_name
        LEFT JOIN dim_product ON product = product_name
        LEFT JOIN dim_date ON event_date = date_key""",
}

SUMMARY_SUMS = f"""
    {', '.join(f'sum({m}) AS {m}' for m in MINUTES)},
    {', '.join(f'CAST(sum({c}) AS BIGINT) AS {c}' for c in COUNTERS)},
    CAST(sum(CAST(coalesce(target_biscuits_per_hour, 0) AS DECIMAL(15,6))
             * CAST(run_time_min AS DECIMAL(22,6))) AS DOUBLE) / 60 AS target_biscuits_total,
    sum(oee * CAST(run_time_min AS DOUBLE)) / nullif(CAST(sum(run_time_min) AS DOUBLE), 0)
      AS oee_weighted_avg"""
SUMMARY_RATIOS = f"""
    {div('run_time_min', 'planned_time_min')} AS availability,
    least({div('total_biscuits_made', 'target_biscuits_total')}, 1.0) AS performance,
    least({div('good_biscuits_made', 'total_biscuits_made')}, 1.0) AS quality"""


def summary(label: str, grouping: str) -> str:
    return f"""
        SELECT year_month, {', '.join(MINUTES)}, {COUNTER_LIST}, availability, performance, quality,
               coalesce(availability, 0) * performance * quality AS oee, oee_weighted_avg
        FROM (SELECT *, {SUMMARY_RATIOS}
              FROM (SELECT {label} AS year_month, {SUMMARY_SUMS} FROM fact_oee_daily {grouping}))"""


def whatif(share: str) -> str:
    return f"""
        SELECT machine, pm AS pm_downtime_min, pm * {share} AS pm_downtime_reduced_min,
               CAST(pm * {share} AS DOUBLE) / 60 AS extra_run_hours,
               made / nullif(run / 60, 0) AS avg_throughput_per_hour,
               (CAST(pm * {share} AS DOUBLE) / 60) * (made / nullif(run / 60, 0))
                 AS extra_products_estimated
        FROM (SELECT machine, CAST(sum(pm_downtime_min) AS DECIMAL(32,6)) AS pm,
                     CAST(sum(run_time_min) AS DOUBLE) AS run,
                     CAST(sum(total_biscuits_made) AS DOUBLE) AS made
              FROM fact_oee_daily GROUP BY machine)"""


MONTH = "strftime(date_key, '%Y-%m')"
LINE_CTES = {
    "readings": """
        SELECT *, l_shipdate + to_minutes((l_orderkey * 31 + l_linenumber * 7) % 1440) AS ts,
               CAST(CAST(l_quantity AS DECIMAL(18,2)) * (l_linenumber * l_linenumber) * 0.6
                    AS DECIMAL(18,6)) AS duration
        FROM lineitem, (VALUES (0), (1)) copies(copy)
        WHERE copy = 0 OR l_discount = 0.1""",
    "raw_fact": """
        SELECT concat('Machine ', l_suppkey, ' ') AS machine, ts AS startdatetime,
               ts + to_microseconds(CAST(duration * 60000000 AS BIGINT)) AS enddatetime, duration,
               CAST(floor(l_extendedprice) AS BIGINT) + copy AS totalbiscuitsmade,
               CAST(floor(l_extendedprice * (1 - l_discount + l_tax)) AS BIGINT)
                 AS goodmadebiscuits,
               CASE l_linenumber WHEN 1 THEN 'run time' WHEN 2 THEN 'Run Time ' WHEN 3 THEN 'cc'
                    WHEN 4 THEN 'PM check' WHEN 5 THEN 'No Order' WHEN 6 THEN 'RUN TIME x' END
                 AS oee_category,
               concat(' Product ', l_partkey) AS product
        FROM readings""",
    "raw_target_speeds": """
        SELECT concat('Machine ', l_suppkey, ' ') AS machine,
               concat(' Product ', l_partkey) AS product,
               CAST(max(l_quantity) * 400 AS DECIMAL(18,6)) AS target_biscuits_per_hour
        FROM lineitem GROUP BY l_suppkey, l_partkey HAVING max(l_tax) >= 0.03""",
}

CTES["mart_oee_monthly_summary"] = summary(MONTH, "GROUP BY ALL")
CTES["mart_whatif_pm_reduction"] = whatif("0.15")

CLASSIFIED = (
    f"{EVENT_KEY}, {dbl('duration_minutes')}, {COUNTER_LIST}, oee_category_raw, oee_status_group,"
    " is_duration_outlier, is_unknown_category, stoppage_class"
)
DAILY_MEASURES = (
    f"{MINUTE_LIST}, {COUNTER_LIST}, {dbl('target_biscuits_per_hour')},"
    " availability, performance, quality"
)
FACT = (
    "machine, product, date_key, machine_key, product_key, is_weekend, day_name,"
    f" {DAILY_MEASURES}, oee"
)
STAGED = (
    f"{EVENT_KEY}, {dbl('duration_minutes')}, {COUNTER_LIST}, oee_category_raw"
)
RAW_FACT = (
    "machine, startdatetime, enddatetime, CAST(duration AS DOUBLE) AS duration,"
    " totalbiscuitsmade, goodmadebiscuits, oee_category, product"
)
WHATIF = (
    f"machine, {dbl('pm_downtime_min', 'pm_downtime_reduced_min')}, extra_run_hours,"
    " avg_throughput_per_hour, extra_products_estimated"
)
SUMMARY = (
    f"year_month, {MINUTE_LIST}, {COUNTER_LIST}, availability, performance, quality, oee,"
    f" {rnd('oee_weighted_avg', 6)} AS oee_weighted_avg"
)


def pct(column: str, digits: int) -> str:
    return rnd(f"avg({column}) * 100", digits)


def hours(column: str, digits: int = 1) -> str:
    return rnd(f"CAST(sum({column}) AS DOUBLE) / 60", digits)


APQ = ", ".join(
    f"{pct(c, 1)} AS {c}_pct" for c in ("availability", "performance", "quality")
)
SPEED = rnd(
    "CAST(sum(total_biscuits_made) AS DOUBLE) / nullif(CAST(sum(run_time_min) AS DOUBLE) / 60, 0)", 0
)
TARGET_SPEED = rnd(
    "(CAST(sum(CAST(coalesce(target_biscuits_per_hour, 0) AS DECIMAL(15,6))"
    " * CAST(run_time_min AS DECIMAL(22,6))) AS DOUBLE) / 60)"
    " / nullif(CAST(sum(run_time_min) AS DOUBLE) / 60, 0)",
    0,
)


def reasons(condition: str = "TRUE") -> str:
    return f"""
        SELECT machine, string_agg(oee_category_raw || ': ' ||
                   CAST(round(CAST(CAST(minutes AS DOUBLE) / 60 AS DECIMAL(38,9)), 1) AS VARCHAR)
                   || 'h', ' · ' ORDER BY place) AS main_stop_reasons
        FROM (SELECT machine, oee_category_raw, sum(duration_minutes) AS minutes,
                     row_number() OVER (PARTITION BY machine
                         ORDER BY sum(duration_minutes) DESC NULLS FIRST, oee_category_raw) AS place
              FROM fact_machine_events
              WHERE oee_status_group <> 'RUN' AND {condition}
              GROUP BY machine, oee_category_raw)
        WHERE place <= 3 GROUP BY machine"""


D = "date_key BETWEEN DATE '2024-01-08' AND DATE '2024-01-21'"
M = "machine = 'Machine 3'"
P = "product = 'Product 5'"
DMP = f"{D} AND {M} AND {P}"
LABEL = "CASE WHEN is_weekend THEN 'Cuối tuần' ELSE 'Ngày thường' END"

# report -> (statement with {where}, predicate of its filtered variant)
REPORTS: dict[str, tuple[str, str]] = {
    "kpi_oee": (f"SELECT {pct('oee', 2)} AS oee_pct FROM fact_oee_daily WHERE {{where}}", DMP),
    "kpi_availability": (
        f"SELECT {pct('availability', 2)} AS availability_pct FROM fact_oee_daily WHERE {{where}}", DMP),
    "kpi_performance": (
        f"SELECT {pct('performance', 2)} AS performance_pct FROM fact_oee_daily WHERE {{where}}", DMP),
    "kpi_quality": (
        f"SELECT {pct('quality', 2)} AS quality_pct FROM fact_oee_daily WHERE {{where}}", DMP),
    "kpi_worldclass": (
        f"SELECT {rnd('avg(oee) * 100 - 85', 2)} AS gap_points FROM fact_oee_daily WHERE {{where}}",
        DMP),
    "oee_trend": (
        f"SELECT date_key, {pct('oee', 2)} AS oee_pct FROM fact_oee_daily WHERE {{where}}"
        " GROUP BY date_key ORDER BY date_key", DMP),
    "oee_dow": (
        f"SELECT day_name, {LABEL} AS day_group, {pct('oee', 2)} AS oee_pct FROM fact_oee_daily"
        " WHERE {where} GROUP BY ALL ORDER BY min(date_key)", DMP),
    "oee_machine": (
        f"SELECT machine, oee_pct, main_stop_reasons FROM (SELECT machine, {pct('oee', 2)} AS oee_pct"
        " FROM fact_oee_daily WHERE {where} GROUP BY machine)"
        f" LEFT JOIN ({reasons()}) USING (machine) ORDER BY oee_pct, machine", DMP),
    "apq_machine": (
        f"SELECT machine, {APQ} FROM fact_oee_daily WHERE {{where}} GROUP BY machine"
        " ORDER BY quality_pct DESC, machine", DMP),
    "worst_machine": (
        "SELECT machine FROM fact_oee_daily WHERE {where} GROUP BY machine"
        " ORDER BY avg(oee), machine LIMIT 1", DMP),
    "stability": (
        f"SELECT machine, {pct('oee', 2)} AS oee_pct,"
        f" {rnd('stddev_samp(oee) * 100', 2)} AS oee_stddev_pct, {APQ}"
        " FROM fact_oee_daily WHERE {where} GROUP BY machine ORDER BY oee_pct DESC, machine", DMP),
    "total_downtime": (
        f"SELECT {hours('downtime_min')} AS downtime_hours FROM fact_oee_daily WHERE {{where}}", DMP),
    "downtime_cat": (
        f"SELECT oee_category_raw, {hours('duration_minutes')} AS hours FROM fact_machine_events"
        " WHERE oee_status_group <> 'RUN' AND {where} GROUP BY oee_category_raw"
        " ORDER BY hours DESC", DMP),
    "minor_major": (
        f"SELECT stoppage_class, {hours('duration_minutes')} AS hours FROM fact_machine_events"
        " WHERE stoppage_class IS NOT NULL AND {where} GROUP BY stoppage_class"
        " ORDER BY hours DESC", DMP),
    "cc_pct": (
        f"SELECT {rnd(div('sum(changeover_time_min)', 'sum(downtime_min)') + ' * 100', 1)}"
        " AS changeover_pct FROM fact_oee_daily WHERE {where}", f"{D} AND {M}"),
    "cc_machine": (
        f"SELECT machine, {hours('changeover_time_min')} AS changeover_hours FROM fact_oee_daily"
        " WHERE {where} GROUP BY machine ORDER BY changeover_hours DESC, machine", f"{D} AND {M}"),
    "waste_product": (
        f"SELECT product, {rnd('(1 - avg(quality)) * 100', 2)} AS waste_pct FROM fact_oee_daily"
        " WHERE {where} GROUP BY product ORDER BY waste_pct DESC, product", DMP),
    "perf_gap": (
        f"SELECT machine, product, {rnd('max(target_biscuits_per_hour)', 0)} AS target_per_hour,"
        f" {SPEED} AS actual_per_hour, {pct('performance', 1)} AS performance_pct"
        " FROM fact_oee_daily WHERE {where} GROUP BY machine, product"
        " ORDER BY performance_pct, machine, product LIMIT 20", DMP),
    "speed_machine": (
        f"SELECT machine, {SPEED} AS actual_per_hour, {TARGET_SPEED} AS target_per_hour"
        " FROM fact_oee_daily WHERE {where} GROUP BY machine ORDER BY actual_per_hour, machine", DMP),
    "whatif_table": (
        f"SELECT machine, {rnd('CAST(pm_downtime_min AS DOUBLE) / 60', 1)} AS pm_hours,"
        f" {rnd('CAST(pm_downtime_reduced_min AS DOUBLE) / 60', 2)} AS saved_hours,"
        f" {rnd('extra_run_hours', 2)} AS extra_run_hours,"
        f" {rnd('extra_products_estimated', 0)} AS extra_products"
        " FROM mart_whatif_pm_reduction WHERE {where} ORDER BY extra_run_hours DESC, machine", M),
    "whatif_hours": (
        f"SELECT machine, {rnd('extra_run_hours', 2)} AS extra_run_hours"
        " FROM mart_whatif_pm_reduction WHERE {where} ORDER BY extra_run_hours DESC, machine", M),
    "whatif_products": (
        f"SELECT machine, {rnd('extra_products_estimated', 0)} AS extra_products"
        " FROM mart_whatif_pm_reduction WHERE {where} ORDER BY extra_products DESC, machine", M),
}

COUNT_RAW = "SELECT '{0}' AS table_name, count(*) AS n_rows FROM {0}"
RAW_TABLES = ("raw_fact", "raw_target_speeds", "raw_product", "raw_machine")


def event_column(column: str) -> str:
    return (
        f"SELECT {EVENT_KEY}, oee_category_raw, {dbl('duration_minutes')}, {column}"
        " FROM int_events_classified"
    )


def daily_columns(*columns: str) -> str:
    return f"SELECT machine, product, event_date, {', '.join(columns)} FROM int_daily_machine_product"


def fact_columns(*columns: str) -> str:
    return f"SELECT machine, product, date_key, {', '.join(columns)} FROM fact_oee_daily"


def freshness(name: str, warn: int, error: int) -> str:
    age = "date_diff('second', max(startdatetime), TIMESTAMP '2024-02-01')"
    return (
        f"SELECT max(startdatetime) AS max_loaded_at, CAST({age} // 86400 AS BIGINT) AS age_days,"
        f" CASE WHEN {age} > {error} * 86400 THEN 'error' WHEN {age} > {warn} * 86400 THEN 'warn'"
        f" ELSE 'pass' END AS status, '{name}' AS limits FROM raw_fact"
    )


STATEMENTS: dict[str, str] = {
    "a1_read_raw": f"SELECT {RAW_FACT} FROM raw_fact",
    "a2_normalize_columns": "SELECT machine, product AS product_name,"
    " CAST(target_biscuits_per_hour AS DOUBLE) AS target__per_hour_ FROM raw_target_speeds",
    "a3_coerce_ts": f"SELECT {RAW_FACT} FROM raw_fact",
    "a4_drop_by_prefix": "SELECT *, 'Bsicuits Per Pallet' AS dropped FROM raw_product",
    "a5_full_reload": f"SELECT {RAW_FACT} FROM raw_fact",
    "a6_reconcile": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows, CAST({n} AS BIGINT) AS expected,"
        f" CASE count(*) WHEN {n} THEN 'OK' ELSE 'DIFFERS' END AS status FROM {t}"
        for t, n in zip(RAW_TABLES, (8044, 72, 18, 10))
    ),
    "a6_load_report": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows, {wanted} AS expected,"
        f" CASE count(*) WHEN {wanted} THEN 'OK' ELSE 'DIFFERS' END AS status,"
        f" CAST({newest} AS TIMESTAMP) AS newest, '{dropped}' AS dropped FROM {t}"
        for t, wanted, newest, dropped in (
            ("raw_fact", "CAST(8044 AS BIGINT)", "max(startdatetime)", ""),
            ("raw_target_speeds", "CAST(72 AS BIGINT)", "NULL", ""),
            ("raw_product", "(SELECT count(*) FROM part)", "NULL", "Bsicuits Per Pallet"),
            ("raw_machine", "(SELECT count(*) FROM supplier)", "NULL", ""),
        )
    ),
    "a7_logged_counts": " UNION ALL ".join(COUNT_RAW.format(t) for t in RAW_TABLES),
    "a8_logged_freshness": "SELECT * EXCLUDE (limits) FROM"
    f" ({freshness('tight', 0, 30)})",
    "a7_verify_counts": " UNION ALL ".join(COUNT_RAW.format(t) for t in RAW_TABLES),
    "a8_freshness": " UNION ALL ".join([
        freshness("default", 3650, 7300), freshness("tight", 0, 30), freshness("strict", 0, 0)
    ]),
    "a9_register_view": "SELECT machine, count(*) AS n_targets,"
    " CAST(max(target_biscuits_per_hour) AS DOUBLE) AS best FROM stg_target_speeds GROUP BY machine",
    "a9_view_stg_fact_events": f"SELECT {STAGED} FROM stg_fact_events",
    "a9_view_stg_target_speeds": "SELECT machine, product,"
    f" {dbl('target_biscuits_per_hour')} FROM stg_target_speeds",
    "a9_view_stg_product": "SELECT * FROM stg_product",
    "a9_view_stg_machine": "SELECT * FROM stg_machine",
    "a9_view_int_events_classified": f"SELECT {CLASSIFIED} FROM int_events_classified",
    "a9_view_int_daily_machine_product": f"SELECT machine, product, event_date, {DAILY_MEASURES}"
    " FROM int_daily_machine_product",
    "a10_switched_months": f"SELECT {FACT}, {MONTH} AS year_month FROM fact_oee_daily",
    "a10_write_mart": f"SELECT {FACT}, {MONTH} AS year_month FROM fact_oee_daily",
    "a11_layer_names": " UNION ALL ".join(
        f"SELECT '{layer}.{t}' AS table_name, count(*) AS n_rows FROM {t}"
        for layer, names in {
            "raw": RAW_TABLES,
            "staging": ("stg_fact_events", "stg_target_speeds", "stg_product", "stg_machine"),
            "intermediate": ("int_events_classified", "int_daily_machine_product"),
            "marts": (
                "dim_machine", "dim_product", "dim_date", "fact_machine_events", "fact_oee_daily",
                "mart_oee_monthly_summary", "mart_whatif_pm_reduction",
            ),
        }.items()
        for t in names
    ),
    "b1_stg_events": f"SELECT {STAGED} FROM trimmed",
    "b1_half_counters": f"""
        SELECT machine, start_datetime, end_datetime, product, {dbl('duration_minutes')},
               CAST(round(CAST(total_biscuits_made - 200 AS DECIMAL(18,1)) / 2) AS BIGINT)
                 AS total_biscuits_made,
               CAST(round(CAST(good_biscuits_made - 200 AS DECIMAL(18,1)) / 2) AS BIGINT)
                 AS good_biscuits_made,
               oee_category_raw FROM trimmed""",
    "b2_stg_target_speeds": "SELECT machine, product,"
    f" {dbl('target_biscuits_per_hour')} FROM stg_target_speeds",
    "b3_stg_product": "SELECT * FROM stg_product",
    "b4_stg_machine": "SELECT * FROM stg_machine",
    "b5_classify_status": event_column("oee_status_group"),
    "b6_flag_outlier": event_column("is_duration_outlier"),
    "b7_flag_unknown": event_column("is_unknown_category"),
    "b8_classify_stoppage": event_column("stoppage_class"),
    "b9_exclude_outliers": f"SELECT {CLASSIFIED} FROM counted",
    "b10_event_date": f"SELECT {EVENT_KEY}, CAST(start_datetime AS DATE) AS event_date"
    " FROM stg_fact_events",
    "b11_run_time": daily_columns(dbl("planned_time_min", "downtime_min", "run_time_min")),
    "b12_availability": daily_columns(dbl("run_time_min", "planned_time_min"), "availability"),
    "b13_performance": daily_columns(
        "total_biscuits_made", dbl("target_biscuits_per_hour"), "performance"),
    "b14_quality": daily_columns("good_biscuits_made", "total_biscuits_made", "quality"),
    "b15_oee": fact_columns("availability", "performance", "quality", "oee"),
    "b16_surrogate_key": f"""
        SELECT start_datetime, machine, category,
               md5({key_text('category')} || '-' || {key_text('machine')} || '-'
                   || {key_text('start_datetime')}) AS key
        FROM (SELECT *, CASE oee_category_raw WHEN 'Run Time' THEN NULL WHEN '0' THEN ''
                        ELSE oee_category_raw END AS category FROM stg_fact_events)""",
    "b17_whatif_reduction": f"SELECT {WHATIF} FROM ({whatif('0.30')})",
    "b17_whatif_reduction_1": f"SELECT {WHATIF} FROM ({whatif('1')})",
    "b17_whatif_reduction_0_12345": f"SELECT {WHATIF} FROM ({whatif('0.12345')})",
    "b18_apply_filters": fact_columns("oee")
    + f" WHERE {D} AND machine IN ('Machine 3', 'Machine 4')"
    " AND product IN ('Product 5', 'Product 6')",
    "b19_non_run": "SELECT oee_status_group, count(*) AS n_events,"
    " CAST(sum(duration_minutes) AS DOUBLE) AS minutes FROM fact_machine_events"
    " WHERE oee_status_group <> 'RUN' GROUP BY ALL",
    "b19_stops_only": "SELECT stoppage_class, count(*) AS n_events,"
    " CAST(sum(duration_minutes) AS DOUBLE) AS minutes FROM fact_machine_events"
    " WHERE stoppage_class IS NOT NULL GROUP BY ALL",
    "b20_drill_day": REPORTS["stability"][0].replace("{where}", "date_key = DATE '2024-01-10'"),
    "c1_join_targets": daily_columns(dbl("target_biscuits_per_hour")),
    "c2_events_machine": "SELECT event_id, machine, machine_key FROM fact_machine_events",
    "c3_events_product": "SELECT event_id, product, product_key FROM fact_machine_events",
    "c4_daily_machine": fact_columns("machine_key"),
    "c5_daily_product": fact_columns("product_key"),
    "c6_daily_date": fact_columns("is_weekend", "day_name"),
    "c7_top_reasons": reasons(),
    "c7_top_reasons_no_outliers": reasons("NOT is_duration_outlier"),
    "c8_orphans": "SELECT machine_key, count(*) AS n_rows FROM fact_machine_events"
    " WHERE machine_key NOT IN (SELECT machine_key FROM dim_machine WHERE machine_type = 'Baking')"
    " GROUP BY machine_key",
    "d1_day_sums": f"SELECT machine, product, event_date, {MINUTE_LIST}, {COUNTER_LIST} FROM day_groups",
    "d2_planned_only": daily_columns(dbl("planned_time_min")),
    "d3_summary_sums": f"SELECT year_month, {MINUTE_LIST}, {COUNTER_LIST} FROM"
    f" (SELECT {MONTH} AS year_month, {SUMMARY_SUMS} FROM fact_oee_daily GROUP BY ALL)",
    "d4_target_total": f"SELECT year_month, {rnd('target_biscuits_total', 6)} AS target_biscuits_total"
    f" FROM (SELECT {MONTH} AS year_month, {SUMMARY_SUMS} FROM fact_oee_daily GROUP BY ALL)",
    "d5_run_weighted_oee": f"SELECT year_month, {rnd('oee_weighted_avg', 6)} AS oee_weighted_avg"
    " FROM mart_oee_monthly_summary",
    "d6_summary_ratios": "SELECT year_month, availability, performance, quality, oee"
    " FROM mart_oee_monthly_summary",
    "d7_machine_sums": "SELECT machine, CAST(sum(pm_downtime_min) AS DOUBLE) AS pm_downtime_min,"
    " CAST(sum(run_time_min) AS DOUBLE) AS run_time_min,"
    " CAST(sum(total_biscuits_made) AS BIGINT) AS total_biscuits_made"
    " FROM fact_oee_daily GROUP BY machine",
    "d8_mean_pct": "SELECT product, "
    + ", ".join(f"{pct(c, 2)} AS {c}_pct" for c in ("availability", "performance", "quality", "oee"))
    + " FROM fact_oee_daily GROUP BY product",
    "d9_max_target": "SELECT machine, CAST(max(target_biscuits_per_hour) AS DOUBLE) AS target"
    " FROM fact_oee_daily GROUP BY machine",
    "d10_first_date": "SELECT day_name, min(date_key) AS first_date FROM fact_oee_daily GROUP BY day_name",
    "d11_stddev": f"SELECT machine, product, {rnd('stddev_samp(oee)', 6)} AS oee_stddev"
    " FROM fact_oee_daily GROUP BY machine, product",
    "d12_ratio_of_sums": "SELECT product,"
    f" {div('sum(changeover_time_min)', 'sum(downtime_min)')} AS changeover_share,"
    " CAST(sum(total_biscuits_made) AS DOUBLE)"
    " / nullif(CAST(sum(run_time_min) AS DOUBLE) / 60, 0) AS speed"
    " FROM fact_oee_daily GROUP BY product",
    "d13_ordered_text": "SELECT machine, string_agg(oee_status_group, ' · ' ORDER BY oee_status_group)"
    " AS groups FROM (SELECT DISTINCT machine, oee_status_group FROM fact_machine_events)"
    " GROUP BY machine",
    "d14_count": "SELECT count(*) AS n_rows FROM fact_machine_events",
    "d15_repeated_keys": f"SELECT {EVENT_KEY}, count(*) AS n_rows FROM trimmed"
    " WHERE machine IS NOT NULL AND product IS NOT NULL AND start_datetime IS NOT NULL"
    " AND end_datetime IS NOT NULL GROUP BY ALL HAVING count(*) > 1",
    "d16_hours": f"SELECT machine, oee_category_raw, {hours('duration_minutes')} AS hours"
    " FROM fact_machine_events GROUP BY ALL",
    "e1_dedup_events": f"SELECT {STAGED} FROM stg_fact_events",
    "e1_merged_extract": f"SELECT {STAGED} FROM stg_fact_events",
    "g7_merged_extract": f"SELECT {FACT} FROM fact_oee_daily",
    "e1_dedup_other_key": f"""
        SELECT {STAGED} FROM trimmed
        QUALIFY 1 = row_number() OVER (PARTITION BY machine, product
            ORDER BY total_biscuits_made DESC NULLS FIRST, start_datetime DESC NULLS FIRST,
                     end_datetime DESC NULLS FIRST, duration_minutes DESC NULLS FIRST,
                     good_biscuits_made DESC NULLS FIRST, oee_category_raw DESC NULLS FIRST)""",
    "f3_ranked": f"SELECT machine, product, {pct('quality', 1)} AS quality_pct FROM fact_oee_daily"
    " GROUP BY machine, product ORDER BY quality_pct DESC, machine, product",
    "f4_bottom_1": f"SELECT product, {pct('oee', 2)} AS oee_pct FROM fact_oee_daily"
    " GROUP BY product ORDER BY oee_pct, product LIMIT 1",
    "f5_bottom_20": fact_columns("oee", dbl("run_time_min"))
    + " ORDER BY fact_oee_daily.run_time_min DESC, machine, product, date_key LIMIT 20",
    "f6_top3_per_group": """
        SELECT machine, oee_category_raw, CAST(minutes AS DOUBLE) AS minutes, CAST(rank AS INTEGER) AS rank
        FROM (SELECT machine, oee_category_raw, sum(duration_minutes) AS minutes,
                     row_number() OVER (PARTITION BY machine
                         ORDER BY sum(duration_minutes) DESC NULLS FIRST, oee_category_raw) AS rank
              FROM fact_machine_events WHERE oee_status_group <> 'RUN'
              GROUP BY machine, oee_category_raw)
        WHERE rank <= 3""",
    "g1_dim_machine": "SELECT * FROM dim_machine",
    "g2_dim_product": "SELECT * FROM dim_product",
    "g3_dim_date": "SELECT * FROM dim_date",
    "g4_events_classified": f"SELECT {CLASSIFIED} FROM int_events_classified",
    "g5_daily_machine_product": f"SELECT machine, product, event_date, {DAILY_MEASURES}"
    " FROM int_daily_machine_product",
    "g6_fact_machine_events": f"SELECT * REPLACE (CAST(duration_minutes AS DOUBLE) AS duration_minutes)"
    " FROM fact_machine_events",
    "g6_refreshed": f"SELECT * REPLACE (CAST(duration_minutes AS DOUBLE) AS duration_minutes)"
    " FROM fact_machine_events",
    "g10_month_rollup": f"SELECT machine, count(*) AS n_rows, {rnd('avg(oee)', 6)} AS oee_mean,"
    f" {rnd('stddev_samp(oee)', 6)} AS oee_stddev, min(oee) AS oee_min, max(oee) AS oee_max,"
    " CAST(sum(planned_time_min) AS DOUBLE) AS planned_time_min FROM fact_oee_daily GROUP BY machine",
    "g11_stop_rollup": "SELECT machine, oee_category_raw, count(*) AS n_events,"
    " CAST(sum(duration_minutes) AS DOUBLE) AS minutes FROM fact_machine_events GROUP BY ALL",
    "g7_fact_oee_daily": f"SELECT {FACT} FROM fact_oee_daily",
    "g7_stored_build": f"SELECT {FACT} FROM fact_oee_daily",
    "g7_day_range": f"SELECT {FACT} FROM fact_oee_daily WHERE {D}",
    "g8_monthly_summary": f"SELECT {SUMMARY} FROM mart_oee_monthly_summary",
    "g8_whole_plant": f"SELECT {SUMMARY} FROM ({summary(chr(39) + 'all' + chr(39), '')})",
    "g9_whatif_pm": f"SELECT {WHATIF} FROM mart_whatif_pm_reduction",
    "h_scalar_functions": f"""
        SELECT {EVENT_KEY}, oee_category_raw AS h1_trim, CAST(duration_minutes AS DOUBLE) AS h2_cast,
               if(oee_category_raw = '0', 'junk', 'named') AS h3_case,
               oee_category_raw = 'Run Time' AS h4_ilike,
               oee_category_raw = '0' AS h5_in,
               if(oee_category_raw = '0', 'none', oee_category_raw) AS h6_h7_coalesce_nullif,
               least({div('good_biscuits_made', 'total_biscuits_made')}, 1.0) AS h8_least,
               {rnd('CAST(duration_minutes AS DOUBLE) / 60', 1)} AS h9_round,
               machine || ': ' || product AS h10_concat,
               CAST(start_datetime AS DATE) AS h11_day,
               CAST(isodow(start_datetime) AS INTEGER) AS h12_iso_weekday,
               CAST(day(start_datetime) AS INTEGER) AS h13_day_of_month,
               dayname(start_datetime) AS h14_day_name,
               strftime(start_datetime, '%Y-%m') AS h15_year_month,
               CAST((day(start_datetime) + 6) // 7 AS INTEGER) AS h16_week_of_month,
               isodow(start_datetime) > 5 AS h17_weekend,
               md5(machine) AS h18_key,
               total_biscuits_made - good_biscuits_made AS h20_waste,
               if(isodow(start_datetime) > 5, 'Cuối tuần', 'Ngày thường') AS h21_label
        FROM stg_fact_events""",
    "h19_date_spine": "SELECT date_day FROM days",
    "k8_quality_profile": """
        SELECT raw_rows, event_rows, raw_rows - event_rows AS duplicate_rows, outlier_rows,
               unknown_rows, no_order_rows, good_above_total_rows, day_groups, dropped_day_groups
        FROM (SELECT count(*) AS raw_rows FROM raw_fact),
             (SELECT count(*) AS event_rows,
                     count(*) FILTER (duration_minutes > 1440) AS outlier_rows,
                     count(*) FILTER (coalesce(oee_category_raw, '') IN ('', '0')) AS unknown_rows,
                     count(*) FILTER (lower(oee_category_raw) LIKE 'no%') AS no_order_rows,
                     count(*) FILTER (good_biscuits_made > total_biscuits_made)
                       AS good_above_total_rows FROM stg_fact_events),
             (SELECT count(*) AS day_groups,
                     count(*) FILTER (planned_time_min <= 0) AS dropped_day_groups FROM day_groups)""",
}


def _with(models: dict[str, str], text: str) -> str:
    prefix = ",\n".join(f"{name} AS ({body})" for name, body in models.items())
    return f"WITH {prefix}\n{text}"


def bodies() -> dict[str, str]:
    """The statements without their common table expressions."""
    body = dict(STATEMENTS)
    for number, (key, (text, predicate)) in enumerate(REPORTS.items(), start=1):
        body[f"q{number}_{key}"] = text.replace("{where}", "TRUE")
        body[f"q{number}_{key}_filtered"] = text.replace("{where}", predicate)
    return body | oracle_checks.statements()


def over(raw: dict[str, str], keys: Iterable[str] | None = None) -> dict[str, str]:
    """Statements with some of the raw tables defined otherwise."""
    models = CTES | oracle_checks.CORRUPTED | raw
    found = bodies()
    return {key: _with(models, found[key]) for key in (found if keys is None else keys)}


def statements() -> dict[str, str]:
    over_lines = over(LINE_CTES, OVER_LINES)
    return over({}) | {key + LINES: text for key, text in over_lines.items()}
