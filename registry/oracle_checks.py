"""DuckDB statements for the data-quality checks."""

from __future__ import annotations

CORRUPTED = {
    "bad_events": """
        SELECT * REPLACE (CASE WHEN duration_minutes > 500 THEN NULL ELSE product END AS product,
                          if(oee_category_raw = '0', -duration_minutes, duration_minutes)
                            AS duration_minutes)
        FROM stg_fact_events""",
    "bad_classified": """
        SELECT * REPLACE (if(oee_status_group = 'UNKNOWN', 'IDLE', oee_status_group)
                          AS oee_status_group)
        FROM int_events_classified""",
    "bad_fact": """
        SELECT * REPLACE (if(quality < 1, md5(product), machine_key) AS machine_key,
                          oee + performance AS oee)
        FROM fact_oee_daily""",
    "bad_products": """
        SELECT * REPLACE (concat('Pack ', biscuits_per_pack) AS product_name) FROM dim_product""",
}

GROUPS = "'RUN', 'CHANGEOVER', 'PLANNED_DOWNTIME_PM', 'NO_ORDER', 'UNKNOWN'"
CLASSES = "'MINOR', 'MAJOR'"

# The declared checks, by table and kind.
DECLARED = {
    "stg_fact_events": {
        "not_null": (
            "machine", "start_datetime", "end_datetime", "duration_minutes",
            "total_biscuits_made", "good_biscuits_made", "oee_category_raw", "product",
        ),
        "min": {"duration_minutes": 0},
    },
    "stg_target_speeds": {
        "not_null": ("machine", "product", "target_biscuits_per_hour"),
        "min": {"target_biscuits_per_hour": 1},
    },
    "stg_product": {
        "not_null": ("product_name", "biscuits_per_pallet"), "unique": ("product_name",),
    },
    "stg_machine": {"not_null": ("machine_name",), "unique": ("machine_name",)},
    "int_events_classified": {
        "not_null": ("is_duration_outlier", "is_unknown_category"),
        "in": {"oee_status_group": GROUPS, "stoppage_class": CLASSES},
    },
    "int_daily_machine_product": {
        "not_null": ("machine", "product", "event_date", "planned_time_min"),
        "true": {
            "planned_time_min": "> 0", "run_time_min": ">= 0", "downtime_min": ">= 0",
            "availability": "<= 1", "performance": "<= 1", "quality": "<= 1",
        },
    },
    "dim_machine": {
        "not_null": ("machine_key", "machine_name", "machine_type"),
        "unique": ("machine_key", "machine_name"),
    },
    "dim_product": {
        "not_null": ("product_key", "product_name", "biscuits_per_pallet"),
        "unique": ("product_key", "product_name"),
    },
    "dim_date": {"not_null": ("date_key", "is_weekend"), "unique": ("date_key",)},
    "fact_machine_events": {
        "not_null": ("event_id", "machine_key", "product_key", "date_key"),
        "unique": ("event_id",),
        "parents": {
            "machine_key": "dim_machine", "product_key": "dim_product", "date_key": "dim_date",
        },
        "in": {"oee_status_group": GROUPS},
    },
    "fact_oee_daily": {
        "not_null": ("machine_key", "product_key", "date_key"),
        "parents": {
            "machine_key": "dim_machine", "product_key": "dim_product", "date_key": "dim_date",
        },
        "true": {
            "availability": "<= 1", "performance": "<= 1", "quality": "<= 1", "oee": "<= 1",
        },
    },
    "mart_oee_monthly_summary": {
        "not_null": ("year_month",),
        "unique": ("year_month",),
        "true": {"availability": "<= 1", "performance": "<= 1", "quality": "<= 1"},
    },
    "mart_whatif_pm_reduction": {
        "not_null": ("machine",),
        "unique": ("machine",),
        "true": {"pm_downtime_reduced_min": ">= 0"},
    },
}


def _row(table: str, kind: str, column: str, detail: str, counted: str) -> str:
    detail = detail.replace("'", "")
    return (
        f"SELECT '{table}' AS table_name, '{kind}' AS check_kind, '{column}' AS column_name,"
        f" '{detail}' AS detail, CAST(n AS BIGINT) AS failures,"
        f" if(n = 0, 'pass', 'fail') AS status FROM ({counted})"
    )


def suite(source: dict[str, str]) -> str:
    rows = []
    for table, spec in DECLARED.items():
        name = source.get(table, table)

        def failing(kind, column, detail, condition, table=table, name=name):
            counted = f"SELECT count(*) AS n FROM {name} WHERE {condition}"
            rows.append(_row(table, kind, column, detail, counted))

        for c in spec.get("not_null", ()):
            failing("not_null", c, "", f"{c} IS NULL")
        for c, values in spec.get("in", {}).items():
            counted = f"SELECT count(DISTINCT {c}) AS n FROM {name} WHERE {c} NOT IN ({values})"
            rows.append(_row(table, "accepted_values", c, values, counted))
        for c, low in spec.get("min", {}).items():
            failing("accepted_range", c, f">= {low}", f"{c} < {low}")
        for c, text in spec.get("true", {}).items():
            failing("expression_is_true", c, text, f"NOT ({c} {text})")
        for c, parent in spec.get("parents", {}).items():
            failing("relationships", c, parent,
                    f"{c} NOT IN (SELECT {c} FROM {source.get(parent, parent)})")
        for c in spec.get("unique", ()):
            counted = (
                f"SELECT count(*) AS n FROM (SELECT {c} FROM {name} WHERE {c} IS NOT NULL"
                f" GROUP BY {c} HAVING count(*) > 1)"
            )
            rows.append(_row(table, "unique", c, "", counted))
    return "\nUNION ALL ".join(rows)


def _extra(table: str, columns: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{columns}' AS column_name, count(*) AS failures FROM"
        f" (SELECT {columns} FROM {table} GROUP BY ALL HAVING count(*) > 1)"
    )


def statements() -> dict[str, str]:
    bad = {
        "stg_fact_events": "bad_events",
        "int_events_classified": "bad_classified",
        "fact_oee_daily": "bad_fact",
        "dim_product": "bad_products",
    }
    event = (
        "machine, start_datetime, end_datetime, product,"
        " CAST(duration_minutes AS DOUBLE) AS duration_minutes,"
        " total_biscuits_made, good_biscuits_made, oee_category_raw"
    )
    return {
        "k1_not_null": f"SELECT {event} FROM bad_events WHERE product IS NULL",
        "k2_unique": "SELECT product_name, count(*) AS n_rows FROM bad_products"
        " GROUP BY product_name HAVING count(*) > 1",
        "k2_unique_composite": "SELECT machine, product, oee_category_raw, count(*) AS n_rows"
        " FROM stg_fact_events WHERE machine IS NOT NULL AND product IS NOT NULL"
        " AND oee_category_raw IS NOT NULL GROUP BY ALL HAVING count(*) > 1",
        "k3_accepted_values": "SELECT oee_status_group AS value, count(*) AS n_rows"
        f" FROM bad_classified WHERE oee_status_group NOT IN ({GROUPS}) GROUP BY ALL",
        "k4_relationships": "SELECT machine_key, count(*) AS n_rows FROM bad_fact"
        " WHERE machine_key NOT IN (SELECT machine_key FROM dim_machine) GROUP BY machine_key",
        "k5_accepted_range": f"SELECT {event} FROM bad_events WHERE duration_minutes < 0",
        "k6_expression_is_true": "SELECT machine, product, date_key, oee FROM bad_fact WHERE oee > 1",
        "k7_run_suite": suite({}),
        "k7_run_suite_corrupted": suite(bad),
        "k7_extra_keys": _extra("stg_target_speeds", "machine, product")
        + " UNION ALL " + _extra("fact_oee_daily", "machine, product, date_key"),
    }
