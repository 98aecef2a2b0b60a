"""Random raw rows with NULLs, padding, repeats and odd values, against the SQL."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest

from compare import connect, difference
from registry import oracle
from registry import queries as registered
from rows import raw_tables

NAMES = ("Machine 3", "Machine 3 ", " Machine 4", "Machine 4", "machine 4", "", None)
PRODUCTS = ("Product 5", " Product 5", "Product 6", None)
CATEGORIES = ("Run Time", "run time", "RUN", "CC", " cc x", "PM", "No Order", "n", "0", " 0", "", None, "XYZ")
MINUTES = ("0", "1", "2.999999", "3", "45.5", "720", "1440", "1440.000001", "9000", "-5", None)
COUNTS = (0, 1, 7, 500, 10**12, -3, None)


def messy_rows(seed: int, n: int = 700):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        start = None
        if rng.random() > 0.02:
            start = dt.datetime(2024, 1, rng.choice([8, 9, 10, 31])) + dt.timedelta(
                days=rng.choice([0, 0, 40]), minutes=rng.choice([0, 719, 1439]))
        minutes = rng.choice(MINUTES)
        end = None if start is None or minutes is None else start + dt.timedelta(minutes=float(minutes))
        rows.append((
            rng.choice(NAMES), start, end, None if minutes is None else Decimal(minutes),
            rng.choice(COUNTS), rng.choice(COUNTS), rng.choice(CATEGORIES), rng.choice(PRODUCTS)))
    # repeated readings that differ in their counters only
    return rows + [(*r[:4], rng.choice(COUNTS), rng.choice(COUNTS), *r[6:]) for r in rows[::5]]


KEYS = [
    "b1_stg_events", "e1_dedup_events", "e1_dedup_other_key", "g1_dim_machine", "g3_dim_date",
    "g4_events_classified", "d1_day_sums", "g5_daily_machine_product", "g6_fact_machine_events",
    "g7_fact_oee_daily", "g8_monthly_summary", "g9_whatif_pm", "c7_top_reasons", "d15_repeated_keys",
    "f6_top3_per_group", "k2_unique_composite", "k7_run_suite", "k8_quality_profile",
    *(f"q{n}_{key}" for n, key in enumerate(oracle.REPORTS, start=1)),
    *(f"q{n}_{key}_filtered" for n, key in enumerate(oracle.REPORTS, start=1)),
]


@pytest.fixture(scope="module")
def plant(spark, sf_dir):
    targets = [("Machine 3", "Product 5", "40"), ("Machine 3 ", "Product 6", "0"),
               ("Machine 4", " Product 5", "123456.5"), ("Machine 9", "Product 5", "1")]
    raw = raw_tables(spark, messy_rows(11), targets, products=(" Product 5", "Product 6 "),
                     machines=("Machine 3 ", "Machine 4"))
    duck = connect(sf_dir)
    for name, df in raw.items():
        duck.register(f"messy_{name}", df.toArrow())
    return registered.Plant(spark, sf_dir, lambda *_: raw), duck


SQL = oracle.over({
    name: f"SELECT * FROM messy_{name}"
    for name in ("raw_fact", "raw_target_speeds", "raw_product", "raw_machine")
})


@pytest.mark.parametrize("key", KEYS)
def test_messy_rows_equal_sql(plant, key):
    given, duck = plant
    found = registered.plain(registered.QUERIES[key](given))
    assert difference(found, duck, SQL[key]) is None
