"""Hand-made raw rows."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from millwright import schemas
from millwright.sources.raw import RawTables

START = dt.datetime(2021, 7, 1, 8, 0)
RUN, CC, PM, NO, JUNK = "Run Time", "CC (Changeover Cleaning)", "PM (Maintenance)", "NO (No Order)", "0"


def event(category=RUN, minutes=10, total=100, good=90, machine="M1", product="P1",
          start=START, end=None):
    """One raw event; without an end it lasts its duration."""
    if end is None:
        end = start + dt.timedelta(minutes=float(minutes or 0))
    amount = None if minutes is None else Decimal(str(minutes))
    return (machine, start, end, amount, total, good, category, product)


def raw_fact(spark, rows):
    return spark.createDataFrame(rows, schemas.RAW_FACT)


def raw_tables(spark, rows, targets=(), products=("P1",), machines=("M1",)):
    return RawTables(
        raw_fact=raw_fact(spark, rows),
        raw_target_speeds=spark.createDataFrame(
            [(m, p, Decimal(str(v))) for m, p, v in targets], schemas.RAW_TARGET_SPEEDS
        ),
        raw_product=spark.createDataFrame(
            [(p, 10, 120, 4800) for p in products], schemas.RAW_PRODUCT
        ),
        raw_machine=spark.createDataFrame([(m, "Baking") for m in machines], schemas.RAW_MACHINE),
    )
