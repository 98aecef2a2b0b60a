"""Staging layer: rename, trim, cast; events are also deduplicated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.functions.numeric import whole
from millwright.operators.dedup import dedup_events
from millwright.schemas import MINUTES


def _text(name: str, alias: str | None = None) -> Column:
    return F.trim(F.col(name)).alias(alias or name)


def _typed(name: str, kind, alias: str | None = None) -> Column:
    return F.col(name).cast(kind).alias(alias or name)


def trim_events(raw_fact: DataFrame) -> DataFrame:
    given = dict(raw_fact.dtypes)
    return raw_fact.select(
        _text("machine"),
        _typed("startdatetime", "timestamp_ntz", "start_datetime"),
        _typed("enddatetime", "timestamp_ntz", "end_datetime"),
        _typed("duration", MINUTES, "duration_minutes"),
        whole("totalbiscuitsmade", given["totalbiscuitsmade"]).alias("total_biscuits_made"),
        whole("goodmadebiscuits", given["goodmadebiscuits"]).alias("good_biscuits_made"),
        _text("oee_category", "oee_category_raw"),
        _text("product"),
    )


def stg_events(raw_fact: DataFrame) -> DataFrame:
    return dedup_events(trim_events(raw_fact))


def stg_target_speeds(raw_target_speeds: DataFrame) -> DataFrame:
    return raw_target_speeds.select(
        _text("machine"), _text("product"), _typed("target_biscuits_per_hour", MINUTES)
    )


def stg_product(raw_product: DataFrame) -> DataFrame:
    sizes = ("biscuits_per_pack", "biscuits_per_case", "biscuits_per_pallet")
    return raw_product.select(_text("product_name"), *[_typed(s, "int") for s in sizes])


def stg_machine(raw_machine: DataFrame) -> DataFrame:
    return raw_machine.select(_text("machine_name"), _text("machine_type"))
