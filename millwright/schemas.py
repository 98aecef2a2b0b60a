"""Declared schemas of the four raw tables; nothing is inferred at load."""

from __future__ import annotations

from pyspark.sql import types as T

MINUTES = T.DecimalType(18, 6)

RAW_FACT = T.StructType([
    T.StructField("machine", T.StringType()),
    T.StructField("startdatetime", T.TimestampNTZType()),
    T.StructField("enddatetime", T.TimestampNTZType()),
    T.StructField("duration", MINUTES),
    T.StructField("totalbiscuitsmade", T.LongType()),
    T.StructField("goodmadebiscuits", T.LongType()),
    T.StructField("oee_category", T.StringType()),
    T.StructField("product", T.StringType()),
])

RAW_TARGET_SPEEDS = T.StructType([
    T.StructField("machine", T.StringType()),
    T.StructField("product", T.StringType()),
    T.StructField("target_biscuits_per_hour", MINUTES),
])

RAW_PRODUCT = T.StructType([
    T.StructField("product_name", T.StringType()),
    T.StructField("biscuits_per_pack", T.IntegerType()),
    T.StructField("biscuits_per_case", T.IntegerType()),
    T.StructField("biscuits_per_pallet", T.IntegerType()),
])

RAW_MACHINE = T.StructType([
    T.StructField("machine_name", T.StringType()),
    T.StructField("machine_type", T.StringType()),
])

RAW = {
    "raw_fact": RAW_FACT,
    "raw_target_speeds": RAW_TARGET_SPEEDS,
    "raw_product": RAW_PRODUCT,
    "raw_machine": RAW_MACHINE,
}

# event identity: a second row with the same values is a repeated sensor reading.
EVENT_KEY = ("machine", "start_datetime", "end_datetime", "product")
DAY_KEY = ("machine", "product", "event_date")

MINUTE_MEASURES = (
    "planned_time_min", "run_time_min", "downtime_min", "changeover_time_min",
    "pm_downtime_min", "minor_stoppage_min", "major_stoppage_min",
)
COUNTERS = ("total_biscuits_made", "good_biscuits_made")
