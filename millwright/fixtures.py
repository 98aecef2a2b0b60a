"""The driver's tables seen as the four raw plant tables, in two ways.

``raw_tables``: every event becomes one machine-status interval of ten machines and
eighteen products in one month. ``line_tables``: every order line becomes one interval
of a machine per supplier and a product per part, over seven years; its day groups and
target pairs are nearly as many as its rows, so its lookups outgrow a broadcast.

Suppliers are the machines and parts the products, so all raw tables grow with the
given ones. Both carry the defects the staging layer has to handle: padded names,
repeated readings, outliers, junk categories, missing targets, good counts above the
total.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright import schemas
from millwright.sources.raw import RawTables, read_table

MACHINES = 10
PRODUCTS = 18
REPEAT_EVERY = 97
BROADCAST_PAIRS = 100_000  # about 10 MB as rows, Spark's own limit for a broadcast

CATEGORY_OF_TYPE = {
    "click": "Run Time",
    "view": "CC (Changeover Cleaning)",
    "purchase": "PM (Maintenance)",
    "signup": "NO (No Order)",
    "error": "0",
}
LINE_CATEGORIES = ("run time", "Run Time ", "cc", "PM check", "No Order", "RUN TIME x")
MACHINE_TYPES = ("Mixing", "Baking", "Packing")

LINEITEM_SCHEMA = (
    "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_shipdate timestamp_ntz"
)
EVENTS_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double,"
    " props string"
)
SUPPLIER_SCHEMA = "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"
PART_SCHEMA = (
    "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
    " p_retailprice double"
)


def _machine_text(number) -> F.Column:
    return F.concat(F.lit("Machine "), number.cast("string"), F.lit(" "))


def _product_text(number) -> F.Column:
    return F.concat(F.lit(" Product "), number.cast("string"))


def _later(start: str, minutes) -> F.Column:
    return F.col(start) + F.make_dt_interval(secs=(minutes * 60).cast("decimal(18,6)"))


def raw_fact(events: DataFrame) -> DataFrame:
    copies = F.when(F.col("event_id") % REPEAT_EVERY == 0, F.array(F.lit(0), F.lit(1)))
    base = events.select(
        "ts",
        (F.col("user_id") % MACHINES).alias("m"),
        ((F.col("event_id") * 7 + F.col("user_id")) % PRODUCTS).alias("p"),
        (F.col("event_id") % 2000).alias("t"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        (F.col("value").cast("decimal(18,2)") * 5).cast(schemas.MINUTES).alias("duration"),
        F.create_map(*[F.lit(x) for kv in CATEGORY_OF_TYPE.items() for x in kv])[
            F.col("event_type")
        ].alias("oee_category"),
        F.explode(F.coalesce(copies, F.array(F.lit(0)))).alias("copy"),
    )
    return base.select(
        _machine_text(F.col("m")).alias("machine"),
        F.col("ts").alias("startdatetime"),
        _later("ts", F.col("duration")).alias("enddatetime"),
        "duration",
        (F.col("t") + F.col("copy")).alias("totalbiscuitsmade"),
        F.floor(F.col("t") * F.col("k") / 50).alias("goodmadebiscuits"),
        "oee_category",
        _product_text(F.col("p")).alias("product"),
    )


def raw_machine(supplier: DataFrame) -> DataFrame:
    types = F.array(*[F.lit(" " + t) for t in MACHINE_TYPES])
    return supplier.select(
        _machine_text(F.col("s_suppkey")).alias("machine_name"),
        F.get(types, (F.col("s_suppkey") % len(MACHINE_TYPES)).cast("int")).alias("machine_type"),
    )


def raw_product(part: DataFrame) -> DataFrame:
    return part.select(
        _product_text(F.col("p_partkey")).alias("product_name"),
        F.col("p_size").alias("biscuits_per_pack"),
        (F.col("p_size") * 12).alias("biscuits_per_case"),
        (F.col("p_size") * 480).alias("biscuits_per_pallet"),
    )


def raw_target_speeds(part: DataFrame) -> DataFrame:
    """Speeds of every part on each of the ten machines.

    As FIXTURES.md lays down, a fifth of the pairs has no speed, so that some day rows
    have no target; no part is left out. File statistics do not show that every part becomes
    many rows of text, so more pairs than a broadcast should hold say so themselves.
    """
    pairs = part.select(
        F.col("p_partkey").alias("p"),
        F.explode(F.sequence(F.lit(0), F.lit(MACHINES - 1))).alias("m"),
    )
    speeds = pairs.filter((F.col("m") + F.col("p")) % 5 != 0).select(
        _machine_text(F.col("m")).alias("machine"),
        _product_text(F.col("p")).alias("product"),
        (200 + 20 * F.col("m") + 10 * F.col("p"))
        .cast(schemas.MINUTES)
        .alias("target_biscuits_per_hour"),
    )
    many = part.count() * MACHINES > BROADCAST_PAIRS  # read from the file footers
    return speeds.hint("merge") if many else speeds


def line_fact(lineitem: DataFrame) -> DataFrame:
    """The seventh line of an order has no category, lines with the top discount repeat."""
    number = F.col("l_linenumber")
    minutes = F.col("l_quantity").cast("decimal(18,2)") * number * number * F.lit(Decimal("0.6"))
    copies = F.when(F.col("l_discount") == 0.1, F.array(F.lit(0), F.lit(1)))
    offset = (F.col("l_orderkey") * 31 + number * 7) % 1440
    base = lineitem.select(
        "*",
        _later("l_shipdate", offset.cast("decimal(6,0)")).alias("startdatetime"),
        minutes.cast(schemas.MINUTES).alias("duration"),
        F.explode(F.coalesce(copies, F.array(F.lit(0)))).alias("copy"),
    )
    good_share = F.lit(1.0) - F.col("l_discount") + F.col("l_tax")
    return base.select(
        _machine_text(F.col("l_suppkey")).alias("machine"),
        "startdatetime",
        _later("startdatetime", F.col("duration")).alias("enddatetime"),
        "duration",
        (F.floor("l_extendedprice") + F.col("copy")).alias("totalbiscuitsmade"),
        F.floor(F.col("l_extendedprice") * good_share).alias("goodmadebiscuits"),
        F.get(F.array(*[F.lit(c) for c in LINE_CATEGORIES]), number - 1).alias("oee_category"),
        _product_text(F.col("l_partkey")).alias("product"),
    )


def line_target_speeds(lineitem: DataFrame) -> DataFrame:
    """A speed for each machine and product that ever met; pairs with low tax have none."""
    pairs = lineitem.groupBy("l_suppkey", "l_partkey").agg(
        F.max("l_quantity").alias("best"), F.max("l_tax").alias("tax")
    )
    return pairs.filter(F.col("tax") >= 0.03).select(
        _machine_text(F.col("l_suppkey")).alias("machine"),
        _product_text(F.col("l_partkey")).alias("product"),
        (F.col("best") * 400).cast(schemas.MINUTES).alias("target_biscuits_per_hour"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/events.parquet", EVENTS_SCHEMA)


def supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/supplier.parquet", SUPPLIER_SCHEMA)


def part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/part.parquet", PART_SCHEMA)


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/lineitem.parquet", LINEITEM_SCHEMA)


def line_tables(spark: SparkSession, sf_dir: str) -> RawTables:
    lines = lineitem(spark, sf_dir)
    return RawTables(
        raw_fact=line_fact(lines),
        raw_target_speeds=line_target_speeds(lines),
        raw_product=raw_product(part(spark, sf_dir)),
        raw_machine=raw_machine(supplier(spark, sf_dir)),
    )


def raw_tables(spark: SparkSession, sf_dir: str) -> RawTables:
    parts = part(spark, sf_dir)
    return RawTables(
        raw_fact=raw_fact(events(spark, sf_dir)),
        raw_target_speeds=raw_target_speeds(parts),
        raw_product=raw_product(parts),
        raw_machine=raw_machine(supplier(spark, sf_dir)),
    )
