"""Deduplicated events stored by month and bucketed by event, so that late extracts merge.

A late extract repeats readings of events that are stored already. The store is bucketed by a
hash of the event's key, so merging joins each bucket with its share of the extract: the extract
is exchanged, the stored months are not, and months the extract does not touch are not read.
The merged months are written beside the live ones and switched one by one, as every stored
table is. Models built on the store (``Models(..., staged=...)``) need no deduplication.

The key hash is the md5 of the four key columns, each with its length, NULL apart from empty
text; two different events share it with a chance below 10**-14 among 10**12 events.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.functions.calendar import year_month
from millwright.operators.dedup import dedup_events
from millwright.plans.staging import trim_events
from millwright.schemas import EVENT_KEY
from millwright.sources.tables import (
    NO_VALUE, STAGING, layer_name, point_partitions, table_folder, version_name,
)

STORE = "stg_event_store"
BUCKETS = 32
KEY, MONTH = "event_key", "year_month"
ORDER = "total_biscuits_made"


def event_key() -> Column:
    parts = []
    for name in EVENT_KEY:
        text = F.col(name).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.md5(F.concat(*parts)))


def _keyed(staged: DataFrame) -> DataFrame:
    return staged.withColumn(KEY, event_key()).withColumn(MONTH, year_month("start_datetime"))


def _write(rows: DataFrame, buckets: int, layer: str) -> str:
    """Write a snapshot of bucketed months and return its folder; the table is not touched."""
    spark = rows.sparkSession
    folder = f"{table_folder(spark, STORE, layer)}/{version_name()}"
    staged = layer_name(layer, f"{STORE}_{uuid.uuid4().hex[:8]}")
    (
        rows.write.format("parquet").option("path", folder)
        .partitionBy(MONTH).bucketBy(buckets, KEY).sortBy(KEY).saveAsTable(staged)
    )
    spark.sql(f"DROP TABLE {staged}")  # the files stay, as their folder was given
    return folder


def create_store(raw_fact: DataFrame, layer: str = STAGING, buckets: int = BUCKETS) -> DataFrame:
    """Store all events of a raw table. ``buckets`` times 256 MB should hold a month."""
    spark = raw_fact.sparkSession
    rows = dedup_events(_keyed(trim_events(raw_fact)), (KEY,), ORDER)
    columns = [c for c in rows.columns if c != MONTH]
    rows = rows.select(*columns, MONTH)
    folder = _write(rows.repartition(buckets, KEY), buckets, layer)
    name = layer_name(layer, STORE)
    listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({listed}) USING parquet PARTITIONED BY ({MONTH})"
        f" CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {buckets} BUCKETS"
        f" LOCATION '{table_folder(spark, STORE, layer)}'"
    )
    point_partitions(spark, folder, STORE, layer, MONTH)
    return stored_events(spark, layer)


def stored_events(spark: SparkSession, layer: str = STAGING) -> DataFrame:
    """All stored events with the columns of ``stg_fact_events`` and their month."""
    return spark.table(layer_name(layer, STORE)).drop(KEY)


def buckets_of(spark: SparkSession, layer: str = STAGING) -> int:
    rows = spark.sql(f"DESCRIBE EXTENDED {layer_name(layer, STORE)}")
    return int(rows.where("col_name = 'Num Buckets'").first().data_type)


def months_of(rows: DataFrame) -> list[str | None]:
    """The months of some events; None for those without a start."""
    found = rows.select(year_month("start_datetime").alias(MONTH)).distinct().collect()
    return sorted((r[0] for r in found), key=str)


def _in_months(rows: DataFrame, months: Iterable[str | None]) -> DataFrame:
    months = list(months)
    within = F.col(MONTH).isin([m for m in months if m is not None])
    return rows.where(within | F.col(MONTH).isNull() if None in months else within)


def _better(stored: str, late: str, columns: list[str]) -> Column:
    """Of two readings the one that the deduplication keeps: highest total, NULL above all."""
    rest = [c for c in columns if c not in EVENT_KEY and c != ORDER]

    def ranked(side: str) -> Column:
        fields = [
            F.struct(
                F.col(f"{side}.{c}").isNull().alias("missing"), F.col(f"{side}.{c}").alias("value")
            ).alias(c)
            for c in (ORDER, *rest, *EVENT_KEY)
        ]
        return F.when(F.col(f"{side}.{KEY}").isNotNull(), F.struct(*fields))

    return F.greatest(ranked(stored), ranked(late))


def merged_months(
    extract: DataFrame, months: Iterable[str | None], layer: str = STAGING
) -> DataFrame:
    """The given months of the store with the events of a raw extract merged in."""
    spark = extract.sparkSession
    stored = _in_months(spark.table(layer_name(layer, STORE)), months)
    late = _in_months(_keyed(trim_events(extract)), months)
    late = dedup_events(late, (KEY,), ORDER)
    joined = stored.alias("s").join(late.alias("l"), F.col(f"s.{KEY}") == F.col(f"l.{KEY}"), "full")
    key = F.coalesce(F.col(f"s.{KEY}"), F.col(f"l.{KEY}"))
    month = F.coalesce(F.col(f"s.{MONTH}"), F.col(f"l.{MONTH}"))
    columns = [c for c in stored.columns if c not in (KEY, MONTH)]
    best = joined.select(_better("s", "l", columns).alias("b"), key.alias(KEY), month.alias(MONTH))
    return best.select(*[F.col(f"b.{c}.value").alias(c) for c in columns], KEY, MONTH)


def merge(extract: DataFrame, layer: str = STAGING) -> list[str | None]:
    """Merge a raw extract into the store; the months it touched, None for undated events.

    The extract is read twice, for its months and for its rows. A merge that stops before
    the switch changes nothing, and running it again is harmless: the result is the same.
    """
    spark = extract.sparkSession
    months = months_of(trim_events(extract))
    if not months:
        return []
    folder = _write(merged_months(extract, months, layer), buckets_of(spark, layer), layer)
    replaced = {NO_VALUE if m is None else m for m in months}
    point_partitions(spark, folder, STORE, layer, MONTH, replaced)
    return months
