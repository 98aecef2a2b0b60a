"""Removal of repeated sensor readings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millwright.schemas import EVENT_KEY


def dedup_events(
    df: DataFrame,
    keys: Sequence[str] = EVENT_KEY,
    order: str = "total_biscuits_made",
) -> DataFrame:
    """Keep one row per key: the highest ``order`` value, a NULL ranking above all.

    Ties are broken by the remaining columns, so the kept row does not depend on
    partitioning. ``row_number() == 1`` is planned with a group limit on both sides of
    the exchange: each task first cuts its own copies of a key down to one row, so a key
    with very many copies never meets in one task.

    Timestamps lead the key list because sorting compares the first column by its
    8-byte prefix, which padded names share.
    """
    times = [k for k in keys if df.schema[k].dataType.typeName().startswith("timestamp")]
    spec = times + [k for k in keys if k not in times]
    rest = [c for c in df.columns if c not in keys and c != order]
    window = Window.partitionBy(*spec).orderBy(
        *[F.col(c).desc_nulls_first() for c in [order, *rest]]
    )
    return (
        df.withColumn("_rank", F.row_number().over(window))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )
