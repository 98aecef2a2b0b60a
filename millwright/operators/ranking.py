"""Sorted output, limits and top-k per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _order(by: str, ascending: bool):
    """NULL counts as the largest value: last ascending, first descending."""
    column = F.col(by)
    return column.asc_nulls_last() if ascending else column.desc_nulls_first()


def ranked(
    df: DataFrame,
    by: str,
    ascending: bool,
    limit: int | None = None,
    tie: Sequence[str] = (),
) -> DataFrame:
    """Sort by a metric, then by the tie columns; optionally keep the first rows."""
    ordered = df.orderBy(_order(by, ascending), *[_order(t, True) for t in tie])
    return ordered if limit is None else ordered.limit(limit)


def top_per_group(
    df: DataFrame,
    group: Sequence[str],
    by: str,
    k: int,
    tie: Sequence[str] = (),
    rank: str = "rank",
) -> DataFrame:
    """The k rows with the highest value in each group, numbered from 1."""
    window = Window.partitionBy(*group).orderBy(
        _order(by, False), *[_order(t, True) for t in tie]
    )
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)
