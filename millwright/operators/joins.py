"""Joins against lookup tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(facts: DataFrame, lookup: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """LEFT equi-join of facts to a lookup; ``on`` maps fact column -> lookup column.

    There is no broadcast hint on purpose. The lookup is broadcast when its size, known
    from file statistics or measured at run time, is below
    ``spark.sql.autoBroadcastJoinThreshold``. A lookup that has outgrown the threshold
    is sort-merge joined, and adaptive execution splits the partitions of hot keys.
    """
    keyed = lookup.withColumnsRenamed({right: f"_lookup_{left}" for left, right in on.items()})
    condition = None
    for left in on:
        equal = F.col(left) == F.col(f"_lookup_{left}")
        condition = equal if condition is None else condition & equal
    return facts.join(keyed, condition, "left").drop(*[f"_lookup_{left}" for left in on])


def orphans(df: DataFrame, key: str, parent: DataFrame, parent_key: str | None = None) -> DataFrame:
    """Non-NULL key values without a parent row, and how many rows carry each.

    Rows are counted per key value before the join, so a hot key is one row by then.
    """
    parent_key = parent_key or key
    counted = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n_rows"))
    return counted.join(
        parent.select(F.col(parent_key).alias("_parent")),
        F.col(key) == F.col("_parent"),
        "left_anti",
    )
