"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: existing keys were hashed with them
NULL_TEXT = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"


def surrogate_key(*names: str) -> Column:
    """md5 of the joined text of the columns; NULL and empty text give different keys."""
    parts = [F.coalesce(F.col(n).cast("string"), F.lit(NULL_TEXT)) for n in names]
    return F.md5(F.concat_ws(SEPARATOR, *parts))
