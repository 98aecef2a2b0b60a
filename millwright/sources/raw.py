"""Reading raw tables and preparing them for load."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millwright import schemas
from millwright.functions.numeric import whole

TIMESTAMP_COLUMNS = ("startdatetime", "enddatetime")
# fixed value: the source carries a misspelt copy of the pallet column
MISSPELT_PREFIX = "bsicuits"


@dataclass(frozen=True)
class RawTables:
    """The four raw tables every model is built from."""

    raw_fact: DataFrame
    raw_target_speeds: DataFrame
    raw_product: DataFrame
    raw_machine: DataFrame

    def items(self):
        return vars(self).items()


def read_table(
    spark: SparkSession, path: str, schema: str | T.StructType, fmt: str = "parquet"
) -> DataFrame:
    """Scan with a declared schema; no inference pass over the data."""
    return spark.read.schema(schema).format(fmt).load(path)


def normalize_name(name: str) -> str:
    return re.sub(r"[ ()/-]", "_", name.strip().lower())


def normalize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[normalize_name(c) for c in df.columns])


def coerce_ts(df: DataFrame, cols: Iterable[str] = TIMESTAMP_COLUMNS) -> DataFrame:
    """Cast to zone-less timestamps; text that is no timestamp raises."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


def drop_by_prefix(df: DataFrame, prefix: str = MISSPELT_PREFIX) -> tuple[DataFrame, list[str]]:
    """Drop the columns whose name starts with the prefix, and say which they were."""
    dropped = [c for c in df.columns if c.strip().lower().startswith(prefix)]
    kept = [c for c in df.columns if c not in dropped]
    return df.select(*[F.col(f"`{c}`") for c in kept]), dropped


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Pick the declared columns by name and cast them."""
    given = dict(df.dtypes)
    return df.select(*[
        (
            whole(f.name, given[f.name])
            if isinstance(f.dataType, T.LongType)
            else F.col(f.name).cast(f.dataType)
        ).alias(f.name)
        for f in schema
    ])


def prepare(df: DataFrame, name: str) -> tuple[DataFrame, list[str]]:
    """Source columns -> the declared raw table, with the list of dropped columns."""
    dropped: list[str] = []
    if name == "raw_product":
        df, dropped = drop_by_prefix(df)
    df = normalize_columns(df)
    if name == "raw_fact":
        df = coerce_ts(df)
    return conform(df, schemas.RAW[name]), dropped


def read_source(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Open an extract with its own headings. CSV columns stay text until ``prepare``."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("inferSchema", False)
    return reader.load(path)


def read_raw(spark: SparkSession, path: str, name: str, fmt: str = "parquet") -> DataFrame:
    """One of the four raw tables from CSV, JSON, ORC or Parquet files."""
    return prepare(read_source(spark, path, fmt), name)[0]
