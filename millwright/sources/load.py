"""Load of raw tables with reconciliation, and a log from which counts and freshness are read."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import astuple, dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millwright import schemas
from millwright.config import DEFAULTS
from millwright.sources.raw import RawTables, prepare, read_source
from millwright.sources.tables import (
    RAW, days_together, ensure_layer, layer_name, stage_write, swap_in,
)

OK = "OK"
DIFFERS = "DIFFERS"
LOG = "load_log"
LOG_SCHEMA = (
    "table_name string, n_rows bigint, dropped_columns array<string>, expected bigint,"
    " status string, newest timestamp_ntz, loaded_at timestamp_ntz, live boolean, folder string"
)
# raw table -> the timestamp that tells how fresh it is
NEWEST = {"raw_fact": "startdatetime"}


class RowCountMismatch(RuntimeError):
    """A strict load read another number of rows than expected."""


@dataclass(frozen=True)
class LoadReport:
    """What one load found; a row of the load log. ``live`` is false for a refused load."""

    table: str
    n_rows: int
    dropped_columns: tuple[str, ...]
    expected: int | None
    status: str
    newest: dt.datetime | None = None
    loaded_at: dt.datetime | None = None
    live: bool = True
    folder: str = ""


def load_table(
    source: DataFrame,
    table: str,
    layer: str = RAW,
    expected: int | None = None,
    strict: bool = False,
    by_day: str | None = None,
    newest: str | None = None,
) -> tuple[DataFrame, LoadReport]:
    """Prepare an extract, reload its raw table and log the load.

    Rows are counted, and the newest value of the ``newest`` column is taken, in the write
    itself. A strict load raises on a mismatch before the old table is replaced; otherwise
    the mismatch is only reported. Both are logged. ``by_day`` names a timestamp to store
    the rows by, for extracts that do not come in time order: later builds of some months
    then skip the files of all others.
    """
    prepared, dropped = prepare(source, table)
    if by_day is not None:
        prepared = days_together(prepared, F.to_date(by_day), by_day)
    newest = newest or NEWEST.get(table)
    seen = Observation(f"load_{table}")
    latest = F.col(newest).cast("string") if newest else F.lit(None).cast("string")
    observed = prepared.observe(
        seen, F.count(F.lit(1)).alias("n_rows"), F.max(latest).alias("newest")
    )
    folder = stage_write(observed, table, layer)
    n_rows, last = seen.get["n_rows"], seen.get["newest"]
    status = OK if expected is None or expected == n_rows else DIFFERS
    refused = strict and status != OK
    report = LoadReport(
        table, n_rows, tuple(dropped), expected, status,
        dt.datetime.fromisoformat(last) if last else None,
        dt.datetime.now(dt.UTC).replace(tzinfo=None), not refused, folder,
    )
    if refused:
        append_log(prepared.sparkSession, [report], layer)
        raise RowCountMismatch(f"{table}: {n_rows} rows, expected {expected}")
    stored = swap_in(prepared, folder, table, layer)
    append_log(prepared.sparkSession, [report], layer)
    return stored, report


def load_all(
    spark: SparkSession,
    paths: Mapping[str, str],
    fmt: str = "csv",
    expected: Mapping[str, int] | None = None,
    strict: bool = False,
    layer: str = RAW,
) -> list[LoadReport]:
    """Reload every raw table from its file; one report per table."""
    expected = expected or {}
    reports = []
    for table, path in paths.items():
        source = read_source(spark, path, fmt)
        _, report = load_table(source, table, layer, expected.get(table), strict)
        reports.append(report)
    return reports


def stored_raw(spark: SparkSession, layer: str = RAW) -> RawTables:
    """The raw tables as last loaded."""
    return RawTables(**{name: spark.table(layer_name(layer, name)) for name in schemas.RAW})


# --- load log -----------------------------------------------------------------------


def append_log(spark: SparkSession, reports: list[LoadReport], layer: str = RAW) -> None:
    """Add loads to the log of a layer: one small file per call, never a rewrite."""
    ensure_layer(spark, layer)
    name = layer_name(layer, LOG)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({LOG_SCHEMA}) USING parquet")
    rows = [tuple(list(v) if isinstance(v, tuple) else v for v in astuple(r)) for r in reports]
    spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1).write.insertInto(name)


def load_log(spark: SparkSession, layer: str = RAW) -> DataFrame:
    """All loads so far, refused ones included."""
    return spark.table(layer_name(layer, LOG))


def last_loads(spark: SparkSession, layer: str = RAW) -> DataFrame:
    """Per table, the load it now holds. Loads are partial per task before they meet."""
    log = load_log(spark, layer).where("live")
    rest = [c for c in log.columns if c != "table_name"]
    last = log.groupBy("table_name").agg(F.max_by(F.struct(*rest), "loaded_at").alias("load"))
    return last.select("table_name", *[F.col(f"load.{c}").alias(c) for c in rest])


def logged_counts(spark: SparkSession, layer: str = RAW) -> DataFrame:
    """Row counts as counted in the writes; no table is scanned."""
    return last_loads(spark, layer).select("table_name", "n_rows")


def logged_freshness(
    spark: SparkSession,
    table: str,
    as_of: dt.datetime,
    warn_days: int = DEFAULTS.freshness_warn_days,
    error_days: int = DEFAULTS.freshness_error_days,
    layer: str = RAW,
) -> DataFrame:
    """Age of the newest row of a stored table, from the log. A table never loaded is an error."""
    load = last_loads(spark, layer).where(F.col("table_name") == table)
    return _aged(load.agg(F.max("newest").alias("max_loaded_at")), as_of, warn_days, error_days)


# --- the same by scans, for tables that were not loaded here ----------------------------


def reconcile(df: DataFrame, table: str, expected: int | None = None) -> DataFrame:
    """Row count of a table against the expected one."""
    wanted = F.lit(expected).cast("bigint")
    matches = wanted.isNull() | (F.col("n_rows") == wanted)
    return df.agg(F.count("*").alias("n_rows")).select(
        F.lit(table).alias("table_name"),
        "n_rows",
        wanted.alias("expected"),
        F.when(matches, OK).otherwise(DIFFERS).alias("status"),
    )


def verify_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    parts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def freshness(
    df: DataFrame,
    column: str,
    as_of: dt.datetime,
    warn_days: int = DEFAULTS.freshness_warn_days,
    error_days: int = DEFAULTS.freshness_error_days,
) -> DataFrame:
    """Age of the newest row. An empty table is an error."""
    newest = df.agg(F.max(column).alias("max_loaded_at"))
    return _aged(newest, as_of, warn_days, error_days)


def _aged(newest: DataFrame, as_of: dt.datetime, warn_days: int, error_days: int) -> DataFrame:
    day = 24 * 60 * 60
    moment = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    age = F.col("age_seconds")
    aged = newest.withColumn(
        "age_seconds", F.timestamp_diff("SECOND", F.col("max_loaded_at"), moment)
    )
    status = (
        F.when(age.isNull() | (age > error_days * day), "error")
        .when(age > warn_days * day, "warn")
        .otherwise("pass")
    )
    return aged.select(
        "max_loaded_at", (F.floor(age / day)).alias("age_days"), status.alias("status")
    )
