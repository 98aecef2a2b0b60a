"""Stored tables: one catalog database per layer."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.functions.calendar import year_month
from millwright.scratch import delete_folder, store

RAW, STAGING, INTERMEDIATE, MARTS = "raw", "staging", "intermediate", "marts"
_LAYER_OF_PREFIX = {"raw_": RAW, "stg_": STAGING, "int_": INTERMEDIATE}


def layer_of(table: str) -> str:
    """Layer of a model by the prefix of its name; everything else is a mart."""
    return next((l for p, l in _LAYER_OF_PREFIX.items() if table.startswith(p)), MARTS)


def layer_name(layer: str, table: str) -> str:
    """Qualified name; the layer is the database name as it stands."""
    return f"{layer.strip()}.{table}"


def ensure_layer(spark: SparkSession, layer: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer.strip()}{place}")


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Staging and intermediate models are views: nothing is computed or stored."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def _folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if it does not exist."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(target):
        return []
    return sorted(f.getPath().getName() for f in system.listStatus(target) if f.isDirectory())


def _described(spark: SparkSession, name: str, partition: str = "") -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE EXTENDED {name} {partition}").collect()
    found: dict[str, str] = {}
    for row in rows:  # of a partition, its own location comes before that of the table
        found.setdefault(row.col_name, row.data_type)
    return found


def _location(spark: SparkSession, name: str) -> str | None:
    """Folder of a stored table, or None if there is no such table."""
    return _described(spark, name)["Location"] if spark.catalog.tableExists(name) else None


def table_folder(spark: SparkSession, table: str, layer: str = RAW) -> str:
    """The folder that holds all snapshots of a table."""
    ensure_layer(spark, layer)
    return f"{spark.catalog.getDatabase(layer).locationUri}/{table}"


def version_name() -> str:
    """Name of the next snapshot's folder."""
    return f"v{dt.datetime.now(dt.UTC):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def stage_write(
    df: DataFrame, table: str, layer: str = RAW, partition_by: Sequence[str] = ()
) -> str:
    """Write a snapshot beside the live rows and return its folder.

    Every load has a folder of its own and the catalog points at one of them, so nothing
    that is being read is ever written to. A load that stops here leaves the table as it
    was; its folder goes with the next load.
    """
    folder = f"{table_folder(df.sparkSession, table, layer)}/{version_name()}"
    df.write.partitionBy(*partition_by).parquet(folder)
    return folder


def swap_in(
    df: DataFrame, folder: str, table: str, layer: str = RAW, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Point the table at a written snapshot; ``df`` gives the column types.

    For a table without partitions this is a single change of its location: a reader sees
    all old rows or all new ones. The snapshot it replaced stays until the next load, so a
    reader that began before the switch finishes on the rows it began with. A session that
    has read the table before knows the new rows after ``REFRESH TABLE``, or on its own with
    ``spark.sql.metadataCacheTTLSeconds``. Only where columns or partitioning differ from the
    live table is that one dropped and made anew. One load of a table runs at a time.
    """
    spark = df.sparkSession
    live = layer_name(layer, table)
    columns = [(f.name, f.dataType) for f in df.schema]
    last = None
    if spark.catalog.tableExists(live):
        held = spark.table(live)
        same = [(f.name, f.dataType) for f in held.schema] == columns
        parted = [c.name for c in spark.catalog.listColumns(live) if c.isPartition]
        if not same or parted != list(partition_by):
            spark.sql(f"DROP TABLE {live}")
        else:
            last = _location(spark, live)
    if last is None:
        listed = ", ".join(f"`{n}` {t.simpleString()}" for n, t in columns)
        parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
        place = table_folder(spark, table, layer) if partition_by else folder
        spark.sql(f"CREATE TABLE {live} ({listed}) USING parquet{parts} LOCATION '{place}'")
    elif not partition_by:
        spark.sql(f"ALTER TABLE {live} SET LOCATION '{folder}'")
    if partition_by:
        return point_partitions(spark, folder, table, layer, partition_by[0])
    keep = {place.rsplit("/", 1)[1] for place in (folder, last or folder)}
    for version in set(_folders(spark, folder.rsplit("/", 1)[0])) - keep:
        delete_folder(spark, f"{folder.rsplit('/', 1)[0]}/{version}")
    return spark.table(live)


NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def point_partitions(
    spark: SparkSession, folder: str, table: str, layer: str, column: str,
    replaced: Iterable[str] | None = None,
) -> DataFrame:
    """Point partitions of a table at those of a written snapshot, each in one step.

    ``replaced`` names the values that the snapshot stands for, all if not given: those
    that it holds no rows of are removed. A reader sees a partition as it was or as it is
    now, never half of it. Of each partition the snapshot that was live before is kept.
    """
    live, base = layer_name(layer, table), folder.rsplit("/", 1)[0]
    here = {name.split("=", 1)[1] for name in _folders(spark, folder) if "=" in name}
    held = {row[0].split("=", 1)[1] for row in spark.sql(f"SHOW PARTITIONS {live}").collect()}
    spec = {
        v: f"PARTITION ({column} = {'null' if v == NO_VALUE else repr(v)})" for v in here | held
    }
    before = {v: _described(spark, live, spec[v])["Location"] for v in here & held}
    for value in sorted(here & held):
        place = f"{folder}/{column}={value}"
        spark.sql(f"ALTER TABLE {live} {spec[value]} SET LOCATION '{place}'")
    if here - held:
        added = " ".join(
            f"{spec[v]} LOCATION '{folder}/{column}={v}'" for v in sorted(here - held)
        )
        spark.sql(f"ALTER TABLE {live} ADD {added}")
    gone = held - here if replaced is None else (held - here) & set(replaced)
    if gone:
        spark.sql(f"ALTER TABLE {live} DROP " + ", ".join(spec[v] for v in sorted(gone)))
    spark.catalog.refreshTable(live)
    for version in set(_folders(spark, base)) - {folder.rsplit("/", 1)[1]}:
        inside = _folders(spark, f"{base}/{version}")
        for name in inside:
            value = name.split("=", 1)[-1]
            old = f"{base}/{version}/{name}"
            if value in here and not before.get(value, "").endswith(f"{version}/{name}"):
                delete_folder(spark, old)
                inside = [n for n in inside if n != name]
        if not inside:
            delete_folder(spark, f"{base}/{version}")
    return spark.table(live)


def write_table(
    df: DataFrame, table: str, layer: str = RAW, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Full reload in a write and a switch. A failed write leaves the old rows in place."""
    folder = stage_write(df, table, layer, partition_by)
    return swap_in(df, folder, table, layer, partition_by)


def days_together(df: DataFrame, day: Column, *order: str) -> DataFrame:
    """Rows rebalanced by day and sorted within each file to be.

    The rebalance gives each day its own writers, splits a day too big for one file and
    joins small ones, so files stay near the advisory size whatever the skew, and a day
    filter skips files and pages by their statistics.
    """
    keyed = df.withColumn("_day", day).hint("rebalance", "_day")
    return keyed.sortWithinPartitions(*order).drop("_day")


def _by_month(df: DataFrame, derived: Mapping[str, Column]) -> DataFrame:
    """Month column last, days together, sorted for the filters of the reports."""
    if "year_month" not in df.columns:
        df = df.withColumn("year_month", year_month("date_key"))
    names = [*(c for c in df.columns if c != "year_month"), "year_month"]
    rows = df.select(*[c for c in names if c not in derived])
    rows = days_together(rows, F.col("date_key"), "year_month", "date_key", "machine")
    return rows.select(*[derived[c].alias(c) if c in derived else c for c in names])


def write_mart(
    df: DataFrame,
    table: str,
    layer: str = MARTS,
    partition_by: str | None = None,
    derived: Mapping[str, Column] = {},
) -> DataFrame:
    """Store a mart; facts are partitioned by month so date filters prune files.

    ``derived`` columns of a partitioned mart are computed from its other columns after
    the rows were exchanged: a hash as wide as the rest of the row need not travel.
    """
    if partition_by is None:
        return write_table(df, table, layer)
    if partition_by != "year_month":
        raise ValueError("marts are partitioned by year_month")
    return write_table(_by_month(df, derived), table, layer, [partition_by])


def replace_months(
    df: DataFrame,
    months: Sequence[str],
    table: str,
    layer: str = MARTS,
    derived: Mapping[str, Column] = {},
) -> DataFrame:
    """Replace some months of a stored, month-partitioned mart with the rows of ``df``.

    Rows without a month are a partition of their own, which is replaced too. The months
    are written to a folder of this load and then switched one by one, so a reader never
    meets half a month and a load that stops in the write changes nothing. A month that
    has no rows any more is removed.
    """
    spark = df.sparkSession
    live = layer_name(layer, table)
    if "year_month" not in df.columns:
        df = df.withColumn("year_month", year_month("date_key"))
    df = df.filter(F.col("year_month").isin(*months) | F.col("year_month").isNull())
    if not spark.catalog.tableExists(live):
        return write_mart(df, table, layer, "year_month", derived)
    rows = df.select(*spark.table(live).columns)
    folder = stage_write(_by_month(rows, derived), table, layer, ["year_month"])
    return point_partitions(spark, folder, table, layer, "year_month", {*months, NO_VALUE})


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared scratch folder and read back.

    For a result with several consumers: it survives lost executors, later scans prune
    columns, and its file size tells the planner whether it may be broadcast.
    """
    return store(df, name)
