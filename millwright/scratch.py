"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager, suppress

from pyspark.sql import DataFrame, SparkSession

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_LOCAL: dict[str, str] = {}
_WRITTEN: dict[str, SparkSession] = {}
_DATABASES: dict[str, SparkSession] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; the setting is read, never changed.

    Where it is unset, a session on one machine (tests) gets a temporary folder; on a
    cluster that is an error, as executors would not see each other's files.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    if context.master.split("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _LOCAL.setdefault(context.applicationId, tempfile.mkdtemp(prefix="millwright-"))


def delete_folder(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when the application ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _WRITTEN[path] = spark
    return path


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of writes inside are deleted as each write ends, not when memory is collected."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def store(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet and read again: a lost executor costs no recomputation."""
    return store_parts([df], name)


def store_parts(parts: Iterable[DataFrame], name: str) -> DataFrame:
    """Frames of one schema written one after the other and read again as one.

    The shuffle files of a part are gone before the next one is computed.
    """
    path = None
    for df in parts:
        spark, schema = df.sparkSession, df.schema
        path = path or scratch_path(spark, name)
        with shuffles_dropped(spark):
            df.write.mode("append").parquet(path)
    stored = spark.read.schema(schema).parquet(path)
    stored.scratch_path = path
    return stored


def drop(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more."""
    for table in tables:
        path = getattr(table, "scratch_path", None)
        if path and _WRITTEN.pop(path, None):
            delete_folder(table.sparkSession, path)


def scratch_database(spark: SparkSession, prefix: str = "layer") -> str:
    """A new database in the shared folder, dropped with its files when the application ends."""
    name = f"{prefix}_{uuid.uuid4().hex}"
    path = f"{shared_folder(spark)}/{name}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    _WRITTEN[path] = spark
    _DATABASES[name] = spark
    return name


@atexit.register
def clean_up() -> None:
    """Delete what is left; runs when the application ends."""
    for name in list(_DATABASES):
        spark = _DATABASES.pop(name)
        with suppress(Exception):
            if spark.sparkContext._jsc is not None:
                spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    for path in list(_WRITTEN):
        spark = _WRITTEN.pop(path)
        with suppress(Exception):  # the session may have ended before
            if spark.sparkContext._jsc is not None:
                delete_folder(spark, path)
