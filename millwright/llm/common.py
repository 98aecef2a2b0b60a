"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_VOCABULARY_BYTES = 64 * 2**20
SLICE_BYTES = 2**20


def vocabulary_path(name: str) -> str:
    return public_tokenizers.path(name)


def read_vocabulary(path: str) -> str:
    """The whole file, read by the driver; a bound proves that it may be broadcast."""
    size = Path(path).stat().st_size
    if size > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} has {size} bytes; at most {MAX_VOCABULARY_BYTES} are broadcast")
    return Path(path).read_text(encoding="utf-8")


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def map_rows(
    df: DataFrame, columns: list[str], schema: str, make: Callable[[], Callable],
    sliced: str | None = None,
) -> DataFrame:
    """Map Arrow batches of ``columns`` through a function made once per task.

    ``make`` runs in the task and returns ``batch_lists -> dict of lists``. ``sliced`` names
    a text column by whose bytes batches are cut first, for functions that hold the words of
    all texts they are given.
    """
    from pyspark.sql.types import StructType
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        if sliced:
            batches = text_slices(batches, sliced, SLICE_BYTES)
        for batch in batches:
            if batch.num_rows:
                found = work(*(column.to_pylist() for column in batch.columns))
                yield pa.RecordBatch.from_pydict(found, schema=arrow)

    return df.select(*[F.col(f"`{c}`") for c in columns]).mapInArrow(run, schema)


def text_slices(
    batches: Iterator[pa.RecordBatch], column: str, limit: int
) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that a slice has about ``limit`` bytes of a string column.

    Slices share the batch's memory, so a task turns few texts into Python objects at a time.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(
            zero_copy_only=False
        )
        part = (np.cumsum(sizes, dtype=np.int64) - sizes) // limit
        begins = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for begin, end in zip(begins, begins[1:]):
            yield batch.slice(begin, end - begin)
