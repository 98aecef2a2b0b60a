"""Near-duplicate vectors by counting collisions of one-dimensional projections.

Unit vectors at the wanted cosine lie at most ``r`` apart, so their projections on a random
line differ by a normal value of deviation r. Around each vector (the query) a window of fixed
width is opened on many sorted projections; a pair is a candidate if it meets in enough of
them, where enough is the count that a pair at distance r reaches with probability
``COUNT_RECALL``. Candidates are verified by their cosine in double precision.

One projection's window holds a fixed share of all vectors, so pairs are never gathered over
all of them. Cells of a few coarse projections each bring near vectors together in at least
one of several tables (their number follows from the number of vectors and from ``RECALL``);
sorting and counting run inside the cells. The test on a pair does not depend on the table,
and a pair is counted in the first table whose cell it shares, so counts add up without the
pairs leaving their task: a cell returns one row per vector with its number of links, and
edges that span the cell's components. Cells of more than ``BLOCK`` vectors are split into
blocks, and each pair of blocks is a group of its own. Equal vectors are one class from the
start and count by their number.

Vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor
do vectors of different length. Rows with equal ids are vectors of their own; an id's row shows
the component of its smallest row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.llm.components import components
from millwright.scratch import drop, store

COSINE = 0.95
RECALL = 0.999  # of a pair exactly at the threshold; closer pairs are found more surely
COUNT_RECALL = 0.9999
PER_CELL = 32  # unrelated vectors that a cell holds on average
COARSE = 4.0  # width of a coarse projection's cell, in units of r
LINES = 24  # projections whose collisions are counted
WINDOW = 1.5  # half width of their windows, in units of r
FIRST_WINDOW = 4.5  # half width of the window that proposes pairs
BLOCK = 2000
PAIRS_AT_ONCE = 200_000


def normal_cdf(x: float) -> float:
    return 0.5 * (1 + math.erf(x / math.sqrt(2)))


def cell_probability(distance: float, width: float) -> float:
    """That two points at a distance share the cell of one projection with a random offset."""
    t = width / distance
    return (
        1 - 2 * normal_cdf(-t)
        - 2 / (math.sqrt(2 * math.pi) * t) * (1 - math.exp(-t * t / 2))
    )


def plan(n: int, cosine: float = COSINE) -> tuple[int, int]:
    """Coarse projections per table, and tables, for n vectors."""
    r = math.sqrt(2 - 2 * cosine)
    near, far = (cell_probability(d, COARSE * r) for d in (r, math.sqrt(2)))
    k = max(1, round(math.log(max(n, 2) / PER_CELL) / -math.log(far)))
    return k, math.ceil(math.log(1 - RECALL) / math.log(1 - near**k))


def enough_collisions() -> int:
    """The largest count that a pair at distance r reaches often enough."""
    p, tail = 2 * normal_cdf(WINDOW) - 1, 1.0
    for count in range(LINES + 1):
        tail -= math.comb(LINES, count) * p**count * (1 - p) ** (LINES - count)
        if tail < COUNT_RECALL:
            return count
    return LINES


class Lines:
    """Random projections for vectors of one length; the same in every task."""

    def __init__(self, size: int, k: int, tables: int, r: float):
        rng = np.random.default_rng([size, 17])
        self.first = rng.standard_normal(size)
        self.fine = rng.standard_normal((size, LINES))
        self.coarse = rng.standard_normal((size, tables * k)) / (COARSE * r)
        self.offsets = rng.random(tables * k)
        self.factors = rng.integers(1, 2**62, (tables, k)) * 2 + 1
        self.k, self.tables, self.size = k, tables, size

    def cells(self, unit: np.ndarray) -> np.ndarray:
        """One 64-bit cell key per vector and table."""
        steps = np.floor(unit @ self.coarse + self.offsets).astype(np.int64)
        steps = steps.reshape(len(unit), self.tables, self.k)
        with np.errstate(over="ignore"):
            keys = (steps * self.factors).sum(axis=2)
            keys ^= keys >> 29
            return keys * 0x5851F42D4C957F2D + np.arange(self.tables) * 1_000_003 + self.size


@lru_cache(maxsize=8)
def lines(size: int, k: int, tables: int, r: float) -> Lines:
    return Lines(size, k, tables, r)


def unit_vectors(rows: list) -> np.ndarray:
    v = np.array(rows, float)
    v /= np.abs(v).max(axis=1, keepdims=True)  # lengths of huge or tiny values stay finite
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def local_components(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest row reachable by links, for each of n rows."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def cell_links(
    unit: np.ndarray, side: np.ndarray, table: int, known: Lines, r: float, cosine: float,
    enough: int,
) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs of rows of one group that this table is the first to bring together.

    ``side``: 0 for all pairs; 1 and 2 for the two blocks of a pair of blocks.
    """
    position = unit @ known.first
    order = np.argsort(position, kind="stable")
    unit, side, position = unit[order], side[order], position[order]
    fine = unit @ known.fine
    ends = np.searchsorted(position, position + FIRST_WINDOW * r, side="right")
    sizes = ends - np.arange(len(unit)) - 1
    total = np.cumsum(sizes)
    found_i, found_j = [], []
    begin = 0
    while begin < len(unit):
        done = total[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(total, done + PAIRS_AT_ONCE, side="right")))
        i = np.repeat(np.arange(begin, end), sizes[begin:end])
        starts = np.cumsum(sizes[begin:end]) - sizes[begin:end]
        j = i + 1 + np.arange(len(i)) - np.repeat(starts, sizes[begin:end])
        begin = end
        apart = (side[i] == 0) | (side[i] != side[j])
        i, j = i[apart], j[apart]
        collisions = (np.abs(fine[i] - fine[j]) <= WINDOW * r).sum(axis=1)
        i, j = i[collisions >= enough], j[collisions >= enough]
        near = np.einsum("ij,ij->i", unit[i], unit[j]) >= cosine
        found_i.append(i[near])
        found_j.append(j[near])
    i, j = np.concatenate(found_i), np.concatenate(found_j)
    if table and len(i):
        rows, place = np.unique(np.concatenate([i, j]), return_inverse=True)
        keys = known.cells(unit[rows])[:, :table]
        left, right = place[: len(i)], place[len(i) :]
        new = np.ones(len(i), bool)
        for at in range(0, len(i), 50_000):
            part = slice(at, at + 50_000)
            new[part] = ~(keys[left[part]] == keys[right[part]]).any(axis=1)
        i, j = i[new], j[new]
    return order[i], order[j]


def near_duplicates(
    vectors: DataFrame, cosine: float = COSINE, key: str = "vec_id", column: str = "embedding"
) -> DataFrame:
    """One row per vector: its key, n_links, component_id and kept."""
    value = F.col(f"`{column}`")
    rows = vectors.select(F.col(f"`{key}`").cast("long").alias("id"), value.alias("v"))
    usable = F.coalesce(
        F.expr("size(v) > 0 and forall(v, x -> x is not null and not isnan(x)"
               " and abs(x) < double('Infinity')) and exists(v, x -> x <> 0)"), F.lit(False)
    )
    real = rows.where(usable & F.col("id").isNotNull())
    # 0.0 and -0.0 are one value
    real = real.withColumn("v", F.expr("transform(v, x -> x + 0)"))
    classes = store(
        real.groupBy("v").agg(F.min("id").alias("rep"), F.count("*").alias("weight")), "vectors"
    )
    n = classes.count()
    r = math.sqrt(2 - 2 * cosine)
    k, tables = plan(n, cosine)
    enough = enough_collisions()

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.to_pydict()
            cells: list = [None] * batch.num_rows
            by_size: dict[int, list[int]] = {}
            for at, v in enumerate(found["v"]):
                by_size.setdefault(len(v), []).append(at)
            for size, ats in by_size.items():
                keys = lines(size, k, tables, r).cells(unit_vectors([found["v"][a] for a in ats]))
                for a, row in zip(ats, keys.tolist()):
                    cells[a] = row
            yield pa.RecordBatch.from_pydict(
                {"id": found["rep"], "cells": pa.array(cells, pa.list_(pa.int64()))}
            )

    cells = store(
        classes.select("rep", "v").mapInArrow(keyed, "id bigint, cells array<bigint>"), "cells"
    )
    spread = cells.select("id", F.posexplode("cells").alias("t", "cell"))
    blocks = spread.groupBy("t", "cell").agg(F.count("*").alias("n")).where("n > 1")
    blocks = blocks.select("t", "cell", F.ceil(F.col("n") / BLOCK).alias("blocks"))
    placed = spread.join(blocks, ["t", "cell"]).withColumn(
        "own", F.expr("pmod(xxhash64(id), blocks)")
    ).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    grouped = placed.select(
        "id", "t", "cell", F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"),
        F.expr("case when own = other then 0 when own < other then 1 else 2 end").alias("side"),
    )
    # a block meets itself with side 0, and another block with sides 1 and 2
    carried = grouped.join(
        classes.select(F.col("rep").alias("id"), "v", "weight"), "id"
    ).repartition("t", "cell", "i", "j").sortWithinPartitions("t", "cell", "i", "j", "id")

    schema = "id bigint, links bigint, root bigint"

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        held_key = None

        def flush():
            table = pa.Table.from_batches(held)
            ids = table["id"].to_numpy()
            flat = table["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
            weight, side = table["weight"].to_numpy(), table["side"].to_numpy()
            sizes = np.asarray(table["v"].combine_chunks().value_lengths())
            if (sizes != sizes[0]).any():  # cells of different lengths share no key
                raise ValueError("vectors of different length in one cell")
            unit = unit_vectors(flat.reshape(len(ids), -1))
            known = lines(unit.shape[1], k, tables, r)
            i, j = cell_links(unit, side, held_key[0], known, r, cosine, enough)
            links = np.zeros(len(ids), np.int64)
            np.add.at(links, i, weight[j])
            np.add.at(links, j, weight[i])
            root = ids[local_components(len(ids), i, j)]
            some = links > 0
            return pa.RecordBatch.from_pydict(
                {"id": ids[some], "links": links[some], "root": root[some]}
            )

        for batch in batches:
            keys = np.stack([batch[c].to_numpy() for c in ("t", "cell", "i", "j")], axis=1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            edges = [0, *cuts.tolist(), len(keys)]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                now = tuple(keys[a].tolist())
                if held and now != held_key:
                    yield flush()
                    held.clear()
                held_key = now
                held.append(batch.slice(a, b - a))
        if held:
            yield flush()

    found = store(
        carried.select("id", "t", "cell", "i", "j", "side", "v", "weight").mapInArrow(
            linked, schema
        ),
        "links",
    )
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    joined = store(
        components(found.select(F.col("id").alias("a"), F.col("root").alias("b"))), "components"
    )
    per_class = (
        classes.join(counts, classes.rep == counts.id, "left").drop("id")
        .join(joined, F.col("rep") == joined.id, "left")
        .select(
            "v", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links"),
            F.coalesce("component_id", "rep").alias("component_id"),
        )
    )
    members = rows.withColumn("v", F.when(usable & F.col("id").isNotNull(),
                                          F.expr("transform(v, x -> x + 0)")))
    out = members.join(per_class, "v", "left").select(
        F.col("id").cast(vectors.schema[key].dataType).alias(key),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
    )
    drop(cells)
    return out.withColumn(
        "kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True))
    )
