"""Connected components by alternating stars over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.scratch import drop, store


def components(edges: DataFrame) -> DataFrame:
    """(id, component_id) of every node of an edge; the component is its smallest node.

    ``edges`` has the long columns a and b. Every node is hooked to its smallest neighbour,
    first among the larger ones and then among the smaller, until nothing changes; the number
    of rounds grows with the logarithm of the longest path. Minima are partial before they are
    exchanged, and a hot node's join is left to skew handling. Each round is written to the
    shared folder, so a lost executor costs one round at most.
    """
    now = store(_oriented(edges), "edges")
    mark = _mark(now)
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"),
                                                            F.col("m").alias("b"))
        large = _oriented(large)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = store(_oriented(small.unionByName(least.withColumnRenamed("m", "b"))), "edges")
        drop(now)
        now, last, mark = after, mark, _mark(after)
        if mark == last:
            break
    roots = now.select(F.col("b").alias("id"), F.col("b").alias("component_id")).distinct()
    return now.select(F.col("a").alias("id"), F.col("b").alias("component_id")).unionByName(roots)


def _oriented(edges: DataFrame) -> DataFrame:
    return (
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a <> b").distinct()
    )


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")
    ).first()
    return row.n, row.s
