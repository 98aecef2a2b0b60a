"""Exact removal of repeated byte strings, by distributed prefix doubling.

Two positions are duplicates when the ``length`` bytes from them on are equal. Prefix doubling
ranks positions by prefixes of growing length: the rank of a position at length 2h is that of
the pair (its rank at h, the rank at offset h). Ranks are compared for equality only, so a
64-bit fingerprint serves as rank and needs no global numbering. Spark sorts the ranked
positions once per round, and positions whose rank is unique drop out.

Round one, at half the length, sorts sampled positions only: of every ``length`` bytes the
half-length prefix with the smallest fingerprint is sampled, so equal strings sample the same
place, and a string whose sample is unique is unique itself. The strings that sample one place
are consecutive starts, a *run*; its rank pair is (rank of the sample, rank of all its bytes).
A run whose pair was seen earlier repeats as a whole. Runs whose sample has several pairs stay
open. Round two, at the full length, sorts every start of the open runs by the pair (rank at
the start, rank at half the length further on). Every start but the first of its rank is
removed with the bytes it covers.

Long texts are read in overlapping segments, which only cuts runs: starts, and hence results,
stay the same. Null text counts as empty. Every row is a document of its own, numbered when its
text is stored; positions are ordered by id, null last, then by row.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.llm.common import map_rows
from millwright.scratch import drop, store

LENGTH = 100
SEGMENT = 1 << 20
RUN_BITS = 6  # a run holds fewer than 2**6 starts
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


BYTE_RANKS = mixed(np.arange(1, 257, dtype=np.uint64))


def prefix_ranks(data: np.ndarray, length: int) -> np.ndarray:
    """Rank of the ``length`` bytes from each position on, by doubling inside the text."""
    n = len(data) - length + 1
    ranks, size, done, out = BYTE_RANKS[data], 1, 0, None
    while length:
        if length & 1:
            part = ranks[done : done + n]
            out = part.copy() if out is None else mixed(out * FACTOR + part)
            done += size
        length >>= 1
        if length:
            pairs = ranks[:-size] * FACTOR + ranks[size:]
            ranks = pairs ^ (pairs >> np.uint64(31))
            size *= 2
    return mixed(out)


def smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each window of ``width`` values."""
    n, size = len(values) - width + 1, 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[:n], values[width - size : width - size + n])


def segments(raw: bytes, length: int) -> Iterator[tuple[int, bytes]]:
    """(start, bytes) so that every string of ``length`` bytes lies in exactly one."""
    for at in range(0, max(len(raw) - length + 1, 0), SEGMENT):
        yield at, raw[at : at + SEGMENT + length - 1]


def runs(pieces: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """Runs of several pieces: (piece, start, starts in it, rank of sample, rank of run)."""
    half = length // 2
    data = np.frombuffer(b"".join(pieces), np.uint8)
    sizes = np.array([len(p) for p in pieces])
    begins = np.cumsum(sizes) - sizes
    ranks = prefix_ranks(data, half)
    sample = smallest(ranks, length - half + 1)
    whole = prefix_ranks(data, length)
    piece = np.repeat(np.arange(len(pieces)), sizes)[: len(sample)]
    at = np.arange(len(sample)) - begins[piece]
    inside = np.flatnonzero(at <= sizes[piece] - length)
    # a sample at the very start of a string is not in the next one, though its equal may be
    leaves = (ranks[: len(sample)] == sample)[inside]
    piece, at, sample, whole = piece[inside], at[inside], sample[inside], whole[inside]
    new = np.ones(len(at), bool)
    new[1:] = (sample[1:] != sample[:-1]) | (piece[1:] != piece[:-1]) | leaves[:-1]
    first = np.flatnonzero(new)
    # runs of long strings are cut at the limit
    since = np.arange(len(at)) - np.repeat(first, np.diff([*first, len(at)]))
    first = np.flatnonzero(since % ((1 << RUN_BITS) - 1) == 0)
    count = np.diff([*first, len(at)])
    run = mixed(whole[first] * FACTOR + whole[first + count - 1] + count.astype(np.uint64))
    return piece[first], at[first], count, sample[first], run


def sampled_runs(docs: DataFrame, length: int) -> DataFrame:
    """(g, h, id, row, at, done): rank pair of each run, its document, start and size in ``at``.

    A pair that one batch holds twice is decided there (``done``) and leaves as a row without
    rank, so a passage that many documents share sends one row per batch to its partition.
    """

    def make():
        gc.disable()
        unpack = zstandard.ZstdDecompressor().decompress

        def flush(ids, rows, starts, pieces):
            piece, at, count, g, h = runs(pieces, length)
            ids, rows, starts = (np.array(x)[piece] for x in (ids, rows, starts))
            return ids, rows, at + starts, count, g, h

        def work(ids, rows, datas):
            parts, held, size = [], ([], [], [], []), 0
            for i, row, data in zip(ids, rows, datas):
                for start, raw in segments(unpack(data), length):
                    for column, value in zip(held, (i, row, start, raw)):
                        column.append(value)
                    size += len(raw)
                    if size >= SEGMENT:
                        parts.append(flush(*held))
                        held, size = ([], [], [], []), 0
            if size:
                parts.append(flush(*held))
            if not parts:
                return {n: [] for n in ("g", "h", "id", "row", "at", "done")}
            doc, row, at, count, g, h = map(np.concatenate, zip(*parts))
            order = np.lexsort((at, row, doc, h, g))
            g, h, doc, row = g[order], h[order], doc[order], row[order]
            at = (at[order] << RUN_BITS) + count[order]
            done = np.zeros(len(g), bool)
            done[1:] = (g[1:] == g[:-1]) & (h[1:] == h[:-1])
            g = np.where(done, mixed(row.astype(np.uint64)), g)
            columns = (g.view(np.int64), h.view(np.int64), doc, row, at, done)
            return dict(zip(("g", "h", "id", "row", "at", "done"), columns))

        return work

    return map_rows(
        docs, ["id", "row", "data"],
        "g bigint, h bigint, id bigint, row bigint, at bigint, done boolean", make,
    )


def decide(sorted_runs: DataFrame) -> DataFrame:
    """(row, at, open): runs that repeat as a whole, and runs that stay open.

    Rows come sorted by rank pair and position. Only the last sample and its first run are
    carried from batch to batch, so a frequent sample needs no memory.
    """

    def make_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple | None = None  # sample, pair and position of the last row
        alone: tuple | None = None  # first run of the last sample while it has one pair
        for batch in batches:
            g, h, doc, at, done = (
                c.to_numpy(zero_copy_only=False) for c in batch.columns
            )
            out_doc, out_at = [doc[done]], [at[done]]
            out_open = [np.zeros(done.sum(), bool)]
            g, h, doc, at = (c[~done] for c in (g, h, doc, at))
            if len(g):
                new_g, new_h, same = (np.ones(len(g), bool) for _ in range(3))
                new_g[1:] = g[1:] != g[:-1]
                new_h[1:] = new_g[1:] | (h[1:] != h[:-1])
                same[1:] = ~new_h[1:] & (doc[1:] == doc[:-1]) & (at[1:] == at[:-1])
                same[0] = last == (g[0], h[0], doc[0], at[0])
                if last is not None:
                    new_g[0] = g[0] != last[0]
                    new_h[0] = new_g[0] or h[0] != last[1]
                repeat = ~new_h & ~same
                first = np.flatnonzero(new_h)
                follows = np.zeros(len(first), bool)  # another pair of the sample comes next
                follows[:-1] = ~new_g[first[1:]]
                is_open = ~new_g[first] | follows
                if alone is not None and len(first) and not new_g[first[0]]:
                    if first[0] == 0 or not new_g[: first[0] + 1].any():
                        out_doc.append(np.array([alone[0]]))
                        out_at.append(np.array([alone[1]]))
                        out_open.append(np.ones(1, bool))
                        alone = None
                if new_g.any() or len(first):
                    tail = first[-1] if len(first) else None
                    if tail is not None:
                        alone = (doc[tail], at[tail]) if new_g[tail] else None
                for rows, state in ((np.flatnonzero(repeat), False), (first[is_open], True)):
                    out_doc.append(doc[rows])
                    out_at.append(at[rows])
                    out_open.append(np.full(len(rows), state))
                last = (g[-1], h[-1], doc[-1], at[-1])
            yield pa.RecordBatch.from_pydict({
                "row": np.concatenate(out_doc), "at": np.concatenate(out_at),
                "open": np.concatenate(out_open),
            })

    return sorted_runs.select("g", "h", "row", "at", "done").mapInArrow(
        make_rows, "row bigint, at bigint, open boolean"
    )


def open_starts(texts: DataFrame, found: DataFrame, length: int) -> DataFrame:
    """(r, id, row, at): every start of the open runs with its rank pair at the full length."""
    per_doc = found.where("open").groupBy("row").agg(F.collect_list("at").alias("runs"))
    joined = texts.join(per_doc, "row").select("id", "row", "data", "runs")
    half = length // 2

    def make():
        unpack = zstandard.ZstdDecompressor().decompress

        def work(ids, rows, datas, lists):
            out = {"r": [], "id": [], "row": [], "at": []}
            for i, row, data, packed in zip(ids, rows, datas, lists):
                raw = unpack(data)
                packed = np.sort(np.array(packed, np.int64))
                starts, counts = packed >> RUN_BITS, packed & ((1 << RUN_BITS) - 1)
                for low in range(0, len(starts), 4096):
                    s, c = starts[low : low + 4096], counts[low : low + 4096]
                    # the bytes of neighbouring runs, gathered once
                    spans = merged(s, s + c + length - 1)
                    for a, b in spans:
                        for base in range(a, b - length + 1, SEGMENT):
                            piece = np.frombuffer(raw[base : min(b, base + SEGMENT + length - 1)],
                                                  np.uint8)
                            ranks = prefix_ranks(piece, half)
                            pair = mixed(ranks[:-half] * FACTOR + ranks[half:]) if length % 2 == 0 \
                                else prefix_ranks(piece, length)
                            inside = np.zeros(len(pair) + 1, np.int64)
                            lo = np.clip(s - base, 0, len(pair))
                            hi = np.clip(s + c - base, 0, len(pair))
                            np.add.at(inside, lo, 1)
                            np.add.at(inside, hi, -1)
                            at = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
                            out["r"].append(pair[at].view(np.int64))
                            out["at"].append(at + base)
                            out["id"].append(np.full(len(at), i))
                            out["row"].append(np.full(len(at), row))
            return {n: np.concatenate(v) if v else [] for n, v in out.items()}

        return work

    return map_rows(
        joined, ["id", "row", "data", "runs"], "r bigint, id bigint, row bigint, at bigint", make
    )


def repeated_starts(sorted_starts: DataFrame) -> DataFrame:
    """(row, at): starts that are not the first of their rank; rows come sorted by rank."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = first = None
        for batch in batches:
            if not batch.num_rows:
                continue
            r, doc, at = (c.to_numpy() for c in batch.columns)
            new = np.ones(len(r), bool)
            new[1:] = r[1:] != r[:-1]
            if last is not None and r[0] == last:
                new[0] = False
            # position of the first row of each rank
            heads = np.flatnonzero(new)
            group = np.cumsum(new) - 1
            head_doc = np.where(group >= 0, doc[heads[group]] if len(heads) else 0, 0)
            head_at = np.where(group >= 0, at[heads[group]] if len(heads) else 0, 0)
            if first is not None:
                head_doc[group < 0], head_at[group < 0] = first
            repeat = ~new & ((doc != head_doc) | (at != head_at))
            last, first = r[-1], (head_doc[-1], head_at[-1])
            yield pa.RecordBatch.from_pydict({"row": doc[repeat], "at": at[repeat]})

    return sorted_starts.select("r", "row", "at").mapInArrow(rows, "row bigint, at bigint")


def merged(begins: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Union of spans as maximal spans in order."""
    if not len(begins):
        return []
    order = np.argsort(begins, kind="stable")
    begins, reach = begins[order], np.maximum.accumulate(ends[order])
    cut = np.flatnonzero(begins[1:] > reach[:-1]) + 1
    return list(zip(begins[[0, *cut]].tolist(), reach[[*(cut - 1), len(reach) - 1]].tolist()))


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: its key, n_bytes, n_removed, n_spans and kept_sha256."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    id_column = F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(2**62))
    def pack():
        squeeze = zstandard.ZstdCompressor(level=1).compress

        def work(ids, rows, keys, texts):
            datas = [squeeze((t or "").encode()) for t in texts]
            return {"id": ids, "row": rows, "key": keys, "data": datas}

        return work

    kind = docs.schema[key].dataType.simpleString()
    # numbers of rows hold only once they are written
    packed = store(map_rows(
        docs.select(id_column.alias("id"), F.monotonically_increasing_id().alias("row"),
                    F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")),
        ["id", "row", "key", "text"], f"id bigint, row bigint, key {kind}, data binary", pack,
    ), "packed")
    ranked = sampled_runs(packed, length).repartition(n, "g").sortWithinPartitions(
        "g", "h", "id", "row", "at"
    )
    found = store(decide(ranked), "runs")
    # dealt by document once, for both joins
    texts = packed.repartition(n, "row").persist(StorageLevel.MEMORY_AND_DISK)
    starts = open_starts(texts, found, length).repartition(n, "r").sortWithinPartitions(
        "r", "id", "row", "at"
    )
    single = repeated_starts(starts).select("row", ((F.col("at") * 2**RUN_BITS) + 1).alias("at"))
    removed = found.where("not open").select("row", "at").unionByName(single)
    per_doc = removed.groupBy("row").agg(F.collect_list("at").alias("runs"))

    def cut():
        unpack = zstandard.ZstdDecompressor().decompress

        def work(keys, datas, lists):
            out = {key: keys, "n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": []}
            for data, packed in zip(datas, lists):
                raw = unpack(data)
                packed = np.array(packed or [], np.int64)
                starts, counts = packed >> RUN_BITS, packed & ((1 << RUN_BITS) - 1)
                spans = merged(starts, starts + counts + length - 1)
                kept, at, gone = sha256(), 0, 0
                for a, b in spans:
                    kept.update(raw[at:a])
                    at, gone = b, gone + b - a
                kept.update(raw[at:])
                out["n_bytes"].append(len(raw))
                out["n_removed"].append(gone)
                out["n_spans"].append(len(spans))
                out["kept_sha256"].append(kept.hexdigest())
            return out

        return work

    result = store(map_rows(
        texts.join(per_doc, "row", "left").select("key", "data", "runs"),
        ["key", "data", "runs"],
        f"{key} {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
        cut,
    ), "kept")
    texts.unpersist()
    drop(found, packed)
    return result
