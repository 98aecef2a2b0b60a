"""Removal of word passages that an earlier document holds too, by level-wise doubling.

A window is ``width`` consecutive words of one document. It is removed with all its words where
its word sequence also starts in a document with a smaller id. Windows are not sorted at once:
the first level looks at shorter ones (half the width by default) and only what repeats there is
extended to twice that length, until the width is reached or no candidates survive.

At a level of length m every surviving window is represented by the m words with the smallest
rank inside it, so equal windows choose the same m words. Neighbouring windows that chose the
same place are a *run* and travel as one row: (g, rank of the m words; r, rank of all words of
the run; its document; its place). One exchange by g and one sort answer, for each run:

* no other document holds g: none of its windows repeats, the run dies;
* a smaller document holds the same (g, r): all its windows are removed;
* g is found in several documents with different r: the run is *open* and goes on, at twice the
  length. Runs at the full width are single windows, so nothing is open after it.

Runs that a few megabytes of text hold twice are decided where they are made, so a passage that
a third of all documents share sends one row per few megabytes to its partition.

Ranks are 64-bit fingerprints, and two windows count as equal where two independent ones (g, r)
agree. Among 10^13 windows (100 TB of text) the chance of one wrong pair is below 10^-10 at the
last level and below 10^-5 for whole runs, whose g already agrees.

Null and empty texts have no words. Documents are told apart by id and text: rows with the same
id and text get the same answer, rows with one id and several texts are judged one by one and
are never "smaller" than each other. A null id counts as the largest. Words longer than a
segment and texts of any length are read whole; columns besides id and text are ignored.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator
from functools import lru_cache, reduce
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millwright.llm.common import text_slices
from millwright.scratch import drop, store

WIDTH = 13
FLUSH = 2 << 20  # bytes of text that are ranked at once
SEGMENT = 1 << 20  # longer texts are cut into overlapping segments
RUN_BITS = 10  # a run holds fewer than 2**10 windows
NO_ID = 2**63 - 1
FACTOR = np.uint64(0x9E3779B97F4A7C15)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, *range(9, 14)]] = True
RUN_SCHEMA = "g bigint, r bigint, id bigint, h bigint, at bigint, gone boolean"


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every word."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~IS_SPACE[data]
    edges = np.diff(inside)
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


@lru_cache(maxsize=2)
def letter_table(lane: int) -> np.ndarray:
    return np.random.default_rng([lane, 11]).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2)


@lru_cache(maxsize=4)
def place_table(lane: int, size: int) -> np.ndarray:
    """Powers of an odd number, one for each place in a word."""
    base = np.random.default_rng([lane, 13]).integers(2**61, 2**62, dtype=np.uint64)
    table = np.full(size, base * np.uint64(2) + np.uint64(1))
    table[0] = 1
    return np.multiply.accumulate(table)


def word_ranks(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lane: int) -> np.ndarray:
    """64-bit rank of each word, from its letters and their places."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sizes = ends - starts
    first = np.cumsum(sizes) - sizes
    place = np.arange(sizes.sum()) - np.repeat(first, sizes)
    table = place_table(lane, 1 << int(sizes.max()).bit_length())
    # odd letters, so that a longer word of the same start differs
    letters = letter_table(lane)[data[~IS_SPACE[data]]] + np.uint64(1)
    return mixed(np.add.reduceat(letters * table[place], first) + sizes.astype(np.uint64))


def window_ranks(words: np.ndarray, length: int) -> np.ndarray:
    """Rank of the ``length`` words from each place on, by doubling."""
    n = max(len(words) - length + 1, 0)
    ranks, size = words, 1
    while size < length:
        step = min(size, length - size)  # the last doubling overlaps
        ranks = mixed(ranks[:-step] * FACTOR + ranks[step:]) if len(ranks) > step else ranks[:0]
        size += step
    return ranks[:n]


def smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each window of ``width`` values."""
    n, size = max(len(values) - width + 1, 0), 1
    if not n:
        return values[:0]
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[:n], values[width - size : width - size + n])


def segments(raw: bytes, width: int) -> Iterator[tuple[int, bytes]]:
    """(number of its first word, bytes): every window lies in one segment."""
    begin, word = 0, 0
    while len(raw) - begin > SEGMENT:
        end = begin + SEGMENT
        while end < len(raw):
            while end < len(raw) and not IS_SPACE[raw[end]]:
                end += 1
            starts, _ = word_bounds(np.frombuffer(raw[begin:end], np.uint8))
            if len(starts) >= width:
                break
            end += SEGMENT  # words of great length
        if end >= len(raw):
            break
        yield word, raw[begin:end]
        word += len(starts) - width + 1
        begin += int(starts[len(starts) - width + 1])
    yield word, raw[begin:]


def runs(pieces: list, length: int, width: int) -> tuple[np.ndarray, ...]:
    """Runs of (id, h, first word, bytes, starts) pieces: (g, r, piece, place, windows).

    ``starts`` are the surviving windows of the document, None for all.
    """
    data = np.frombuffer(b" ".join(p[3] for p in pieces), np.uint8)
    sizes = np.array([len(p[3]) + 1 for p in pieces])
    begins = np.cumsum(sizes) - sizes
    starts, ends = word_bounds(data)
    a = word_ranks(data, starts, ends, 0)
    sample = smallest(window_ranks(a, length), width - length + 1)
    whole = window_ranks(word_ranks(data, starts, ends, 1), width)
    piece = np.searchsorted(begins, starts, side="right") - 1
    n = len(sample)
    leaves = window_ranks(a, length)[:n] == sample
    inside = piece[:n] == piece[width - 1 : width - 1 + n] if n else np.zeros(0, bool)
    first_word = np.searchsorted(starts, begins)
    at = np.arange(n) - first_word[piece[:n]] + np.array([p[2] for p in pieces])[piece[:n]]
    for i, p in enumerate(pieces):
        if p[4] is not None:
            of = slice(first_word[i], min(first_word[i + 1] if i + 1 < len(pieces) else n, n))
            inside[of] &= np.isin(at[of], p[4])
    chosen = np.flatnonzero(inside)
    if not len(chosen):
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    new = np.ones(len(chosen), bool)
    new[1:] = (
        (np.diff(chosen) != 1) | (sample[chosen[1:]] != sample[chosen[:-1]])
        | (piece[chosen[1:]] != piece[chosen[:-1]]) | leaves[chosen[:-1]]
    )
    first = np.flatnonzero(new)
    count = np.diff([*first, len(chosen)])
    head, tail = chosen[first], chosen[first + count - 1]
    r = mixed(whole[head] * FACTOR + whole[tail] + count.astype(np.uint64))
    return sample[head].view(np.int64), r.view(np.int64), piece[head], at[head], count


def level_rows(docs: DataFrame, length: int, width: int) -> DataFrame:
    """Runs of the documents, or of their surviving windows where ``runs`` lists them.

    A run that the same flush holds in a smaller document is ``gone`` and needs no partition
    mates; its g is replaced by one that spreads.
    """
    packed = "runs" in docs.columns
    schema = pa.schema([
        ("g", pa.int64()), ("r", pa.int64()), ("id", pa.int64()), ("h", pa.int64()),
        ("at", pa.int64()), ("gone", pa.bool_()),
    ])

    def flush(pieces):
        g, r, piece, at, count = runs(pieces, length, width)
        ids, hs = (np.array([p[k] for p in pieces], np.int64)[piece] for k in (0, 1))
        order = np.lexsort((ids, r, g))
        same = np.zeros(len(g), bool)
        same[1:] = (g[order[1:]] == g[order[:-1]]) & (r[order[1:]] == r[order[:-1]])
        head = np.maximum.accumulate(np.where(same, 0, np.arange(len(g))))
        gone = np.zeros(len(g), bool)
        gone[order] = ids[order] > ids[order[head]]
        at = (at << RUN_BITS) + count
        g = np.where(gone, mixed((hs + at).view(np.uint64)).view(np.int64), g)
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (g, r, ids, hs, at, gone)],
                                          schema=schema)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()
        held, size, seen = [], 0, set()
        for part in text_slices(batches, "text", FLUSH):
            columns = [part.column(c).to_pylist() for c in ("id", "h", "text")]
            lists = part.column("runs").to_pylist() if packed else [None] * part.num_rows
            for i, h, text, alive in zip(*columns, lists):
                if not text or (i, h) in seen:
                    continue
                seen.add((i, h))
                if alive is not None:
                    alive = expanded(alive)
                for word, raw in segments(text.encode(), width):
                    held.append((i, h, word, raw, alive))
                    size += len(raw)
                    if size >= FLUSH:
                        yield flush(held)
                        held, size, seen = [], 0, {(i, h)}
        if held:
            yield flush(held)

    columns = ["id", "h", "text", *(["runs"] if packed else [])]
    return docs.select(*columns).mapInArrow(rows, RUN_SCHEMA)


def expanded(packed: list[int]) -> np.ndarray:
    """The windows of packed runs."""
    packed = np.array(packed, np.int64)
    at, n = packed >> RUN_BITS, packed & ((1 << RUN_BITS) - 1)
    first = np.cumsum(n) - n
    return np.unique(np.repeat(at - first, n) + np.arange(n.sum()))


def judged(rows: DataFrame) -> DataFrame:
    """(id, h, at, gone): removed runs, and open ones (not gone)."""
    pair, sample = Window.partitionBy("g", "r"), Window.partitionBy("g")
    # dealt by g once: both windows and their sort follow from it
    found = rows.repartition(F.col("g")).select(
        "*", F.min(F.when(~F.col("gone"), F.col("id"))).over(pair).alias("least")
    ).select(
        "id", "h", "at",
        (F.col("gone") | (F.col("id") > F.col("least"))).alias("gone"),
        ((F.min("id").over(sample) < F.max("id").over(sample))
         & (F.min("r").over(sample) < F.max("r").over(sample))).alias("open"),
    )
    return found.where("gone or open").drop("open")


def removed_windows(
    docs: DataFrame, width: int = WIDTH, first: int | None = None
) -> list[DataFrame]:
    """Stored (id, h, at, gone) per level of (id, h, text) documents; gone ones are removed."""
    if not 1 < width < 1 << RUN_BITS:
        raise ValueError(f"a window has 2 to {(1 << RUN_BITS) - 1} words, not {width}")
    length = first or (width + 1) // 2
    levels, now = [], docs
    while True:
        level = store(judged(level_rows(now, length, width)), f"passages-{length}")
        levels.append(level)
        if length == width:
            break
        length = min(2 * length, width)
        still = level.where("not gone")
        if still.isEmpty():  # no candidates survive
            break
        still = still.groupBy("id", "h").agg(F.collect_set("at").alias("runs"))
        now = docs.join(still, ["id", "h"])
    return levels


def remove_repeats(
    docs: DataFrame, width: int = WIDTH, first: int | None = None,
    key: str = "doc_id", text: str = "text", keep_text: bool = True,
) -> DataFrame:
    """One row per document: its key, n_words, n_removed, kept_sha256 and, if wanted, ``kept``,
    the words that are left, joined by one space."""
    kind = docs.schema[key].dataType.simpleString()
    keyed = docs.select(
        F.col(f"`{key}`").alias("key"),
        F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(NO_ID)).alias("id"),
        F.xxhash64(F.col(f"`{text}`")).alias("h"), F.col(f"`{text}`").alias("text"),
    )
    levels = removed_windows(keyed.drop("key"), width, first)
    removed = reduce(DataFrame.unionByName, levels).where("gone")
    per_doc = removed.groupBy("id", "h").agg(F.collect_set("at").alias("runs"))
    joined = keyed.join(per_doc, ["id", "h"], "left").select("key", "text", "runs")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text", FLUSH):
            out = {"n_words": [], "n_removed": [], "kept_sha256": []}
            if keep_text:
                out["kept"] = []
            for body, packed in zip(part.column("text").to_pylist(),
                                    part.column("runs").to_pylist()):
                words = body.encode().split() if body else []
                n = len(words)
                if packed:
                    words = without(words, packed, width)
                kept = b" ".join(words)
                out["n_words"].append(n)
                out["n_removed"].append(n - len(words))
                out["kept_sha256"].append(sha256(kept).hexdigest())
                if keep_text:
                    out["kept"].append(kept.decode())
            arrays = [part.column("key"), *(pa.array(c) for c in out.values())]
            yield pa.RecordBatch.from_arrays(arrays, names=[key, *out])

    result = store(joined.mapInArrow(
        cut, f"`{key}` {kind}, n_words bigint, n_removed bigint, kept_sha256 string"
        + (", kept string" if keep_text else "")
    ), "passages-kept")
    drop(*levels)
    return result


def without(words: list[bytes], packed: list[int], width: int) -> list[bytes]:
    """The words that no removed window covers."""
    packed = np.array(packed, np.int64)
    at, n = packed >> RUN_BITS, packed & ((1 << RUN_BITS) - 1)
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, at, 1)
    np.add.at(depth, at + n + width - 1, -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0)]
