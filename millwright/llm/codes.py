"""Vector code compression: product codebooks learnt by exact integer Lloyd rounds.

Vectors become whole numbers and are cut into equal parts; every part position has a codebook,
and a vector's code names the nearest entry of each. All arithmetic is exact, so the codes do
not depend on how rows are dealt to tasks.

A round need not compare a part with every entry. The entries of a codebook form groups of
neighbours. For each part and group a lower bound of the distance to the group's entries (but
the assigned one) is kept together with the round it was computed in, its *stamp*, and the
codebooks of all rounds are retained. The bound holds today after subtracting the largest *net*
displacement of the group's entries since that round: the norm of the sum of the moves. Adding
up the norms of single moves, as a bound without history must, is never smaller and grows even
where entries swing to and fro. Only groups whose bound does not exceed the exact distance to
the assigned entry are scanned again, with exact distances and ties to the lower index.

Each pass reads the rows with their bounds and writes them anew to the shared folder, where a
lost executor finds them. Sums are partial per task and per executor before they are exchanged;
the driver sees codebooks only (entries x components, whatever the number of rows).

Left out: null vectors, vectors with null or non-finite components, vectors without components,
and vectors whose length differs from that of the smallest kept id. Rows with equal ids are
vectors of their own; a null id is the largest; ties in the id are broken by the components. A
table of fewer rows than entries has as many entries as rows. Whole numbers beyond 2**26 (or a
length that cannot be cut) are an error, as their squared distances may pass 64 bits. Columns
besides id, vector and label are ignored, and without a label column all labels are null.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.scratch import drop, store

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
GROUPS = 16
LARGEST = 1 << 26
ROWS_AT_ONCE = 8192
FAR = np.iinfo(np.int64).max


def packed(numbers: np.ndarray) -> bytes:
    """Whole numbers as bytes that sort as the numbers do."""
    return (numbers.astype(np.int64) + 2**31).astype(">u4").tobytes()


def unpacked(rows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(rows), ">u4").astype(np.int64) - 2**31


def whole_numbers(column: pa.ListArray, scale: int) -> tuple[list[int], list[np.ndarray]]:
    """Row numbers and whole components of the usable vectors."""
    rows, values = [], []
    for row, vector in enumerate(column.to_pylist()):
        if not vector or None in vector:
            continue
        v = np.array(vector, np.float64)
        if np.isfinite(v).all():
            rows.append(row)
            values.append(np.floor(v * scale))
    return rows, values


def integers(vectors: DataFrame, key: str, vector: str, label: str | None, scale: int) -> DataFrame:
    """(vec_id, label, x): usable vectors as packed 32-bit whole numbers."""
    kind = vectors.schema[key].dataType.simpleString()
    label_kind = vectors.schema[label].dataType.simpleString() if label else "int"

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                kept, values = whole_numbers(part.column("v"), scale)
                for v in values:
                    if np.abs(v).max() > LARGEST:
                        raise ValueError(f"component {np.abs(v).max() / scale} is too large")
                x = pa.array([packed(v) for v in values], pa.binary())
                kept = pa.array(kept, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id").take(kept), part.column("label").take(kept), x],
                    names=["vec_id", "label", "x"],
                )

    return vectors.select(
        F.col(f"`{key}`").alias("vec_id"),
        (F.col(f"`{label}`") if label else F.lit(None).cast("int")).alias("label"),
        F.col(f"`{vector}`").cast("array<double>").alias("v"),
    ).mapInArrow(rows, f"vec_id {kind}, label {label_kind}, x binary")


def squared_distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to entries."""
    largest = max(int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if x.shape[1] * (2 * largest) ** 2 < 2**53:  # every sum is a whole number a double holds
        a, b = x.astype(np.float64), entries.astype(np.float64)
        both = (a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)
        return both.astype(np.int64)
    if x.shape[1] * (2 * largest) ** 2 >= 2**63:
        raise ValueError("squared distances pass 64 bits")
    out = np.zeros((len(x), len(entries)), np.int64)
    for column in range(x.shape[1]):
        out += (x[:, column, None] - entries[None, :, column]) ** 2
    return out


def neighbours(entries: np.ndarray, groups: int) -> list[np.ndarray]:
    """Groups of near entries: halves along the widest component, again and again."""
    found = [np.arange(len(entries))]
    while len(found) < groups and max(map(len, found)) > 1:
        halves = []
        for members in found:
            spread = np.ptp(entries[members], axis=0) if len(members) else np.zeros(1)
            widest = int(np.argmax(spread)) if entries.shape[1] else 0
            order = members[np.argsort(entries[members, widest], kind="stable")]
            halves += [np.sort(order[: len(order) // 2]), np.sort(order[len(order) // 2 :])]
        found = [members for members in halves if len(members)]
    return found


def net_displacements(history: list[np.ndarray], groups: list[np.ndarray]) -> np.ndarray:
    """[round, group]: how far an entry of the group has come since that round, at most."""
    now = history[-1]
    out = np.zeros((len(history), len(groups)))
    for stamp, then in enumerate(history):
        moved = np.sqrt(((now - then).astype(np.float64) ** 2).sum(axis=1))
        out[stamp] = [moved[members].max() for members in groups]
    return out * (1 + 1e-9)  # rounding must not shorten a move


def assign(
    x: np.ndarray, history: list[np.ndarray], groups: list[np.ndarray],
    code: np.ndarray | None, bound: np.ndarray | None, stamp: np.ndarray | None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """(code, squared distance, bound, stamp, scanned): nearest entries of today's codebook.

    Without a code every group is scanned. ``scanned`` counts exact distances.
    """
    entries, now = history[-1], len(history) - 1
    n, rows = len(x), np.arange(len(x))
    best = np.full((n, len(groups)), FAR)  # the nearest of each scanned group, and the next
    best_at = np.zeros((n, len(groups)), np.int64)
    second = np.full((n, len(groups)), FAR)
    if code is None:
        code = np.zeros(n, np.int64)
        old = np.full(n, FAR)
        need = np.ones((n, len(groups)), bool)
        bound = np.zeros((n, len(groups)), np.int64)
        stamp = np.zeros((n, len(groups)), np.int64)
        scanned = 0
    else:
        gap = x - entries[code]
        old = (gap * gap).sum(axis=1)
        lower = bound - net_displacements(history, groups)[stamp, np.arange(len(groups))]
        need = lower <= np.sqrt(old.astype(np.float64))[:, None] * (1 + 1e-9)
        scanned = n
    group_of = np.zeros(len(entries), np.int64)
    for g, members in enumerate(groups):
        group_of[members] = g
        at = np.flatnonzero(need[:, g])
        if not len(at):
            continue
        d = squared_distances(x[at], entries[members])
        scanned += d.size
        least = np.argmin(d, axis=1)  # members ascend, so ties go to the lower index
        best[at, g] = d[np.arange(len(at)), least]
        best_at[at, g] = members[least]
        if len(members) > 1:
            second[at, g] = np.partition(d, 1, axis=1)[:, 1]
    new_d, new = old.copy(), np.where(old == FAR, len(entries), code)
    for g in range(len(groups)):
        closer = (best[:, g] < new_d) | ((best[:, g] == new_d) & (best_at[:, g] < new)
                                         & (best[:, g] < FAR))
        new_d = np.where(closer, best[:, g], new_d)
        new = np.where(closer, best_at[:, g], new)
    # bounds of scanned groups leave the assigned entry out
    fresh = best.copy()
    fresh[rows, group_of[new]] = second[rows, group_of[new]]
    whole = np.floor(np.sqrt(fresh.astype(np.float64)) * (1 - 1e-9))
    bound = np.where(need, np.minimum(whole, 65535).astype(np.int64), bound)
    stamp = np.where(need, now, stamp)
    # a group that was not scanned but has lost its assigned entry must cover it again
    left = np.flatnonzero((new != code) & ~need[rows, group_of[code]])
    if len(left):
        g = group_of[code[left]]
        cover = np.minimum(lower[left, g], np.sqrt(old[left].astype(np.float64)) * (1 - 1e-9))
        bound[left, g] = np.clip(np.floor(cover), 0, 65535).astype(np.int64)
        stamp[left, g] = now
    return new, new_d, bound, stamp, scanned


def assigned(rows: DataFrame, history: list[list[np.ndarray]], groups: list, last: bool) -> DataFrame:
    """The rows with today's codes and bounds; in the last pass with the error instead."""
    parts, first = len(history), "code" not in rows.columns
    size = history[0][0].shape[1]
    names = ["vec_id", "label", "x"] + ([] if first else ["code", "bound", "stamp"])
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:2]]
    schema = kept + (["code binary", "error bigint"] if last else
                     ["x binary", "code binary", "bound binary", "stamp binary"])

    def state_of(column, kind):
        held = np.frombuffer(b"".join(column.to_pylist()), kind).astype(np.int64)
        return held.reshape(len(column), parts, -1)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                yield coded(batch.slice(at, ROWS_AT_ONCE))

    def coded(batch):
        n = batch.num_rows
        x = unpacked(batch.column("x").to_pylist()).reshape(n, parts, size)
        codes = np.zeros((n, parts), np.uint8)
        error = np.zeros(n, np.int64)
        state = [[], []]
        if not first:
            old = [state_of(batch.column(c), k)
                   for c, k in (("code", "u1"), ("bound", "<u2"), ("stamp", "u1"))]
        for p in range(parts):
            mine = (None, None, None) if first else (old[0][:, p, 0], old[1][:, p], old[2][:, p])
            new, d, bound, stamp, _ = assign(x[:, p], history[p], groups[p], *mine)
            codes[:, p] = new
            error += d
            state[0].append(bound.astype("<u2"))
            state[1].append(stamp.astype("u1"))
        columns = [batch.column("vec_id"), batch.column("label")]
        if last:
            columns += [strings(codes), pa.array(error)]
        else:
            bounds, stamps = (np.stack(s, axis=1) for s in state)
            columns += [batch.column("x"), strings(codes), strings(bounds), strings(stamps)]
        return pa.RecordBatch.from_arrays(columns, names=[s.split()[0].strip("`") for s in schema])

    def strings(array):
        return pa.array([row.tobytes() for row in array], pa.binary())

    return rows.select(*names).mapInArrow(work, ", ".join(schema))


def entry_sums(rows: DataFrame, parts: int, entries: int, size: int) -> DataFrame:
    """(slot, n, s): count and component sum by part, entry and place; one set per task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, size), np.int64)
        count = np.zeros((parts, entries), np.int64)
        for batch in batches:
            x = unpacked(batch.column("x").to_pylist()).reshape(batch.num_rows, parts, size)
            code = np.frombuffer(b"".join(batch.column("code").to_pylist()), "u1")
            code = code.reshape(batch.num_rows, parts)
            for p in range(parts):
                order = np.argsort(code[:, p], kind="stable")
                mine = code[order, p]
                heads = np.flatnonzero(np.diff(mine, prepend=-1) != 0) if len(mine) else []
                if len(heads):
                    total[p, mine[heads]] += np.add.reduceat(x[order, p], heads)
                    count[p] += np.bincount(mine, minlength=entries)
        used = np.flatnonzero(np.repeat(count.ravel(), size))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(count.ravel()[used // size]), pa.array(total.ravel()[used])],
            names=["slot", "n", "s"],
        )

    sums = rows.select("x", "code").mapInArrow(work, "slot bigint, n bigint, s bigint")
    return sums.groupBy("slot").agg(
        F.sum(F.col("n").cast("decimal(38,0)")).alias("n"),
        F.sum(F.col("s").cast("decimal(38,0)")).alias("s"),
    )


def moved(books: list[np.ndarray], sums: list) -> list[np.ndarray]:
    """Entries replaced by the floor of their mean; unused ones stay."""
    flat = np.stack(books).copy()
    shape = flat.shape
    flat = flat.reshape(-1)
    for row in sums:
        flat[row.slot] = int(row.s) // int(row.n)
    return list(flat.reshape(shape))


def compress(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
    scale: int = SCALE, groups: int = GROUPS,
    key: str = "vec_id", vector: str = "embedding", label: str | None = "label",
) -> tuple[DataFrame, list[np.ndarray]]:
    """(vec_id, label, code, error) of every usable vector, and the final codebooks by part."""
    if not 1 <= entries <= 256:
        raise ValueError("a code byte names 1 to 256 entries")
    rows = store(integers(vectors, key, vector, label, scale), "code-vectors")
    start = rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).collect()
    length = len(start[0].x) // 4 if start else 0
    if length % parts:
        raise ValueError(f"{length} components cannot be cut into {parts} equal parts")
    same = rows.where(F.octet_length("x") == 4 * length)
    if any(len(row.x) != 4 * length for row in start):
        start = same.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).collect()
    size = length // parts
    flat = unpacked([row.x for row in start]).reshape(len(start), parts, size)
    books = [flat[:, p] for p in range(parts)]
    if not start:
        codes = rows.select("vec_id", "label", F.col("x").alias("code"),
                            F.lit(0).cast("long").alias("error"))
        return codes, books
    near = [neighbours(book, groups) for book in books]
    history, now = [[book] for book in books], same
    for _ in range(rounds):
        after = store(assigned(now, history, near, last=False), "code-rows")
        drop(rows if now is same else now)
        now = after
        books = moved(books, entry_sums(now, parts, len(start), size).collect())
        for past, book in zip(history, books):
            past.append(book)
    codes = store(assigned(now, history, near, last=True), "codes")
    drop(rows, now)
    return codes, books


def digest(books: list[np.ndarray]) -> str:
    """Lowercase hex of all entries' decimal components by part, entry and place."""
    return sha256(",".join(str(v) for book in books for v in book.ravel().tolist()).encode()).hexdigest()


def code_table(vectors: DataFrame, **options) -> DataFrame:
    """vec_id, code in hex, error, the error of all vectors of its label, codebook digest."""
    codes, books = compress(vectors, **options)
    by_label = codes.groupBy(F.col("label").alias("of")).agg(
        F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error")
    )
    return codes.join(by_label, F.col("label").eqNullSafe(F.col("of"))).select(
        F.col("vec_id").alias(options.get("key", "vec_id")),
        F.lower(F.hex("code")).alias("code"), "error", "label_error",
        F.lit(digest(books)).alias("codebooks_sha256"),
    )
