"""Product codes against plain Lloyd rounds in Python integers."""

from __future__ import annotations

import math
from hashlib import sha256

import numpy as np
import pytest

from millwright.llm import codes


def brute(rows, parts=4, entries=256, rounds=4):
    """{(vec_id, vector): (code, error)} and label errors, with Python integers only."""
    kept = []
    for i, vector, label in rows:
        if vector and None not in vector and all(map(math.isfinite, vector)):
            kept.append((i, [math.floor(1024 * x) for x in vector], label))
    kept.sort(key=lambda r: (r[0] is None, r[0], r[1]))
    size = len(kept[0][1]) // parts
    cut = [[v[p * size : (p + 1) * size] for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(book, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for c in cut:
                members.setdefault(nearest(books[p], c[p])[1], []).append(c[p])
            for k, found in members.items():
                books[p][k] = [sum(col) // len(found) for col in zip(*found)]
    out, by_label = [], {}
    for (i, _, label), c in zip(kept, cut):
        best = [nearest(books[p], c[p]) for p in range(parts)]
        error = sum(d for d, _ in best)
        by_label[label] = by_label.get(label, 0) + error
        out.append((i, "".join("%02x" % k for _, k in best), error, label))
    text = ",".join(str(x) for book in books for entry in book for x in entry)
    digest = sha256(text.encode()).hexdigest()
    return sorted(((i, code, e, by_label[label], digest) for i, code, e, label in out), key=str)


SCHEMA = "vec_id long, embedding array<float>, label int"


def found(spark, rows, schema=SCHEMA, parts=3, **options):
    df = spark.createDataFrame(rows, schema).repartition(parts)
    table = codes.code_table(df, **options)
    assert table.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted((tuple(r) for r in table.collect()), key=str)


def clouds(seed, n, size, spread=0.1):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((30, size))
    v = centres[rng.integers(0, 30, n)] + spread * rng.standard_normal((n, size))
    return [(int(i), v[i].astype(np.float32).astype(float).tolist(),
             None if i % 5 == 0 else int(i % 3)) for i in rng.permutation(n)]


def test_against_plain_rounds(spark):
    rows = clouds(1, 500, 8)
    assert found(spark, rows) == brute(rows)


@pytest.mark.parametrize("entries,rounds", [(1, 2), (7, 9), (40, 0), (40, 6)])
def test_other_sizes(spark, entries, rounds):
    rows = clouds(2, 150, 8, spread=0.5)
    assert found(spark, rows, entries=entries, rounds=rounds) == brute(
        rows, entries=entries, rounds=rounds)


def test_few_values_many_ties(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.integers(-1, 2, 4) / 1024).tolist(), 1) for i in range(300)]
    assert found(spark, rows, entries=20) == brute(rows, entries=20)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = clouds(4, 30, 4) + [
        (100, None, 1), (101, [], 1), (102, [1.0, None, 2.0, 3.0], 1), (103, [nan] * 4, None),
        (104, [inf, 0.0, 0.0, 0.0], 2), (None, [1.0, 2.0, 3.0, 4.0], None),
        (None, [1.0, 2.0, 3.0, 5.0], 7), (5, [0.0, 0.0, 0.0, 0.0], 7), (5, [0.0] * 4, 7),
        (5, [-0.0001] * 4, 7), (105, [60000.0, -60000.0, 0.5, 0.25], 2),
    ]
    assert found(spark, rows) == brute(rows)
    # a vector of another length than that of the smallest id is left out
    assert found(spark, rows + [(900, [1.0] * 8, 1)]) == brute(rows)


def test_empty_tables_and_clashing_columns(spark):
    extra = ", x string, code string, error string, of int, bound int, n long, slot long"
    assert found(spark, [], SCHEMA + extra) == []
    assert found(spark, [(1, None, 1), (2, [], 1)]) == []
    rows = clouds(5, 40, 4)
    more = [(*r, "x", "c", "e", 1, 2, 3, 4) for r in rows]
    assert found(spark, more, SCHEMA + extra, entries=9) == brute(rows, entries=9)


def test_a_length_that_cannot_be_cut_is_an_error(spark):
    with pytest.raises(ValueError, match="equal parts"):
        found(spark, [(1, [1.0, 2.0, 3.0], 1)])


def test_bounds_skip_most_entries_and_net_moves_are_shorter():
    rng = np.random.default_rng(6)
    centres = rng.integers(-900, 900, (64, 16))
    x = centres[rng.integers(0, 64, 4000)] + rng.integers(-40, 40, (4000, 16))
    book = x[:64].copy()
    groups = codes.neighbours(book, 16)
    assert sorted(np.concatenate(groups).tolist()) == list(range(64))
    history, state, scans, drift = [book], (None, None, None), [], np.zeros(64)
    for _ in range(6):
        code, d, bound, stamp, scanned = codes.assign(x, history, groups, *state)
        full = codes.squared_distances(x, history[-1])
        assert (code == full.argmin(axis=1)).all() and (d == full.min(axis=1)).all()
        state = (code, bound, stamp)
        scans.append(scanned)
        new = history[-1].copy()
        for k in np.unique(code):
            new[k] = x[code == k].sum(axis=0) // (code == k).sum()
        drift += np.sqrt(((new - history[-1]) ** 2).sum(axis=1))
        history.append(new)
    net = np.sqrt(((history[-1] - history[0]) ** 2).sum(axis=1))
    assert (net <= drift + 1e-9).all() and (net < drift - 1).any()
    assert scans[0] == 4000 * 64 and scans[-1] < 0.5 * scans[0]


def test_exact_beyond_doubles():
    x = np.array([[2**26, -(2**26), 5], [3, 4, 5]])
    d = codes.squared_distances(x, np.array([[-(2**26), 2**26, 4], [3, 4, 6]]))
    assert d.tolist() == [[2 * 2**54 + 1, (2**26 - 3) ** 2 + (2**26 + 4) ** 2 + 1],
                          [(2**26 + 3) ** 2 + (2**26 - 4) ** 2 + 1, 1]]


def test_registered_query(spark, sf_dir):
    from millwright.llm import queries

    rows = queries.QUERIES["op12_net_bound_codes"](spark, sf_dir)
    source = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    data = [tuple(r) for r in source.select("vec_id", "embedding", "label").collect()]
    assert sorted((tuple(r) for r in rows.collect()), key=str) == brute(data)
