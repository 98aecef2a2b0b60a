"""Passages shared by documents, against brute force over all windows."""

from __future__ import annotations

import random
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from millwright.llm import passages


def brute(rows, width):
    """(id, n_words, n_removed, digest) per row, from the smallest id of every window."""
    least, top = {}, 2**63
    split = [(top if i is None else i, (t or "").encode().split()) for i, t in rows]
    for i, words in split:
        for at in range(len(words) - width + 1):
            window = tuple(words[at : at + width])
            least[window] = min(i, least.get(window, top))
    out = []
    for (i, words), (key, _) in zip(split, rows):
        gone = set()
        for at in range(len(words) - width + 1):
            if least[tuple(words[at : at + width])] < i:
                gone.update(range(at, at + width))
        kept = b" ".join(w for n, w in enumerate(words) if n not in gone)
        out.append((key, len(words), len(gone), sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows, parts=5, schema="doc_id long, text string", **options):
    df = spark.createDataFrame(rows, schema).repartition(parts)
    kept = passages.remove_repeats(df, **options)
    names = ("doc_id", "n_words", "n_removed", "kept_sha256")
    out = kept.collect()
    for row in out:
        assert sha256(row.kept.encode()).hexdigest() == row.kept_sha256
    return sorted((tuple(r[n] for n in names) for r in out), key=str)


def shuffled_passages(seed, n=150, lexicon=40):
    """Texts glued from shared passages, cut at random places, some periodic."""
    rng = random.Random(seed)
    words = ["w%d" % i for i in range(lexicon)] + ["é", "日本", "x" * 300]
    bases = [[rng.choice(words) for _ in range(rng.randint(3, 60))] for _ in range(12)]
    bases += [["ha"] * 70, ["a", "b"] * 30, ["a", "b", "c", "a", "b"] * 12]
    rows = []
    for i in range(n):
        text = []
        for _ in range(rng.randint(0, 5)):
            base = rng.choice(bases)
            begin = rng.randrange(len(base))
            text += base[begin : begin + rng.randint(1, 60)]
            text += [rng.choice(words) for _ in range(rng.randint(0, 6))]
        rows.append((i, rng.choice([" ", "\n", " \t", "\x0b"]).join(text)))
    return rows


@pytest.mark.parametrize("width,first", [(13, None), (13, 2), (4, None), (30, 5), (2, None)])
def test_against_all_windows(spark, width, first):
    rows = shuffled_passages(width)
    assert found(spark, rows, width=width, first=first) == brute(rows, width)


def test_flushes_and_segments_change_nothing(spark, monkeypatch):
    rows = shuffled_passages(3)
    expected = brute(rows, 13)
    # tasks run in worker processes, so the limits are set on the driver before they start
    monkeypatch.setattr(passages, "FLUSH", 300)
    assert found(spark, rows) == expected
    monkeypatch.setattr(passages, "FLUSH", 1 << 30)
    assert found(spark, rows, parts=1) == expected


def test_segments_hold_every_window_once(monkeypatch):
    monkeypatch.setattr(passages, "SEGMENT", 64)
    rng = random.Random(1)
    for _ in range(50):
        words = ["v" * rng.choice([1, 2, 3, 90]) for _ in range(rng.randint(0, 60))]
        raw = "  ".join(words).encode()
        windows = [
            (first + at, tuple(part.split()[at : at + 5]))
            for first, part in passages.segments(raw, 5)
            for at in range(len(part.split()) - 4)
        ]
        plain = raw.split()
        assert windows == [(at, tuple(plain[at : at + 5])) for at in range(len(plain) - 4)]


def test_same_number_of_words_as_the_pattern():
    import numpy as np

    raw = "a\x1fb c d  e\x0b\x0cf\r\ng\x85h\x00i ".encode()
    starts, ends = passages.word_bounds(np.frombuffer(raw, np.uint8))
    assert [raw[a:b] for a, b in zip(starts, ends)] == raw.split()


def test_odd_rows(spark):
    line = " ".join(f"p{i}" for i in range(20))
    long = " ".join(f"q{i % 997} {i}" for i in range(150_000))
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, line), (5, line), (5, line + " z"),
        (None, line), (None, line + " end"), (7, long), (8, "x " + long + " y"), (9, "z" * 2_000_000),
        (-3, " ".join(line.split()[:13])), (10, " ".join(["same"] * 5000)),
        (11, " ".join(["same"] * 14)),
    ]
    assert found(spark, rows, parts=3) == brute(rows, 13)


def test_a_third_of_all_rows_in_one_group(spark):
    rng = random.Random(9)
    hot = " ".join(f"h{i}" for i in range(40))
    rows = [(i, hot if i % 3 else " ".join(f"u{rng.random()}" for _ in range(30)))
            for i in range(300)]
    rows += [(5, hot)] * 100
    assert found(spark, rows) == brute(rows, 13)


def test_empty_table_and_clashing_columns(spark):
    schema = "doc_id long, text string, id long, h long, at long, runs string, g long, gone boolean"
    assert found(spark, [], schema=schema) == []
    rows = [(i, t, 1, 2, 3, "r", 4, True) for i, t in shuffled_passages(4, 30)]
    assert found(spark, rows, schema=schema) == brute([r[:2] for r in rows], 13)


def test_registered_query_has_the_contract_columns(spark, sf_dir):
    from millwright.llm import queries

    rows = queries.QUERIES["op11_doubling_passages"](spark, sf_dir)
    assert rows.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    expected = brute([tuple(r) for r in docs.select("doc_id", "text").collect()], 13)
    assert sorted((tuple(r) for r in rows.collect()), key=str) == expected
    assert rows.agg(F.sum("n_removed")).first()[0] > 0
