"""Phrase counts and scores against plain counting, filters against dictionaries."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from millwright.llm import phrases


def brute(rows, longest=5, min_count=100, top=2000, redundant=(100, 100)):
    n, f = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", lower):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for at in range(len(words) - k + 1):
                    f[lang, tuple(words[at : at + k])] += 1
    often = {key: a for key, a in f.items() if a >= min_count and len(key[1]) > 1}
    found = {}
    for (lang, gram), a in often.items():
        inside = any(
            of == lang and len(big) > len(gram) and b * redundant[1] >= a * redundant[0]
            and any(big[i : i + len(gram)] == gram for i in range(len(big)))
            for (of, big), b in often.items()
        )
        if not inside:
            cuts = [(1000 * a * n[lang] // (f[lang, gram[:k]] * f[lang, gram[k:]]), k)
                    for k in range(1, len(gram))]
            score, k = min(cuts)
            found.setdefault(lang, []).append(
                (-score, -a, " ".join(gram).encode(), f[lang, gram[:k]], f[lang, gram[k:]]))
    out = []
    for lang, rows in found.items():
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def found(spark, rows, schema="text string, lang string", **options):
    table = phrases.collocations(spark.createDataFrame(rows, schema).repartition(4), **options)
    assert table.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in table.collect())


def prose(seed, n=200):
    rng = random.Random(seed)
    words = [w + e for w in "an Be do it Ox up Él 日本 x1 q'z".split() for e in ("", "a", "Z")]
    idioms = [[rng.choice(words) for _ in range(rng.randint(2, 7))] for _ in range(8)]
    rows = []
    for i in range(n):
        text = []
        for _ in range(rng.randint(0, 25)):
            text += rng.choice(idioms) if rng.random() < 0.4 else [rng.choice(words)]
            text.append(rng.choice(["", "", "", ".", ",", "\n", "!?", "\t", "\x0b", "\r"]))
        rows.append((" ".join(text), rng.choice(["en", "en", "en", "de", None, "und", ""])))
    return rows


@pytest.mark.parametrize("options", [
    {"min_count": 5}, {"min_count": 2, "longest": 4}, {"min_count": 3, "top": 7},
    {"min_count": 4, "redundant": (80, 100)}, {"min_count": 1, "longest": 3, "top": 50},
])
def test_against_plain_counts(spark, options):
    rows = prose(7)
    assert found(spark, rows, **options) == brute(rows, **options)


def test_small_flushes_shards_and_a_full_bitmap_change_nothing(spark, monkeypatch):
    rows = prose(8)
    expected = brute(rows, min_count=3)
    for name, value in (("CHUNK", 200), ("GRAMS_HELD", 50), ("GRAMS_A_SHARD", 40)):
        monkeypatch.setattr(phrases, name, value)
    assert found(spark, rows, min_count=3) == expected


def test_odd_rows(spark):
    hot = "the same words again and again. "
    rows = [(None, "en"), ("", "en"), (" .,;\n", "en"), ("One", None), (hot * 3000, "en"),
            ("A" * 100_000 + " b", "fr"), ("a b " * 60, None), ("a b " * 60, "und"), (None, None)]
    rows += [(hot, "de")] * 150
    assert found(spark, rows) == brute(rows)


def test_empty_table_and_clashing_columns(spark):
    extra = ", chunk long, id long, f long, n long, word string, gram string, rank long, k int"
    schema = "text string, lang string" + extra
    assert found(spark, [], schema) == []
    assert found(spark, [(None, "en", 1, 2, 3, 4, "w", "g", 5, 6)], schema) == []
    rows = prose(9, 60)
    more = [(*r, 1, 2, 3, 4, "w", "g", 5, 6) for r in rows]
    assert found(spark, more, schema, min_count=4) == brute(rows, min_count=4)


@pytest.mark.parametrize("n,bits", [(2, 1), (2, 9), (3, 17), (5, 13), (5, 25), (4, 32), (5, 32)])
def test_filters_are_lossless(n, bits):
    rng = np.random.default_rng(n * bits)
    rows = rng.integers(0, 1 << bits, (3000, n), dtype=np.uint64)
    rows = rows[rng.integers(0, rng.integers(1, 3000), 6000)]
    plain = Counter(map(tuple, rows.tolist()))
    columns = [rows[:, i] for i in range(n)]
    mixed = phrases.permuted(columns, bits)
    assert all((a == b).all() for a, b in zip(phrases.restored(mixed, bits), columns))
    assert max(int(c.max()) for c in mixed) < 1 << bits
    weight = np.where(np.arange(6000) % 100 == 0, 300, 1)
    for shard_bits in (0, 1, min(6, phrases.widths(n, bits)[0])):
        merged: dict[int, list] = {}
        for half in (slice(0, 2500), slice(2500, 6000)):
            words, counts = phrases.counted(
                [w[half] for w in phrases.packed(mixed, bits)], np.ones(6000, np.int64)[half])
            for shard, raw in phrases.filters(words, counts, n, bits, shard_bits):
                merged.setdefault(shard, []).append(phrases.decode(raw, n, bits))
        total = Counter()
        for parts in merged.values():
            words, counts = phrases.counted(
                [np.concatenate(w) for w in zip(*(p[0] for p in parts))],
                np.concatenate([p[1] for p in parts]))
            back = phrases.restored(phrases.unpacked(words, n, bits), bits)
            total.update(dict(zip(zip(*(c.tolist() for c in back)), counts.tolist())))
        assert total == plain
    words, counts = phrases.counted(phrases.packed(mixed, bits), weight)
    ((_, raw),) = phrases.filters(words, counts, n, bits, 0)
    again, same = phrases.decode(raw, n, bits)
    assert (same == counts).all() and all((a == b).all() for a, b in zip(again, words))


def test_a_filter_is_smaller_than_its_keys():
    rng = np.random.default_rng(1)
    columns = [rng.integers(0, 1 << 16, 100_000).astype(np.uint64) for _ in range(4)]
    words, counts = phrases.counted(
        phrases.packed(phrases.permuted(columns, 16), 16), np.ones(100_000, np.int64))
    ((_, raw),) = phrases.filters(words, counts, 4, 16, 0)
    assert len(raw) < 100_000 * (8 + 1)


def test_registered_query(spark, sf_dir):
    from millwright.llm import queries

    rows = queries.QUERIES["op13_quotient_phrases"](spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", "lang")
    assert sorted(tuple(r) for r in rows.collect()) == brute([tuple(r) for r in docs.collect()])
