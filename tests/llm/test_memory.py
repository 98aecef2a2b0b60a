"""What text workers remember is bounded and changes no result."""

from __future__ import annotations

import random

import pyarrow as pa
import pytest

from millwright.llm import bpe, common, packing
from millwright.llm.common import vocabulary_path


def texts(seed, n=60):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(30)] + ["the", " ", "\n", "é", "<|endoftext|>", "x" * 400]
    return [None if rng.random() < 0.1 else " ".join(rng.choices(words, k=rng.randrange(20)))
            for _ in range(n)]


def test_coder_that_forgets_gives_the_same_ids():
    source = open(vocabulary_path("byte_bpe_50k.json"), encoding="utf-8").read()
    merges = bpe.Merges(source)
    lexicon = bpe.Transducer.compile([b"w1", b" w2"], merges.encode([b"w1", b" w2"]))
    small, large = (bpe.Coder(merges, lexicon, cached) for cached in (8, 10**6))
    for seed in range(6):
        assert small.texts(texts(seed)) == large.texts(texts(seed))
    assert len(small.before) + len(small.known) < len(large.known) + 60


def test_word_ids_that_forget_are_the_same(monkeypatch):
    source = open(vocabulary_path("word_bpe_49k.json"), encoding="utf-8").read()
    large, small = packing.WordIds(source), packing.WordIds(source)
    wanted = [large.texts(texts(seed)) for seed in range(6)]
    monkeypatch.setattr(packing, "CACHED_WORDS", 6)
    assert [small.texts(texts(seed)) for seed in range(6)] == wanted


def test_word_ids_are_those_of_each_word_alone():
    source = open(vocabulary_path("word_bpe_49k.json"), encoding="utf-8").read()
    words = ["a", "\x01", "x\x01y", "", "\u0301e", "e\u0301", "ΟΔΟΣ", "don't.", "\t", "a\u00a0b",
             "\x02", "<|endoftext|>", "q<|", "#$%", "\u1e9b\u0323", "İ", "\u2028", "0x1F"] * 3
    memory = packing.WordIds(source)
    found = memory.texts([" ".join(words), " ".join(reversed(words))])
    alone = [memory.tokenizer.encode(w, add_special_tokens=False).ids for w in words]
    flat = [i for ids in alone for i in ids], [i for ids in reversed(alone) for i in ids]
    assert [list(memoryview(f).cast("I")) for f in found] == list(flat)
    assert list(flat[0]) == memory.tokenizer.encode(" ".join(words), add_special_tokens=False).ids


def test_a_packing_worker_remembers_little():
    """Two generations of words in each of an executor's workers, beside the JVM's heap."""
    assert 2 * packing.CACHED_WORDS <= 500_000


@pytest.mark.parametrize("limit", [1, 7, 10**6])
def test_slices_hold_all_rows_in_order(limit):
    rows = [None, "", "a", "bb" * 9, None, "é" * 3, "", "c" * 40]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(rows))), pa.array(rows)], names=["n", "text"])
    parts = list(common.text_slices([batch, batch.slice(0, 0), batch.slice(2, 3)], "text", limit))
    assert [r for p in parts for r in p.column("text").to_pylist()] == rows + rows[2:5]
    assert all(p.num_rows for p in parts)
    if limit == 1:
        assert max(sum(map(bool, p.column("text").to_pylist())) for p in parts) == 1
