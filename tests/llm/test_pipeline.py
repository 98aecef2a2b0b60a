"""The stages of the corpus pipeline, each against brute force and on odd rows."""

from __future__ import annotations

import random
import re

import pytest
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from millwright.llm import lines, pii, quality
from millwright.llm.common import documents, vocabulary_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows, schema=SCHEMA, parts=3):
    return spark.createDataFrame(
        [(i, t, "en", "s", None if t is None else len(t), *rest) for i, t, *rest in rows], schema
    ).repartition(parts)


def pairs(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def shingle_set(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    size = min(5, len(words))
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def near_brute(rows):
    """Rows that stay: the smallest (id, null last) of each group of linked rows."""
    sets, up = [shingle_set(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                up[find(a)] = find(b)
    groups = {}
    for n in range(len(rows)):
        groups.setdefault(find(n), []).append(rows[n])
    return groups.values()


def check_near(found, rows):
    groups = near_brute(rows)
    assert len(found) == len(groups)
    left = list(found)
    for group in groups:
        least = min((i is None, i) for i, _ in group if i is not None) if any(
            i is not None for i, _ in group) else (True, None)
        mine = [r for r in left if r in group and r[0] == least[1]]
        assert mine, (group, left)
        left.remove(mine[0])
    assert left == []


def texts(seed, n):
    rng = random.Random(seed)
    bases = [[f"w{rng.randrange(60)}" for _ in range(rng.randint(1, 60))] for _ in range(8)]
    for _ in range(n):
        words = [w if rng.random() > rng.choice([0, 0.01, 0.2]) else "zz" for w in rng.choice(bases)]
        yield " ".join(words)


def test_near_dedup_by_rows(spark, sf_dir):
    """Repeated ids, null ids and rows without words; no unique text is lost."""
    rng = random.Random(1)
    rows = [(rng.choice([None, 1, 2, 3, 4, 5, 6, 7]), t) for t in texts(2, 60)]
    a = "the quick brown fox jumps over the lazy dog and runs far away"
    rows += [(1, a), (2, a), (2, "something else entirely that nobody wrote before now"),
             (5, "X y z"), (5, "X y z"), (None, a), (None, None), (9, ""), (9, " \n ")]
    found = pairs(pipeline.near_dedup(spark, frame(spark, rows), sf_dir))
    check_near(found, rows)


@pytest.fixture(scope="module")
def extra():
    return SCHEMA + ", id long, row long, line string, component_id long, near string"


def odd_rows():
    return [(1, None), (2, ""), (3, " \t\n"), (4, "a" * 50_000), (5, "short"),
            (6, "a line that is long enough to count\n" * 3), (6, "a line that is long enough to count"),
            (None, "no id here, but words there are, more than five of them"),
            (7, "é 日本 " * 3000), (8, "mail me at jane.doe@example.org or +49 (30) 1234-5678 now")]


@pytest.mark.parametrize("name,stage", pipeline.STAGES[:-1])
def test_stages_keep_columns_and_survive_odd_rows(spark, sf_dir, extra, name, stage):
    rows = [(i, t, 1, 2, "l", 3, "n") for i, t in odd_rows()]
    out = stage(spark, frame(spark, rows, extra), sf_dir)
    assert [f.name for f in out.schema] == [f.strip().split()[0] for f in extra.split(",")]
    found = out.collect()
    assert len(found) <= len(rows)
    for row in found:
        assert row.n_chars == (None if row.text is None else len(row.text))
        assert (row.row, row.near) == (2, "n")
    empty = stage(spark, frame(spark, [], extra), sf_dir)
    assert empty.columns == out.columns and empty.count() == 0


def test_quality_stage_equals_the_judged_rows(spark, sf_dir):
    docs = documents(spark, sf_dir)
    sample = quality.labelled_sample(docs, documents(spark, sf_dir, "labels"))
    verdict = {r.doc_id: r.kept for r in quality.judge(docs, quality.train(sample)).collect()}
    found = {r.doc_id for r in pipeline.quality_rules(spark, docs, sf_dir).collect()}
    assert found == {i for i, kept in verdict.items() if kept}


def test_line_stage_keeps_one_line_of_each_class(spark, sf_dir):
    rng = random.Random(4)
    stock = [" ".join(rng.choice(["ab", "cde", "fghi", "j"]) for _ in range(8)) for _ in range(15)]
    rows = [(i, "\n".join(rng.choice(stock) for _ in range(rng.randint(1, 6)))) for i in range(30)]
    df = frame(spark, rows)
    kept = [l for _, t in pairs(pipeline.line_dedup(spark, df, sf_dir)) for l in t.split("\n")]
    classes = {r.line: r.class_id for r in lines.near_lines(df, short=True).collect()} if (
        "class_id" in lines.near_lines(df, short=True).columns) else None
    seen = {l for _, t in rows for l in t.split("\n")}
    assert len(kept) == len(set(kept)) and set(kept) <= seen
    if classes:
        assert len(kept) == len(set(classes.values()))


def test_pii_stage_redacts_what_is_detected(spark, sf_dir):
    rows = [(i, t) for i, t in odd_rows() if i is not None]
    out = dict(pairs(pipeline.redact_pii(spark, frame(spark, rows), sf_dir)))
    assert "jane.doe" not in out[8] and "1234-5678" not in out[8]
    assert re.search(r"\[\w+\]", out[8]) and out[5] == "short"
    spans = {r.doc_id: r.spans for r in pii.detect(frame(spark, rows)).collect()}
    assert all(out[i] == t for i, t in rows if i in spans and not spans[i] and i != 6)


def test_packing_stage_holds_every_token_once(spark, sf_dir):
    rows = odd_rows()
    tokenizer = Tokenizer.from_file(vocabulary_path("word_bpe_49k.json"))
    tokenizer.no_truncation()
    wanted = sorted((len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1) for _, t in rows)
    packed = pipeline.pack_sequences(spark, frame(spark, rows), sf_dir).collect()
    assert sum(wanted) == sum(r.length for r in packed)
    ends = {}
    for r in sorted(packed, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0) and r.offset + r.length <= 4096
        ends[r.sequence_id] = r.offset + r.length


def test_run_is_the_stages_one_after_the_other(spark, sf_dir):
    docs = documents(spark, sf_dir)
    for _, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
    kept = {r.doc_id for r in docs.select("doc_id").collect()}
    packed = pipeline.run(spark, sf_dir)
    found = {r.doc_id for r in packed.select("doc_id").distinct().collect()}
    assert found == kept and 0 < len(kept) < documents(spark, sf_dir).count()


def test_samples_are_bounded_whatever_repeats(spark):
    """Foreign labels take no places, repeated ids and pages count once."""
    from millwright.llm import extraction

    docs = frame(spark, [(i % 7, f"text {i % 7}\nline") for i in range(200)] + [(9, "x" * 30_000)])
    labels = spark.createDataFrame(
        [(i, i % 2) for i in range(7)] + [(9, 1)] + [(i, 1) for i in range(1000, 3000)],
        "doc_id long, quality int")
    sample = quality.labelled_sample(docs, labels, sample=3)
    assert sorted((lines_[0], q) for lines_, q in sample) == sorted(sample_of(3))
    page = "<html><article>{}</article></html>"
    pages = spark.createDataFrame(
        [(i, "u", page.format(i % 5)) for i in range(100)] + [(200, "u", None), (201, "u", "<p>")],
        "page_id long, url string, html string")
    assert sorted(extraction.labelled_sample(pages, 50)) == [page.format(i) for i in range(5)]
    assert len(extraction.labelled_sample(pages, 3)) == 3
    assert extraction.labelled_sample(pages.limit(0)) == []


def sample_of(n):
    import xxhash

    def spark_hash(i):  # Spark's seed is 42
        value = xxhash.xxh64_intdigest(i.to_bytes(8, "little"), 42)
        return value - 2**64 if value >= 2**63 else value

    for q in (0, 1):
        ids = sorted((i for i in range(7) if i % 2 == q), key=spark_hash)[:n]
        yield from ((f"text {i}", q) for i in ids)
