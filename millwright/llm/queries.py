"""The registered query of each operator, over its whole table with production parameters."""

from __future__ import annotations

from millwright.llm import (
    bpe, codes, embeddings, extraction, language, lines, minhash, oracle, packing, passages,
    phrases, pii, quality, suffixes,
)
from millwright.llm.common import documents, vocabulary_path

QUERIES = {}


def query(name):
    def register(fn):
        QUERIES[name] = fn
        return fn

    return register


@query("op1_projection_collisions")
def _(spark, sf_dir):
    return embeddings.near_duplicates(documents(spark, sf_dir, "embeddings"))


@query("op2_harmonic_packing")
def _(spark, sf_dir):
    return packing.pack(documents(spark, sf_dir), vocabulary_path("word_bpe_49k.json"))


@query("op3_line_crf_quality")
def _(spark, sf_dir):
    docs = documents(spark, sf_dir)
    sample = quality.labelled_sample(docs, documents(spark, sf_dir, "labels"))
    return quality.judge(docs, quality.train(sample))


@query("op4_segment_lines")
def _(spark, sf_dir):
    return lines.near_lines(documents(spark, sf_dir), short=True).drop("line")


@query("op5_transducer_bpe")
def _(spark, sf_dir):
    return bpe.encode_decode(documents(spark, sf_dir), vocabulary_path("byte_bpe_50k.json"))

@query("op6_region_extraction")
def _(spark, sf_dir):
    pages = documents(spark, sf_dir, "pages")
    return extraction.extract(pages, extraction.train(extraction.labelled_sample(pages)))


@query("op7_bbit_minhash")
def _(spark, sf_dir):
    return minhash.near_duplicates(documents(spark, sf_dir))


@query("op8_prefix_doubling")
def _(spark, sf_dir):
    return suffixes.remove_repeats(documents(spark, sf_dir))


@query("op9_boosted_pii")
def _(spark, sf_dir):
    return pii.detect(documents(spark, sf_dir))


@query("op10_pitman_yor")
def _(spark, sf_dir):
    return language.score(documents(spark, sf_dir))


@query("op11_doubling_passages")
def _(spark, sf_dir):
    return passages.remove_repeats(documents(spark, sf_dir), keep_text=False)


@query("op12_net_bound_codes")
def _(spark, sf_dir):
    return codes.code_table(documents(spark, sf_dir, "embeddings"))


@query("op13_quotient_phrases")
def _(spark, sf_dir):
    return phrases.collocations(documents(spark, sf_dir))


ORACLE_SQL = dict(oracle.STATEMENTS)
