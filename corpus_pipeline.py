"""Five stages from raw documents to packed token sequences.

Every stage takes what the one before it kept, written as Parquet and read again. The first
four return the columns of documents; ``n_chars`` is counted anew where a text changes. Columns
beyond those are carried along. SQL cannot express the line field, the boosted trees, the edit
join or the tokenizer, so there is no SQL for the rows of ``run``; tests compare the stages
with brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.llm import lines, minhash, packing, pii, quality
from millwright.llm.common import documents, vocabulary_path
from millwright.scratch import drop, store

ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; the field learns from the labelled documents of the input."""
    labels = documents(spark, sf_dir, "labels")
    sample = quality.labelled_sample(documents(spark, sf_dir), labels)
    return quality.keep(docs, quality.train(sample))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every class of near-equal lines the first stays; emptied documents go."""
    return lines.keep_first(docs, short=True)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the smallest id, null last.

    Every row is a document, whatever its id: rows are numbered when they are stored, compared
    by number, and removed by number. Rows without words are never near anything and stay.
    """
    row = "near_dedup_row"
    numbered = store(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    groups = minhash.near_duplicates(numbered.select(row, "text"), key=row)
    members = numbered.select(row, "doc_id").join(groups.select(row, "component_id"), row)
    # hot groups are partial minima before they meet
    place = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", row)
    first = members.groupBy("component_id").agg(F.min(place).alias("first"))
    kept = numbered.join(first.select(F.col(f"first.{row}").alias(row)), row, "left_semi")
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gives way to its kind in brackets."""
    return pii.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents and their places in sequences."""
    return packing.pack(docs, vocabulary_path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("minhash_near_dedup", near_dedup),
    ("pii", redact_pii),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        last, docs = docs, store(stage(spark, docs, sf_dir), name)
        drop(last)
    return STAGES[-1][1](spark, docs, sf_dir)
