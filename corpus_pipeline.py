"""Corpus pipeline: language ID, exact dedup, near dedup, benchmark decontamination, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's documents. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cumulo.llm import decontaminate, exact_dedup, language_id, near_dedup, queries
from cumulo.llm.common import materialise, prepare
from cumulo.sources.tables import load


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that are in no language of the corpus (no letter, or hardly a trigram the languages explain),
    so that no later stage works on them, and fills missing languages with the predicted one. The model is learned
    from the labelled documents of the input; documents in several languages stay, whatever the largest share."""
    prepare(spark)
    return language_id.keep_and_label(docs, language_id.learn(docs))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased) the row with the largest id stays."""
    prepare(spark)
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of documents with similarity 0.8 or more on 5-word shingles one stays."""
    prepare(spark)
    return near_dedup.drop_near_copies(docs, k=5, percent=80)


def drop_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold 0.8 or more of a benchmark item's 5-word shingles go."""
    prepare(spark)
    return decontaminate.drop_contaminated(docs, load(spark, sf_dir, "benchmark"))


def encode_and_decode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of what is left."""
    prepare(spark)
    return queries.bpe_codec(docs)


STAGES = [
    ("language_id", identify_languages),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontaminate", drop_test_items),
    ("bpe_codec", encode_and_decode),
]

#: Language ID, MinHash verification and BPE have no SQL form; tests/llm holds the result against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written to the shared folder and read again."""
    prepare(spark)
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
