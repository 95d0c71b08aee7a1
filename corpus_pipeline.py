"""Corpus pipeline: five operators over ``documents``, each stage written as Parquet and reread by the next.

A stage takes (spark, docs, sf_dir).  All but the last return the columns of documents, and each works on every row its
predecessor kept.  The toxicity model learns from ``labels`` and the documents given, as the query does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from goalpost.llm import byte_bpe, mixing, ngram_join, secrets, toxicity
from goalpost.llm.common import read_table, saved
from goalpost.llm.queries import vocabulary


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored toxic go."""
    return toxicity.filter_toxic(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity of 0.8 or more: the smallest doc_id of each group stays."""
    return ngram_join.drop_copies(docs, percent=80, width=5)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Found secrets are replaced in the text; ``n_chars`` counts the new text."""
    return secrets.redact(docs, secrets.fit(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A calibrated draw towards flattened source, language and topic shares."""
    return mixing.sample(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids."""
    return byte_bpe.encode(docs, *vocabulary())


STAGES = [("toxicity", drop_toxic), ("ngram_jaccard_join", drop_near_copies), ("secret_scan", redact_secrets),
          ("mixing", mix_sources), ("byte_bpe", encode_tokens)]

#: Trained models and byte merges have no SQL form; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
