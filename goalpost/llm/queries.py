"""One query for each operator of this subpackage, over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goalpost.llm import (bit_planes, byte_bpe, metric_tree, mixing, ngram_join, oracles, quality_rank, quality_rules,
                          quotations, secrets, spot_signatures, substring_dedup, token_align, toxicity)
from goalpost.llm.common import read_table


def vocabulary() -> tuple[str, str]:
    """Rank file and split pattern of the default tokenizer."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link(read_table(spark, sf_dir, "documents"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(read_table(spark, sf_dir, "documents"), *vocabulary())


def op3_quality_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return quality_rank.score(docs, quality_rank.fit(docs, read_table(spark, sf_dir, "labels")))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeats(read_table(spark, sf_dir, "documents"), within=True)


def op5_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotations.order(read_table(spark, sf_dir, "conversations"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.weigh(read_table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return quality_rules.apply_rules(docs, quality_rules.fit(docs, read_table(spark, sf_dir, "labels")))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return secrets.scan(docs, secrets.fit(docs))


def op10_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spot_signatures.compare_next(read_table(spark, sf_dir, "documents"))


def op11_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    paths = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return token_align.link_counts(read_table(spark, sf_dir, "documents"), *paths)


def op12_metric_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_tree.top_k(read_table(spark, sf_dir, "embeddings"))


def op13_bit_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return bit_planes.mine(rows, moved, F.col("vec_id") % 100 == 0)


QUERIES = {f.__name__: f for f in (
    op1_ngram_jaccard_join, op2_byte_bpe, op3_quality_rank, op4_substring_dedup, op5_quotation_linking,
    op6_toxicity, op7_mixing, op8_quality_rules, op9_secret_scan, op10_spot_signatures, op11_token_align,
    op12_metric_tree, op13_bit_planes)}

ORACLE = {
    "op1_ngram_jaccard_join": oracles.OP1,
    "op7_mixing": oracles.op7(mixing.ROUNDS, mixing.SOLVE_STEPS, mixing.FLATTEN, mixing.FRACTION, mixing.SEED),
    "op12_metric_tree": oracles.OP12,
    "op13_bit_planes": oracles.OP13,
}
