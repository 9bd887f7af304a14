"""Registered queries of this package: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.llm import (
    contamination,
    counts,
    jaccard,
    negatives,
    pages,
    pieces,
    quality,
    repeats,
    rules,
    secrets,
    sharding,
    simhash,
    spelling,
)
from tallystar.llm.common import read
from tallystar.llm.sql import ORACLE

Query = Callable[[SparkSession, str], DataFrame]


def piece_model() -> str:
    """Place of the vocabulary file; a parameter of the operators, never part of the package."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(read(spark, sf_dir, "documents")).drop("p_good")


def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(read(spark, sf_dir, "documents")))


def op3_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op4_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(read(spark, sf_dir, "documents"))


def op5_repeat_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(read(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.token_counts(read(spark, sf_dir, "documents"), piece_model())


def op7_piece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(read(spark, sf_dir, "documents"), piece_model())


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(read(spark, sf_dir, "pages"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    return contamination.digest(contamination.hits(docs, benchmark))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op11_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.linked(read(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = negatives.quantised(read(spark, sf_dir, "embeddings"))
    return negatives.hard_negatives(rows, F.col("id") % negatives.EVERY == 0)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(read(spark, sf_dir, "documents")))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_secret_scans,
        op3_simhash_groups,
        op4_minimax_shards,
        op5_repeat_removal,
        op6_token_counts,
        op7_piece_round_trip,
        op8_html_extraction,
        op9_decontamination,
        op10_quality_classifier,
        op11_ngram_jaccard_join,
        op12_hard_negatives,
        op13_spelling_variants,
    )
}
__all__ = ["ORACLE", "QUERIES", "piece_model"]
