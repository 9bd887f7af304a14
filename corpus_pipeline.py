"""From ``documents`` to token ids in five stages, each over all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
``documents``.  ``run`` writes each stage's rows in the shared folder and reads them again, so that a lost executor
costs no earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallystar.llm import contamination, pieces, rules, secrets, simhash
from tallystar.llm.common import discard, kept, read, written
from tallystar.llm.queries import piece_model


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return rules.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of the documents whose SimHash fingerprints link, the one of the smallest id stays."""
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of the benchmark are cut out of the texts."""
    return contamination.remove(docs, read(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark."""
    return secrets.redact(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and hashes of them and of what they decode to."""
    return pieces.round_trip(docs, piece_model(), with_ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scans", secret_scans),
    ("encoding", encoding),
]

#: EM, fingerprints and merges are no SQL; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    begun = written()
    for name, stage in STAGES:
        docs = kept(stage(spark, docs, sf_dir), name)
        discard(spark, begun, but=1)  # a stage's rows are all that the next one needs
    return docs
