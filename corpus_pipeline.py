"""A corpus from raw documents to packed sequences: five stages, each over all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from packshot.llm import best_fit_packing, decontamination, jaccard_join, quality_classifier, secret_scan
from packshot.llm.queries import table, tokenizer_file
from packshot.runtime import materialise

WORDS, PERCENT = 5, 80  # of near duplicates


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality_classifier.kept_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return jaccard_join.one_per_group(docs, WORDS, PERCENT)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark item go."""
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts."""
    return secret_scan.without_secrets(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences."""
    return best_fit_packing.packed_documents(docs, tokenizer_file())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("secret scans", secrets),
    ("best-fit packing", packed),
]

# the classifier and the tokenizer have no SQL; the stages are tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir))
    return docs
