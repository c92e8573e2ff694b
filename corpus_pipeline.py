"""The corpus pipeline: stages that turn ``documents`` into packed training sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tableflow.llm.common import staged, table
from tableflow.llm.mixing import mixed_documents
from tableflow.llm.packing import pack_documents
from tableflow.llm.quality_classifier import good_documents
from tableflow.llm.quality_rules import kept_documents
from tableflow.llm.simhash import first_of_each


def classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go; it learns from ``labels`` and the documents at hand."""
    return good_documents(docs, table(spark, sf_dir, "labels"))


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return kept_documents(docs)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, the document with the smallest id stays."""
    return first_of_each(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: repeated, cut at the end of an epoch, or not at all."""
    return mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document of the mix with its place in a sequence."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", classifier_stage),
    ("quality_rules", rules_stage),
    ("simhash_dedup", dedup_stage),
    ("mixing", mixing_stage),
    ("best_fit_packing", packing_stage),
]

# Trained models and tokenizers have no SQL; tests/llm/test_pipeline.py holds each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over all that its predecessor kept, each written as a table and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
