"""The corpus pipeline: documents to packed training sequences, stage by stage.

Each stage is written as Parquet and read again as the next one's documents. All stages but the last return the
columns of ``documents``. SQL cannot express SimHash groups or the packing plan, so ORACLE_SQL is None and the stages
are tested against brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strandwise.llm import exact_dedup, mixing, packing, rules, simhash
from strandwise.llm.common import table, written

ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule of the policy go."""
    return rules.kept_documents(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id stays."""
    return exact_dedup.unique_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one document stays: the first by doc_id, null last (``simhash.one_of_each_group``).

    Texts are linked by fingerprints that differ in at most three bits and by a five-word Jaccard similarity of 0.8 and more.
    """
    return simhash.one_of_each_group(docs)


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture at the tempered weights: every document once, those of sources below their weight in several epochs."""
    return mixing.mixed_documents(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their place in the training sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_duplicates),
    ("simhash_near_dedup", near_duplicates),
    ("source_mixture", source_mixture),
    ("packing", packed_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
