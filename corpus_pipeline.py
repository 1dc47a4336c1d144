"""Cleaning of the document table in stages, each of which reads all that the one before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pricelake.llm import decontamination, exact_dedup, language_id, near_dedup, piece_sampling
from pricelake.llm.common import stage


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language is found; those without a letter go, NULL and empty texts with them. Equal rows stay or go together."""
    model = language_id.learn(docs.where(language_id.training_rows("doc_id")))
    return language_id.keep_identified(docs, model)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays. NULL counts as the empty text, a NULL doc_id as the smallest."""
    return exact_dedup.keep_one(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts whose fingerprints of three-word shingles differ in two bits or fewer the one with the smallest doc_id stays.

    Texts without a word are copies of each other; of rows without a doc_id one stays where the group has no other.
    """
    return near_dedup.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item stay, items with text glued to their ends included. NULL and empty texts hold none and stay."""
    return decontamination.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with the pieces of a sampled segmentation, their number, and the text decoded from them. NULL has the pieces of the empty text."""
    return piece_sampling.encode_and_decode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("language_id", language_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("piece_sampling", pieces_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES[:-1]:
        docs, _ = stage(apply(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: The stages train models and draw samples, which SQL cannot say; tests/llm holds the brute-force versions.
ORACLE_SQL = None
