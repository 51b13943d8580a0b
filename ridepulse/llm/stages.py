"""Stages of the corpus pipeline: (spark, docs, sf_dir) -> the documents that stay, or the last stage's digest.

Columns are those of ``documents``; null and empty texts go at the first
stage, repeated rows at the second.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ridepulse.llm import catalog, decontaminate, language, mixing, simhash
from ridepulse.llm.common import ready, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an identifiable language go."""
    ready(spark)
    return language.keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    ready(spark)
    return simhash.one_of_each(docs, shingle=4, max_bits=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak a benchmark item go."""
    ready(spark)
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    ready(spark)
    return mixing.mixture(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mixture, and their digest."""
    return catalog.op4_token_files(spark, sf_dir, docs)


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mix),
    ("token_files", token_files),
]
