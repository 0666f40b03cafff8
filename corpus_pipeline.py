"""From documents to packed sequences: five stages, each on all that the one before it kept.

Every stage but the last returns the columns of ``documents``. Null texts and texts without a letter go in the first
stage; an empty table passes through all of them as an empty table; further columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablewatch.llm.common import stored, table
from tablewatch.llm.language import accepted
from tablewatch.llm.lines import without_repeated_lines
from tablewatch.llm.minhash import keep_first
from tablewatch.llm.packing import pack_documents
from tablewatch.llm.recompression import without_repeats


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach; undetermined and foreign texts go."""
    return accepted(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of runs of three or more lines are cut from the texts."""
    return without_repeated_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: shingles of five words, a similarity of 0.8 or more."""
    return keep_first(docs, k=5, percent=80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 or more words that stand in several places are cut from the texts."""
    return without_repeats(docs, window=50)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and offset."""
    return pack_documents(docs)


STAGES = [
    ("language_id", known_language),
    ("line_dedup", line_dedup),
    ("minhash_near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("best_fit_packing", packing),
]

#: The language filter, the near-duplicate components and the tokens have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
