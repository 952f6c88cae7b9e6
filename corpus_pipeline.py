"""The corpus pipeline: stages over ``documents``, each written as Parquet and reread by the next.

Every stage but the last returns the columns of documents; the last returns the packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lendscope.llm import decontaminate, exact_dedup, jaccard, langid, packing
from lendscope.llm.common import table
from lendscope.llm.queries import tokenizer_path
from lendscope.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Below this mean probability no language is believed; code-switched prose stays above it.
LEAST_LANGUAGE_SCORE = 0.35
#: Near copies share this percentage of their n-grams of so many words; op2 has its own contract of 4 and 85.
NEAR_COPY_WORDS = 5
NEAR_COPY_PERCENT = 80


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not known go."""
    return langid.keep_known(docs, LEAST_LANGUAGE_SCORE)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays, the one with the largest id."""
    return exact_dedup.drop_exact_duplicates(docs)


def ngram_jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the least id."""
    return jaccard.drop_near_copies(docs, NEAR_COPY_WORDS, NEAR_COPY_PERCENT)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents that are left, with their places in the sequences."""
    return packing.pack(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_stage),
    ("exact_dedup", exact_dedup_stage),
    ("ngram_jaccard_join", ngram_jaccard_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: Learned models and the packing program are not expressible in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; every stage reads what the one before has written."""
    docs = table(spark, sf_dir, "documents")
    for place, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = materialize(spark, docs, f"pipeline-{name}")
    return docs
