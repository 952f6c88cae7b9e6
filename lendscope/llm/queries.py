"""The registered queries of the operators, with their check SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lendscope.llm import (
    decontaminate,
    exact_dedup,
    jaccard,
    langid,
    packing,
    pii,
    prefix_trie,
    quality,
    substrings,
    token_counts,
    toxicity,
    turn_repair,
    vector_cells,
)
from lendscope.llm.common import table
from lendscope.session import run_folder

Query = Callable[[SparkSession, str], DataFrame]


def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, folder, "documents")).select(*exact_dedup.COLUMNS)


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the box keeps a public vocabulary file; it is never copied."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Counts through a cache of this run's own, so that no earlier run saves it any work."""
    docs = table(spark, folder, "documents")
    return token_counts.count_tokens(docs, tokenizer_path(), run_folder(spark, "token-counts"))


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), tokenizer_path())


def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """The documents that hold a benchmark item, one row per item; clean documents have none."""
    return decontaminate.contaminations(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op2_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, folder, "documents"))


def op3_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.digest_columns(pii.personal_data(table(spark, folder, "documents")))


def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return langid.languages(table(spark, folder, "documents"))


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op9_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = substrings.remove_repeated(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, folder, "conversations"))


def op12_exact_search(spark: SparkSession, folder: str) -> DataFrame:
    return vector_cells.nearest(table(spark, folder, "embeddings"))


def op13_turn_repair(spark: SparkSession, folder: str) -> DataFrame:
    return turn_repair.repair(table(spark, folder, "conversations"))


QUERIES: dict[str, Query] = {
    "op1_decontamination": op1_decontamination,
    "op2_ngram_jaccard_join": op2_ngram_jaccard_join,
    "op3_pii": op3_pii,
    "op4_language_id": op4_language_id,
    "op5_toxicity": op5_toxicity,
    "op6_quality": op6_quality,
    "op7_packing": op7_packing,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_token_counts": op10_token_counts,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_exact_search": op12_exact_search,
    "op13_turn_repair": op13_turn_repair,
}

SQL: dict[str, str] = {
    "op2_ngram_jaccard_join": jaccard.SQL,
    "op8_exact_dedup": exact_dedup.SQL,
    "op9_substring_dedup": substrings.SQL,
    "op11_prefix_trie": prefix_trie.SQL,
    "op12_exact_search": vector_cells.SQL,
    "op13_turn_repair": turn_repair.SQL,
}
