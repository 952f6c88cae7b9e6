"""Token counts through a cache of digests: only texts that no earlier run has counted are encoded."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lendscope.llm.bpe import encoder, tokenizer_bytes, version
from lendscope.llm.common import texts

CACHE_SCHEMA = "digest binary, n_tokens long, version string"
#: A document with more tokens is over the limit.
TOKEN_LIMIT = 512


def _counter(content: bytes, kind: str):
    """A step that turns (digest, text) batches into (digest, n_tokens)."""

    def by_file(batches):
        coder = encoder(content)
        for batch in batches:
            counts = [n for *_, each in coder.encode(batch.column("text"), with_ids=False) for n in each.tolist()]
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(counts, pa.int64())], ["digest", "n_tokens"])

    def by_model(batches):
        import sentencepiece

        coder = sentencepiece.SentencePieceProcessor(model_proto=content)
        for batch in batches:
            counts = [len(coder.encode(text.as_py(), num_threads=1)) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(counts, pa.int64())], ["digest", "n_tokens"])

    return by_model if kind == "model" else by_file


def stored_counts(spark, cache: str, tokenizer: str) -> DataFrame:
    """The cache's rows for one tokenizer version; batches of a failed run may repeat a digest, with the same count."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{cache}/version={tokenizer}")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], CACHE_SCHEMA).drop("version")
    # Only batches that were written to the end have data files that Spark lists.
    return spark.read.schema("digest binary, n_tokens long").option("recursiveFileLookup", "true").parquet(path.toString())


def count_tokens(docs: DataFrame, tokenizer_path: str, cache: str, limit: int = TOKEN_LIMIT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit.

    Content is normalised by reading null as the empty text and by nothing else, so that a count is
    the library's own. ``cache`` is a folder on storage that all executors share; it holds (digest, n_tokens)
    below the tokenizer's version digest, and grows by the counts of this run. A changed file or
    library version has another digest and finds none of the old counts.

    Of the rows of one content a single one stands for all, the one with the least id, so the texts that move are the
    distinct misses, dealt out evenly by id. Repeated ids, null ids and empty texts (no
    tokens) count like all others; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    content = tokenizer_bytes(tokenizer_path)
    mark = version(content)
    rows = texts(docs).select(
        F.coalesce("doc_id", F.lit(-1)).alias("place"),
        "doc_id",
        F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"),
        F.octet_length("text").cast("long").alias("n_bytes"),
        "text",
    )
    known = stored_counts(spark, cache, mark).select("digest").distinct()
    misses = rows.groupBy("digest").agg(F.min("place").alias("place")).join(known, "digest", "left_anti")
    # AQE broadcasts the misses when they are few; else both sides are dealt by the id, which no row dominates.
    wanted = rows.select("place", "digest", "text").join(misses, ["place", "digest"], "left_semi")
    wanted = wanted.dropDuplicates(["place", "digest"])  # rows that repeat id and text; already dealt and sorted so
    counted = wanted.select("digest", "text").mapInArrow(_counter(content, tokenizer_path.rsplit(".", 1)[-1]), "digest binary, n_tokens long")
    counted.write.parquet(f"{cache}/version={mark}/batch={uuid.uuid4().hex}")
    counts = (
        stored_counts(spark, cache, mark)
        .groupBy(F.col("digest").alias("counted"))
        .agg(F.max("n_tokens").alias("n_tokens"))
    )
    return rows.select("doc_id", "digest", "n_bytes").join(counts, F.col("digest") == F.col("counted")).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
