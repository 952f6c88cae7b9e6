"""Ranking of documents for a set of queries: by words (BM25) and by vectors (cosine)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendscope.operators.latest import ranked
from lendscope.session import materialize

# --- fixed values: BM25 parameters and the digits a score is compared by ---
SATURATION = 1.2
LENGTH_WEIGHT = 0.75
SCORE_DIGITS = 6

# Queries, query words and hits are counted before they are sent to every task.
MAX_QUERIES = 1000
MAX_QUERY_WORDS = 500_000
MAX_HITS = 500_000
#: Pairs of a query and a document that one task sums scores of, at most.
PAIRS_PER_TASK = 1_000_000


NO_WORD = r"[^\p{L}\p{N}]+"


def words(text: Column) -> Column:
    """Lower-case words: runs of letters and digits."""
    return F.array_remove(F.split(F.lower(text), NO_WORD), "")


def bm25(
    corpus: DataFrame, queries: DataFrame, k: int, key: str = "doc_id", text: str = "text", where: Column | None = None
) -> DataFrame:
    """The ``k`` best documents per query: query_id, rank, ``key``, score.

    With ``where``, a condition on the corpus, only documents that meet it are ranked;
    how rare a word is still follows from the whole corpus.

    ``queries`` has query_id and query. Only documents that share a word with the
    query are ranked; equal scores go by ``key``. The query words are counted first:
    a bounded set is sent to every task, which drops all other corpus words and
    counts the rest per document before anything is shuffled. A larger set is joined
    by shuffle, after the words have been counted per document. The counts are then
    brought together by document, so that a document's score needs no further
    shuffle and every task sends on only its best ``k`` per query.
    """
    spark = corpus.sparkSession
    asked = queries.select("query_id", F.explode(F.array_distinct(words(F.col("query")))).alias("_word"))
    small = asked.count() <= MAX_QUERY_WORDS
    bounded = F.broadcast if small else (lambda df: df)
    # Every document is given the empty word: its row carries the document's size, so that the
    # number of documents and their mean size need no second pass over the texts.
    vocabulary = asked.select("_word").unionByName(spark.range(1).select(F.lit("").alias("_word"))).distinct()

    pieces = corpus.select(key, F.split(F.lower(text), NO_WORD).alias("_words"))
    # Only the first and the last piece of a text can be empty, and they are no words.
    ends = (F.element_at("_words", 1) == "").cast("int") + (F.element_at("_words", -1) == "").cast("int")
    tokens = pieces.withColumn("_size", F.greatest(F.size("_words") - ends, F.lit(0)))
    per_word = tokens.select(key, "_size", F.explode(F.array_append("_words", F.lit(""))).alias("_word"))
    if small:
        per_word = per_word.join(bounded(vocabulary), "_word", "left_semi")
    # Read several times below: written once.
    counts = materialize(
        spark, per_word.groupBy(key, "_size", "_word").agg(F.count(F.lit(1)).alias("_times")), "word-counts"
    )
    totals = counts.filter(F.col("_word") == "").agg(
        F.struct(F.count(F.lit(1)).alias("docs"), F.avg("_size").alias("mean"))
    )
    holding = counts.groupBy("_word").agg(F.count(F.lit(1)).alias("_holding"))
    total = F.col("_total")
    rarity = F.log(F.lit(1.0) + (total["docs"] - F.col("_holding") + 0.5) / (F.col("_holding") + 0.5))
    weights = (
        asked.join(holding, "_word")
        .withColumn("_total", totals.scalar())
        .select("_word", "query_id", rarity.alias("_rarity"), total["mean"].alias("_mean"))
    )
    length = F.lit(1 - LENGTH_WEIGHT) + F.lit(LENGTH_WEIGHT) * F.col("_size") / F.col("_mean")
    weight = F.col("_rarity") * F.col("_times") * (SATURATION + 1) / (F.col("_times") + SATURATION * length)
    by_document = counts
    if small:
        pairs = counts.filter(F.col("_word") == "").count() * queries.count()
        tasks = max(spark.sparkContext.defaultParallelism, -(-pairs // PAIRS_PER_TASK))
        by_document = counts.repartition(tasks, key)
    scores = (
        by_document.join(bounded(weights), "_word")
        .groupBy("query_id", key)
        .agg(F.round(F.sum(weight), SCORE_DIGITS).alias("score"))
    )
    if where is not None:
        scores = scores.join(corpus.filter(where).select(key), key, "left_semi")
    return ranked(scores, ["query_id"], [F.desc("score"), F.asc(key)], k).select("query_id", "rank", key, "score")


def search(
    corpus: DataFrame,
    queries: DataFrame,
    k: int,
    key: str,
    text: str,
    filters: dict[str, list] | None = None,
    columns: tuple[str, ...] = (),
) -> DataFrame:
    """The ``k`` best documents per query whose attributes have one of the given values each, with the chosen columns."""
    where = None
    for name, values in (filters or {}).items():
        met = F.col(name).isin([value for value in values if value is not None])
        met = met | F.col(name).isNull() if None in values else met
        where = met if where is None else where & met
    found = bm25(corpus, queries, k, key, text, where)
    return hit_rows(found, queries, k, corpus, key, list(columns)).select("query_id", "rank", key, "score", *columns)


def hit_rows(found: DataFrame, queries: DataFrame, k: int, corpus: DataFrame, key: str, columns: list) -> DataFrame:
    """The hits with columns of their documents.

    There are at most ``k`` hits per query, so a bounded number of them is sent to
    the corpus instead of moving the corpus; beyond the bound the two are shuffled,
    with only the asked columns.
    """
    wanted = corpus.select(key, *columns)
    if queries.count() * k <= MAX_HITS:
        found = F.broadcast(found)
    return wanted.join(found, key)


def unit(vector: Column) -> Column:
    """The vector as doubles, scaled to length 1; a zero vector stays zero."""
    doubles = F.transform(vector, lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(doubles, F.lit(0.0), lambda total, x: total + x * x))
    return F.transform(doubles, lambda x: F.when(norm > 0, x / norm).otherwise(F.lit(0.0)))


def dot(left: Column, right: Column) -> Column:
    products = F.zip_with(left, right, lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def nearest_within(
    corpus: DataFrame, queries: DataFrame, k: int, key: str, vector: str, attribute: str
) -> DataFrame:
    """The ``k`` nearest rows per query among the rows with the query's attribute value.

    ``queries`` has query_id, query_vector and the attribute. Rows meet only the
    queries of their own attribute value.
    """
    asked = queries.select(attribute, "query_id", unit(F.col("query_vector")).alias("_query"))
    scored = (
        corpus.select(key, attribute, unit(F.col(vector)).alias("_vector"))
        .join(asked, attribute)
        .select("query_id", key, F.round(dot(F.col("_vector"), F.col("_query")), SCORE_DIGITS).alias("similarity"))
    )
    return ranked(scored, ["query_id"], [F.desc("similarity"), F.asc(key)], k).select(
        "query_id", "rank", key, "similarity"
    )


def _best_of_batches(ids: list, queries: list, k: int, key: str, exclude_own: bool):
    """A batch function that keeps, per query, the rows of the batch that can be among its best ``k``."""

    # Kept inside, so that the whole step travels to the workers by value.
    def unit_rows(vectors: list) -> np.ndarray:
        matrix = np.array(vectors, dtype=np.float64)
        length = np.linalg.norm(matrix, axis=1, keepdims=True)
        return matrix / np.where(length > 0, length, 1.0)

    asked, names = unit_rows(queries), np.array(ids)

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if frame.empty:
                continue
            keys = frame[key].to_numpy()
            similarity = np.round(unit_rows(frame["_vector"].tolist()) @ asked.T, SCORE_DIGITS) + 0.0
            if exclude_own:
                similarity[keys[:, None] == names[None, :]] = -np.inf
            kept = similarity > -np.inf
            if len(keys) > k:
                # Equal values at the border all stay; the final ranking settles them by key.
                kept &= similarity >= np.partition(similarity, len(keys) - k, axis=0)[len(keys) - k]
            row, place = np.nonzero(kept)
            yield pd.DataFrame({"query_id": names[place], key: keys[row], "similarity": similarity[row, place]})

    return batches


def nearest(
    corpus: DataFrame, queries: DataFrame, k: int, key: str, vector: str, exclude_own: bool = False
) -> DataFrame:
    """The ``k`` nearest rows of the whole corpus per query, by exact cosine.

    ``queries`` has query_id and query_vector. The query set is counted first and
    goes to the tasks in portions of at most ``MAX_QUERIES``; the corpus never moves.
    Every Arrow batch keeps only rows that can be among a query's best ``k``.
    ``exclude_own`` leaves out the row whose key is the query_id.
    """
    asked = queries.select("query_id", F.col("query_vector").alias("query"))
    portions = -(-max(asked.count(), 1) // MAX_QUERIES)
    rows = corpus.select(key, F.col(vector).alias("_vector"))
    schema = T.StructType(
        [
            T.StructField("query_id", asked.schema["query_id"].dataType),
            T.StructField(key, corpus.schema[key].dataType),
            T.StructField("similarity", T.DoubleType()),
        ]
    )
    parts = []
    for portion in range(portions):
        mine = asked if portions == 1 else asked.filter(F.pmod(F.xxhash64("query_id"), F.lit(portions)) == portion)
        held = mine.collect()
        if held:
            vectors = [row["query"] for row in held]
            keep = _best_of_batches([row["query_id"] for row in held], vectors, k, key, exclude_own)
            parts.append(rows.mapInPandas(keep, schema))
    if not parts:
        none = rows.sparkSession.createDataFrame([], schema).withColumn("rank", F.lit(1))
        return none.select("query_id", "rank", key, "similarity")
    scored = parts[0]
    for part in parts[1:]:
        scored = scored.unionByName(part)
    return ranked(scored, ["query_id"], [F.desc("similarity"), F.asc(key)], k).select(
        "query_id", "rank", key, "similarity"
    )
