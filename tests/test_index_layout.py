"""What the word index moves and keeps: no text is stored or shuffled, entries are small, and only the pieces of query words move."""

import pytest
from pyspark.sql import functions as F

from lendscope.operators import word_index
from lendscope.operators.word_index import WordIndex, where_any
from test_word_index import QUERIES, check, frame, made

COALESCE = "spark.sql.adaptive.coalescePartitions.enabled"


def test_texts_are_neither_kept_nor_moved(spark, tmp_path, monkeypatch):
    written = []
    store = WordIndex._store
    monkeypatch.setattr(WordIndex, "_store", lambda self, pieces, gone: written.append(pieces) or store(self, pieces, gone))
    index = WordIndex(spark, f"file://{tmp_path}/index", "doc_id", ("kind",))
    spark.range(600).select(F.col("id").alias("doc_id"), F.concat(F.lit("alpha w"), F.col("id") % 9).alias("text"), F.lit("x").alias("kind")).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    index.refresh(docs, "text")
    changed = docs.where("doc_id < 590").withColumn("text", F.when(F.col("doc_id") % 3 == 0, F.lit("beta beta")).otherwise(F.col("text")))
    assert index.refresh(changed, "text") == 197
    # The plans of both segments read the texts and write postings, without an exchange of rows.
    for pieces in written:
        plan = pieces._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning" not in plan and "rangepartitioning" not in plan
    folder = f"{index.base}/{index.segments()[0]['path']}"
    assert "words" not in spark.read.parquet(f"{folder}/documents").columns
    entries = spark.read.parquet(f"{folder}/postings").select(F.inline("entries"))
    assert dict(entries.dtypes)["offset"] == "smallint" and entries.count() == 1200
    asked = spark.createDataFrame([(1, "beta"), (2, "alpha")], "query_id long, query string")
    assert [row["doc_id"] for row in index.best(asked, 3).where("query_id = 1").orderBy("rank").collect()] == [0, 3, 6]
    whole = index._read("counts").agg(F.sum("docs"), F.sum("n_words")).first()
    assert tuple(whole) == (590, 1180)


@pytest.mark.parametrize("bounds", [(10**6, 10**6, 10**6), (1, 0, 0)])
def test_portions_and_shuffled_paths(spark, tmp_path, monkeypatch, bounds):
    for name, value in zip(("ASKED_WORDS", "MAX_MASKS", "MAX_KEYS"), bounds):
        monkeypatch.setattr(word_index, name, value)
    monkeypatch.setattr(word_index, "HITS_HELD", 3)
    import random

    rng = random.Random(21)
    docs = made(rng, range(400))
    index = WordIndex(spark, f"file://{tmp_path}/index", "doc_id", ("kind",))
    index.refresh(frame(spark, docs), "text")
    docs = {key: value for key, value in docs.items() if key % 7} | made(rng, [1, 2, 500, 501])
    assert index.refresh(frame(spark, docs), "text") == 4
    check(spark, index, docs)
    check(spark, index, docs, 4, ["y", None])


def test_query_that_comes_twice_counts_twice(spark, tmp_path):
    index = WordIndex(spark, f"file://{tmp_path}/index", "doc_id", ("kind",))
    index.refresh(frame(spark, {1: ("loan risk", "x"), 2: ("risk", "y"), 3: ("bank", None)}), "text")
    once, twice = (
        {(row["query_id"], row["doc_id"]): row["score"] for row in index.best(spark.createDataFrame(rows, "query_id long, query string"), 2).collect()}
        for rows in ([(1, "loan"), (2, "risk")], [(1, "loan"), (1, "loan"), (2, "risk"), (None, "risk")])
    )
    assert twice.keys() == once.keys() and twice[1, 1] == pytest.approx(2 * once[1, 1], abs=2e-6) and twice[2, 1] == once[2, 1]
    assert where_any({"kind": []}) is not None and index.best(spark.createDataFrame(QUERIES, "query_id long, query string"), 2, where_any({"kind": []})).collect() == []
