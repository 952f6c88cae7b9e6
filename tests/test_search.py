"""Search against brute force."""

import math
import random
import re

import numpy as np

from lendscope.operators import search

WORDS = "capital norm risk loan asset provision bank credit a b c été".split()


def corpus(rng, count):
    return [(place, " ".join(rng.choice(WORDS) for _ in range(rng.randrange(0, 40)))) for place in range(count)]


def tokens(text):
    return [word for word in re.split(r"[^\w]+|_", text.lower()) if word]


def brute_bm25(docs, query, k):
    split = {key: tokens(text) for key, text in docs}
    mean = sum(map(len, split.values())) / len(split)
    scores = {}
    for word in set(tokens(query)):
        holding = sum(word in words for words in split.values())
        rarity = math.log(1 + (len(split) - holding + 0.5) / (holding + 0.5))
        for key, words in split.items():
            times = words.count(word)
            if times:
                weight = rarity * times * 2.2 / (times + 1.2 * (0.25 + 0.75 * len(words) / mean))
                scores[key] = scores.get(key, 0) + weight
    best = sorted(scores.items(), key=lambda item: (-round(item[1], 6), item[0]))[:k]
    return [(rank + 1, key, round(score, 6)) for rank, (key, score) in enumerate(best)]


def check_bm25(spark):
    rng = random.Random(3)
    docs = corpus(rng, 60) + [(60, ""), (61, "capital capital, CAPITAL!"), (62, "capital capital, CAPITAL!")]
    queries = [(1, "Capital norms: risk?"), (2, "été loan loan"), (3, "nothing known here"), (4, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    asked = spark.createDataFrame(queries, "query_id long, query string")
    found = search.bm25(df, asked, 5).collect()
    for query_id, query in queries:
        got = sorted((row["rank"], row["doc_id"], row["score"]) for row in found if row["query_id"] == query_id)
        want = brute_bm25(docs, query, 5)
        assert [item[:2] for item in got] == [item[:2] for item in want]
        assert np.allclose([item[2] for item in got], [item[2] for item in want], atol=2e-6)


def test_bm25(spark):
    check_bm25(spark)


def test_bm25_with_many_query_words(spark, monkeypatch):
    monkeypatch.setattr(search, "MAX_QUERY_WORDS", 1)
    check_bm25(spark)


def test_documents_of_hits_stay_where_they_are(spark, capsys, monkeypatch):
    corpus_rows = spark.range(2000).selectExpr("id AS doc_id", "concat('word ', id) AS text")
    queries = spark.createDataFrame([(1, "word 5")], "query_id long, query string")
    found = search.bm25(corpus_rows, queries, 3)
    search.hit_rows(found, queries, 3, corpus_rows, "doc_id", ["text"]).explain()
    assert "BroadcastHashJoin" in capsys.readouterr().out
    monkeypatch.setattr(search, "MAX_HITS", 1)
    both = search.hit_rows(found, queries, 3, corpus_rows, "doc_id", ["text"])
    assert sorted((row["rank"], row["text"]) for row in both.collect())[0] == (1, "word 5")


def test_search_with_filters_and_columns(spark):
    rng = random.Random(5)
    docs = [(key, text, "ab"[key % 2] if key % 5 else None) for key, text in corpus(rng, 60)]
    df = spark.createDataFrame(docs, "doc_id long, text string, kind string").repartition(3)
    asked = spark.createDataFrame([(1, "Capital norms: risk?")], "query_id long, query string")
    everything = brute_bm25([doc[:2] for doc in docs], "Capital norms: risk?", 100)
    for values in (["a"], ["b", None], []):
        found = search.search(df, asked, 4, "doc_id", "text", {"kind": values}, ("kind",)).collect()
        kinds = {key: kind for key, _, kind in docs}
        want = [key for _, key, _ in everything if kinds[key] in values][:4]
        assert [r["doc_id"] for r in sorted(found, key=lambda r: r["rank"])] == want
        assert all(r["kind"] == kinds[r["doc_id"]] for r in found)


def vectors(rng, count):
    made = [(place, [rng.uniform(-1, 1) for _ in range(6)], place % 3) for place in range(count)]
    return made + [(count, made[0][1], 0), (count + 1, [0.0] * 6, 1)]


def brute_nearest(rows, query, k, keep=lambda key, label: True):
    def cosine(left, right):
        size = np.linalg.norm(left) * np.linalg.norm(right)
        return 0.0 if size == 0 else float(np.dot(left, right) / size)

    scored = [(key, round(cosine(vector, query), 6)) for key, vector, label in rows if keep(key, label)]
    best = sorted(scored, key=lambda item: (-item[1], item[0]))[:k]
    return [(rank + 1, key) for rank, (key, _) in enumerate(best)]


def check_nearest(spark):
    rng = random.Random(9)
    rows = vectors(rng, 80)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label long").repartition(4)
    queries = df.filter("vec_id < 7").selectExpr("vec_id AS query_id", "embedding AS query_vector")
    found = search.nearest(df, queries, 4, "vec_id", "embedding", exclude_own=True).collect()
    for query_id in range(7):
        got = sorted((row["rank"], row["vec_id"]) for row in found if row["query_id"] == query_id)
        assert got == brute_nearest(rows, rows[query_id][1], 4, lambda key, label, own=query_id: key != own)


def test_nearest(spark):
    check_nearest(spark)


def test_nearest_in_portions(spark, monkeypatch):
    monkeypatch.setattr(search, "MAX_QUERIES", 3)
    check_nearest(spark)


def test_nearest_in_small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        check_nearest(spark)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_nearest_without_queries(spark):
    df = spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<double>")
    queries = spark.createDataFrame([], "query_id long, query_vector array<double>")
    assert search.nearest(df, queries, 3, "vec_id", "embedding").count() == 0


def test_nearest_within_an_attribute(spark):
    rng = random.Random(4)
    rows = vectors(rng, 50)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label long")
    queries = spark.createDataFrame([(7, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0], 1)], "query_id long, query_vector array<double>, label long")
    found = search.nearest_within(df, queries, 5, "vec_id", "embedding", "label").collect()
    got = sorted((row["rank"], row["vec_id"]) for row in found)
    assert got == brute_nearest(rows, [1.0, 0, 0, 0, 0, 0], 5, lambda key, label: label == 1)
