"""The stored word index against brute force, through refreshes, removals, filters and merges; commits of two jobs at a time."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendscope.operators import word_index
from lendscope.operators.commits import CommitLog
from lendscope.operators.word_index import WordIndex, where_any
from test_search import WORDS, brute_bm25

QUERIES = [(1, "Capital norms: risk?"), (2, "été loan loan"), (3, "nothing known here"), (4, ""), (5, "a b c bank credit asset")]
SCHEMA = "doc_id long, text string, kind string"


def made(rng, keys):
    return {key: (" ".join(rng.choice(WORDS) for _ in range(rng.randrange(0, 40))), rng.choice(["x", "y", None])) for key in keys}


def frame(spark, docs):
    return spark.createDataFrame([(key, *value) for key, value in docs.items()], SCHEMA).repartition(3)


def check(spark, index, docs, k=5, kinds=None):
    asked = spark.createDataFrame(QUERIES, "query_id long, query string")
    found = index.best(asked, k, where_any({"kind": kinds} if kinds else None), ("kind",)).collect()
    for query_id, query in QUERIES:
        got = sorted((r["rank"], r["doc_id"], r["score"]) for r in found if r["query_id"] == query_id)
        want = brute_bm25([(key, text) for key, (text, _) in docs.items()], query, 10**6)
        want = [item for item in want if not kinds or docs[item[1]][1] in kinds][:k]
        assert [item[1] for item in got] == [item[1] for item in want] and [item[0] for item in got] == [*range(1, len(got) + 1)]
        assert np.allclose([item[2] for item in got], [item[2] for item in want], atol=2e-6)
    assert all(r["kind"] == docs[r["doc_id"]][1] for r in found)


@pytest.fixture
def small_ranges(monkeypatch):
    monkeypatch.setattr(word_index, "RANGE_BITS", 2)
    monkeypatch.setattr(word_index, "FIRST_RANGES", 2)


def test_index_is_kept_up(spark, tmp_path, small_ranges):
    rng = random.Random(8)
    index = WordIndex(spark, f"file://{tmp_path}/index", "doc_id", ("kind",))
    docs = made(rng, range(90)) | {200: (None, None), 201: ("capital capital, CAPITAL!", "x"), 202: ("capital capital, CAPITAL!", "x")}
    assert index.refresh(frame(spark, docs), "text") == len(docs)
    docs = {key: (text or "", kind) for key, (text, kind) in docs.items()}
    check(spark, index, docs)
    check(spark, index, docs, 3, ["x", None])
    assert index.refresh(frame(spark, docs | {200: (None, None)}), "text") == 0 and len(index.segments()) == 1  # nothing new, nothing written
    changed = made(rng, [3, 50, 51, 300, 301])
    docs = {key: value for key, value in docs.items() if key not in (10, 11, 201)} | changed
    assert index.refresh(frame(spark, docs | {200: (None, None)}), "text") == len(changed)
    check(spark, index, docs)
    more = made(rng, [3, 400])
    docs = {key: value for key, value in docs.items() if key != 300} | more
    removed = spark.createDataFrame([(300,), (9999,)], "doc_id long")
    assert index.update(frame(spark, more), removed, "text") == 2
    check(spark, index, docs, 4)
    check(spark, index, docs, 4, ["y"])
    again = WordIndex(spark, f"file://{tmp_path}/index", "doc_id", ("kind",))
    assert again.merge() and len(again.segments()) == 1
    check(spark, again, docs)
    check(spark, index, docs)  # an object goes on with the state that it has read


def test_segments_are_merged(spark, tmp_path, monkeypatch, small_ranges):
    monkeypatch.setattr(word_index, "MERGE_AT", 3)
    rng = random.Random(9)
    index, docs = WordIndex(spark, f"file://{tmp_path}/index", "doc_id", ("kind",)), {}
    for step in range(4):
        docs |= made(rng, range(5 * step, 5 * step + 8))
        index.refresh(frame(spark, docs), "text")
        assert len(index.segments()) < 3
    check(spark, index, docs)


def test_few_documents_are_scored(spark, tmp_path):
    rng = random.Random(1)
    docs = {key: ("common " * rng.randint(1, 3) + f"w{key % 97} " * rng.randint(1, 9) + "filler " * rng.randint(0, 30), None) for key in range(4000)}
    index = WordIndex(spark, f"file://{tmp_path}/index", "doc_id", ("kind",))
    index.refresh(frame(spark, docs), "text")
    asked = spark.createDataFrame([(i, f"common w{i}") for i in range(20)], "query_id long, query string")
    scored = index.scored(asked, 5)
    assert scored.count() < 0.05 * 20 * 4000
    assert index.scored(asked, 5, F.col("kind") == "x").count() == 0
    found = {i: sorted((r["rank"], r["doc_id"]) for r in index.best(asked.where(f"query_id = {i}"), 5).collect()) for i in (0, 7)}
    for i, got in found.items():
        assert got == [item[:2] for item in brute_bm25([(key, text) for key, (text, _) in docs.items()], f"common w{i}", 5)]


def test_empty_corpus_and_no_queries(spark, tmp_path):
    index = WordIndex(spark, f"file://{tmp_path}/index", "doc_id", ("kind",))
    none = spark.createDataFrame([], "query_id long, query string")
    with pytest.raises(ValueError):
        index.best(none, 3)
    assert index.refresh(frame(spark, {1: ("a", None)}).limit(0), "text") == 0
    asked = spark.createDataFrame(QUERIES, "query_id long, query string")
    assert index.best(asked, 3).collect() == [] and index.best(none, 3).collect() == []


def test_overtaken_refresh_starts_again(spark, tmp_path, monkeypatch):
    base = f"file://{tmp_path}/index"
    docs = {1: ("capital risk", "x"), 2: ("loan", "y")}
    newer = docs | {3: ("asset", "x")}
    slow, fast = WordIndex(spark, base, "doc_id", ("kind",)), WordIndex(spark, base, "doc_id", ("kind",))
    slow.refresh(frame(spark, docs), "text")
    write, raced = slow._write, []

    def overtaken(rows, gone):
        made = write(rows, gone)
        if not raced:  # another job publishes while this one is about to
            raced.append(fast.refresh(frame(spark, newer), "text"))
        return made

    monkeypatch.setattr(slow, "_write", overtaken)
    docs = newer | {4: ("capital", "y")}
    assert slow.refresh(frame(spark, docs), "text") == 1 and raced == [1]  # document 3 is indexed once
    check(spark, WordIndex(spark, base, "doc_id", ("kind",)), docs)


def test_commits_of_two_jobs(spark, tmp_path):
    one, other = (CommitLog(spark, f"file://{tmp_path}/log", "path string") for _ in range(2))
    assert one.last() == 0 and one.entries() == []
    assert one.commit(1, path="a") and not other.commit(1, path="b") and other.commit(2, path="b")
    assert [(e["number"], e["path"]) for e in one.entries()] == [(1, "a"), (2, "b")] and one.last() == 2
