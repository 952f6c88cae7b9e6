"""Passage removal against the comparison of all windows."""

import hashlib
import random
import re

import pytest

from lendscope.llm import substrings

SCHEMA = "doc_id long, text string, lang string, codes string, marks string"


def brute_force(rows, window):
    """(doc_id, words, words removed, digest of what is kept) by comparing all windows."""
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    least = {}
    for i, found in split:
        for at in range(len(found) - window + 1):
            if i is not None:
                key = tuple(found[at : at + window])
                least[key] = min(i, least.get(key, i))
    out = []
    for i, found in split:
        gone = [False] * len(found)
        for at in range(len(found) - window + 1):
            if i is not None and least[tuple(found[at : at + window])] < i:
                gone[at : at + window] = [True] * window
        kept = " ".join(w for w, g in zip(found, gone) if not g)
        out.append((i, len(found), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def found_in(frame):
    return sorted(
        ((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in frame.collect()),
        key=repr,
    )


def planted(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("a b c d e Ä é ab cd".split())
    shared = [[word() for _ in range(rng.randint(5, 40))] for _ in range(4)]
    rows = []
    for i in range(80):
        text = []
        for _ in range(rng.randint(0, 6)):
            text += rng.choice(shared) if rng.random() < 0.5 else [f"{word()}{rng.randint(0, 40)}" for _ in range(rng.randint(0, 30))]
        rows.append((rng.randint(0, 60) if rng.random() < 0.2 else 100 + i, rng.choice([" ", "\n", " \t "]).join(text)))
    rows += [(None, rows[5][1]), (900, None), (901, ""), (902, " \n\t"), (903, "x " * 5000), (904, "x " * 4000), (5000, rows[3][1])]
    return rows


@pytest.mark.parametrize("window,shortest", [(13, 7), (5, 7), (20, 4), (2, 1)])
def test_against_all_windows(spark, window, shortest):
    rows = planted(window)
    docs = spark.createDataFrame([(*r, "en", "x", "y") for r in rows], SCHEMA).repartition(5)
    assert found_in(substrings.remove_repeated(docs, window, shortest)) == brute_force(rows, window)


def test_small_batches_change_nothing(spark, monkeypatch):
    rows = planted(1)
    docs = spark.createDataFrame([(*r, "en", "x", "y") for r in rows], SCHEMA).repartition(3)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert found_in(substrings.remove_repeated(docs, 6, 3)) == brute_force(rows, 6)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_empty_table(spark):
    assert substrings.remove_repeated(spark.createDataFrame([], SCHEMA)).collect() == []


def test_levels():
    assert substrings.levels(13) == [7, 13]
    assert substrings.levels(50) == [7, 13, 25, 50]
    assert substrings.levels(5) == [5]
