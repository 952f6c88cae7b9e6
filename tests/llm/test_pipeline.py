"""The registered queries of the operators, exact dedup, and the pipeline stage by stage against brute force."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from check import TABLES, rows
from lendscope.llm import decontaminate, exact_dedup, packing, queries
from lendscope.session import materialize

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_registered_query(spark, name):
    assert name in entry.queries()
    df = queries.QUERIES[name](spark, FOLDER)
    found = df.collect()
    if name in queries.SQL:
        sql = duckdb.connect()
        for table in TABLES:
            sql.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
        cursor = sql.execute(queries.SQL[name])
        columns = [column[0] for column in cursor.description]
        assert rows(df.columns, [tuple(row) for row in found]) == rows(columns, cursor.fetchall())
    elif name not in ("op1_decontamination", "op7_packing"):
        assert len(found) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()


def test_exact_duplicates(spark):
    rng = random.Random(1)
    texts = ["a", "A", "a ", "", None, "é", "x" * 100_000]
    made = [(rng.randint(0, 150) if i % 9 else None, rng.choice(texts), "en", "s", 1) for i in range(400)]
    docs = materialize(spark, spark.createDataFrame(made, SCHEMA).repartition(6), "test")
    groups = defaultdict(list)
    for doc_id, text, *_ in made:
        groups[text or ""].append(doc_id)
    for leaves, fan_in in ((256, 16), (8, 2), (1, 2)):
        found = exact_dedup.exact_duplicates(docs, leaves, fan_in).collect()
        assert len(found) == len(made)
        by_hash = {hashlib.sha256(t.encode()).hexdigest(): t for t in groups}
        for r in found:
            ids = groups[by_hash[r.text_sha256]]
            assert r.group_size == len(ids) and r.keep_id == max((i for i in ids if i is not None), default=None)
        for text in groups:  # exactly one row of each group stays, ties included
            kept = [r for r in found if r.kept and by_hash[r.text_sha256] == text]
            assert len(kept) == 1 and kept[0].doc_id == kept[0].keep_id
    left = exact_dedup.drop_exact_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted((r.text or "") for r in left.collect()) == sorted(groups)
    assert exact_dedup.exact_duplicates(docs.limit(0)).collect() == []


def stage_outputs(spark, docs, folder):
    """What each stage was given and what it made, each written and read again."""
    given = []
    for name, stage in corpus_pipeline.STAGES:
        made = materialize(spark, stage(spark, docs, folder), f"test-{name}")
        given.append((name, docs, made))
        docs = made
    return given


def word_set(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return ({tuple(found[i : i + 5]) for i in range(len(found) - 4)} or {tuple(found)}) if found else set()


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    bench = [(r.item_id, decontaminate.normalised(r.text)) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    given = {name: (before.collect(), after.collect(), after) for name, before, after in stage_outputs(spark, docs, FOLDER)}
    for name, (before, after, frame) in given.items():
        if name != "packing":
            assert frame.columns == docs.columns and len(after) <= len(before) and set(after) <= set(before)

    before, after, _ = given["language_id"]
    assert {r for r in before if re.search(r"[^\W\d_]", r.text or "")} >= set(after) and len(after) >= 0.98 * len(before)
    before, after, _ = given["exact_dedup"]
    best = defaultdict(int)
    for r in before:
        best[r.text] = max(best[r.text], r.doc_id)
    assert sorted(r.doc_id for r in after) == sorted(best.values())
    before, after, _ = given["ngram_jaccard_join"]
    sets = {r.doc_id: word_set(r.text) for r in before}
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[:x]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                low, high = sorted((top(i), top(j)))
                root[high] = low
    assert sorted(r.doc_id for r in after) == sorted(i for i in ids if top(i) == i)
    before, after, _ = given["decontamination"]
    gone = {r.doc_id for r in before} - {r.doc_id for r in after}
    exact = {r.doc_id for r in before if any(len(t) >= 40 and t in decontaminate.normalised(r.text) for _, t in bench)}
    assert exact <= gone and len(gone) <= len(exact) + 5
    before, after, _ = given["packing"]
    library = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    for r in before[:40]:
        ids = library.encode(r.text, add_special_tokens=False).ids + [packing.END_ID]
        parts = sorted((p.start, p.length, p.ids_crc32) for p in after if p.doc_id == r.doc_id)
        assert parts == [
            (a, len(ids[a : a + 2048]), zlib.crc32(np.array(ids[a : a + 2048], "<u4").tobytes())) for a in range(0, len(ids), 2048)
        ]
    assert {p.doc_id for p in after} == {r.doc_id for r in before}


def test_near_copies_of_the_stage(spark):
    text = [f"w{i}" for i in range(100)]
    scattered = [f"v{i}" for i in range(96)]
    edited = [w if i % 48 != 24 else "edited" for i, w in enumerate(scattered)]
    rows = [(1, text), (2, text + [f"new{i}" for i in range(20)]), (3, scattered), (4, edited), (5, text[:70])]
    docs = spark.createDataFrame([(i, " ".join(t), "en", "s", 1) for i, t in rows], SCHEMA)
    sets = {i: {tuple(t[k : k + 5]) for k in range(len(t) - 4)} for i, t in rows}
    linked = {(i, j) for i in sets for j in sets if i < j and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}
    assert linked == {(1, 2), (3, 4)}
    stage = dict(corpus_pipeline.STAGES)["ngram_jaccard_join"]
    assert sorted(r.doc_id for r in stage(spark, docs, FOLDER).collect()) == [1, 3, 5]


def test_empty_documents_run_through(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"file://{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"file://{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, f"file://{tmp_path}").collect() == []
