"""Token counts and packing against the tokenizer library itself."""

import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lendscope.llm import packing, token_counts
from lendscope.llm.bpe import BatchEncoder, tokenizer_bytes
from lendscope.session import run_folder

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))
SCHEMA = "doc_id long, text string, lang string, digest string, length long"
BITS = ["a", "B", " ", "  ", "'s", "'ll", "'", "\n", "\t", "1", "23", "é", "🙂", "中", "!", "…", "<|endoftext|>", "​", "I'm"]
LIBRARY = Tokenizer.from_file(PATH)


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def some_docs(spark, seed=3, rows=60):
    rng = random.Random(seed)
    made = [(i, "".join(rng.choice(BITS) for _ in range(rng.randint(0, 40))), "en", "x", 1) for i in range(rows)]
    made += [(100, None, None, None, None), (101, "", "en", "x", 1), (None, "no id", "en", "x", 1), (7, made[7][1], "en", "x", 1)]
    made += [(102, "long words and the rest of it " * 3000, "en", "x", 1), (103, made[3][1], "de", "y", 2)]
    return spark.createDataFrame(made, SCHEMA).repartition(3), made


def test_batches_have_the_librarys_ids():
    rng = random.Random(11)
    texts = ["".join(rng.choice(BITS) for _ in range(rng.randint(0, 30))) for _ in range(5000)] + ["", " ", "a\n", "'s"]
    found = []
    for at, end, ids, counts in BatchEncoder(tokenizer_bytes(PATH)).encode(pa.array(texts)):
        bounds = np.concatenate([[0], np.cumsum(counts)])
        found += [ids[bounds[i] : bounds[i + 1]].tolist() for i in range(end - at)]
    assert found == [library_ids(text) for text in texts]


def test_counts_and_cache(spark):
    docs, made = some_docs(spark)
    cache = run_folder(spark, "test-counts")
    expected = sorted(((i, len((t or "").encode()), len(library_ids(t))) for i, t, *_ in made), key=repr)
    for _ in range(2):  # the second run finds every digest in the cache
        found = token_counts.count_tokens(docs, PATH, cache, limit=20).collect()
        assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in found), key=repr) == expected
        assert all(r.over_limit == (r.n_tokens > 20) for r in found)
    stored = spark.read.parquet(f"{cache}/*/*").collect()
    assert len(stored) == len({t or "" for _, t, *_ in made})  # each distinct text was encoded once
    more = docs.selectExpr("doc_id", "concat(text, ' tail') AS text").limit(5)
    token_counts.count_tokens(more, PATH, cache).collect()
    assert len(stored) < spark.read.parquet(f"{cache}/*/*").count() <= len(stored) + 5


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_tokenizers_go_through_their_library(spark, name):
    docs, made = some_docs(spark)
    path = str(public_tokenizers.path(name))
    if name.endswith(".json"):
        other = Tokenizer.from_file(path)
        count = lambda text: len(other.encode(text, add_special_tokens=False).ids)
    else:
        import sentencepiece

        other = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda text: len(other.encode(text))
    found = token_counts.count_tokens(docs, path, run_folder(spark, "test-counts")).collect()
    assert sorted(((r.doc_id, r.n_tokens) for r in found), key=repr) == sorted(
        ((i, count(t or "")) for i, t, *_ in made), key=repr
    )


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert token_counts.count_tokens(none, PATH, run_folder(spark, "test-counts")).collect() == []
    assert packing.pack(none, PATH).collect() == []


def test_packing_holds_every_id_once(spark):
    docs, made = some_docs(spark)
    size = 64
    rows = packing.pack(docs, PATH, size=size).collect()
    whole = {}
    for doc_id, text, *_ in made:
        whole.setdefault(doc_id, []).append(library_ids(text) + [packing.END_ID])
    for doc_id, versions in whole.items():
        mine = [r for r in rows if r.doc_id == doc_id]
        expected = sorted(
            (a, len(ids[a : a + size]), zlib.crc32(np.array(ids[a : a + size], "<u4").tobytes()), len(ids))
            for ids in versions
            for a in range(0, len(ids), size)
        )
        assert sorted((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in mine) == expected
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    tokens = sum(r.length for r in rows)
    assert len(sequences) <= 1.1 * tokens / size + 2
    assert sorted(sequences) == list(range(len(sequences)))


def test_ranks_in_slices(spark):
    pieces = spark.createDataFrame([(i % 40, 0, i % 3, 1, 1) for i in range(300)], packing.PIECES)
    found = packing.ranked(pieces, rows_per_task=20).collect()
    for length in range(3):
        assert sorted(r["rank"] for r in found if r.length == length) == list(range(100))


def test_patterns_use_the_histogram_up():
    rng = np.random.default_rng(2)
    lengths, counts = np.unique(rng.integers(1, 200, 5000), return_counts=True)
    histogram = dict(zip(lengths.tolist(), counts.tolist())) | {256: 3}
    found = packing.patterns(histogram, 256)
    used = {}
    for pattern, times in found:
        assert sum(length * n for length, n in pattern.items()) <= 256
        for length, n in pattern.items():
            used[length] = used.get(length, 0) + n * times
    assert used == histogram
    tokens = sum(length * n for length, n in histogram.items())
    assert tokens / 256 / sum(times for _, times in found) > 0.98
    assert packing.patterns({}, 256) == [] and packing.patterns({5: 1}, 256) == [({5: 1}, 1)]
