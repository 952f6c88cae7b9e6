"""Linked documents against the comparison of all pairs."""

import random
import re

import numpy as np
import pytest

from lendscope.llm import components, jaccard

SCHEMA = "doc_id long, text string, lang string, key string, point string"


def word_set(text, size):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not found:
        return set()
    return {tuple(found[i : i + size]) for i in range(len(found) - size + 1)} or {tuple(found)}


def brute_force(rows, size=4, percent=85):
    sets = [(i, word_set(t, size)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= percent * len(a | b):
                low, high = sorted((root(i), root(j)))
                parent[high] = low
    return sorted(((i, len(a), root(i) if i is not None else None) for i, a in sets), key=repr)


def found_in(frame):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in frame.collect()), key=repr)


def planted(seed, bases=12, copies=9):
    rng = random.Random(seed)
    passage = [f"P{k}" for k in range(40)]
    rows, doc_id = [], 1000
    for base in range(bases):
        words = [f"w{rng.randint(0, 4000)}" for _ in range(rng.choice([2, 3, 4, 6, 30, 60, 200]))]
        if rng.random() < 0.5:
            words[len(words) // 2 : len(words) // 2] = passage
        for _ in range(rng.randint(1, copies)):
            mine = list(words)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                mine[rng.randrange(len(mine))] = rng.choice(["edited", "Changed", "x"])
            doc_id += rng.randint(1, 5)
            rows.append((doc_id * 7919 % 100_003, rng.choice([" ", "\n"]).join(mine).swapcase() if rng.random() < 0.2 else " ".join(mine)))
    rows += [(1, None), (2, ""), (3, " \t"), (None, rows[0][1]), (4, "one two"), (5, "ONE  two"), (6, "a " * 3000), (8, "a " * 50)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    rows = planted(seed)
    docs = spark.createDataFrame([(*r, "en", "k", "p") for r in rows], SCHEMA).repartition(4)
    assert found_in(jaccard.jaccard_components(docs)) == brute_force(rows)


def test_repeated_ids_and_empty_table(spark):
    text = " ".join(f"w{i}" for i in range(50))
    other = " ".join(f"v{i}" for i in range(50))
    rows = [(9, text), (9, text), (3, text), (9, other), (20, other + " more"), (30, "alone it stands here")]
    docs = spark.createDataFrame([(*r, "en", "k", "p") for r in rows], SCHEMA)
    assert {
        r.doc_id: r.component_id for r in jaccard.jaccard_components(docs).collect()
    } == {9: 3, 3: 3, 20: 3, 30: 30}
    assert jaccard.jaccard_components(spark.createDataFrame([], SCHEMA)).collect() == []


def test_tree_finds_what_the_bound_allows():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 9, (40, 8))
    points = np.concatenate([base + rng.integers(0, 2, base.shape) for _ in range(8)]).astype(np.uint32)
    sizes = points.sum(1).astype(np.int64)
    labels = rng.integers(0, 30, len(points))
    found = {tuple(sorted(p)) for a, b in jaccard.CountTree(points, sizes).pairs(85, labels) for p in zip(a.tolist(), b.tolist())}
    expected = {
        (i, j)
        for j in range(len(points))
        for i in range(j)
        if labels[i] != labels[j] and 185 * np.minimum(points[i], points[j]).sum() >= 85 * (sizes[i] + sizes[j])
    }
    assert found == expected and len(expected) > 50


def test_components_of_a_long_chain(spark):
    ends = list(range(200))
    random.Random(1).shuffle(ends)
    links = spark.createDataFrame([*zip(ends, ends[1:]), (500, 501), (7, 7), (None, 3)], "a long, b long")
    found = {r.node: r.component for r in components.components(links).collect()}
    assert found == {i: 0 for i in range(200)} | {500: 500, 501: 500}
    assert components.components(links.limit(0)).collect() == []
