"""The prefix trie and the contraction of trees against brute force."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from lendscope.llm import contraction, prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, a long, id string, depth string"


def brute_force(rows):
    """Rows of the contract from (conv_id, turn, role, text)."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {conv: [t[2:] for t in sorted(found)] for conv, found in turns.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for conv in turns:
        shared = zlib.crc32(str(conv).encode()) % 4
        path = tuple(turns.get(conv - conv % 20, [])[:shared] + turns[conv][shared:])
        for depth in range(len(path) + 1):
            members[path[:depth]].append(conv)
        ends[path].append(conv)
    out = []
    kids = defaultdict(list)
    for path in members:
        if path:
            kids[path[:-1]].append(path)
    for path in members:
        below = [p for p in members if p[: len(path)] == path]
        saved = sum((len(members[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) for p in below if p)
        ended = ",".join(map(str, sorted(ends.get(path, []))))
        out.append(
            (
                min(members[path]),
                len(path),
                min(members[path[:-1]]) if path else None,
                len(members[path]),
                len(kids[path]),
                sum(not kids[p] for p in below),
                saved,
                hashlib.sha256(ended.encode()).hexdigest(),
            )
        )
    return sorted(out, key=repr)


def found_in(spark, rows):
    df = spark.createDataFrame([(*r, 7, "x", "y") for r in rows], SCHEMA).repartition(5)
    trie = prefix_trie.prefix_trie(df)
    assert trie.columns == "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    return sorted((tuple(r) for r in trie.collect()), key=repr)


def test_against_brute_force(spark):
    rng = random.Random(5)
    texts = ["a b", "c", "", None, "é\tü x", " \n", "long " * 3000]
    rows = []
    for conv in [*range(90), 4000, 4019, 10**12, 10**12 + 5]:
        for turn in range(rng.randint(1, 6)):
            rows.append((conv, rng.choice([turn, turn, None, 2]), rng.choice(["user", "assistant", None]), rng.choice(texts)))
    rows += rows[40:60]  # rows that repeat everything
    rows += [(None, 1, "user", "nobody's")]
    assert found_in(spark, rows) == brute_force(rows)


def test_copies_and_one_long_conversation(spark):
    rows = [(conv, turn, "user", f"w {turn}") for conv in range(100, 160) for turn in range(5)]
    rows += [(7, turn, "user", f"t {turn % 3}") for turn in range(60)]
    assert found_in(spark, rows) == brute_force(rows)


def test_lists_of_members_longer_than_a_chunk(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 4)
    ends = spark.createDataFrame([(i % 3, i) for i in range(100)], "id long, conv_id long").repartition(6)
    found = {r.id: r.ends_sha256 for r in prefix_trie.end_digests(ends).collect()}
    assert found == {k: hashlib.sha256(",".join(str(i) for i in range(100) if i % 3 == k).encode()).hexdigest() for k in range(3)}


def test_empty_tables(spark):
    assert found_in(spark, []) == []
    assert found_in(spark, [(None, None, None, None)]) == []


@pytest.mark.parametrize("shape", ["path", "star", "random", "caterpillar", "forest"])
def test_contraction(spark, shape):
    rng = random.Random(3)
    n = 120
    parent = {
        "path": lambda i: i - 1,
        "star": lambda i: 0,
        "random": lambda i: rng.randrange(i),
        "caterpillar": lambda i: i - 1 if i % 2 else max(0, i - 2),
        "forest": lambda i: None if i % 40 == 0 else i - 1 - (i % 3 == 0 and i % 40 > 3),
    }[shape]
    parents = [None] + [parent(i) for i in range(1, n)]
    level, sums = [], [[i + 1, i % 7] for i in range(n)]
    for i, p in enumerate(parents):
        level.append(0 if p is None else level[p] + 1)
    rows = [(i, parents[i], level[i], *sums[i]) for i in range(n)]
    for i in reversed(range(n)):
        if parents[i] is not None:
            sums[parents[i]] = [x + y for x, y in zip(sums[parents[i]], sums[i])]
    tree = spark.createDataFrame(rows, "id long, parent long, level long, x long, y long").repartition(4)
    found = {r.id: [r.x, r.y] for r in contraction.subtree_sums(tree, ["x", "y"]).collect()}
    assert found == dict(enumerate(sums))
