"""Conversation repair against a search over all edit sequences."""

import hashlib
import heapq
import random
import zlib
from collections import defaultdict

from lendscope.llm import turn_repair

SCHEMA = "conv_id long, turn long, role string, text string, a long, cost string, block string"
SPACE = "\x20\t\n\x0b\x0c\r"


def damaged(rows):
    kept = defaultdict(list)
    for conv, turn, role, text in rows:
        here = kept[conv]
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        hit = zlib.crc32(key.encode()) % 20
        was = (turn is not None, turn or 0, role, text)
        if hit == 0:
            continue
        if hit == 1:
            text = ""
        if hit == 2:
            text = "".join(c for c in text if c not in ".!?")
        if hit == 4:
            role = "user"
        here += [(was, turn, role, text)] * (2 if hit == 3 else 1)
    return {conv: [r[1:] for r in sorted(found, key=lambda r: r[0])] for conv, found in kept.items()}


def cheapest(rows):
    """Least (cost, audit) and its text by a best-first search over (row, last initial put out)."""
    best, queue = {}, [(0, "", 0, "", ())]
    while queue:
        cost, audit, at, last, lines = heapq.heappop(queue)
        if (at, last) in best and best[at, last] <= (cost, audit):
            continue
        best[at, last] = (cost, audit)
        if at == len(rows) and last in ("", "a"):
            return cost, audit, "\n".join(lines)
        due = "assistant" if last == "u" else "user"
        heapq.heappush(queue, (cost + 2, audit + "I", at, due[0], (*lines, f"{due}:")))
        if at < len(rows):
            role, text, fault = rows[at]
            heapq.heappush(queue, (cost + 3, audit + "D", at + 1, last, lines))
            more = int(fault == "truncated")
            if fault not in ("blank", "duplicate"):
                first = role[:1]
                if (first == "s" and last == "") or (first == "u" and last in ("", "s", "a")) or (first == "a" and last == "u"):
                    heapq.heappush(queue, (cost + more, audit + "K", at + 1, first, (*lines, f"{role}:{text}")))
                heapq.heappush(queue, (cost + 2 + more, audit + "R", at + 1, due[0], (*lines, f"{due}:{text}")))
    raise AssertionError


def brute_force(rows):
    out = []
    for conv, found in damaged(rows).items():
        faults, seen, marked = defaultdict(int), set(), []
        for _, role, text in found:
            bare = text.strip(SPACE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            faults[fault] += 1
            marked.append((role, text, fault))
        turns = [t for t, *_ in found if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") or not a[1] or not b[1] for a, b in zip(found, found[1:]))
        cost, audit, text = cheapest(marked)
        out.append((conv, gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def found_in(spark, rows, least_block=turn_repair.LEAST_BLOCK):
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA).repartition(5)
    found = turn_repair.repair(df, least_block)
    assert [t for _, t in found.dtypes] == ["bigint"] * 7 + ["string"] * 2
    return sorted((tuple(r) for r in found.collect()), key=repr)


def made(seed, convs, longest):
    rng = random.Random(seed)
    roles = ["user", "assistant"] * 4 + ["system", "user", "tool", "", None, "ünd"]
    texts = ["Yes.", "No", "What? ", "Ja!\n\t", "", " \n", None, "end. ", "a.b", "x" * 5000 + "."] + [f"t{i}." for i in range(20)]
    rows = []
    for conv in range(convs):
        for turn in range(rng.randint(1, longest)):
            rows.append((conv, rng.choice([turn] * 9 + [None, turn + 3, 2]), rng.choice(roles), rng.choice(texts)))
    return rows


def test_against_search(spark):
    rows = made(1, 150, 9)
    rows += rows[100:130] + [(None, 3, "user", "Hi."), (None, None, "assistant", "Ho"), (10**15, None, None, None)]
    assert found_in(spark, rows) == brute_force(rows)


def test_blocks(spark):
    rows = made(2, 12, 80) + [(77, turn, "au"[turn % 2] if turn % 7 else "s", f"t{turn}.") for turn in range(400)]
    expected = brute_force(rows)
    assert found_in(spark, rows, 1) == expected  # blocks of the square root of the rows
    assert found_in(spark, rows, 5) == expected
    assert found_in(spark, rows) == expected


def test_empty_tables_and_lost_conversations(spark):
    assert found_in(spark, []) == []
    lost = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert found_in(spark, [(lost, 0, "user", "Hi.")]) == [(lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_extreme_turns(spark):
    far = [(5, -(2**63), "user", "Hi."), (5, 2**63 - 1, "assistant", "Ho.")]
    (row,) = found_in(spark, far)
    assert row[0] == 5 and row[1] is None
