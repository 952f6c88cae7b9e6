"""Benchmark passages against the plain edit-distance table."""

import random

from lendscope.llm import decontaminate as d

SCHEMA = "doc_id long, text string, lang string, place string, item_id string"


def least_distance(item, text):
    """The least edit distance of the item to a part of the text, by the whole table."""
    row = [0] * (len(text) + 1)
    for i, char in enumerate(item, 1):
        last, row[0] = row[0], i
        for j, other in enumerate(text, 1):
            last, row[j] = row[j], min(last + (char != other), row[j] + 1, row[j - 1] + 1)
    return min(row)


def edited(rng, text, edits):
    chars = list(text)
    for _ in range(edits):
        at = rng.randrange(len(chars))
        chars[at : at + 1] = rng.choice([[], ["q"], [chars[at], "z"]])
    return "".join(chars)


def test_against_the_whole_table(spark):
    rng = random.Random(5)
    item = lambda n: " ".join("".join(rng.choice("abc") for _ in range(rng.randint(1, 6))) for _ in range(n))
    items = [(i, item(rng.randint(14, 30))) for i in range(12)] + [(50, None), (51, "short one"), (52, "")]
    noise = lambda: item(rng.randint(0, 40))
    docs = [(i, noise()) for i in range(20)] + [(90, None), (91, ""), (None, items[0][1])]
    for i in range(60):
        number, text = rng.choice(items[:12])
        text = edited(rng, text, rng.randint(0, int(len(text) * 0.12)))
        if rng.random() < 0.3:
            text = text.upper().replace(" ", rng.choice(["  ", "\n", " \t "]))
        docs.append((100 + i % 50, f"{noise()} {text} {noise()}"))
    docs.append((500, "x " * 40_000 + items[3][1] + " y" * 1000))
    frame = spark.createDataFrame([(*r, "en", "p", "i") for r in docs], SCHEMA).repartition(3)
    bench = spark.createDataFrame([(*r, "e") for r in items], "item_id long, text string, doc_id string")
    found = d.contaminations(frame, bench, block_chars=300)
    rows = found.collect()
    expected = sorted(
        (
            (doc_id, number, best)
            for doc_id, text in docs
            for number, wanted in items
            if wanted and len(d.normalised(wanted)) >= d.SHORTEST_ITEM
            for best in [least_distance(d.normalised(wanted), d.normalised(text)) if doc_id != 500 else (0 if number == 3 else 10**6)]
            if best <= int(d.MAX_ERROR * len(d.normalised(wanted)))
        ),
        key=repr,
    )
    assert sorted(((r.doc_id, r.item_id, r.distance) for r in rows), key=repr) == expected and len(expected) > 30
    by_id = {}
    for doc_id, text in docs:
        by_id.setdefault(doc_id, []).append(text)
    wanted = dict(items)
    for r in rows:  # the span holds the item at the stated distance
        spans = [d.normalised((t or "")[r.start : r.end]) for t in by_id[r.doc_id]]
        assert min(least_distance(d.normalised(wanted[r.item_id]), s) for s in spans) == r.distance
    kept = d.drop_contaminated(frame, bench)
    assert kept.columns == frame.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted(
        (i for i, t in docs if not any(w and len(w) >= 40 and i != 500 and least_distance(d.normalised(w), d.normalised(t)) <= int(0.08 * len(d.normalised(w))) for _, w in items) and i != 500),
        key=repr,
    )


def test_short_items(spark):
    items = [(1, "Who wrote Hamlet?"), (2, "水の化学式は何ですか"), (3, "pi"), (4, "Name the largest moon of Saturn"), (5, " "), (6, "法国")]
    docs = [
        (10, "Quiz: who  wrote\nHAMLET? Nobody knows"),
        (11, "問題:水の化学式は何ですか。答え"),
        (12, "pint of opium, rapid pi3"),
        (13, "value of PI, about three"),
        (14, "he asked: nme the largest mooon of saturn!"),
        (15, "他在法国住"),
        (16, "clean"),
        (17, None),
        (18, "who wrxte hxmlet? two edits of 17 characters are too many"),
        (19, "spin the pi"),
    ]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id, r.distance): docs[r.doc_id - 10][1][r.start : r.end] for r in d.contaminations(frame, bench).collect()}
    assert set(found) == {(10, 1, 0), (11, 2, 0), (13, 3, 0), (14, 4, 2), (15, 6, 0), (19, 3, 0)}
    assert found[10, 1, 0] == "who  wrote\nHAMLET?" and found[11, 2, 0] == items[1][1] and found[13, 3, 0] == "PI" and found[15, 6, 0] == "法国"
    for doc_id, item, distance in found:
        assert least_distance(d.normalised(dict(items)[item]), d.normalised(dict(docs)[doc_id])) == distance
    assert sorted(r.doc_id for r in d.drop_contaminated(frame, bench).collect()) == [12, 16, 17, 18]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "text", "en", "p", "i")], SCHEMA)
    bench = spark.createDataFrame([(1, "t" * 60)], "item_id long, text string")
    assert d.contaminations(docs.limit(0), bench).collect() == []
    assert d.contaminations(docs, bench.limit(0)).collect() == []
    assert d.drop_contaminated(docs, bench.limit(0)).count() == 1
