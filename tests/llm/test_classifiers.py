"""Language, toxicity and quality by accuracy on documents kept out of training, and forward-backward by enumeration."""

import itertools
import random
import zlib

import numpy as np
import pytest

from lendscope.llm import langid, learning, quality, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, label int"
VOWELS = {"xx": "aeo", "yy": "iuy", "zz": "öäé"}


def word(rng, lang):
    return "".join(rng.choice("bdfgklmnprst") + rng.choice(VOWELS[lang]) for _ in range(rng.randint(1, 4)))


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


def prose(rng, lang, n):
    return " ".join(word(rng, lang) for _ in range(n))


def test_forward_backward_by_enumeration():
    rng = np.random.default_rng(3)
    size, length = 3, 4
    model = langid.Model(["a", "b", "c"], *(np.zeros((1, size)) for _ in range(3)), np.zeros(size), rng.normal(size=size), rng.normal(size=(size, size)))
    scores = rng.normal(size=(2, length, size))
    mask = np.array([[True] * 4, [True, True, False, False]])
    marginals, pairs = langid.forward_backward(scores, mask, model, pairs=True)
    expected, expected_pairs = np.zeros((2, length, size)), np.zeros((size, size))
    for row, n in ((0, 4), (1, 2)):
        weights = {}
        for path in itertools.product(range(size), repeat=n):
            value = model.start[path[0]] + sum(scores[row, t, k] for t, k in enumerate(path))
            weights[path] = np.exp(value + sum(model.transitions[a, b] for a, b in zip(path, path[1:])))
        total = sum(weights.values())
        for path, weight in weights.items():
            for t, k in enumerate(path):
                expected[row, t, k] += weight / total
            for a, b in zip(path, path[1:]):
                expected_pairs[a, b] += weight / total
    assert np.allclose(marginals, expected) and np.allclose(pairs, expected_pairs)


@pytest.fixture(scope="module")
def speech():
    rng = random.Random(6)
    rows = [(i, prose(rng, lang, rng.randint(3, 60)), lang, "s", 1, 0.5, 1) for i, lang in enumerate(rng.choices(list(VOWELS), k=400))]
    rows += [(9000, None, "xx", None, None, None, None), (9001, "", None, None, None, None, None), (9002, "123 !! 45", "xx", "s", 1, 0.1, 0)]
    rows += [(None, prose(rng, "yy", 30), "yy", "s", 1, 0.1, 0), (1, rows[1][1], rows[1][2], "s", 1, 0.5, 1)]
    rows += [(9003, prose(rng, "xx", 30) + " " + prose(rng, "yy", 10), None, "s", 1, 0.1, 0), (9004, prose(rng, "zz", 30_000), None, "s", 1, 0.1, 0)]
    return rows


def test_languages(spark, speech):
    docs = spark.createDataFrame(speech, SCHEMA).repartition(3)
    found = langid.languages(docs).collect()
    assert len(found) == len(speech) and all(r.held_out == held_out(r.doc_id) and 0 <= r.score <= 1 for r in found)
    lang = {r[0]: r[2] for r in speech[:400]}
    judged = [r.lang_pred == lang[r.doc_id] for r in found if r.held_out and r.doc_id in lang]
    assert len(judged) > 50 and sum(judged) / len(judged) > 0.95
    by_id = {r.doc_id: r for r in found}
    assert [(by_id[i].lang_pred, by_id[i].score) for i in (9000, 9001, 9002)] == [("und", 0.0)] * 3
    assert by_id[9003].lang_pred == "xx" and by_id[9004].lang_pred == "zz" and by_id[None].lang_pred == "yy"
    kept = langid.keep_known(docs, 0.35)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= set(lang) | {9003, 9004}
    assert not {9000, 9001, 9002} & {r.doc_id for r in kept.collect()}


def test_languages_without_labels(spark, speech):
    docs = spark.createDataFrame(speech, SCHEMA)
    unlabelled = docs.selectExpr("doc_id", "text", "CAST(NULL AS string) AS lang")
    assert {(r.lang_pred, r.score) for r in langid.languages(unlabelled).collect()} == {("und", 0.0)}
    assert langid.languages(docs.limit(0)).collect() == []


def test_machine_learns_an_interaction():
    # Neither term alone tells the classes apart as well as their meeting does.
    rng = np.random.default_rng(1)
    lists, labels = [], []
    for i in range(1200):
        a, b = rng.random(2) < 0.5
        lists.append(np.unique(np.concatenate([np.flatnonzero([False, a, b]), 100 + rng.integers(0, 400, 8)])))
        labels.append(float(a and b))
    machine = toxicity.train(lists, np.array(labels))
    owner, place = toxicity._gather(machine.places, lists)
    scores = toxicity.machine_scores(machine, owner, place, len(lists))
    assert ((scores > 0) == np.array(labels, bool)).mean() > 0.98
    a, b = machine.places[1], machine.places[2]
    assert float(machine.factors[a] @ machine.factors[b]) > 0.1
    by_hand = machine.bias + machine.weights[a] + machine.weights[b] + float(machine.factors[a] @ machine.factors[b])
    assert np.isclose(toxicity.machine_scores(machine, np.array([0, 0]), np.array([a, b]), 1)[0], by_hand)


def test_toxicity(spark):
    rng = random.Random(4)
    insults = ["zonker", "grumble", "fizzle"]
    rows, labels = [], []
    for i in range(700):
        bad = rng.random() < 0.25
        text = prose(rng, "xx", rng.randint(10, 60)).split()
        if bad:
            text.insert(rng.randrange(len(text)), rng.choice(insults).upper() + rng.choice(["!", ",", ""]))
        rows.append((i, " ".join(text), "xx", "s", 1, 0.5, 1))
        labels.append((i, int(bad)))
    rows += [(8000, None, None, None, None, None, None), (8001, "", "xx", "s", 1, 0.5, 1), (None, "zonker", "xx", "s", 1, 0.5, 1)]
    rows += [(8002, prose(rng, "xx", 20_000) + " fizzle.", "xx", "s", 1, 0.5, 1)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    marks = spark.createDataFrame([*labels, (3, labels[3][1]), (None, 1), (5, None)], "doc_id long, toxic int")
    found = toxicity.toxicity(docs, marks).collect()
    truth = dict(labels)
    judged = [(r.predicted, truth[r.doc_id]) for r in found if r.held_out and r.doc_id in truth]
    assert len(found) == len(rows) and sum(p == t for p, t in judged) / len(judged) > 0.97
    by_id = {r.doc_id: r for r in found}
    assert by_id[8000].predicted == by_id[8001].predicted == 0 and by_id[8002].predicted == 1
    assert {r.score for r in toxicity.toxicity(docs, marks.limit(0)).collect()} == {0.5}
    assert toxicity.toxicity(docs.limit(0), marks).collect() == []


def test_quality(spark):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(600):
        good = rng.random() < 0.7
        text = prose(rng, "xx", rng.randint(20, 80))
        if not good:
            text = rng.choice([text.upper().replace(" ", "!! "), "\n".join([text[:40]] * 6), text.replace(" ", " | ")])
        rows.append((i, text, "xx", f"src{rng.randint(0, 3) + 4 * (not good)}" if rng.random() < 0.8 else "src1", len(text), 0.5, 1))
        if i % 2:
            labels.append((i, int(good)))
    rows += [(7000, None, None, None, None, None, None), (7001, "", "xx", "s", 0, 0.5, 1), (None, "x y z", None, None, -4, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    marks = spark.createDataFrame([*labels, (None, 1), (2, None)], "doc_id long, quality int")
    found = quality.quality(docs, marks).collect()
    truth = dict(labels)
    judged = [(r.predicted, truth[r.doc_id]) for r in found if r.held_out and r.doc_id in truth]
    assert len(found) == len(rows) and sum(p == t for p, t in judged) / len(judged) > 0.95
    assert all(0 <= r.score <= 1 for r in found)
    assert {r.score for r in quality.quality(docs, marks.limit(0)).collect()} == {0.5}
    assert quality.quality(docs.limit(0), marks).collect() == []


def test_pseudo_labels_help():
    # A view that sees hardly any labels learns from the other one's sure documents.
    rng = np.random.default_rng(8)
    truth = rng.integers(0, 2, 3000).astype(float)
    clear = truth[:, None] * 4 + rng.normal(size=(3000, 1))
    weak = truth[:, None] * 2 + rng.normal(size=(3000, 6)) * np.array([1, 3, 3, 3, 3, 3])
    few = slice(0, 16)
    alone = quality.fit(weak[few], truth[few])
    taught = quality.co_train([clear[few], weak[few]], truth[few], [clear[16:], weak[16:]])[1]
    right = lambda view: ((view.raw(weak[16:]) > 0) == (truth[16:] > 0)).mean()
    assert right(taught) > right(alone)


def test_logistic_finds_the_line():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(2000, 2))
    y = (x @ np.array([2.0, -1.0]) + 0.5 > 0).astype(float)
    weights, bias = learning.logistic(x, y)
    assert (((x @ weights + bias) > 0) == (y > 0)).mean() > 0.97
