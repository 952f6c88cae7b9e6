"""Records of JSON files over many lines: every layout, broken lines, bounded memory."""

import json
import random

import pytest
from test_feed import feed, record, run  # noqa: F401

from lendscope.streaming.record_scan import RecordScanner


def scan(text, **options):
    scanner, made, longest = RecordScanner(**options), [], 0
    for line in text.split("\n"):
        made += scanner.line(line)
        longest = max(longest, scanner.size)
    return made + scanner.end(), longest


def values(texts):
    """The JSON values of the records, and the broken texts."""
    good, broken = [], []
    for text in texts:
        try:
            value = json.loads(text)
            good += value if isinstance(value, list) else [value]
        except ValueError:
            broken.append(text)
    return good, broken


def test_every_layout_in_one_file():
    a, b, c, d, e = ({"n": n, "in": {"l": [n, {"x": "},\"[{"}], "e": []}} for n in range(5))
    text = "\n".join(
        [json.dumps(a, indent=2), json.dumps(b), "", json.dumps([c, d], indent=4), json.dumps([e]), "[\n", json.dumps(a) + ",", json.dumps(b), "]"]
    )
    good, broken = values(scan(text)[0])
    assert good == [a, b, c, d, e, a, b] and not broken


@pytest.mark.parametrize(
    "line", ['{"a": 1', "{broken", '{"a": "no end', "]", "}", '{"a": 1,', '{"a": [1, 2}', "nothing", '{"a":', "{", '{"a": 1} more']
)
def test_a_broken_line_costs_no_other_record(line):
    before, after = {"n": 1}, {"n": 2, "l": [{"m": 3}]}
    for indent in (None, 2):
        text = "\n".join([json.dumps(before, indent=indent), line, json.dumps(after, indent=indent), json.dumps(before)])
        good, broken = values(scan(text)[0])
        assert [v for v in good if v != {"m": 3}] == [before, after, before] or line == '{"a":' and before in good
        assert broken


def test_long_arrays_and_files_are_not_held():
    rows = [{"n": n, "t": "x" * 50} for n in range(5000)]
    for text in (json.dumps(rows, indent=1), "[" + ",\n".join(map(json.dumps, rows)) + "]", "\n".join(map(json.dumps, rows)) + "\n{"):
        made, longest = scan(text)
        assert values(made)[0] == rows and longest < 1000
    made, longest = scan("{\n" + '"k": 1,\n' * 1000 + "\n" + json.dumps(rows[0]) + "\n" + json.dumps(rows[1]), most=400)
    assert rows[1] in values(made)[0] and longest < 500


def test_random_mixtures():
    rng = random.Random(2)

    def value(depth=0):
        kind = rng.randrange(6 if depth < 3 else 3)
        if kind < 3:
            return rng.choice([1, -2.5, "a", 'q"\\{[', "é\n", None, True])
        return [value(depth + 1) for _ in range(rng.randrange(3))] if kind == 3 else {f"k{i}": value(depth + 1) for i in range(rng.randrange(4))}

    for _ in range(300):
        made = [{"top": value()} if rng.random() < 0.7 else [{"in": value()} for _ in range(rng.randrange(4))] for _ in range(rng.randrange(1, 6))]
        text = "\n".join(json.dumps(item, indent=rng.choice([None, 0, 2])) for item in made)
        good, broken = values(scan(text)[0])
        assert good == [item for one in made for item in (one if isinstance(one, list) else [one])] and not broken


def test_files_of_several_values(spark, feed, tmp_path):  # noqa: F811
    (feed / "a.json").write_text(json.dumps(record(1), indent=2) + "\n" + json.dumps(record(2), indent=2))
    (feed / "b.json").write_text("\n".join([json.dumps([record(3), record(4)], indent=2), "{broken", json.dumps(record(5)), json.dumps(record(6), indent=1)]))
    (feed / "c.json").write_text("\n".join(json.dumps(record(n)) for n in range(10, 400)) + "\n{broken\n" + json.dumps(record(400)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")  # a file is read in several pieces
    try:
        tables = run(spark, feed, tmp_path)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    found = sorted(int(row["indicator_id"][1:]) for row in tables.indicators().collect())
    assert found == [*range(1, 7), *range(10, 401)]
    aside = sorted((row["source_file"], row["text"]) for row in spark.read.parquet(tables.quarantine_path).collect())
    assert aside == [("b.json", "{broken"), ("c.json", "{broken")]
