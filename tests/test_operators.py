"""Operators against plain Python on small random inputs."""

import random

import pytest
from pyspark.sql import functions as F

from lendscope.operators.latest import latest, newest
from lendscope.operators.maintenance import Versions, append, new_files, replace_by_key
from lendscope.operators.numbering import number_rows, padded_id
from lendscope.operators.quality import InSet, MaxLength, NotNull, Reference, Unique, check_rules
from lendscope.operators.running import running_total
from lendscope.operators.sections import join_ranges, plan_ranges, split_sections
from lendscope.sources.tables import insert, stored_book, with_defaults


def test_latest_takes_null_first(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", None, "y"), ("b", 2, "z")], "k string, d int, id string")
    found = {row["k"]: row["id"] for row in latest(df, ["k"], [newest("d"), newest("id")]).collect()}
    assert found == {"a": "y", "b": "z"}


def test_latest_limits_groups_before_the_shuffle(spark, capsys):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS d")
    latest(df, ["k"], [newest("d")]).explain()
    plan = capsys.readouterr().out
    assert "Partial" in plan and plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_running_total_with_a_hot_key(spark):
    rng = random.Random(5)
    data = [(1 if rng.random() < 0.7 else rng.randrange(5), place // 3, place, rng.randrange(-9, 9)) for place in range(400)]
    df = spark.createDataFrame(data, "k int, hour int, id int, amount int").repartition(4)
    got = running_total(df, "k", ["hour", "id"], F.col("hour"), F.col("amount"), "total")
    sums, want = {}, {}
    for key, _, place, amount in data:
        sums[key] = sums.get(key, 0) + amount
        want[place] = sums[key]
    assert {row["id"]: row["total"] for row in got.collect()} == want


def test_numbers_are_global_and_in_order(spark):
    df = spark.range(5000).select(F.md5(F.col("id").cast("string")).alias("name"), (F.col("id") % 7).alias("piece"))
    found = number_rows(spark, df.repartition(6), ["name", "piece"], "n").collect()
    assert [row["n"] for row in sorted(found, key=lambda row: (row["name"], row["piece"]))] == list(range(1, 5001))


def test_numbering_nothing(spark):
    assert number_rows(spark, spark.range(0).withColumnRenamed("id", "a"), ["a"], "n").count() == 0


def test_policy_id_is_never_cut(spark):
    df = spark.createDataFrame([(1,), (999,), (1000,), (12345,)], "n long").coalesce(1)
    ids = [row[0] for row in df.select(padded_id("REG", F.col("n"), 3)).collect()]
    assert ids == ["REG001", "REG999", "REG1000", "REG12345"]


def test_replace_by_key_keeps_null_keys(spark):
    old = spark.createDataFrame([("a", 1), ("b", 1), (None, 1)], "k string, v int")
    new = spark.createDataFrame([("a", 2), ("c", 2), (None, 2)], "k string, v int")
    found = sorted((str(row["k"]), row["v"]) for row in replace_by_key(old, new, "k").collect())
    assert found == [("None", 1), ("None", 2), ("a", 2), ("b", 1), ("c", 2)]


def test_new_files_retries_failures_and_changes(spark):
    listing = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3"), ("d", "4")], "file_name string, file_hash string")
    known = spark.createDataFrame(
        [("a", "1", "SUCCESS"), ("b", "2", "FAILED"), ("c", "0", "SUCCESS")],
        "file_name string, file_hash string, processing_status string",
    )
    assert sorted(row["file_name"] for row in new_files(listing, known).collect()) == ["b", "c", "d"]


def test_versions_switch_last(spark, tmp_path):
    table = Versions(spark, f"file://{tmp_path}/table")
    assert table.read() is None
    table.write(spark.range(3))
    table.write(spark.range(5))
    # A version that was written but not published is not read.
    spark.range(9).write.parquet(f"file://{tmp_path}/table/version=2/attempt=died")
    assert table.read().count() == 5
    table.write(spark.range(7), version=2)
    table.write(spark.range(7), version=2)
    assert table.published() == 2 and table.read().count() == 7


def test_append(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    append(spark.range(2), path)
    append(spark.range(3), path)
    assert spark.read.parquet(path).count() == 5


def test_defaults_fill_null_and_missing(spark):
    df = spark.createDataFrame([(None,), ("EU",)], "region string").coalesce(1)
    found = with_defaults(df, {"region": "India", "amount": 0}).collect()
    assert [(row["region"], row["amount"]) for row in found] == [("India", 0), ("EU", 0)]


def test_rules(spark):
    parent = spark.createDataFrame([("p",)], "id string")
    df = spark.createDataFrame(
        [("1", "p", "A", "short"), ("1", "q", "Z", "much too long"), ("2", None, None, None)],
        "id string, parent string, kind string, text string",
    )
    rules = [Unique("id"), Reference("parent", "parents", "id"), InSet("kind", ("A", "B")), NotNull("text"),
             MaxLength("text", 8)]
    found = {row["rule"]: row["violations"] for row in check_rules("t", df, rules, lambda _: parent).collect()}
    assert found == {"unique": 1, "reference": 1, "domain": 1, "not_null": 1, "length": 1}


@pytest.mark.parametrize(
    ("pages", "want"),
    [(0, []), (1, [(0, 1)]), (500, [(0, 500)]), (501, [(0, 500), (500, 501)]),
     (1200, [(0, 500), (500, 1000), (1000, 1200)])],
)
def test_page_ranges(spark, pages, want):
    df = spark.createDataFrame([("d", pages)], "doc string, pages long")
    found = sorted((row["range_start"], row["range_end"]) for row in plan_ranges(df, "pages").collect())
    assert found == want


def test_ranges_join_in_order_with_blank_lines(spark):
    parts = spark.createDataFrame([("d", 1000, "c"), ("d", 0, "a"), ("d", 500, "b"), ("e", 0, "x")], "k string, s long, t string")
    found = {row["k"]: row["whole"] for row in join_ranges(parts, "k", "s", "t", "whole").collect()}
    assert found == {"d": "\n\na\n\nb\n\nc", "e": "x"}


def test_sections(spark):
    text = "preface text here\n## First title\nbody one\nbody two\n### Deeper one\nmore body\n## short\n## No line break here"
    df = spark.createDataFrame([("d", text)], "doc string, text string")
    found = {row["piece_index"]: (row["section"], row["content"]) for row in split_sections(df, "text").collect()}
    assert found == {
        0: ("preface text here", None),
        1: ("First title", "body one\nbody two\n#"),
        2: ("Deeper one", "more body\n"),
        4: ("No line break here", None),
    }


def test_section_that_starts_with_a_break(spark):
    df = spark.createDataFrame([("d", "\nonly a body in here\n")], "doc string, text string")
    row = split_sections(df, "text").first()
    assert row["section"] is None and row["content"] == "only a body in here\n"


def test_insert_gives_defaults_to_missing_columns_only(spark, tmp_path):
    base = f"file://{tmp_path}/book"
    given = spark.createDataFrame([("a", "c", None)], "application_id string, customer_id string, currency string")
    insert(given, "loan_applications", base)
    row = stored_book(spark, base)["loan_applications"].first()
    assert row["application_status"] == "PENDING" and row["currency"] is None and row["created_at"] is not None
