"""Every threshold: just below, equal, just above, NULL."""

import operator
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lendscope import fixed
from lendscope.functions.banding import band, label_score, level

BANDS = [name for name, value in vars(fixed).items() if isinstance(value, fixed.Bands)]
COMPARE = {"<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge, "=": operator.eq}


def expected(value, bands):
    for symbol, limit, score in bands.steps:
        if value is not None and COMPARE[symbol](value, Decimal(str(limit))):
            return score
    return bands.otherwise


@pytest.mark.parametrize("kind", ["decimal(18,4)", "double"])
def test_every_edge(spark, kind):
    cases = []
    for name in BANDS:
        for _, limit, _ in getattr(fixed, name).steps:
            edge = Decimal(str(limit))
            cases += [(name, edge + step) for step in (Decimal("-0.0001"), Decimal(0), Decimal("0.0001"))]
        cases.append((name, None))
    df = spark.createDataFrame([(name, value) for name, value in cases], "name string, value decimal(18,4)")
    df = df.withColumn("value", F.col("value").cast(kind)).coalesce(1)
    results = df.select(
        "name", *[band("value", getattr(fixed, name)).cast("string").alias(name) for name in BANDS]
    ).collect()
    for (name, value), row in zip(cases, results):
        want = expected(value, getattr(fixed, name))
        got = row[name]
        assert got == (want if want is None or isinstance(want, str) else str(want)) or float(got) == float(want), (
            name,
            value,
        )


def test_rating_labels(spark):
    labels = [(label, score) for score, names in fixed.RATING_SCORE for label in names] + [("D", 0), (None, 0)]
    df = spark.createDataFrame(labels, "label string, want int").withColumn(
        "got", label_score("label", fixed.RATING_SCORE, fixed.RATING_SCORE_OTHERWISE)
    )
    assert df.filter("got <> want").count() == 0


def test_outlook_labels(spark):
    df = spark.createDataFrame([("Positive", 3), ("Stable", 2), ("Negative", 0), ("positive", 1), (None, 1)], "l string, want int")
    got = df.withColumn("got", label_score("l", fixed.RATING_OUTLOOK_SCORE, fixed.RATING_OUTLOOK_OTHERWISE))
    assert got.filter("got <> want").count() == 0


def test_level_counts_missing_as_zero(spark):
    df = spark.createDataFrame([(None,), (2,), (3,), (6,), (7,)], "score int")
    assert [row[0] for row in df.coalesce(1).select(level("score", 2, 6)).collect()] == [
        "HIGH", "HIGH", "MEDIUM", "MEDIUM", "LOW",
    ]


def test_component_maxima():
    assert sum(maximum for _, _, maximum in fixed.COMPONENTS) == 108
