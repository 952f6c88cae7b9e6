"""Data rules as jobs: violations are counted, never enforced by the storage."""

from __future__ import annotations

from functools import reduce
from typing import Callable, NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class NotNull(NamedTuple):
    column: str


class InSet(NamedTuple):
    """As a CHECK constraint: a NULL value does not violate it."""

    column: str
    values: tuple


class MaxLength(NamedTuple):
    column: str
    length: int


class Unique(NamedTuple):
    columns: str


class Reference(NamedTuple):
    column: str
    parent: str
    parent_column: str


_RESULT = ("table_name", "rule", "column_name", "violations")


def _row_violation(rule):
    value = F.col(rule.column)
    if isinstance(rule, NotNull):
        return "not_null", value.isNull()
    if isinstance(rule, InSet):
        return "domain", value.isNotNull() & ~value.isin(*rule.values)
    return "length", F.length(value.cast("string")) > rule.length


def row_rules(name: str, df: DataFrame, rules: list) -> DataFrame:
    """All single-row rules of a table in one pass over it."""
    checks = [(rule.column, *_row_violation(rule)) for rule in rules]
    counts = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("table_name"),
                    F.lit(kind).alias("rule"),
                    F.lit(column).alias("column_name"),
                    F.count_if(condition).alias("violations"),
                )
                for column, kind, condition in checks
            ]
        ).alias("checks")
    )
    return counts.select(F.inline("checks"))


def duplicate_keys(name: str, df: DataFrame, columns: str) -> DataFrame:
    """Number of key values that occur more than once; equal keys are pre-counted before the shuffle."""
    keys = [column.strip() for column in columns.split(",")]
    return (
        df.groupBy(*keys)
        .count()
        .filter(F.col("count") > 1)
        .agg(F.count(F.lit(1)).alias("violations"))
        .select(
            F.lit(name).alias("table_name"), F.lit("unique").alias("rule"), F.lit(",".join(keys)).alias("column_name"),
            "violations",
        )
    )


def orphans(name: str, df: DataFrame, rule: Reference, parent: DataFrame) -> DataFrame:
    """Rows whose key has no parent. Child keys are counted first, so a hot key crosses the shuffle once per task."""
    child = df.groupBy(F.col(rule.column).alias("key")).agg(F.count(F.lit(1)).alias("rows")).filter("key is not null")
    known = parent.select(F.col(rule.parent_column).alias("key"))
    return (
        child.join(known, "key", "left_anti")
        .agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("violations"))
        .select(
            F.lit(name).alias("table_name"), F.lit("reference").alias("rule"), F.lit(rule.column).alias("column_name"),
            "violations",
        )
    )


def check_rules(name: str, df: DataFrame, rules: list, parent: Callable[[str], DataFrame] | None = None) -> DataFrame:
    """(table_name, rule, column_name, violations), one row per rule."""
    rowwise = [rule for rule in rules if isinstance(rule, (NotNull, InSet, MaxLength))]
    parts = [row_rules(name, df, rowwise)] if rowwise else []
    parts += [duplicate_keys(name, df, rule.columns) for rule in rules if isinstance(rule, Unique)]
    parts += [orphans(name, df, rule, parent(rule.parent)) for rule in rules if isinstance(rule, Reference)]
    return reduce(DataFrame.unionByName, parts).select(*_RESULT)
