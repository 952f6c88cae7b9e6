"""Exact money and ratio arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
RATIO = T.DecimalType(8, 4)
RATE = T.DecimalType(5, 2)
SCORE = T.DecimalType(6, 1)


def money(value: Column) -> Column:
    """Two-digit decimal, so that sums do not depend on the order of rows."""
    return value.cast(MONEY)


def share(hits: Column, rows: Column, scale: int) -> Column:
    """``scale`` times the share of hits, rounded half up to one digit."""
    return F.round(hits * F.lit(scale).cast("decimal(5,1)") / F.nullif(rows, F.lit(0)), 1).cast(SCORE)


def scaled(value: Column, unit: int, digits: int = 1) -> Column:
    """Amount in a larger unit (crore, lakh, billion), rounded half up."""
    return F.round(value / F.lit(unit).cast("decimal(10,0)"), digits)


def grouped(value: Column) -> Column:
    """Whole number with thousands separators."""
    return F.format_number(F.round(value, 0), 0)


def mean_score(column: str) -> Column:
    """Mean with enough digits that a later rounding is not a second one."""
    return F.avg(F.col(column).cast("decimal(20,10)"))
