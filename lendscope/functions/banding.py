"""Threshold bands and label maps as Column expressions.

Values are given as SQL text (a column name or an expression). A whole CASE then
reaches Spark as one expression, and the limits stay exact decimals.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lendscope.fixed import Bands


def _literal(value) -> str:
    if value is None:
        return "NULL"
    return f"'{value}'" if isinstance(value, str) else str(value)


def band(value: str, bands: Bands) -> Column:
    """Score of the first threshold that holds; NULL compares as false and falls to the last value."""
    steps = " ".join(f"WHEN {value} {symbol} {limit} THEN {_literal(score)}" for symbol, limit, score in bands.steps)
    return F.expr(f"CASE {steps} ELSE {_literal(bands.otherwise)} END")


def label_score(label: str, table: tuple, otherwise: int) -> Column:
    """Score of a label from ``((score, labels), ...)``; unknown and NULL labels get ``otherwise``."""
    steps = " ".join(f"WHEN {label} IN ({', '.join(map(_literal, labels))}) THEN {score}" for score, labels in table)
    return F.expr(f"CASE {steps} ELSE {otherwise} END")


def level(score: str, high: int, medium: int) -> Column:
    """HIGH / MEDIUM / LOW from a score where few points mean high risk; a missing score counts as 0."""
    points = f"coalesce({score}, 0)"
    return F.expr(f"CASE WHEN {points} <= {high} THEN 'HIGH' WHEN {points} <= {medium} THEN 'MEDIUM' ELSE 'LOW' END")
