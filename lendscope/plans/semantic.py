"""Semantic model: dimensions, measures and relationships, queried by name."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendscope.sources.tables import Book


class Entity(NamedTuple):
    """A table of the model. Every table is joined many-to-one to customers on customer_id."""

    dimensions: tuple[str, ...]
    measures: dict[str, str]
    time_dimensions: tuple[str, ...] = ()
    one_per_customer: bool = False


# --- fixed values: the model. A score without its own aggregate is averaged. ---
MODEL: dict[str, Entity] = {
    "customers": Entity(
        ("customer_id", "company_name", "sector", "industry", "risk_tier", "relationship_manager"),
        {"total_borrowers": "count(distinct customer_id)"},
        one_per_customer=True,
    ),
    "risk_scores": Entity(
        ("customer_id", "risk_grade", "key_risk_drivers"),
        {
            "composite_score": "avg(CAST(composite_score AS DECIMAL(20,10)))",
            "financial_health_score": "avg(CAST(financial_health_score AS DECIMAL(20,10)))",
            "repayment_score": "avg(CAST(repayment_score AS DECIMAL(20,10)))",
            "cashflow_behavior_score": "avg(CAST(cashflow_behavior_score AS DECIMAL(20,10)))",
            "collateral_score": "avg(CAST(collateral_score AS DECIMAL(20,10)))",
            "rating_score": "avg(CAST(rating_score AS DECIMAL(20,10)))",
            "industry_score": "avg(CAST(industry_score AS DECIMAL(20,10)))",
            "macro_environment_score": "avg(CAST(macro_environment_score AS DECIMAL(20,10)))",
            "avg_risk_score": "avg(CAST(composite_score AS DECIMAL(20,10)))",
        },
        one_per_customer=True,
    ),
    "loan_applications": Entity(
        ("application_id", "customer_id", "application_status", "ai_recommendation", "officer_decision", "loan_type"),
        {"total_applications": "count(*)", "total_requested_amount": "sum(requested_amount)"},
        ("application_date",),
    ),
    "loan_history": Entity(
        ("customer_id", "loan_type", "loan_status"),
        {
            "total_outstanding": "sum(outstanding_balance)",
            "total_collateral": "sum(collateral_value)",
            "active_loan_count": "count(*)",
        },
    ),
}


def _split(name: str) -> tuple[str, str]:
    table, column = name.split(".")
    entity = MODEL[table]
    if column not in (*entity.dimensions, *entity.time_dimensions):
        raise ValueError(f"{name} is not a dimension of the model")
    return table, column


def _label(name: str) -> str:
    return name.replace(".", "_")


def _with_dimensions(book: Book, table: str, names: list[str]) -> DataFrame:
    """Rows of one table with the named dimensions attached; joins only tables with one row per customer."""
    wanted: dict[str, list[str]] = {}
    for name in names:
        owner, column = _split(name)
        wanted.setdefault(owner, []).append(column)
    rows = book[table]
    for column in wanted.pop(table, []):
        rows = rows.withColumn(_label(f"{table}.{column}"), F.col(column))
    for owner, columns in wanted.items():
        if not MODEL[owner].one_per_customer:
            raise ValueError(f"{owner} has many rows per customer and cannot describe {table}")
        side = book[owner].select(
            "customer_id", *[F.col(column).alias(_label(f"{owner}.{column}")) for column in columns]
        )
        rows = rows.join(side, "customer_id")
    return rows


def query(
    book: Book, measures: list[str], dimensions: list[str], filters: dict[str, list] | None = None
) -> DataFrame:
    """Measures by dimensions, all given as ``table.name``.

    Each table is aggregated to the requested dimensions on its own and the
    results are then put side by side, so a measure is never multiplied by rows of
    another table. The book must hold ``risk_scores`` when its columns are asked
    for. ``filters`` maps a dimension to its allowed values.
    """
    filters = filters or {}
    asked: dict[str, list[str]] = {}
    for name in measures:
        table, measure = name.split(".")
        if measure not in MODEL[table].measures:
            raise ValueError(f"{name} is not a measure of the model")
        asked.setdefault(table, []).append(measure)
    keys = [_label(name) for name in dimensions]
    parts = []
    for table, names in asked.items():
        rows = _with_dimensions(book, table, sorted({*dimensions, *filters}))
        for name, values in filters.items():
            rows = rows.filter(F.col(_label(name)).isin(*values))
        aggregates: list[Column] = [F.expr(MODEL[table].measures[name]).alias(name) for name in names]
        parts.append(rows.groupBy(*keys).agg(*aggregates))
    if len(parts) == 1:
        return parts[0]
    together = reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), parts)
    columns = [name.split(".")[1] for name in measures]
    return together.groupBy(*keys).agg(*[F.max(column).alias(column) for column in columns])
