"""Macro and industry reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope import fixed
from lendscope.plans.scoring import indicator, latest_industry, latest_macro
from lendscope.sources.tables import Book


def macro_list(book: Book) -> DataFrame:
    return (
        latest_macro(book)
        .select(
            "indicator_name", "indicator_category", "value", "previous_value", "change_pct", "unit", "report_date",
            "source",
        )
        .orderBy("indicator_category", "indicator_name")
    )


def industry_list(book: Book) -> DataFrame:
    return (
        latest_industry(book)
        .select(
            "sector", "industry", "outlook", F.col("default_rate_pct").alias("default_rate"),
            F.col("npa_ratio_pct").alias("npa_ratio"), F.col("sector_growth_pct").alias("growth"), "key_risk_factors",
            "report_date",
        )
        .orderBy(F.desc_nulls_first("default_rate"), "sector", "industry")
    )


def macro_headline(book: Book, names: tuple[str, ...] = fixed.HEADLINE_INDICATORS) -> DataFrame:
    """One row: value and change of every named indicator; NULL for an indicator that has no report."""
    columns = []
    for name in names:
        columns.append(indicator(name).alias(f"{name.lower()}_value"))
        columns.append(F.bround(indicator(name, "change_pct"), 1).alias(f"{name.lower()}_change"))
    return latest_macro(book).agg(*columns)
