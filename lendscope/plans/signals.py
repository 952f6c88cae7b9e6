"""Borrower profile text, risk signals, overdue category and lending recommendation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendscope import fixed
from lendscope.functions.banding import band, level
from lendscope.functions.text import fill, fill_sql, or_missing
from lendscope.plans.scoring import scored_customers
from lendscope.providers import Provider, classify, extract_fields
from lendscope.sources.tables import Book

IDENTITY = ("customer_id", "company_name", "sector", "industry")


def crore_text(column: str) -> str:
    """SQL text of an amount in whole crore with thousands separators, or the word for a missing one."""
    return f"coalesce(concat(format_number(round({column} / {fixed.CRORE}, 0), 0), ' Cr'), '{fixed.MISSING}')"


MARGIN_PERCENT = "CAST(round(net_profit_margin * 100, 2) AS DECIMAL(10,2))"


def profile_text() -> Column:
    """One paragraph per borrower; NULL when the company name or the industry is NULL."""
    payments = fill_sql(fixed.PROFILE_PAYMENTS_FORMAT, on_time="on_time_pct", overdue="max_overdue")
    return fill(
        fixed.PROFILE_FORMAT,
        company="company_name",
        industry="industry",
        revenue=crore_text("revenue"),
        ebitda=crore_text("ebitda"),
        de=or_missing("debt_to_equity_ratio"),
        icr=or_missing("interest_coverage_ratio"),
        cr=or_missing("current_ratio"),
        npm=or_missing(MARGIN_PERCENT),
        fcf=crore_text("free_cash_flow"),
        outstanding=crore_text("total_outstanding"),
        collateral=crore_text("total_collateral"),
        payments=f"coalesce({payments}, '{fixed.PROFILE_NO_PAYMENTS}')",
        outlook=or_missing("outlook"),
        default_rate=or_missing("default_rate_pct"),
    )


def borrower_profiles(book: Book, scored: DataFrame | None = None) -> DataFrame:
    scored = scored if scored is not None else scored_customers(book)
    return scored.select(*IDENTITY, profile_text().alias("profile_text"))


def signal_rules() -> dict[str, Column]:
    """Default signals: bands over the scores behind the profile."""
    return {
        "debt_sustainability": level("de_score", 2, 6),
        "liquidity_risk": level("cr_score", 2, 4),
        "repayment_risk": level("overdue_score", 2, 6),
        "collateral_adequacy": level("collateral_score", 4, 7),
        "revenue_stability": level("npm_score", 1, 3),
        "overall_risk_narrative": F.col("key_risk_drivers"),
    }


def risk_signals(book: Book, provider: Provider | None = None, scored: DataFrame | None = None) -> DataFrame:
    scored = scored if scored is not None else scored_customers(book)
    if provider is not None:
        return extract_fields(borrower_profiles(book, scored), "profile_text", fixed.SIGNAL_FIELDS, provider)
    rules = signal_rules()
    return scored.select(
        *IDENTITY,
        profile_text().alias("profile_text"),
        *[rules[name].alias(name) for name in fixed.SIGNAL_FIELDS],
    )


def overdue_category() -> Column:
    """NPA and SMA steps by days overdue; any delay or a stressed score is SMA_0; a NULL score is no stress."""
    stressed = (F.coalesce("max_overdue", F.lit(0)) > 0) | (F.col("composite_score") < fixed.STRESSED_SCORE)
    return F.coalesce(
        band("coalesce(max_overdue, 0)", fixed.OVERDUE_CATEGORY), F.when(stressed, "SMA_0").otherwise("STANDARD")
    )


def classification_text() -> Column:
    return fill(
        fixed.CLASSIFICATION_FORMAT,
        company="company_name",
        industry="industry",
        score=or_missing("composite_score"),
        grade=or_missing("risk_grade"),
        overdue=or_missing("max_overdue", "0"),
        de=or_missing("debt_to_equity_ratio"),
        icr=or_missing("interest_coverage_ratio"),
        on_time=or_missing("on_time_pct", "0"),
        drivers=or_missing("key_risk_drivers", "None identified"),
    )


def recommendation_rule() -> Column:
    """Default recommendation from overdue category and grade; the first rule that holds wins."""
    overdue, grade = F.col("sma_category"), F.col("risk_grade")
    return (
        F.when((overdue == "NPA") | (grade == "E"), "REJECT")
        .when((overdue == "SMA_2") | (grade == "D"), "ESCALATE")
        .when((overdue == "SMA_1") | (grade == "C"), "CONDITIONAL_APPROVE")
        .otherwise("APPROVE")
    )


def classified(scored: DataFrame, provider: Provider | None = None) -> DataFrame:
    """The wide frame with classification text, overdue category and recommendation."""
    rows = scored.withColumns(
        {"classification_text": classification_text(), "sma_category": overdue_category()}
    )
    if provider is None:
        return rows.withColumn("lending_recommendation", recommendation_rule())
    return classify(rows, "classification_text", fixed.RECOMMENDATIONS, provider, "lending_recommendation")


def borrower_classification(book: Book, provider: Provider | None = None) -> DataFrame:
    return classified(scored_customers(book), provider).select(
        *IDENTITY,
        "composite_score",
        "risk_grade",
        F.coalesce("max_overdue", F.lit(0)).alias("max_days_overdue"),
        F.coalesce("on_time_pct", F.lit(0)).cast("decimal(6,1)").alias("on_time_pct"),
        "sma_category",
        "lending_recommendation",
        "key_risk_drivers",
        "classification_text",
    )
