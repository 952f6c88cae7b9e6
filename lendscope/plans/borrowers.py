"""Reports of one borrower, computed for all borrowers or for a set of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope import fixed
from lendscope.functions.numbers import scaled
from lendscope.sources.tables import Book


def for_customers(df: DataFrame, wanted: DataFrame | None) -> DataFrame:
    """Rows of the wanted customers (a DataFrame with customer_id); all rows without it."""
    return df if wanted is None else df.join(wanted.select("customer_id"), "customer_id", "left_semi")


def borrower_list(book: Book) -> DataFrame:
    return book["customers"].select("customer_id", "company_name", "risk_tier").orderBy("company_name", "customer_id")


def borrower_financials(book: Book, wanted: DataFrame | None = None) -> DataFrame:
    return (
        for_customers(book["company_financials"], wanted)
        .select(
            "customer_id",
            "fiscal_year",
            "fiscal_quarter",
            scaled(F.col("revenue"), fixed.CRORE).alias("revenue_cr"),
            scaled(F.col("ebitda"), fixed.CRORE).alias("ebitda_cr"),
            scaled(F.col("net_profit"), fixed.CRORE).alias("net_profit_cr"),
            F.col("debt_to_equity_ratio").alias("de_ratio"),
            F.col("interest_coverage_ratio").alias("icr"),
            F.round(F.col("net_profit_margin") * 100, 1).alias("npm_pct"),
            "current_ratio",
            F.round(F.col("return_on_assets") * 100, 1).alias("roa_pct"),
        )
        .orderBy("customer_id", "fiscal_year", "fiscal_quarter")
    )


def borrower_loans(book: Book, wanted: DataFrame | None = None) -> DataFrame:
    return (
        for_customers(book["loan_history"], wanted)
        .orderBy("customer_id", F.desc_nulls_first("outstanding_balance"), "loan_id")
        .select(
            "customer_id",
            "loan_id",
            "loan_type",
            scaled(F.col("sanctioned_amount"), fixed.CRORE).alias("sanctioned_cr"),
            scaled(F.col("outstanding_balance"), fixed.CRORE).alias("outstanding_cr"),
            scaled(F.col("collateral_value"), fixed.CRORE).alias("collateral_cr"),
            "loan_status",
            F.col("interest_rate").alias("rate_pct"),
            "purpose",
        )
    )


def borrower_repayments(book: Book, wanted: DataFrame | None = None) -> DataFrame:
    return (
        for_customers(book["loan_repayment"], wanted)
        .orderBy("customer_id", "due_date", "repayment_id")
        .select(
            "customer_id",
            "repayment_id",
            "due_date",
            scaled(F.col("emi_amount"), fixed.LAKH).alias("emi_lakhs"),
            "payment_status",
            "days_overdue",
        )
    )
