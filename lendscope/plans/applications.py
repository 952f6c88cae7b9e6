"""Loan application pipeline reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendscope import fixed
from lendscope.functions.numbers import scaled
from lendscope.sources.tables import Book


def loan_applications(book: Book) -> DataFrame:
    """Applications with their customer, newest first."""
    return (
        book["loan_applications"]
        .join(book["customers"].select("customer_id", "company_name"), "customer_id")
        .select(
            "application_id",
            "company_name",
            "loan_type",
            scaled(F.col("requested_amount"), fixed.CRORE).alias("requested_cr"),
            "application_status",
            "ai_recommendation",
            F.round(F.col("ai_confidence_score") * 100, 0).alias("confidence"),
            "officer_decision",
            "application_date",
            "ai_recommendation_reason",
        )
        .orderBy(F.desc_nulls_first("application_date"), "application_id")
    )


def chosen(df: DataFrame, column: str, values: list | None = None) -> DataFrame:
    """Rows whose value was chosen. ``None`` keeps every value seen, and a None in the list keeps NULL rows."""
    if values is None:
        return df
    keep = F.col(column).isin(*[value for value in values if value is not None])
    if None in values:
        keep = keep | F.col(column).isNull()
    return df.filter(keep)


def applications_filtered(book: Book, statuses: list | None = None) -> DataFrame:
    return chosen(loan_applications(book), "application_status", statuses).drop("ai_recommendation_reason")


def application_kpis(book: Book) -> DataFrame:
    status = F.col("application_status")
    return book["loan_applications"].agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(status.isin(*fixed.OPEN_APPLICATION_STATUSES)).alias("in_pipeline"),
        F.count_if(status == "APPROVED").alias("approved"),
        F.count_if(status == "REJECTED").alias("rejected"),
    )


def says_approve(column: str) -> Column:
    """Any label that contains APPROVE in any case counts, so CONDITIONAL_APPROVE does too."""
    return F.upper(column).contains("APPROVE")


def decision_alignment(book: Book) -> DataFrame:
    """How often advice and officer decision agree, among applications that have both."""
    advised, decided = F.col("ai_recommendation").isNotNull(), F.col("officer_decision").isNotNull()
    agree = says_approve("ai_recommendation") == says_approve("officer_decision")
    counts = book["loan_applications"].agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(advised).alias("advised"),
        F.count_if(advised & decided).alias("decided"),
        F.count_if(advised & decided & agree).alias("agree"),
    )
    rate = F.bround(
        F.col("agree").cast("decimal(20,0)") * 100 / F.nullif(F.col("decided"), F.lit(0)).cast("decimal(20,0)"), 0
    )
    return counts.withColumn("agreement_rate", rate.cast("long"))


def pending_applications(book: Book) -> DataFrame:
    return (
        book["loan_applications"]
        .filter(F.col("application_status").isin(*fixed.OPEN_APPLICATION_STATUSES))
        .join(book["customers"].select("customer_id", "company_name"), "customer_id")
        .orderBy("application_date", "application_id")
        .select(
            "application_id", "company_name", "loan_type", "requested_amount", "application_status", "ai_recommendation"
        )
    )
