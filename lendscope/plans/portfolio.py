"""Portfolio reports over the stored score table (``book["risk_scores"]``) and the loan book."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope import fixed
from lendscope.functions.banding import band
from lendscope.functions.numbers import mean_score
from lendscope.sources.tables import Book


def high_risk():
    return F.col("risk_grade").isin(*fixed.HIGH_RISK_GRADES)


def exposure_kpis(book: Book) -> DataFrame:
    """One row, also for an empty loan book. All loans count as exposure; ACTIVE and NPA are shown beside it."""
    balance, status = F.col("outstanding_balance"), F.col("loan_status")
    return book["loan_history"].agg(
        F.sum(balance).alias("total_exposure"),
        F.sum(F.when(status == "ACTIVE", balance)).alias("active_exposure"),
        F.sum(F.when(status.isin("NPA", "DEFAULT"), balance).otherwise(F.lit(0))).alias("npa_exposure"),
        F.count_distinct("customer_id").alias("borrowers"),
    )


def portfolio_kpis(book: Book) -> DataFrame:
    scores = book["risk_scores"].agg(
        F.count(F.lit(1)).alias("borrowers"),
        F.bround(mean_score("composite_score"), 0).cast("long").alias("avg_score"),
        F.count_if(high_risk()).alias("high_risk"),
    )
    loans = exposure_kpis(book).select(
        F.struct(
            *[
                F.bround(F.coalesce(F.col(name), F.lit(0)) / F.lit(fixed.BILLION).cast("decimal(10,0)"), 1).alias(name)
                for name in ("total_exposure", "active_exposure", "npa_exposure")
            ]
        )
    )
    return scores.withColumn("loans", loans.scalar()).select(
        "borrowers",
        "avg_score",
        "high_risk",
        F.col("loans.total_exposure").alias("total_exposure_bn"),
        F.col("loans.active_exposure").alias("active_exposure_bn"),
        F.col("loans.npa_exposure").alias("npa_exposure_bn"),
    )


def grade_counts(book: Book) -> DataFrame:
    return book["risk_scores"].groupBy("risk_grade").agg(F.count(F.lit(1)).alias("count")).orderBy("risk_grade")


def grade_distribution(book: Book) -> DataFrame:
    return (
        book["risk_scores"]
        .groupBy("risk_grade")
        .agg(
            F.count_distinct("customer_id").alias("borrower_count"),
            F.round(mean_score("composite_score"), 1).alias("avg_score"),
        )
        .orderBy("risk_grade")
    )


def sma_breakdown(book: Book) -> DataFrame:
    """Customers per overdue category, by delay alone."""
    worst = book["loan_repayment"].groupBy("customer_id").agg(F.max("days_overdue").alias("days"))
    return (
        worst.groupBy(band("days", fixed.OVERDUE_CATEGORY_REPORT).alias("category"))
        .agg(F.count(F.lit(1)).alias("customers"))
        .orderBy(F.desc("customers"), "category")
    )


def sector_summary(book: Book) -> DataFrame:
    """Customers without a sector are left out; halves round to even."""
    return (
        book["risk_scores"]
        .filter(F.col("sector").isNotNull())
        .groupBy("sector")
        .agg(
            F.count("customer_id").alias("borrowers"),
            F.bround(mean_score("composite_score"), 1).alias("avg_score"),
            F.min("composite_score").alias("min_score"),
            F.count_if(high_risk()).alias("high_risk"),
        )
        .orderBy("avg_score", "sector")
    )


SCORECARD = ("customer_id", "company_name", "sector", "composite_score", "risk_grade", "key_risk_drivers")


def scorecard(book: Book) -> DataFrame:
    return book["risk_scores"].select(*SCORECARD).orderBy(F.desc_nulls_last("composite_score"), "customer_id")


def high_risk_borrowers(book: Book) -> DataFrame:
    return (
        book["risk_scores"]
        .filter(high_risk())
        .select("customer_id", "company_name", "composite_score", "risk_grade", "key_risk_drivers")
        .orderBy("composite_score", "customer_id")
    )


def worst_rows(book: Book, rows: int = fixed.WORST_ROWS) -> DataFrame:
    """The rows with the lowest scores: a top-k report."""
    return book["risk_scores"].select(*SCORECARD).orderBy("composite_score", "customer_id").limit(rows)


def score_components(book: Book) -> DataFrame:
    """One row per customer and component, with the component's maximum."""
    names = [name for name, _, _ in fixed.COMPONENTS]
    long = (
        book["risk_scores"]
        .select("customer_id", *[F.col(name).cast("decimal(6,1)").alias(name) for name in names])
        .unpivot("customer_id", names, "component", "score")
    )
    labels = F
    maxima = F
    for name, label, maximum in fixed.COMPONENTS:
        labels = labels.when(F.col("component") == name, F.lit(label))
        maxima = maxima.when(F.col("component") == name, F.lit(maximum))
    return long.select("customer_id", labels.alias("component"), "score", maxima.alias("max_score"))


def exposure_list(book: Book) -> DataFrame:
    """ACTIVE loans with their customer, largest balance first; as everywhere, falling order puts NULL before all values."""
    loans = book["loan_history"].filter(F.col("loan_status") == "ACTIVE")
    return (
        loans.join(book["customers"], "customer_id")
        .select(
            "loan_id", "company_name", "sector", "loan_type", "outstanding_balance", "collateral_value", "loan_status"
        )
        .orderBy(F.desc_nulls_first("outstanding_balance"), "loan_id")
    )
