"""Seven component scores, the composite score, the grade and its drivers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendscope import fixed
from lendscope.functions.banding import band, label_score
from lendscope.functions.numbers import SCORE, share
from lendscope.functions.text import fill_sql, or_missing
from lendscope.operators.maintenance import Versions
from lendscope.operators.latest import latest, newest
from lendscope.session import materialize
from lendscope.sources.tables import Book

FINANCIAL_ORDER = ("fiscal_year", "fiscal_quarter", "financial_id")
RATING_ORDER = ("rating_date", "rating_id")


def latest_financials(book: Book) -> DataFrame:
    """Newest statement per customer. A yearly statement (NULL quarter) counts as newer than Q4 of its year."""
    return financial_state(book["company_financials"])


def latest_rating(book: Book) -> DataFrame:
    return rating_state(book["credit_ratings"])


def latest_industry(book: Book) -> DataFrame:
    return latest(book["industry_trends"], ["sector", "industry"], [newest("report_date"), newest("trend_id")])


def latest_macro(book: Book) -> DataFrame:
    return latest(
        book["macro_economic_indicators"], ["indicator_name"], [newest("report_date"), newest("indicator_id")]
    )


def statement_scores(statements: DataFrame) -> DataFrame:
    """The four ratio scores of every statement."""
    return statements.withColumns(
        {
            "de_score": band("debt_to_equity_ratio", fixed.DEBT_TO_EQUITY),
            "cr_score": band("current_ratio", fixed.CURRENT_RATIO),
            "icr_score": band("interest_coverage_ratio", fixed.INTEREST_COVERAGE),
            "npm_score": band("net_profit_margin", fixed.NET_PROFIT_MARGIN),
        }
    )


# Each fact table is brought to one row per customer, its state, from which the scores follow. Where a
# state is stored (see `plans.score_state`), it stands in for the fact table.


def financial_state(statements: DataFrame) -> DataFrame:
    return latest(statements, ["customer_id"], [newest(column) for column in FINANCIAL_ORDER])


def financial_scores(book: Book, state: DataFrame | None = None) -> DataFrame:
    total = F.col("de_score") + F.col("cr_score") + F.col("icr_score") + F.col("npm_score")
    statements = latest_financials(book) if state is None else state
    return statement_scores(statements).withColumn("financial_health_score", total)


def repayment_state(repayments: DataFrame) -> DataFrame:
    return repayments.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("payments"),
        F.count_if(F.col("payment_status") == "ON_TIME").alias("on_time"),
        F.max("days_overdue").alias("max_overdue"),
    )


def repayment_summary(book: Book, state: DataFrame | None = None) -> DataFrame:
    state = repayment_state(book["loan_repayment"]) if state is None else state
    return state.withColumn("on_time_pct", share(F.col("on_time"), F.col("payments"), 100))


def repayment_scores(book: Book, state: DataFrame | None = None) -> DataFrame:
    """Adds the score columns to the summary: share paid on time and worst delay."""
    scored = repayment_summary(book, state).withColumns(
        {
            "ontime_score": share(F.col("on_time"), F.col("payments"), fixed.ONTIME_MAXIMUM),
            "overdue_score": band("max_overdue", fixed.OVERDUE_DAYS),
        }
    )
    return scored.withColumn("repayment_score", (F.col("ontime_score") + F.col("overdue_score")).cast(SCORE))


def cashflow_state(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("transactions"),
        F.sum("credit_amount").alias("credit"),
        F.count("credit_amount").alias("credits"),
        F.sum("debit_amount").alias("debit"),
        F.count("debit_amount").alias("debits"),
        F.sum("running_balance").alias("balance"),
        F.count("running_balance").alias("balances"),
        F.min("running_balance").alias("min_balance"),
        F.count_if(F.col("running_balance") < 0).alias("negative_rows"),
    )


def cashflow_scores(book: Book, state: DataFrame | None = None) -> DataFrame:
    sums = cashflow_state(book["bank_transactions"]) if state is None else state
    flow = "credit / nullif(debit, 0)"
    steady = "min_balance / nullif(balance / balances, 0)"
    scored = sums.select(
        "customer_id",
        band(flow, fixed.CREDIT_TO_DEBIT).alias("net_flow_score"),
        F.when(F.col("min_balance") <= 0, 0)
        .otherwise(band(steady, fixed.BALANCE_STABILITY))
        .alias("balance_stability_score"),
        band("negative_rows", fixed.NEGATIVE_BALANCES).alias("stress_score"),
        F.round(F.expr(flow), 2).cast("decimal(18,2)").alias("credit_debit_ratio"),
        "min_balance",
    )
    total = F.col("net_flow_score") + F.col("balance_stability_score") + F.col("stress_score")
    return scored.withColumn("cashflow_behavior_score", total)


def collateral_state(loans: DataFrame) -> DataFrame:
    active = loans.filter(F.col("loan_status") == "ACTIVE")
    return active.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("loans"),
        F.sum("outstanding_balance").alias("total_outstanding"),
        F.count("outstanding_balance").alias("outstandings"),
        F.sum("collateral_value").alias("total_collateral"),
        F.count("collateral_value").alias("collaterals"),
    )


def collateral_scores(book: Book, state: DataFrame | None = None) -> DataFrame:
    """Cover of the ACTIVE loans; a customer without one has no row here."""
    state = collateral_state(book["loan_history"]) if state is None else state
    return state.select(
        "customer_id",
        "total_outstanding",
        "total_collateral",
        band("total_collateral / nullif(total_outstanding, 0)", fixed.COLLATERAL_COVER).alias("collateral_score"),
    )


def rating_state(ratings: DataFrame) -> DataFrame:
    return latest(ratings, ["customer_id"], [newest(column) for column in RATING_ORDER])


def rating_scores(book: Book, state: DataFrame | None = None) -> DataFrame:
    scored = (latest_rating(book) if state is None else state).withColumns(
        {
            "rating_num_score": label_score("rating", fixed.RATING_SCORE, fixed.RATING_SCORE_OTHERWISE),
            "outlook_score": label_score(
                "rating_outlook", fixed.RATING_OUTLOOK_SCORE, fixed.RATING_OUTLOOK_OTHERWISE
            ),
        }
    )
    return scored.withColumn("rating_score", F.col("rating_num_score") + F.col("outlook_score"))


def industry_scores(book: Book) -> DataFrame:
    scored = latest_industry(book).withColumns(
        {
            "default_rate_score": band("default_rate_pct", fixed.DEFAULT_RATE),
            "industry_outlook_score": label_score(
                "outlook", fixed.INDUSTRY_OUTLOOK_SCORE, fixed.INDUSTRY_OUTLOOK_OTHERWISE
            ),
            "reg_risk_score": band("regulatory_risk_score", fixed.REGULATORY_RISK),
        }
    )
    total = F.col("default_rate_score") + F.col("industry_outlook_score") + F.col("reg_risk_score")
    return scored.withColumn("industry_score", total)


def indicator(name: str, column: str = "value") -> Column:
    """Value of one named indicator in an aggregate over the latest indicators."""
    return F.max(F.when(F.col("indicator_name") == name, F.col(column)))


def macro_pivot(book: Book, names: dict[str, str] | None = None) -> DataFrame:
    """One row with one column per indicator."""
    names = names or {
        "cpi": fixed.CPI_NAME,
        "repo_rate": fixed.REPO_NAME,
        "credit_growth": fixed.CREDIT_GROWTH_NAME,
        "npa_ratio": fixed.NPA_NAME,
        "fx": fixed.FX_NAME,
    }
    return latest_macro(book).agg(*[indicator(name).alias(column) for column, name in names.items()])


def macro_scores(book: Book) -> DataFrame:
    """Exactly one row, also when there is no indicator at all."""
    values = latest_macro(book).agg(
        indicator(fixed.CPI_NAME).alias("latest_cpi"),
        indicator(fixed.REPO_NAME).alias("latest_repo_rate"),
        indicator(fixed.NPA_NAME).alias("latest_npa_ratio"),
        indicator(fixed.CREDIT_GROWTH_NAME).alias("credit_growth"),
        indicator(fixed.FX_NAME, "change_pct").alias("fx_change"),
    )
    scored = values.select(
        band("latest_cpi", fixed.CPI).alias("cpi_score"),
        band("latest_repo_rate", fixed.REPO_RATE).alias("repo_score"),
        band("credit_growth", fixed.CREDIT_GROWTH).alias("credit_growth_score"),
        band("latest_npa_ratio", fixed.SYSTEM_NPA).alias("system_npa_score"),
        band("fx_change", fixed.FX_CHANGE).alias("fx_score"),
        "latest_cpi",
        "latest_repo_rate",
        "latest_npa_ratio",
    )
    parts = ["cpi_score", "repo_score", "credit_growth_score", "system_npa_score", "fx_score"]
    return scored.withColumn("macro_environment_score", sum((F.col(part) for part in parts[1:]), F.col(parts[0])))


def with_industry(book: Book) -> DataFrame:
    """Customers with the newest trend of their sector and industry, where there is one.

    The newest trends are written first. Spark then knows their true size: as long as
    it is below the broadcast limit they are sent to the customers, and otherwise
    both are shuffled, where a hot sector is split by the skew-join rule.
    """
    trends = industry_scores(book).select(
        "sector", "industry", "outlook", "default_rate_pct", "sector_growth_pct", "industry_outlook_score",
        "industry_score",
    )
    return book["customers"].join(materialize(book.spark, trends, "trends"), ["sector", "industry"], "left")


def with_macro(book: Book, df: DataFrame) -> DataFrame:
    """Attach the single macro row as a scalar subquery: evaluated once, no join."""
    macro = macro_scores(book)
    return df.withColumn("macro", macro.select(F.struct("*")).scalar())


def drivers() -> Column:
    """Sentences of the risk drivers that apply, in fixed order; an empty string when none does."""
    sentences = (
        ("coalesce(de_score, 0) <= 4", fill_sql(fixed.DRIVER_LEVERAGE, de=or_missing("debt_to_equity_ratio"))),
        ("coalesce(icr_score, 0) <= 3", fill_sql(fixed.DRIVER_COVERAGE, icr=or_missing("interest_coverage_ratio"))),
        ("coalesce(ontime_score, 0) < 10", fill_sql(fixed.DRIVER_DELAYS, days=or_missing("max_overdue", "0"))),
        ("coalesce(net_flow_score, 0) <= 1", fill_sql(fixed.DRIVER_OUTFLOWS, ratio=or_missing("credit_debit_ratio"))),
        ("coalesce(stress_score, 0) = 0", fill_sql(fixed.DRIVER_STRESS)),
        ("coalesce(collateral_score, 0) <= 4", fill_sql(fixed.DRIVER_COLLATERAL)),
        ("coalesce(industry_outlook_score, 0) <= 1", fill_sql(fixed.DRIVER_INDUSTRY, outlook=or_missing("outlook"))),
        ("coalesce(rating_num_score, 0) <= 3", fill_sql(fixed.DRIVER_RATING, rating=or_missing("rating"))),
        ("coalesce(macro.cpi_score, 0) = 0", fill_sql(fixed.DRIVER_INFLATION, cpi=or_missing("macro.latest_cpi"))),
    )
    # Passes over NULLs, and is compiled with the rest of the row, as functions of arrays are not.
    applying = [F.expr(f"CASE WHEN {condition} THEN {sentence} END") for condition, sentence in sentences]
    return F.concat_ws(fixed.DRIVER_SEPARATOR, *applying)


def customer_components(book: Book, states: dict[str, DataFrame] | None = None) -> DataFrame:
    """One wide row per customer: the inputs and the component scores that no macro indicator changes.

    Every input is brought to one row per customer before its join, so no join
    multiplies rows, and the joins reuse the partitioning of the aggregates. With ``states``, one
    by the name of each fact table, no fact table is read.
    """
    given = states or {}
    financials = financial_scores(book, given.get("company_financials")).drop("financial_id")
    repayments = repayment_scores(book, given.get("loan_repayment"))
    cashflow = cashflow_scores(book, given.get("bank_transactions"))
    collateral = collateral_scores(book, given.get("loan_history"))
    ratings = rating_scores(book, given.get("credit_ratings")).select(
        "customer_id", "rating", "rating_outlook", "rating_num_score", "rating_score"
    )
    wide = with_industry(book)
    for part in (financials, repayments, cashflow, collateral, ratings):
        wide = wide.join(part, "customer_id", "left")
    return wide


def composed(book: Book, wide: DataFrame) -> DataFrame:
    """Customers with their components, the macro scores of the book, composite, grade and drivers."""
    wide = with_macro(book, wide)
    components = {name: F.coalesce(F.col(name), F.lit(0)) for name, _, _ in fixed.COMPONENTS[:-1]}
    components["macro_environment_score"] = F.coalesce(F.col("macro.macro_environment_score"), F.lit(0))
    components["key_risk_drivers"] = drivers()
    total = sum((F.col(name) for name, _, _ in fixed.COMPONENTS), F.lit(0))
    return (
        wide.withColumns(components)
        .withColumn("composite_score", F.round(total, 1).cast(SCORE))
        .withColumn("risk_grade", band("composite_score", fixed.RISK_GRADE))
    )


def scored_customers(book: Book) -> DataFrame:
    """The frame that scores, signals, classification and assessments all select from."""
    return composed(book, customer_components(book))


def select_scores(scored: DataFrame) -> DataFrame:
    return scored.select(
        "customer_id",
        "company_name",
        "sector",
        "industry",
        *[name for name, _, _ in fixed.COMPONENTS],
        "composite_score",
        "risk_grade",
        "key_risk_drivers",
        F.col("credit_debit_ratio").alias("cashflow_ratio"),
        F.col("min_balance").alias("min_account_balance"),
        "macro.latest_cpi",
        "macro.latest_repo_rate",
        "macro.latest_npa_ratio",
    )


def risk_scores(book: Book) -> DataFrame:
    """The score table, without the time stamp of the run (see :func:`stamped`)."""
    return select_scores(scored_customers(book))


def stamped(scores: DataFrame) -> DataFrame:
    return scores.withColumn("scored_at", F.current_timestamp().cast("timestamp_ntz"))


def stored_components(book: Book) -> DataFrame:
    """The customers' components, written once for refreshes that only bring new indicators."""
    return materialize(book.spark, customer_components(book), "components")


def refreshed_scores(book: Book, components: DataFrame, indicators: DataFrame) -> DataFrame:
    """The score table from stored components and the current indicators: no fact table is read."""
    return select_scores(composed(book.replaced(macro_economic_indicators=indicators), components))


def publish_scores(book: Book, base: str) -> int:
    """Compute the score table once and publish it below ``base``; all reports read it from there."""
    return Versions(book.spark, f"{base}/risk_scores").write(stamped(risk_scores(book)))


def with_stored_scores(book: Book) -> Book:
    """The book with the score table computed once, stamped and written: reports read it from there."""
    return book.replaced(risk_scores=materialize(book.spark, stamped(risk_scores(book)), "risk-scores"))
