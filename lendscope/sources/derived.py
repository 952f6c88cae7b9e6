"""Domain tables derived from the driver's order, line, event and customer tables.

The driver's tables hold no lending data, so each domain table is computed from
whole driver tables by the arithmetic below. The SQL checks use the same rules.
Keys keep the driver's integer type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lendscope.operators.running import running_total
from lendscope.sources.schemas import DEFAULTS
from lendscope.sources.tables import Book, with_defaults

# --- fixed values of the derivation ---
RATING_LABELS = (
    "AAA", "AA+", "AA", "AA-", "A+", "A", "A-", "BBB+", "BBB", "BBB-", "BB+", "BB", "BB-", "B+", "B", "B-", "CCC",
    "Aa1", "A2", "Baa3", "Ba2",
)
RATING_OUTLOOKS = ("Positive", "Stable", "Negative", None)
INDUSTRY_OUTLOOKS = ("POSITIVE", "STABLE", "WATCHLIST", "NEGATIVE")
APPLICATION_STATUSES = ("PENDING", "UNDER_REVIEW", "APPROVED", "REJECTED", "WITHDRAWN", "ESCALATED")
APPLICATION_ADVICE = ("APPROVE", "REJECT", "CONDITIONAL_APPROVE", "ESCALATE", None)
APPLICATION_DECISIONS = ("APPROVED", "REJECTED", "DEFERRED", None)
EVENT_INDICATORS = {
    # event type: (indicator, category, unit, divisor)
    "view": ("CPI_GENERAL", "INFLATION", "percent", 10),
    "click": ("REPO_RATE", "RATES", "percent", 10),
    "purchase": ("INR_USD", "FX", "rupees", 10),
    "signup": ("GROSS_NPA_RATIO", "CREDIT", "percent", 20),
    "error": ("CREDIT_GROWTH_INDUSTRY", "GROWTH", "percent", 5),
}


# Order keys are reduced before they are summed, so that sums stay inside 64 bits at any table size.
KEY = "o_orderkey % 1000000"
PRICE = "CAST(o_totalprice AS DECIMAL(18,2))"
# Amounts are summed as whole cents in 64 bits, which takes less time and room than sums of decimals; no sum that fits
# its column comes near their limit.
CENTS = f"CAST({PRICE} * 100 AS BIGINT)"


def amount(cents: str) -> str:
    """SQL text of a sum of cents as an amount."""
    return f"CAST(CAST({cents} AS DECIMAL(20,0)) * 0.01BD AS DECIMAL(18,2))"


def _pick(values: tuple, place: str) -> str:
    """SQL text for label number ``place`` (from 0) of a fixed list."""
    listed = ", ".join("NULL" if value is None else f"'{value}'" for value in values)
    return f"element_at(array({listed}), CAST({place} AS INT) + 1)"


def _by_event_type(place: int) -> str:
    """SQL text that picks one attribute of the indicator of an event type."""
    steps = " ".join(
        f"WHEN '{event_type}' THEN {row[place]!r}" for event_type, row in EVENT_INDICATORS.items()
    )
    return f"CASE event_type {steps} END"


def customers(book: Book) -> DataFrame:
    return (
        book["customer"]
        .join(book["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
        .join(book["region"], F.col("n_regionkey") == F.col("r_regionkey"))
        .selectExpr(
            "c_custkey AS customer_id",
            "c_name AS company_name",
            "c_mktsegment AS sector",
            "r_name AS industry",
            "n_name AS country",
            "CASE WHEN c_acctbal < 2000 THEN 'HIGH' WHEN c_acctbal < 6000 THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier",
        )
    )


def company_financials(book: Book) -> DataFrame:
    """Quarterly statements and, with a NULL quarter, the yearly statement."""
    orders = book["orders"].selectExpr(
        "o_custkey AS customer_id",
        "CAST(year(o_orderdate) AS BIGINT) AS fiscal_year",
        "coalesce(quarter(o_orderdate), 0) AS quarter",
        f"{KEY} AS k",
        f"{CENTS} AS c",
    )
    # A year's statements are summed side by side in one row, so that an order enters one group and not one for each statement.
    kinds = [("NULL", "true"), *((str(q), f"quarter = {q}") for q in (1, 2, 3, 4)), ("NULL", "quarter = 0")]
    sums, rows = [], []
    for place, (q, here) in enumerate(kinds):
        parts = {"n": f"count_if({here})", "s": f"sum(CASE WHEN {here} THEN k END)", "c": f"sum(CASE WHEN {here} THEN c END)"}
        sums += [F.expr(f"{part} AS {name}{place}") for name, part in parts.items()]
        rows.append(f"named_struct('q', CAST({q} AS INT), 'n', n{place}, 's', s{place}, 'c', c{place})")
    years = orders.groupBy("customer_id", "fiscal_year").agg(*sums)
    sums = years.selectExpr("customer_id", "fiscal_year", f"inline(array({', '.join(rows)}))").where("n > 0").selectExpr(
        "customer_id", "fiscal_year", "q", "s", f"{amount('c')} AS revenue"
    )

    # Products with exact fractions: a division of decimals takes many times as long, and there are seven in every statement.
    def part_of_revenue(percent: int) -> str:
        return f"CAST(revenue * 0.{percent:02d}BD AS DECIMAL(18,2))"

    def ratio(whole: str, unit: str, less: str = "0") -> str:
        return f"CAST(CAST({whole} AS DECIMAL(8,0)) * {unit}BD - {less} AS DECIMAL(8,4))"

    return sums.selectExpr(
        "concat_ws('-', customer_id, fiscal_year, coalesce(concat('Q', q), 'FY')) AS financial_id",
        "customer_id",
        "fiscal_year",
        "concat('Q', q) AS fiscal_quarter",
        "revenue",
        f"{part_of_revenue(20)} AS ebitda",
        f"{part_of_revenue(8)} AS net_profit",
        f"{part_of_revenue(10)} AS free_cash_flow",
        f"CASE WHEN s % 37 != 0 THEN {ratio('s % 500', '0.01')} END AS debt_to_equity_ratio",
        f"{ratio('s * 7 % 300', '0.01')} AS current_ratio",
        f"{ratio('s * 13 % 800', '0.01')} AS interest_coverage_ratio",
        f"{ratio('s * 17 % 250', '0.001', '0.05')} AS net_profit_margin",
        f"{ratio('s * 19 % 200', '0.001')} AS return_on_assets",
    )


def loan_history(book: Book) -> DataFrame:
    pledged = (
        book["lineitem"]
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.expr("sum(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS BIGINT)) AS c"))
        .selectExpr("o_orderkey", f"{amount('c')} AS collateral_value")
    )
    return (
        book["orders"]
        .join(pledged, "o_orderkey", "left")
        .selectExpr(
            "o_orderkey AS loan_id",
            "o_custkey AS customer_id",
            "o_orderpriority AS loan_type",
            f"{PRICE} AS sanctioned_amount",
            f"CAST({PRICE} * 0.5BD AS DECIMAL(18,2)) AS outstanding_balance",
            "CAST(5 + CAST(o_orderkey % 800 AS DECIMAL(8,0)) / 100 AS DECIMAL(5,2)) AS interest_rate",
            "to_date(o_orderdate) AS sanction_date",
            "collateral_value",
            "CASE o_orderstatus WHEN 'O' THEN 'ACTIVE' WHEN 'F' THEN 'CLOSED' WHEN 'P' THEN 'NPA' END AS loan_status",
            "concat('Facility ', o_orderpriority) AS purpose",
            "'USD' AS currency",
        )
    )


def loan_repayment(book: Book) -> DataFrame:
    late = "l_returnflag = 'R' AND l_discount >= 0.08D"
    return (
        book["lineitem"]
        .join(book["orders"], F.col("l_orderkey") == F.col("o_orderkey"))
        .selectExpr(
            "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS repayment_id",
            "l_orderkey AS loan_id",
            "o_custkey AS customer_id",
            "to_date(o_orderdate) AS due_date",
            "CAST(l_extendedprice AS DECIMAL(18,2)) AS emi_amount",
            f"CASE WHEN {late} AND o_custkey % 5 > 0 THEN 'LATE' ELSE 'ON_TIME' END AS payment_status",
            f"CASE WHEN {late} THEN CAST(floor(l_quantity * (o_custkey % 5) / 2) AS BIGINT) ELSE 0L END AS days_overdue",
        )
    )


def bank_transactions(book: Book) -> DataFrame:
    def value_of(*kinds: str) -> str:
        return f"CAST(CASE WHEN event_type IN {kinds} THEN value ELSE 0 END AS DECIMAL(18,2))"

    moves = book["events"].selectExpr(
        "event_id AS transaction_id",
        "user_id AS customer_id",
        "ts",
        "to_date(ts) AS transaction_date",
        "event_type AS transaction_type",
        f"{value_of('view', 'click')} AS debit_amount",
        f"{value_of('purchase', 'signup')} AS credit_amount",
    )
    balanced = running_total(
        moves,
        "customer_id",
        ["ts", "transaction_id"],
        F.to_date("ts"),
        F.expr("CAST((credit_amount - debit_amount) * 100 AS BIGINT)"),
        "moved",
    )
    opening = "CAST(customer_id % 4 * 300 AS DECIMAL(10,0))"
    return balanced.withColumn("running_balance", F.expr(f"CAST({opening} + {amount('moved')} AS DECIMAL(18,2))")).drop(
        "ts", "moved"
    )


def credit_ratings(book: Book) -> DataFrame:
    kinds = len(RATING_LABELS)
    return (
        book["orders"]
        .selectExpr(
            "o_orderkey AS rating_id",
            "o_custkey AS customer_id",
            "'Agency' AS rating_agency",
            f"{_pick(RATING_LABELS, f'(o_orderkey % {kinds})')} AS rating",
            f"{_pick(RATING_OUTLOOKS, f'((o_orderkey div {kinds}) % 4)')} AS rating_outlook",
            "to_date(o_orderdate) AS rating_date",
        )
    )


def industry_trends(book: Book) -> DataFrame:
    """One row per sector, industry and quarter. Orders are summed per customer before they meet the customers."""
    per_customer = (
        book["orders"]
        .groupBy(F.col("o_custkey").alias("customer_id"), F.expr("trunc(to_date(o_orderdate), 'QUARTER') AS q"))
        .agg(F.expr(f"sum({KEY}) AS s"), F.expr("max(to_date(o_orderdate)) AS report_date"))
    )
    return (
        per_customer.join(book["customers"].select("customer_id", "sector", "industry"), "customer_id")
        .groupBy("sector", "industry", "q")
        .agg(F.sum("s").alias("s"), F.max("report_date").alias("report_date"))
        .selectExpr(
            "concat_ws('-', sector, industry, CAST(q AS STRING)) AS trend_id",
            "sector",
            "industry",
            "report_date",
            "concat(year(q), 'Q', quarter(q)) AS quarter",
            "s % 60 / 10D AS default_rate_pct",
            "s % 70 / 10D AS npa_ratio_pct",
            "s % 90 / 10D AS sector_growth_pct",
            "(s div 240) % 8 AS regulatory_risk_score",
            f"{_pick(INDUSTRY_OUTLOOKS, '((s div 60) % 4)')} AS outlook",
            "concat('Demand in ', sector) AS key_risk_factors",
        )
    )


def macro_economic_indicators(book: Book) -> DataFrame:
    """Daily mean per event type. The lag runs over the days of five indicators, not over the events."""
    daily = (
        book["events"]
        .filter(F.col("event_type").isin(*EVENT_INDICATORS))
        .groupBy("event_type", F.expr("to_date(ts) AS report_date"))
        .agg(F.expr("CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean"))
    )
    named = daily.selectExpr(
        f"{_by_event_type(0)} AS indicator_name",
        f"{_by_event_type(1)} AS indicator_category",
        f"{_by_event_type(2)} AS unit",
        "report_date",
        f"floor(mean / {_by_event_type(3)} * 100D + 0.5D) / 100D AS value",
    )
    days = Window.partitionBy("indicator_name").orderBy("report_date")
    change = "100D * (value - previous_value) / nullif(previous_value, 0D)"
    rows = named.withColumn("previous_value", F.lag("value").over(days)).selectExpr(
        "concat_ws('-', indicator_name, CAST(report_date AS STRING)) AS indicator_id",
        "indicator_name",
        "indicator_category",
        "value",
        "previous_value",
        f"floor({change} * 100D + 0.5D) / 100D AS change_pct",
        "unit",
        "report_date",
        "'DAILY' AS frequency",
        "'events' AS source",
        "CASE WHEN indicator_name = 'INR_USD' THEN 'Global' END AS region",
    )
    return with_defaults(rows, DEFAULTS["macro_economic_indicators"])


def loan_applications(book: Book) -> DataFrame:
    return book["orders"].selectExpr(
        "o_orderkey AS application_id",
        "o_custkey AS customer_id",
        "to_date(o_orderdate) AS application_date",
        "o_orderpriority AS loan_type",
        f"{PRICE} AS requested_amount",
        f"{_pick(APPLICATION_STATUSES, '(o_orderkey % 6)')} AS application_status",
        f"{_pick(APPLICATION_ADVICE, '((o_orderkey div 6) % 5)')} AS ai_recommendation",
        "concat('Order status ', o_orderstatus) AS ai_recommendation_reason",
        "o_orderkey % 100 / 100D AS ai_confidence_score",
        f"{_pick(APPLICATION_DECISIONS, '((o_orderkey div 30) % 4)')} AS officer_decision",
        "'INR' AS currency",
    )


# --- fixed values: columns and types of the driver's tables ---
DRIVER_TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}
DERIVED = {
    "customers": customers,
    "company_financials": company_financials,
    "loan_history": loan_history,
    "loan_repayment": loan_repayment,
    "bank_transactions": bank_transactions,
    "credit_ratings": credit_ratings,
    "industry_trends": industry_trends,
    "macro_economic_indicators": macro_economic_indicators,
    "loan_applications": loan_applications,
}


def derived_book(spark: SparkSession, folder: str) -> Book:
    """Driver tables of ``folder`` and the domain tables derived from them."""

    def reader(name: str):
        return lambda _: spark.read.schema(DRIVER_TABLES[name]).parquet(f"{folder}/{name}.parquet")

    return Book(spark, {name: reader(name) for name in DRIVER_TABLES} | DERIVED)
