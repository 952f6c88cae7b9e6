"""Batch credit assessments: inputs, prompt, narrative, confidence, audit row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendscope import fixed
from lendscope.functions.banding import band
from lendscope.functions.text import fill, or_missing
from lendscope.operators.latest import latest, newest
from lendscope.operators.search import bm25, hit_rows
from lendscope.operators.word_index import WordIndex
from lendscope.plans.scoring import composed, scored_customers
from lendscope.plans.signals import MARGIN_PERCENT, classified
from lendscope.providers import Provider, complete
from lendscope.sources.tables import Book

PROMPT = (
    "Write a credit assessment as a senior credit analyst. Borrower: {company} ({industry}). "
    "Risk score: {score} of 108 (grade {grade}). Overdue category: {overdue}. Risk drivers: {drivers}. "
    "Financials: {financials}. Repayment: {repayment}. Industry: {industry_outlook}. Macro: {macro}. "
    "Regulations: {regulations}. Sections: executive summary, financial analysis, risk factors, "
    "regulatory compliance, recommendation."
)
NARRATIVE = (
    "## Executive Summary\n{company} ({industry}) scores {score} (grade {grade}, {overdue}).\n"
    "## Financial Analysis\n{financials}\n## Risk Factors\n{drivers}\n"
    "## Regulatory Compliance\n{repayment}; {industry_outlook}; {macro}\n## Recommendation\n{recommendation}"
)
TEMPLATE_MODEL = "template"


def search_context(
    policies: DataFrame,
    query: str,
    hits: int,
    key: str = "policy_id",
    text: str = "content",
    title: str = "title",
    index: WordIndex | None = None,
) -> DataFrame:
    """One row: ``title: content`` of the best hits, in rank order, cut to the length that can be used.

    With the policies' stored index, no policy but the hits is read.
    """
    asked = policies.sparkSession.range(1).select(F.col("id").alias("query_id"), F.lit(query).alias("query"))
    found = bm25(policies, asked, hits, key, text) if index is None else index.best(asked, hits)
    # Only the first characters of a hit can reach the citation.
    line = F.concat(title, F.lit(": "), F.left(text, F.lit(fixed.CITATION_LENGTH))).alias("line")
    best = hit_rows(found, asked, hits, policies, key, [line])
    lines = F.transform(F.array_sort(F.collect_list(F.struct("rank", "line"))), lambda item: item["line"])
    return best.agg(F.left(F.array_join(lines, "\n"), F.lit(fixed.CITATION_LENGTH)).alias("context"))


def input_texts() -> dict[str, Column]:
    """The four input sentences; each is NULL when one of its values is."""

    def crore(column: str) -> str:
        return f"CAST(round({column} / {fixed.CRORE}, 2) AS DECIMAL(18,2))"

    return {
        "financials": fill(
            fixed.FINANCIALS_FORMAT,
            revenue=crore("revenue"),
            ebitda=crore("ebitda"),
            de="debt_to_equity_ratio",
            icr="interest_coverage_ratio",
            npm=MARGIN_PERCENT,
            fcf=crore("free_cash_flow"),
        ),
        "repayment": fill(fixed.REPAYMENT_FORMAT, payments="payments", on_time="on_time", overdue="max_overdue"),
        "industry_outlook": fill(
            fixed.INDUSTRY_FORMAT, outlook="outlook", default_rate="default_rate_pct", growth="sector_growth_pct"
        ),
        "macro_text": fill(fixed.MACRO_FORMAT, cpi="macro.latest_cpi", repo="macro.latest_repo_rate"),
    }


def assessment_id(run_date: str, run_id: str) -> Column:
    """Date, customer and twelve digits that follow from both and the run: a run that is repeated gives the same ids, another
    run of the same day gives others."""
    digest = F.md5(F.concat_ws("|", F.col("customer_id").cast("string"), F.lit(run_date), F.lit(run_id)))
    return F.concat_ws("-", F.lit("CA"), F.lit(run_date.replace("-", "")), "customer_id", F.left(digest, F.lit(12)))


def assessments(
    book: Book,
    policies: DataFrame,
    run_date: str,
    query: str = fixed.APPRAISAL_QUERY,
    provider: Provider | None = None,
    wanted: DataFrame | None = None,
    model: str = TEMPLATE_MODEL,
    run_id: str = "run-1",
    generated_at: Column | None = None,
    index: WordIndex | None = None,
    components: DataFrame | None = None,
) -> DataFrame:
    """One assessment per customer (or per wanted customer), with its prompt and the columns of the audit table.

    With ``components``, as `plans.scoring.stored_components` keeps them for several runs, no fact table is read.
    """
    scored = scored_customers(book) if components is None else composed(book, components)
    if wanted is not None:
        scored = scored.join(wanted.select("customer_id"), "customer_id", "left_semi")
    rows = classified(scored).withColumns(input_texts())
    rows = rows.withColumn("_regulations", search_context(policies, query, fixed.HITS_ASSESSMENT, index=index).scalar())
    shared = {
        "company": "company_name",
        "industry": "industry",
        "score": "composite_score",
        "grade": "risk_grade",
        "overdue": "sma_category",
        "drivers": or_missing("key_risk_drivers", "None"),
        "financials": or_missing("financials"),
        "repayment": or_missing("repayment"),
        "industry_outlook": or_missing("industry_outlook"),
        "macro": or_missing("macro_text"),
    }
    regulations = f"left(coalesce(_regulations, ''), {fixed.POLICY_CONTEXT_LENGTH})"
    rows = rows.withColumn("prompt", fill(PROMPT, **shared, regulations=regulations))
    audit = rows.select(
        assessment_id(run_date, run_id).alias("assessment_id"),
        "customer_id",
        F.to_date(F.lit(run_date)).alias("assessment_date"),
        F.col("composite_score").cast("double").alias("risk_score"),
        "risk_grade",
        "sma_category",
        F.col("lending_recommendation").alias("ai_recommendation"),
        "prompt",
        fill(NARRATIVE, **shared, recommendation="lending_recommendation").alias("_template"),
        F.left("_regulations", F.lit(fixed.CITATION_LENGTH)).alias("regulatory_citations"),
        band("composite_score", fixed.CONFIDENCE).cast("double").alias("confidence_score"),
        F.lit(model).alias("model_used"),
        F.current_user().alias("generated_by"),
        (F.current_timestamp() if generated_at is None else generated_at).cast("timestamp_ntz").alias("generated_at"),
    )
    if provider is None:
        return audit.withColumnRenamed("_template", "ai_narrative")
    return complete(audit.drop("_template"), "prompt", provider, "ai_narrative")


def result_text() -> Column:
    return F.concat(
        F.lit("Assessment generated: "),
        "assessment_id",
        F.lit(" | Recommendation: "),
        F.coalesce("ai_recommendation", F.lit("PENDING")),
        F.lit(" | Score: "),
        F.col("risk_score").cast("string"),
    )


def latest_assessment(stored: DataFrame) -> DataFrame:
    """The newest assessment of every customer."""
    return latest(stored, ["customer_id"], [newest("generated_at"), newest("assessment_id")])
