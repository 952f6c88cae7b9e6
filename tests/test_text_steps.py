"""Providers, routing, contexts, assessments, applications and the semantic model on small tables."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from lendscope.functions.text import clean_reply
from lendscope.plans import advisor, applications, assessments, semantic, signals
from lendscope.providers import classify, complete, extract_fields


def test_extract_fields(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "id long, text string")
    provider = lambda texts: texts.map(lambda text: json.dumps({"response": {"a": text * 2}}))
    found = sorted((row["id"], row["a"], row["b"]) for row in extract_fields(df, "text", ("a", "b"), provider).collect())
    assert found == [(1, "xx", None), (2, "yy", None)]


def test_classify_takes_the_first_known_label(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "text string").coalesce(1)
    replies = {"a": '{"labels": ["REJECT", "APPROVE"]}', "b": '{"labels": ["MAYBE"]}', "c": "oops"}
    found = classify(df, "text", ("APPROVE", "REJECT"), lambda texts: texts.map(replies), "label").collect()
    assert [row["label"] for row in found] == ["REJECT", None, None]


def test_complete(spark):
    df = spark.createDataFrame([("a",)], "text string")
    assert complete(df, "text", lambda texts: texts + "!", "reply").first()["reply"] == "a!"


@pytest.mark.parametrize(
    ("question", "first", "every"),
    [
        ("How brisk is it?", "risk_scores", ["risk_scores"]),
        ("Loan exposure by sector", "loan_exposure", ["loan_exposure", "macro"]),
        ("NPA list", None, ["loan_exposure"]),
        ("Pending LOAN applications for review", "loan_exposure", ["loan_exposure", "applications"]),
        ("Hello", None, ["risk_scores"]),
        (None, None, ["risk_scores"]),
    ],
)
def test_routing(spark, question, first, every):
    df = spark.createDataFrame([(question,)], "q string")
    row = df.select(advisor.route_first(F.col("q")).alias("first"), advisor.route_all(F.col("q")).alias("every")).first()
    assert row["first"] == first and row["every"] == every


def test_csv_quotes_only_where_needed(spark):
    df = spark.createDataFrame([("a,b", 'say "x"', None, "plain")], "a string, b string, c string, d string")
    assert df.select(advisor.csv_line(*map(F.col, "abcd"))).first()[0] == '"a,b","say ""x""",,plain'


def test_reply_cleanup(spark):
    df = spark.createDataFrame([("a\\nb\\tc",), (None,)], "t string").coalesce(1)
    assert [row[0] for row in df.select(clean_reply(F.col("t"))).collect()] == ["a\nb\tc", "No response generated."]


@pytest.fixture
def book(make_book):
    day = dt.date(2024, 1, 1)
    return make_book(
        customers=[{"customer_id": f"c{n}", "company_name": f"N{n}", "sector": "S" if n < 2 else None, "industry": "I"}
                   for n in range(3)],
        loan_history=[
            {"loan_id": "l0", "customer_id": "c0", "loan_status": "ACTIVE", "outstanding_balance": 10, "loan_type": "T"},
            {"loan_id": "l1", "customer_id": "c0", "loan_status": "ACTIVE", "outstanding_balance": 20, "loan_type": "T"},
            {"loan_id": "l2", "customer_id": "c2", "loan_status": "CLOSED", "loan_type": "X"},
        ],
        loan_applications=[
            {"application_id": "a1", "customer_id": "c0", "application_date": day, "ai_recommendation": "APPROVE",
             "officer_decision": "APPROVED", "application_status": "PENDING", "requested_amount": 5},
            {"application_id": "a2", "customer_id": "c1", "application_date": day,
             "ai_recommendation": "CONDITIONAL_APPROVE", "officer_decision": "APPROVED", "application_status": "APPROVED"},
            {"application_id": "a3", "customer_id": "c2", "application_date": day, "ai_recommendation": "ESCALATE",
             "officer_decision": "APPROVED", "application_status": "REJECTED"},
            {"application_id": "a4", "customer_id": "c2", "application_date": day, "ai_recommendation": None,
             "officer_decision": "APPROVED", "application_status": None},
        ],
    )


def test_alignment_counts_conditional_as_approve(book):
    row = applications.decision_alignment(book).first()
    assert row.asDict() == {"total": 4, "advised": 3, "decided": 3, "agree": 2, "agreement_rate": 67}


def test_chosen_values(book):
    frame = book["loan_applications"]
    assert applications.chosen(frame, "application_status").count() == 4
    assert applications.chosen(frame, "application_status", ["PENDING", None]).count() == 2


def test_measures_do_not_multiply(book):
    found = semantic.query(
        book,
        ["customers.total_borrowers", "loan_history.total_outstanding", "loan_applications.total_applications"],
        ["customers.sector"],
    ).collect()
    by_sector = {row["customers_sector"]: row for row in found}
    assert by_sector["S"]["total_borrowers"] == 2 and float(by_sector["S"]["total_outstanding"]) == 30
    assert by_sector["S"]["total_applications"] == 2
    assert by_sector[None]["total_borrowers"] == 1 and by_sector[None]["total_outstanding"] is None


def test_model_filters_and_names(book):
    found = semantic.query(book, ["loan_history.active_loan_count"], ["loan_history.loan_type"],
                           {"customers.sector": ["S"]}).collect()
    assert [(row["loan_history_loan_type"], row["active_loan_count"]) for row in found] == [("T", 2)]
    with pytest.raises(ValueError):
        semantic.query(book, ["loan_history.nothing"], [])
    with pytest.raises(ValueError):
        semantic.query(book, ["loan_history.active_loan_count"], ["loan_applications.loan_type"])


def policies(spark):
    return spark.createDataFrame(
        [("REG001", "Capital", "Ratio", "capital adequacy norms " * 200), ("REG002", "Other", None, "nothing")],
        "policy_id string, title string, section string, content string",
    )


def test_assessments(spark, book):
    found = {row["customer_id"]: row for row in assessments.assessments(book, policies(spark), "2024-03-31").collect()}
    row = found["c0"]
    assert row["assessment_id"].startswith("CA-20240331-c0-") and len(row["assessment_id"]) == len("CA-20240331-c0-123456789abc")
    assert "Financials: N/A" in row["prompt"] and "Regulations: Capital: capital adequacy norms" in row["prompt"]
    assert row["confidence_score"] == 0.6 and row["model_used"] == "template"
    assert row["regulatory_citations"].startswith("Capital: ") and len(row["regulatory_citations"]) == 2000
    assert row["ai_narrative"].count("## ") == 5


def test_assessments_with_a_provider_for_some(spark, book):
    wanted = spark.createDataFrame([("c1",)], "customer_id string")
    found = assessments.assessments(
        book, policies(spark), "2024-03-31", provider=lambda prompts: prompts.str.len().astype(str), wanted=wanted,
        model="counter",
    ).collect()
    assert [row["customer_id"] for row in found] == ["c1"]
    assert found[0]["ai_narrative"] == str(len(found[0]["prompt"])) and found[0]["model_used"] == "counter"


def test_newest_assessment(spark, book):
    run = lambda run_id, hour: assessments.assessments(
        book, policies(spark), "2024-03-31", run_id=run_id, generated_at=F.expr(f"TIMESTAMP_NTZ '2024-03-31 {hour}:00:00'")
    )
    both = run("r1", "17").unionByName(run("r2", "09"))
    found = assessments.latest_assessment(both).collect()
    assert len(found) == 3 and {row["generated_at"].hour for row in found} == {17}
    assert both.select("assessment_id").distinct().count() == 6
    assert both.select(assessments.result_text()).first()[0].startswith("Assessment generated: CA-2024")


def test_signals_and_recommendation_from_providers(book):
    reply = json.dumps({"response": {"liquidity_risk": "HIGH"}})
    row = signals.risk_signals(book, provider=lambda texts: texts.map(lambda _: reply)).first()
    assert row["liquidity_risk"] == "HIGH" and row["repayment_risk"] is None
    reply = '{"labels": ["ESCALATE"]}'
    row = signals.borrower_classification(book, provider=lambda texts: texts.map(lambda _: reply)).first()
    assert row["lending_recommendation"] == "ESCALATE"


def test_question_context(spark, book):
    questions = spark.createDataFrame([(1, "capital adequacy of loan exposure"), (2, "zzz")], "query_id long, query string")
    found = {row["query_id"]: row for row in advisor.question_context(
        book, questions, policies(spark), "policy_id", "title", "content").collect()}
    assert found[1]["data_context"].startswith("LOAN EXPOSURE DATA:\ncompany_name,sector,loan_type,")
    assert "N0,S,T,20.00,,ACTIVE\nN0,S,T,10.00,,ACTIVE" in found[1]["data_context"]
    assert found[1]["context"].startswith("[Capital - Ratio]: capital adequacy") and len(found[1]["context"]) <= 1500
    assert found[2]["datasets"] == ["risk_scores"] and found[2]["context"] == ""


def test_short_question_context(spark, book):
    questions = spark.createDataFrame([(1, "capital adequacy of loan exposure"), (2, "zzz")], "query_id long, query string")
    found = {row["query_id"]: row for row in advisor.question_context_first(
        book, questions, policies(spark), "policy_id", "title", "content").collect()}
    assert found[1]["dataset"] == "loan_exposure" and found[1]["data_context"].startswith(
        "LOAN DATA:\ncompany_name,loan_type,outstanding_balance,collateral_value,loan_status\nN0,T,20.00,,ACTIVE\n"
    )
    assert "CLOSED" not in found[1]["data_context"]
    assert found[1]["context"].startswith("Capital: capital adequacy") and len(found[1]["context"]) == 509
    assert found[2]["dataset"] is None and found[2]["data_context"] == "" and found[2]["context"] == ""
