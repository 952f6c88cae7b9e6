"""Scores of crafted customers: gaps, NULLs, ties and edges."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lendscope.functions.numbers import mean_score
from lendscope.plans import assessments, portfolio, scoring, signals
from lendscope.sources.derived import derived_book
from lendscope.sources.schemas import SCHEMAS
from lendscope.sources.tables import Book, stored_book

DAY = dt.date(2024, 1, 15)


@pytest.fixture
def book(make_book):
    return make_book(
        customers=[
            {"customer_id": "c1", "company_name": "Alpha", "sector": "S", "industry": "I"},
            {"customer_id": "c2", "company_name": "Beta", "sector": "S", "industry": None},
            {"customer_id": "c3", "company_name": "Gamma", "sector": None, "industry": "I"},
        ],
        company_financials=[
            {"financial_id": "f1", "customer_id": "c1", "fiscal_year": 2023, "fiscal_quarter": "Q4",
             "debt_to_equity_ratio": 9, "current_ratio": 0.1},
            {"financial_id": "f2", "customer_id": "c1", "fiscal_year": 2023, "fiscal_quarter": None,
             "debt_to_equity_ratio": 0.4, "current_ratio": 2, "interest_coverage_ratio": 6, "net_profit_margin": 0.15},
            {"financial_id": "f3", "customer_id": "c2", "fiscal_year": 2023, "fiscal_quarter": "Q1"},
        ],
        loan_history=[
            {"loan_id": "l1", "customer_id": "c1", "loan_status": "ACTIVE", "outstanding_balance": 100,
             "collateral_value": 200},
            {"loan_id": "l2", "customer_id": "c2", "loan_status": "ACTIVE", "outstanding_balance": 0,
             "collateral_value": 50},
            {"loan_id": "l3", "customer_id": "c3", "loan_status": "NPA", "outstanding_balance": 10,
             "collateral_value": 90},
        ],
        loan_repayment=[
            {"repayment_id": "r1", "customer_id": "c1", "payment_status": "ON_TIME", "days_overdue": 0},
            {"repayment_id": "r2", "customer_id": "c2", "payment_status": "ON_TIME", "days_overdue": -3},
            {"repayment_id": "r3", "customer_id": "c3", "payment_status": "LATE", "days_overdue": None},
        ],
        bank_transactions=[
            {"transaction_id": "t1", "customer_id": "c1", "credit_amount": 110, "debit_amount": 100,
             "running_balance": 50},
            {"transaction_id": "t2", "customer_id": "c2", "credit_amount": 5, "debit_amount": 0, "running_balance": -1},
            {"transaction_id": "t3", "customer_id": "c2", "credit_amount": 5, "debit_amount": 0, "running_balance": -2},
        ],
        credit_ratings=[
            {"rating_id": "1", "customer_id": "c1", "rating": "AAA", "rating_outlook": "Negative", "rating_date": DAY},
            {"rating_id": "2", "customer_id": "c1", "rating": "Baa3", "rating_outlook": "Positive", "rating_date": DAY},
        ],
        industry_trends=[
            {"trend_id": "x", "sector": "S", "industry": "I", "report_date": DAY, "default_rate_pct": 5.0,
             "outlook": "WATCHLIST", "regulatory_risk_score": 3},
        ],
    )


@pytest.fixture
def scores(book, rows):
    return {row["customer_id"]: row for row in rows(scoring.risk_scores(book))}


def test_yearly_statement_beats_fourth_quarter(scores):
    assert scores["c1"]["financial_health_score"] == 30


def test_null_ratios_score_zero(scores):
    assert scores["c2"]["financial_health_score"] == 0


def test_customer_without_rows_scores_zero(scores):
    assert scores["c3"]["financial_health_score"] == 0
    assert scores["c3"]["rating_score"] == 0
    assert scores["c3"]["cashflow_behavior_score"] == 0


def test_collateral_without_cover_is_two_and_without_active_loan_zero(scores):
    assert [scores[key]["collateral_score"] for key in ("c1", "c2", "c3")] == [13, 2, 0]


def test_negative_overdue_scores_six_and_null_zero(scores):
    assert float(scores["c1"]["repayment_score"]) == 20
    assert float(scores["c2"]["repayment_score"]) == 18
    assert float(scores["c3"]["repayment_score"]) == 0


def test_cashflow_without_debits_and_with_two_negative_days(scores):
    assert scores["c1"]["cashflow_behavior_score"] == 10
    assert scores["c2"]["cashflow_behavior_score"] == 0
    assert scores["c2"]["cashflow_ratio"] is None


def test_ratings_of_one_day_go_by_id(scores):
    assert scores["c1"]["rating_score"] == 3 + 3


def test_industry_needs_both_columns(scores):
    assert [scores[key]["industry_score"] for key in ("c1", "c2", "c3")] == [0 + 1 + 2, 0, 0]


def test_no_indicators_still_scores(scores):
    assert all(row["macro_environment_score"] == 0 for row in scores.values())


def test_composite_is_the_sum_and_grades_follow(scores):
    for row in scores.values():
        parts = [name for name, _, _ in scoring.fixed.COMPONENTS]
        assert float(row["composite_score"]) == sum(float(row[name]) for name in parts)
    assert [scores[key]["risk_grade"] for key in ("c1", "c2", "c3")] == ["A", "D", "E"]


def test_drivers_speak_of_missing_data(scores):
    text = scores["c3"]["key_risk_drivers"]
    assert "High leverage (D/E: N/A)" in text
    assert "Account stress: negative balance detected" in text
    assert "Repayment delays (max 0 days overdue)" in text
    assert "High inflation (CPI: N/A%)" in text


def test_no_driver_is_an_empty_text(spark):
    values = {
        "de_score": 8, "icr_score": 5, "ontime_score": 12, "net_flow_score": 4, "stress_score": 3,
        "collateral_score": 13, "industry_outlook_score": 3, "rating_num_score": 9,
    }
    texts = "'x' AS debt_to_equity_ratio, 'x' AS interest_coverage_ratio, 0 AS max_overdue, 1 AS credit_debit_ratio, "
    texts += "'x' AS outlook, 'x' AS rating, struct(3 AS cpi_score, 3.5 AS latest_cpi) AS macro"
    df = spark.range(1).selectExpr(*[f"{value} AS {name}" for name, value in values.items()], *texts.split(", ", 6)[:6],
                                   "struct(3 AS cpi_score, 3.5 AS latest_cpi) AS macro")
    assert df.select(scoring.drivers()).first()[0] == ""


def test_profile_is_null_without_industry(book, rows):
    texts = {row["customer_id"]: row["profile_text"] for row in rows(signals.borrower_profiles(book))}
    assert texts["c2"] is None
    assert texts["c1"].startswith("Company: Alpha (I). Financials: Revenue N/A, EBITDA N/A, Debt-to-Equity: 0.4000")
    assert "Payment History: No payment data" in texts["c3"]


def test_classification(book, rows):
    found = {row["customer_id"]: row for row in rows(signals.borrower_classification(book))}
    assert found["c1"]["sma_category"] == "STANDARD"
    assert found["c2"]["sma_category"] == "SMA_0"
    assert found["c3"]["lending_recommendation"] == "REJECT"
    assert found["c2"]["lending_recommendation"] == "ESCALATE"


def test_sector_summary_leaves_out_missing_sector(book, rows):
    found = rows(portfolio.sector_summary(book))
    assert [row["sector"] for row in found] == ["S"]
    assert found[0]["borrowers"] == 2 and found[0]["high_risk"] == 1


def test_kpis_on_an_empty_book(make_book, rows):
    found = rows(portfolio.exposure_kpis(make_book()))
    assert len(found) == 1 and found[0]["total_exposure"] is None and found[0]["borrowers"] == 0


@pytest.mark.parametrize(("days", "want"), [(0, "STANDARD"), (1, "SMA_0"), (30, "SMA_0"), (31, "SMA_1"), (60, "SMA_1"),
                                            (61, "SMA_2"), (90, "SMA_2"), (91, "NPA")])
def test_overdue_steps(spark, days, want):
    df = spark.sql(f"SELECT {days} AS max_overdue, CAST(70 AS DECIMAL(6,1)) AS composite_score")
    assert df.select(signals.overdue_category()).first()[0] == want


def test_null_score_is_no_stress(spark):
    df = spark.sql("SELECT 0 AS max_overdue, CAST(NULL AS DECIMAL(6,1)) AS composite_score")
    assert df.select(signals.overdue_category()).first()[0] == "STANDARD"


def test_a_mean_is_rounded_once(spark):
    # 900.4 / 11 = 81.854545...: five digits first would give 81.8546.
    df = spark.sql("SELECT CAST(CASE WHEN id = 0 THEN 90.4 ELSE 81.0 END AS DECIMAL(6,1)) AS s FROM range(11)")
    assert str(df.agg(F.round(mean_score("s"), 4)).first()[0]) == "81.8545"


def test_stored_tables_give_the_same_scores(spark, book, tmp_path, rows):
    base = f"file://{tmp_path}/book"
    for name in SCHEMAS:
        if name != "macro_economic_raw":
            book[name].write.parquet(f"{base}/{name}")
    stored = rows(scoring.risk_scores(stored_book(spark, base)), "customer_id")
    assert stored == rows(scoring.risk_scores(book), "customer_id")


def test_no_join_without_keys(book, capsys):
    scoring.risk_scores(book).explain()
    plan = capsys.readouterr().out
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_running_balances_group_by_slice_not_by_customer(spark, capsys):
    derived_book(spark, "/root/testdata/sf0.001")["bank_transactions"].explain()
    plan = capsys.readouterr().out
    # The rows are shuffled once, by customer and hour, and meet no join.
    assert "Join" not in plan
    last = plan[plan.index("Exchange") :].splitlines()[0]
    assert "customer_id" in last and "_slice" in last


def test_an_order_enters_one_group_of_statements(spark, capsys):
    derived_book(spark, "/root/testdata/sf0.001")["company_financials"].explain()
    assert "Expand" not in capsys.readouterr().out


def test_assessments_from_stored_components_read_no_fact_table(spark, book):
    policies = spark.createDataFrame([("p1", "Capital", "credit appraisal")], "policy_id string, title string, content string")
    components = scoring.stored_components(book)
    alone = Book(spark, {"macro_economic_indicators": lambda _: book["macro_economic_indicators"]})
    made = F.expr("TIMESTAMP_NTZ '2024-03-31 09:00:00'")
    run = lambda of, **given: sorted(
        assessments.assessments(of, policies, "2024-03-31", generated_at=made, **given).collect(), key=lambda row: row["customer_id"]
    )
    assert run(alone, components=components) == run(book)
