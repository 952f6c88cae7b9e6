"""Declared schemas, column defaults and data rules of the domain tables."""

from __future__ import annotations

from pyspark.sql import types as T

from lendscope import fixed
from lendscope.functions.numbers import MONEY, RATE, RATIO
from lendscope.operators.quality import InSet, MaxLength, NotNull, Reference, Unique

_TYPES = {
    "string": T.StringType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
    "variant": T.VariantType(),
    "money": MONEY,
    "ratio": RATIO,
    "rate": RATE,
}


def _schema(**columns: str) -> T.StructType:
    """``name="type"`` or ``name="type!"`` for a required column."""
    return T.StructType(
        [T.StructField(name, _TYPES[kind.rstrip("!")], not kind.endswith("!")) for name, kind in columns.items()]
    )


# --- fixed values: column names and types of the domain tables ---
SCHEMAS: dict[str, T.StructType] = {
    "customers": _schema(
        customer_id="string!", company_name="string!", sector="string", industry="string", country="string",
        state_province="string", established_year="long", annual_revenue_usd="money", employee_count="long",
        is_bank_customer="boolean", customer_since="date", relationship_manager="string", company_type="string",
        stock_listed="boolean", stock_exchange="string", website="string", risk_tier="string",
        created_at="timestamp", updated_at="timestamp",
    ),
    "company_financials": _schema(
        financial_id="string!", customer_id="string", fiscal_year="long!", fiscal_quarter="string", revenue="money",
        cost_of_goods_sold="money", gross_profit="money", operating_expenses="money", ebitda="money",
        depreciation_amortization="money", ebit="money", interest_expense="money", net_profit="money",
        total_assets="money", current_assets="money", cash_and_equivalents="money", total_liabilities="money",
        current_liabilities="money", long_term_debt="money", short_term_debt="money", total_equity="money",
        operating_cash_flow="money", free_cash_flow="money", debt_to_equity_ratio="ratio", current_ratio="ratio",
        interest_coverage_ratio="ratio", net_profit_margin="ratio", return_on_assets="ratio",
    ),
    "loan_history": _schema(
        loan_id="string!", customer_id="string", loan_type="string!", sanctioned_amount="money!",
        disbursed_amount="money", outstanding_balance="money", interest_rate="rate", tenure_months="long",
        sanction_date="date", maturity_date="date", collateral_type="string", collateral_value="money",
        loan_status="string", purpose="string", currency="string",
    ),
    "loan_repayment": _schema(
        repayment_id="string!", loan_id="string", customer_id="string", due_date="date!", payment_date="date",
        emi_amount="money", principal_component="money", interest_component="money", penalty_amount="money",
        amount_paid="money", payment_status="string", days_overdue="long",
    ),
    "bank_transactions": _schema(
        transaction_id="string!", customer_id="string", account_number="string", transaction_date="date!",
        transaction_type="string!", debit_amount="money", credit_amount="money", running_balance="money",
        transaction_category="string", description="string", month_year="string",
    ),
    "credit_ratings": _schema(
        rating_id="string!", customer_id="string", rating_agency="string!", rating_type="string", rating="string!",
        rating_outlook="string", rating_date="date!", previous_rating="string", rating_action="string",
        valid_until="date",
    ),
    "industry_trends": _schema(
        trend_id="string!", sector="string!", industry="string!", report_date="date!", quarter="string",
        gdp_growth_pct="double", sector_growth_pct="double", industry_revenue_index="double",
        default_rate_pct="double", npa_ratio_pct="double", credit_demand_index="double",
        commodity_price_index="double", regulatory_risk_score="long", employment_growth_pct="double",
        outlook="string", key_risk_factors="string", data_source="string", created_at="timestamp",
    ),
    "loan_applications": _schema(
        application_id="string!", customer_id="string!", application_date="date!", loan_type="string",
        requested_amount="money", proposed_tenure_months="long", purpose="string", collateral_offered="string",
        collateral_estimated_value="money", applicant_risk_score="double", application_status="string",
        assigned_officer="string", ai_recommendation="string", ai_recommendation_reason="string",
        ai_confidence_score="double", officer_decision="string", officer_remarks="string", decision_date="date",
        currency="string", created_at="timestamp", updated_at="timestamp",
    ),
    "macro_economic_raw": _schema(raw_data="variant!", source_file="string", loaded_at="timestamp"),
    "macro_economic_indicators": _schema(
        indicator_id="string!", indicator_name="string!", indicator_category="string!", value="double!",
        previous_value="double", change_pct="double", unit="string", report_date="date!", frequency="string",
        source="string", region="string", loaded_at="timestamp",
    ),
    "regulatory_policies": _schema(
        policy_id="string!", title="string!", issuing_authority="string!", document_type="string", section="string",
        content="string!", effective_date="date", reference_number="string", category="string",
        relevance_to_lending="string", created_at="timestamp",
    ),
    "credit_assessments": _schema(
        assessment_id="string!", customer_id="string!", assessment_date="date", risk_score="double",
        risk_grade="string", sma_category="string", ai_recommendation="string", ai_narrative="string",
        regulatory_citations="string", confidence_score="double", model_used="string", generated_by="string",
        generated_at="timestamp",
    ),
    "regulatory_docs_raw": _schema(
        file_name="string", file_url="string", parsed_text="string", loaded_at="timestamp", file_size="long",
        file_hash="string", page_count="long", processing_status="string", error_message="string",
        processed_at="timestamp",
    ),
    "pdf_processing_log": _schema(
        run_id="string!", run_started_at="timestamp", run_completed_at="timestamp", files_detected="long",
        files_new="long", files_processed="long", files_failed="long", policies_loaded="long", status="string",
        error_summary="string",
    ),
}

# --- fixed values: column defaults ---
DEFAULTS: dict[str, dict[str, object]] = {
    "customers": {"is_bank_customer": True},
    "loan_history": {"currency": "USD"},
    "loan_repayment": {"penalty_amount": 0, "days_overdue": 0},
    "bank_transactions": {"debit_amount": 0, "credit_amount": 0},
    "loan_applications": {"application_status": "PENDING", "currency": "INR"},
    "macro_economic_indicators": {"region": fixed.REGION_DEFAULT},
    "regulatory_docs_raw": {"file_size": 0, "page_count": 0, "processing_status": "PENDING"},
    "pdf_processing_log": {
        "files_detected": 0, "files_new": 0, "files_processed": 0, "files_failed": 0, "policies_loaded": 0,
        "status": "RUNNING",
    },
}

# --- fixed values: columns that take the time of the insert ---
TIME_DEFAULTS: dict[str, tuple[str, ...]] = {
    "customers": ("created_at", "updated_at"),
    "industry_trends": ("created_at",),
    "loan_applications": ("created_at", "updated_at"),
    "macro_economic_raw": ("loaded_at",),
    "macro_economic_indicators": ("loaded_at",),
    "regulatory_policies": ("created_at",),
    "credit_assessments": ("generated_at",),
    "regulatory_docs_raw": ("loaded_at",),
    "pdf_processing_log": ("run_started_at",),
}

# --- fixed values: declared text lengths ---
LENGTHS: dict[str, dict[str, int]] = {
    "customers": {
        "customer_id": 10, "company_name": 200, "sector": 100, "industry": 100, "country": 50, "state_province": 100,
        "relationship_manager": 100, "company_type": 50, "stock_exchange": 50, "website": 200, "risk_tier": 20,
    },
    "company_financials": {"financial_id": 20, "customer_id": 10, "fiscal_quarter": 2},
    "loan_history": {
        "loan_id": 15, "customer_id": 10, "loan_type": 50, "collateral_type": 100, "loan_status": 30, "purpose": 200,
        "currency": 3,
    },
    "loan_repayment": {"repayment_id": 20, "loan_id": 15, "customer_id": 10, "payment_status": 20},
    "bank_transactions": {
        "transaction_id": 20, "customer_id": 10, "account_number": 20, "transaction_type": 20, "transaction_category": 50,
        "description": 500, "month_year": 7,
    },
    "credit_ratings": {
        "rating_id": 20, "customer_id": 10, "rating_agency": 50, "rating_type": 30, "rating": 10, "rating_outlook": 20,
        "previous_rating": 10, "rating_action": 20,
    },
    "industry_trends": {
        "trend_id": 20, "sector": 100, "industry": 100, "quarter": 10, "outlook": 20, "key_risk_factors": 500,
        "data_source": 100,
    },
    "loan_applications": {
        "application_id": 20, "customer_id": 20, "loan_type": 50, "purpose": 500, "collateral_offered": 200,
        "application_status": 20, "assigned_officer": 100, "ai_recommendation": 20, "ai_recommendation_reason": 1000,
        "officer_decision": 20, "officer_remarks": 500, "currency": 3,
    },
    "macro_economic_raw": {"source_file": 500},
    "macro_economic_indicators": {
        "indicator_id": 30, "indicator_name": 50, "indicator_category": 30, "unit": 20, "frequency": 20, "source": 100,
        "region": 50,
    },
    "regulatory_policies": {
        "policy_id": 20, "title": 500, "issuing_authority": 100, "document_type": 50, "section": 1000, "content": 16000,
        "reference_number": 100, "category": 50, "relevance_to_lending": 200,
    },
    "credit_assessments": {
        "assessment_id": 50, "customer_id": 20, "risk_grade": 2, "sma_category": 10, "ai_recommendation": 30,
        "ai_narrative": 16000, "regulatory_citations": 2000, "model_used": 50, "generated_by": 100,
    },
    "regulatory_docs_raw": {"file_hash": 64, "processing_status": 20},
    "pdf_processing_log": {"run_id": 36, "status": 20},
}

# --- fixed values: keys, required columns, references and domains ---
KEYS: dict[str, str] = {
    "customers": "customer_id",
    "company_financials": "financial_id",
    "loan_history": "loan_id",
    "loan_repayment": "repayment_id",
    "bank_transactions": "transaction_id",
    "credit_ratings": "rating_id",
    "industry_trends": "trend_id",
    "loan_applications": "application_id",
    "macro_economic_indicators": "indicator_id",
    "regulatory_policies": "policy_id",
    "credit_assessments": "assessment_id",
}
REQUIRED: dict[str, tuple[str, ...]] = {
    "customers": ("customer_id", "company_name"),
    "company_financials": ("financial_id", "customer_id", "fiscal_year"),
    "loan_history": ("loan_id", "customer_id", "loan_type", "sanctioned_amount"),
    "loan_repayment": ("repayment_id", "loan_id", "customer_id", "due_date"),
    "bank_transactions": ("transaction_id", "customer_id", "transaction_date", "transaction_type"),
    "credit_ratings": ("rating_id", "customer_id", "rating_agency", "rating", "rating_date"),
    "industry_trends": ("trend_id", "sector", "industry", "report_date"),
    "loan_applications": ("application_id", "customer_id", "application_date"),
    "macro_economic_raw": ("raw_data",),
    "macro_economic_indicators": ("indicator_id", "indicator_name", "indicator_category", "value", "report_date"),
    "regulatory_policies": ("policy_id", "title", "issuing_authority", "content"),
    "credit_assessments": ("assessment_id", "customer_id"),
    "pdf_processing_log": ("run_id",),
}
REFERENCES: dict[str, list[Reference]] = {
    "company_financials": [Reference("customer_id", "customers", "customer_id")],
    "loan_history": [Reference("customer_id", "customers", "customer_id")],
    "loan_repayment": [
        Reference("loan_id", "loan_history", "loan_id"), Reference("customer_id", "customers", "customer_id"),
    ],
    "bank_transactions": [Reference("customer_id", "customers", "customer_id")],
    "credit_ratings": [Reference("customer_id", "customers", "customer_id")],
}
DOMAINS: dict[str, list[InSet]] = {
    "industry_trends": [InSet("outlook", fixed.OUTLOOK_DOMAIN)],
    "loan_applications": [
        InSet("application_status", fixed.APPLICATION_STATUS_DOMAIN),
        InSet("ai_recommendation", fixed.RECOMMENDATIONS),
        InSet("officer_decision", fixed.OFFICER_DECISION_DOMAIN),
    ],
    "macro_economic_indicators": [InSet("indicator_category", fixed.INDICATOR_CATEGORY_DOMAIN)],
}

#: Every declared rule of a table.
RULES: dict[str, list] = {
    name: [
        *([Unique(KEYS[name])] if name in KEYS else []),
        *(NotNull(column) for column in REQUIRED.get(name, ())),
        *(MaxLength(column, length) for column, length in LENGTHS[name].items()),
        *DOMAINS.get(name, ()),
        *REFERENCES.get(name, ()),
    ]
    for name in LENGTHS
}
