"""Fixed values of the credit model.

Everything here must hold exactly these values for results to be right: score
bands, label maps, grade limits, text formats, domain lists, routing words and
size limits. They are data, kept together and in their natural order.
"""

from __future__ import annotations

from typing import NamedTuple


class Bands(NamedTuple):
    """Ordered thresholds: the first step that holds gives the score."""

    steps: tuple
    otherwise: object


# --- fixed values: component score bands (operator, limit, score) ---
DEBT_TO_EQUITY = Bands((("<", 0.5, 10), ("<", 1.0, 8), ("<", 1.5, 6), ("<", 2.5, 4), ("<", 4.0, 2)), 0)
CURRENT_RATIO = Bands(((">=", 2.0, 8), (">=", 1.5, 6), (">=", 1.2, 4), (">=", 1.0, 2)), 0)
INTEREST_COVERAGE = Bands(((">=", 6.0, 7), (">=", 4.0, 5), (">=", 2.5, 3), (">=", 1.5, 1)), 0)
NET_PROFIT_MARGIN = Bands(((">=", 0.15, 5), (">=", 0.08, 4), (">=", 0.04, 3), (">=", 0.01, 1)), 0)
OVERDUE_DAYS = Bands((("=", 0, 8), ("<=", 15, 6), ("<=", 30, 4), ("<=", 60, 2)), 0)
CREDIT_TO_DEBIT = Bands(((">=", 1.1, 4), (">=", 1.0, 3), (">=", 0.9, 1)), 0)
BALANCE_STABILITY = Bands(((">=", 0.7, 3), (">=", 0.4, 2)), 1)
NEGATIVE_BALANCES = Bands((("=", 0, 3), ("=", 1, 1)), 0)
COLLATERAL_COVER = Bands(((">=", 2.0, 13), (">=", 1.5, 10), (">=", 1.2, 7), (">=", 1.0, 4)), 2)
DEFAULT_RATE = Bands((("<", 1.0, 4), ("<", 2.0, 3), ("<", 3.5, 2), ("<", 5.0, 1)), 0)
REGULATORY_RISK = Bands((("<=", 2, 3), ("<=", 3, 2), ("<=", 5, 1)), 0)
CPI = Bands((("<", 4.0, 3), ("<", 5.5, 2), ("<", 7.0, 1)), 0)
REPO_RATE = Bands((("<", 5.5, 3), ("<", 6.5, 2), ("<", 7.5, 1)), 0)
CREDIT_GROWTH = Bands(((">=", 10, 2), (">=", 6, 1)), 0)
SYSTEM_NPA = Bands((("<", 2.5, 2), ("<", 4.0, 1)), 0)
FX_CHANGE = Bands((("<", 1.0, 2), ("<", 3.0, 1)), 0)
ONTIME_MAXIMUM = 12

# --- fixed values: grades, overdue categories, confidence ---
RISK_GRADE = Bands(((">=", 80, "A"), (">=", 60, "B"), (">=", 40, "C"), (">=", 20, "D")), "E")
OVERDUE_CATEGORY = Bands(((">", 90, "NPA"), (">", 60, "SMA_2"), (">", 30, "SMA_1")), None)
OVERDUE_CATEGORY_REPORT = Bands(((">", 90, "NPA"), (">", 60, "SMA-2"), (">", 30, "SMA-1"), (">", 0, "SMA-0")), "Standard")
STRESSED_SCORE = 40
CONFIDENCE = Bands(((">=", 80, 0.95), (">=", 60, 0.85), (">=", 40, 0.70)), 0.60)
HIGH_RISK_GRADES = ("D", "E")

# --- fixed values: label scores ---
RATING_SCORE = (
    (10, ("AAA", "Aaa")),
    (9, ("AA+", "Aa1")),
    (8, ("AA", "Aa2")),
    (7, ("AA-", "Aa3")),
    (6, ("A+", "A1", "A", "A2")),
    (5, ("A-", "A3", "BBB+", "Baa1")),
    (4, ("BBB", "Baa2")),
    (3, ("BBB-", "Baa3")),
    (2, ("BB+", "Ba1")),
    (1, ("BB", "Ba2", "BB-", "Ba3")),
)
RATING_SCORE_OTHERWISE = 0
RATING_OUTLOOK_SCORE = ((3, ("Positive",)), (2, ("Stable",)), (0, ("Negative",)))
RATING_OUTLOOK_OTHERWISE = 1
INDUSTRY_OUTLOOK_SCORE = ((3, ("POSITIVE",)), (2, ("STABLE",)), (1, ("WATCHLIST",)), (0, ("NEGATIVE",)))
INDUSTRY_OUTLOOK_OTHERWISE = 1

# --- fixed values: the seven components and their maxima (they add up to 108) ---
COMPONENTS = (
    ("financial_health_score", "Financial", 30),
    ("repayment_score", "Repayment", 20),
    ("cashflow_behavior_score", "Cash Flow", 10),
    ("collateral_score", "Collateral", 13),
    ("rating_score", "Rating", 13),
    ("industry_score", "Industry", 10),
    ("macro_environment_score", "Macro", 12),
)

# --- fixed values: indicator names used by the macro score ---
CPI_NAME = "CPI_GENERAL"
REPO_NAME = "REPO_RATE"
CREDIT_GROWTH_NAME = "CREDIT_GROWTH_INDUSTRY"
NPA_NAME = "GROSS_NPA_RATIO"
FX_NAME = "INR_USD"
HEADLINE_INDICATORS = ("CPI_GENERAL", "REPO_RATE", "INR_USD", "CRUDE_OIL_BRENT")

# --- fixed values: risk-driver sentences ---
DRIVER_LEVERAGE = "High leverage (D/E: {de})"
DRIVER_COVERAGE = "Weak interest coverage ({icr}x)"
DRIVER_DELAYS = "Repayment delays (max {days} days overdue)"
DRIVER_OUTFLOWS = "Cash outflows exceed inflows (ratio: {ratio})"
DRIVER_STRESS = "Account stress: negative balance detected"
DRIVER_COLLATERAL = "Low collateral coverage"
DRIVER_INDUSTRY = "Adverse industry outlook ({outlook})"
DRIVER_RATING = "Sub-investment grade rating ({rating})"
DRIVER_INFLATION = "High inflation (CPI: {cpi}%)"
DRIVER_SEPARATOR = "; "

# --- fixed values: text formats ---
PROFILE_FORMAT = (
    "Company: {company} ({industry}). Financials: Revenue {revenue}, EBITDA {ebitda}, Debt-to-Equity: {de}, "
    "Interest Coverage: {icr}x, Current Ratio: {cr}, Net Profit Margin: {npm}%, Free Cash Flow: {fcf}. "
    "Loan Exposure: Outstanding {outstanding}, Collateral: {collateral}. Payment History: {payments}. "
    "Industry Outlook: {outlook}, Default Rate: {default_rate}%."
)
PROFILE_PAYMENTS_FORMAT = "{on_time}% on-time, max {overdue} days overdue"
PROFILE_NO_PAYMENTS = "No payment data"
CLASSIFICATION_FORMAT = (
    "{company} ({industry}): Risk Score {score}/100 (Grade {grade}). Max days overdue: {overdue}. D/E Ratio: {de}. "
    "Interest Coverage: {icr}x. Payment on-time rate: {on_time}%. Key risks: {drivers}."
)
FINANCIALS_FORMAT = "Revenue: {revenue} Cr, EBITDA: {ebitda} Cr, D/E: {de}, ICR: {icr}x, NPM: {npm}%, FCF: {fcf} Cr"
REPAYMENT_FORMAT = "Payments: {payments} total, On-time: {on_time}, Max overdue: {overdue} days"
INDUSTRY_FORMAT = "Outlook: {outlook}, Default Rate: {default_rate}%, Growth: {growth}%"
MACRO_FORMAT = "CPI: {cpi}%, Repo: {repo}%"
RUN_RESULT_FORMAT = (
    "Run {run} complete. Detected: {detected} | New: {new} | Processed: {processed} | Failed: {failed} | "
    "Policies loaded: {policies}"
)
ERROR_FORMAT = "{file}: {error}"
ERROR_SEPARATOR = " | "
MISSING = "N/A"
CRORE = 10_000_000
LAKH = 100_000
BILLION = 1_000_000_000

# --- fixed values: names and labels of the text steps ---
SIGNAL_FIELDS = (
    "debt_sustainability",
    "liquidity_risk",
    "repayment_risk",
    "collateral_adequacy",
    "revenue_stability",
    "overall_risk_narrative",
)
RECOMMENDATIONS = ("APPROVE", "CONDITIONAL_APPROVE", "ESCALATE", "REJECT")
DOCUMENT_FIELDS = ("title", "issuing_authority", "reference_number", "effective_date", "category")
DOCUMENT_QUESTIONS = {
    "title": "What is the document called?",
    "issuing_authority": "Which organisation issued it?",
    "reference_number": "What is its reference or circular number?",
    "effective_date": "When does it take effect, or when was it issued? Answer as YYYY-MM-DD.",
    "category": "Which one is it: ASSET_CLASSIFICATION, PROVISIONING, CAPITAL_ADEQUACY, EXPOSURE_LIMITS, RESOLUTION or INSOLVENCY?",
}
DOCUMENT_TYPE = "Master Circular"
RELEVANCE_FORMAT = "Production pipeline | Run: {run}"
APPRAISAL_QUERY = "credit appraisal provisioning norms capital adequacy"
OPEN_APPLICATION_STATUSES = ("PENDING", "UNDER_REVIEW", "ESCALATED")

# --- fixed values: domains of the checked columns ---
OUTLOOK_DOMAIN = ("POSITIVE", "STABLE", "NEGATIVE", "WATCHLIST")
APPLICATION_STATUS_DOMAIN = ("PENDING", "UNDER_REVIEW", "APPROVED", "REJECTED", "WITHDRAWN", "ESCALATED")
OFFICER_DECISION_DOMAIN = ("APPROVED", "REJECTED", "DEFERRED")
INDICATOR_CATEGORY_DOMAIN = ("INFLATION", "RATES", "CREDIT", "COMMODITY", "FX", "GROWTH")
POLICY_CATEGORY_DOMAIN = (
    "ASSET_CLASSIFICATION",
    "PROVISIONING",
    "CAPITAL_ADEQUACY",
    "EXPOSURE_LIMITS",
    "RESOLUTION",
    "INSOLVENCY",
)

# --- fixed values: words that route a question to a dataset ---
ROUTES_FIRST = (
    ("risk_scores", ("risk", "score", "grade", "borrower", "high risk", "critical")),
    ("loan_exposure", ("loan", "exposure", "outstanding", "collateral")),
    ("applications", ("application", "pending", "approved", "rejected")),
    ("macro", ("macro", "cpi", "inflation", "repo", "gdp", "industry", "sector", "outlook")),
)
ROUTES_ALL = (
    ("risk_scores", ("risk", "score", "grade", "borrower", "high risk", "critical", "portfolio", "npa exposure")),
    ("loan_exposure", ("loan", "exposure", "outstanding", "collateral", "npa", "sector")),
    ("applications", ("application", "pending", "approved", "rejected", "review", "officer")),
    ("macro", ("macro", "cpi", "inflation", "repo", "gdp", "industry", "sector", "outlook")),
)
ROUTE_DEFAULT = "risk_scores"
ROUTE_HEADINGS_FIRST = {
    "risk_scores": "RISK SCORES DATA:",
    "loan_exposure": "LOAN DATA:",
    "applications": "APPLICATION DATA:",
    "macro": "MACRO DATA:",
}
ROUTE_HEADINGS = {
    "risk_scores": "PORTFOLIO RISK SCORES:",
    "loan_exposure": "LOAN EXPOSURE DATA:",
    "applications": "APPLICATION PIPELINE:",
    "macro": "MACRO INDICATORS:",
}

# --- fixed values: size limits ---
PAGES_PER_RANGE = 500
SECTION_MARK = "## "
SECTION_MIN_LENGTH = 10
POLICY_PREFIX = "REG"
POLICY_DIGITS = 3
PREVIEW_LENGTH = 200
CITATION_LENGTH = 2000
DATA_CONTEXT_LENGTH = 2500
POLICY_CONTEXT_LENGTH = 1500
HIT_LENGTH = 600
HIT_LENGTH_FIRST = 500
HITS_ASSESSMENT = 2
HITS_ADVISOR = 3
HITS_ADVISOR_FIRST = 2
HITS_POLICY_PAGE = 5
WORST_ROWS = 15
REGION_DEFAULT = "India"
