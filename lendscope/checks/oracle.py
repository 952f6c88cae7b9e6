"""Check SQL per registered query."""

from __future__ import annotations

from lendscope import fixed
from lendscope.checks.derivation_sql import with_ctes
from lendscope.operators.quality import MaxLength, NotNull, Reference, Unique
from lendscope.sources.schemas import RULES

SQL: dict[str, str] = {}


def money(cents: str) -> str:
    """Cents as a number with two digits."""
    return f"({cents} / 100.0::DOUBLE)"


def tenths(value: str) -> str:
    return f"({value} / 10.0::DOUBLE)"


def in_unit(cents: str, unit: int) -> str:
    """Cents in a larger unit, rounded half up to one digit, by whole numbers."""
    whole = unit * 100
    return f"((20 * {cents} + {whole}) // (2 * {whole}) / 10.0::DOUBLE)"


SQL["filter_active"] = f"""
    SELECT loan_id, customer_id, {money('outstanding_cents')} AS outstanding_balance
    FROM loan_history WHERE loan_status = 'ACTIVE'
"""
SQL["like_filter"] = "SELECT doc_id, source FROM documents WHERE source LIKE 'src1%'"
SQL["score_bands"] = """
    SELECT customer_id, fiscal_year, fiscal_quarter,
        CASE WHEN de IS NULL THEN 0 WHEN de < 0.5 THEN 10 WHEN de < 1 THEN 8 WHEN de < 1.5 THEN 6
             WHEN de < 2.5 THEN 4 WHEN de < 4 THEN 2 ELSE 0 END AS de_score,
        CASE WHEN cr >= 2 THEN 8 WHEN cr >= 1.5 THEN 6 WHEN cr >= 1.2 THEN 4 WHEN cr >= 1 THEN 2 ELSE 0 END AS cr_score,
        CASE WHEN icr >= 6 THEN 7 WHEN icr >= 4 THEN 5 WHEN icr >= 2.5 THEN 3 WHEN icr >= 1.5 THEN 1 ELSE 0 END
            AS icr_score,
        CASE WHEN npm >= 0.15 THEN 5 WHEN npm >= 0.08 THEN 4 WHEN npm >= 0.04 THEN 3 WHEN npm >= 0.01 THEN 1
             ELSE 0 END AS npm_score
    FROM company_financials
"""
SQL["latest_financials"] = """
    SELECT customer_id, fiscal_year, fiscal_quarter, de::DOUBLE AS debt_to_equity_ratio, cr::DOUBLE AS current_ratio,
           icr::DOUBLE AS interest_coverage_ratio, npm::DOUBLE AS net_profit_margin
    FROM newest_statement
"""
SQL["latest_rating"] = "SELECT customer_id, rating, rating_outlook, rating_date FROM newest_rating"
SQL["latest_industry"] = """
    SELECT sector, industry, outlook, default_rate_pct AS default_rate, npa_ratio_pct AS npa_ratio,
           sector_growth_pct AS growth, key_risk_factors, report_date FROM newest_trend
"""
SQL["latest_macro"] = """
    SELECT indicator_name, indicator_category, value, previous_value, change_pct, unit, report_date, source
    FROM newest_macro
"""
SQL["financial_scores"] = """
    SELECT customer_id, de_score, cr_score, icr_score, npm_score, total AS financial_health_score FROM fin
"""
SQL["repayment_summary"] = f"""
    SELECT customer_id, payments, on_time, {tenths('pct_tenths')} AS on_time_pct, max_overdue FROM rep
"""
SQL["repayment_scores"] = f"""
    SELECT customer_id, max_overdue AS max_days_overdue, {tenths('ontime_tenths')} AS ontime_score, overdue_score,
           {tenths('total_tenths')} AS repayment_score FROM rep
"""
SQL["cashflow_scores"] = f"""
    SELECT customer_id, net_flow_score, balance_stability_score, stress_score,
           {money('ratio_hundredths')} AS credit_debit_ratio, {money('min_cents')} AS min_balance FROM cash
"""
SQL["collateral_scores"] = "SELECT customer_id, collateral_score FROM coll"
SQL["rating_scores"] = "SELECT customer_id, rating_num_score, outlook_score FROM rat"
SQL["industry_scores"] = "SELECT sector, industry, default_rate_score, industry_outlook_score, reg_risk_score FROM ind"
SQL["macro_scores"] = """
    SELECT cpi_score, repo_score, credit_growth_score, system_npa_score, fx_score, latest_cpi, latest_repo_rate,
           latest_npa_ratio FROM mac
"""
SQL["macro_pivot"] = """
    SELECT max(value) FILTER (indicator_name = 'CPI_GENERAL') AS cpi,
           max(value) FILTER (indicator_name = 'REPO_RATE') AS repo_rate,
           max(value) FILTER (indicator_name = 'CREDIT_GROWTH_INDUSTRY') AS credit_growth,
           max(value) FILTER (indicator_name = 'GROSS_NPA_RATIO') AS npa_ratio,
           max(value) FILTER (indicator_name = 'INR_USD') AS fx
    FROM newest_macro
"""
SQL["industry_join"] = """
    SELECT customer_id, outlook, default_rate_pct FROM customers LEFT JOIN newest_trend USING (sector, industry)
"""
SQL["macro_cross"] = """
    SELECT customer_id, cpi_score, repo_score, credit_growth_score, system_npa_score, fx_score, latest_cpi,
           latest_repo_rate, latest_npa_ratio FROM customers CROSS JOIN mac
"""
RISK_SCORES = f"""
    SELECT customer_id, company_name, sector, industry, s_fin AS financial_health_score,
           {tenths('s_rep_tenths')} AS repayment_score, s_cash AS cashflow_behavior_score, s_coll AS collateral_score,
           s_rat AS rating_score, s_ind AS industry_score, s_mac AS macro_environment_score, composite_score,
           risk_grade, key_risk_drivers, {money('ratio_hundredths')} AS cashflow_ratio,
           {money('min_cents')} AS min_account_balance, latest_cpi, latest_repo_rate, latest_npa_ratio
    FROM graded
"""
SQL["risk_scores"] = RISK_SCORES
SQL["risk_drivers"] = "SELECT customer_id, key_risk_drivers FROM graded"

CRORE_TEXT = "coalesce(format('{{:,}}', ((2 * {cents} + 1000000000) // 2000000000)::BIGINT) || ' Cr', 'N/A')"


def crore_text(cents: str) -> str:
    return CRORE_TEXT.replace("{{", "{").replace("}}", "}").replace("{cents}", cents)


PROFILE = f"""
    'Company: ' || company_name || ' (' || industry || '). Financials: Revenue ' || {crore_text('revenue_cents')}
    || ', EBITDA ' || {crore_text('ebitda_cents')} || ', Debt-to-Equity: ' || coalesce(de::VARCHAR, 'N/A')
    || ', Interest Coverage: ' || coalesce(icr::VARCHAR, 'N/A') || 'x, Current Ratio: ' || coalesce(cr::VARCHAR, 'N/A')
    || ', Net Profit Margin: ' || coalesce((npm_thousandths / 10.0)::DECIMAL(10, 2)::VARCHAR, 'N/A')
    || '%, Free Cash Flow: ' || {crore_text('fcf_cents')} || '. Loan Exposure: Outstanding ' || {crore_text('o')}
    || ', Collateral: ' || {crore_text('c')} || '. Payment History: '
    || coalesce((pct_tenths / 10.0)::DECIMAL(10, 1)::VARCHAR || '% on-time, max ' || max_overdue || ' days overdue',
                'No payment data')
    || '. Industry Outlook: ' || coalesce(outlook, 'N/A') || ', Default Rate: '
    || coalesce(default_rate_pct::VARCHAR, 'N/A') || '%.'
"""
SQL["borrower_profiles"] = f"SELECT customer_id, company_name, sector, industry, {PROFILE} AS profile_text FROM graded"


def level(score: str, high: int, medium: int) -> str:
    return (
        f"CASE WHEN coalesce({score}, 0) <= {high} THEN 'HIGH' WHEN coalesce({score}, 0) <= {medium} THEN 'MEDIUM' "
        "ELSE 'LOW' END"
    )


SQL["risk_signals"] = f"""
    SELECT customer_id, company_name, sector, industry, {PROFILE} AS profile_text,
           {level('de_score', 2, 6)} AS debt_sustainability, {level('cr_score', 2, 4)} AS liquidity_risk,
           {level('overdue_score', 2, 6)} AS repayment_risk, {level('collateral_score', 4, 7)} AS collateral_adequacy,
           {level('npm_score', 1, 3)} AS revenue_stability, key_risk_drivers AS overall_risk_narrative
    FROM graded
"""
SQL["borrower_classification"] = f"""
    SELECT customer_id, company_name, sector, industry, composite_score, risk_grade,
           coalesce(max_overdue, 0) AS max_days_overdue, {tenths('coalesce(pct_tenths, 0)')} AS on_time_pct,
           sma_category, recommendation AS lending_recommendation, key_risk_drivers,
           company_name || ' (' || industry || '): Risk Score ' || score_text || '/100 (Grade ' || risk_grade
           || '). Max days overdue: ' || coalesce(max_overdue::VARCHAR, '0') || '. D/E Ratio: '
           || coalesce(de::VARCHAR, 'N/A') || '. Interest Coverage: ' || coalesce(icr::VARCHAR, 'N/A')
           || 'x. Payment on-time rate: ' || coalesce((pct_tenths / 10.0)::DECIMAL(10, 1)::VARCHAR, '0')
           || '%. Key risks: ' || key_risk_drivers || '.' AS classification_text
    FROM classed
"""

# --- portfolio ---
SQL["exposure_kpis"] = f"""
    SELECT {money('sum(outstanding_cents)')} AS total_exposure,
           {money("sum(outstanding_cents) FILTER (loan_status = 'ACTIVE')")} AS active_exposure,
           {money("coalesce(sum(outstanding_cents) FILTER (loan_status IN ('NPA', 'DEFAULT')), 0)")} AS npa_exposure,
           count(DISTINCT customer_id) AS borrowers
    FROM loan_history
"""
SQL["portfolio_kpis"] = """
    SELECT borrowers, avg_score, high_risk, total_exposure_bn, active_exposure_bn, npa_exposure_bn
    FROM (SELECT count(*) AS borrowers, round_even(sum(tenths) / 10.0::DOUBLE / count(*), 0)::BIGINT AS avg_score,
                 count(*) FILTER (risk_grade IN ('D', 'E')) AS high_risk FROM graded),
         (SELECT round_even(coalesce(sum(outstanding_cents), 0) / 1e11, 1) AS total_exposure_bn,
                 round_even(coalesce(sum(outstanding_cents) FILTER (loan_status = 'ACTIVE'), 0) / 1e11, 1)
                     AS active_exposure_bn,
                 round_even(coalesce(sum(outstanding_cents) FILTER (loan_status IN ('NPA', 'DEFAULT')), 0) / 1e11, 1)
                     AS npa_exposure_bn
          FROM loan_history)
"""
SQL["grade_counts"] = "SELECT risk_grade, count(*) AS count FROM graded GROUP BY 1"
SQL["grade_distribution"] = """
    SELECT risk_grade, count(DISTINCT customer_id) AS borrower_count,
           (2 * sum(tenths) + count(*)) // (2 * count(*)) / 10.0::DOUBLE AS avg_score
    FROM graded GROUP BY 1
"""
SQL["sma_breakdown"] = """
    SELECT CASE WHEN days > 90 THEN 'NPA' WHEN days > 60 THEN 'SMA-2' WHEN days > 30 THEN 'SMA-1'
                WHEN days > 0 THEN 'SMA-0' ELSE 'Standard' END AS category, count(*) AS customers
    FROM (SELECT customer_id, max(days_overdue) AS days FROM loan_repayment GROUP BY 1) GROUP BY 1
"""
SQL["sector_summary"] = """
    SELECT sector, count(customer_id) AS borrowers, round_even(sum(tenths) / 10.0::DOUBLE / count(*), 1) AS avg_score,
           min(tenths) / 10.0::DOUBLE AS min_score, count(*) FILTER (risk_grade IN ('D', 'E')) AS high_risk
    FROM graded WHERE sector IS NOT NULL GROUP BY 1
"""
SQL["scorecard"] = """
    SELECT customer_id, company_name, sector, composite_score, risk_grade, key_risk_drivers FROM graded
"""
SQL["high_risk_borrowers"] = """
    SELECT customer_id, company_name, composite_score, risk_grade, key_risk_drivers FROM graded
    WHERE risk_grade IN ('D', 'E')
"""
SQL["worst_15"] = """
    SELECT customer_id, company_name, sector, composite_score, risk_grade, key_risk_drivers FROM graded
    ORDER BY tenths, customer_id LIMIT 15
"""
SQL["score_components"] = """
    SELECT customer_id, component, score, max_score FROM (
        SELECT customer_id, unnest([
            {'component': 'Financial', 'score': s_fin::DOUBLE, 'max_score': 30},
            {'component': 'Repayment', 'score': s_rep_tenths / 10.0::DOUBLE, 'max_score': 20},
            {'component': 'Cash Flow', 'score': s_cash::DOUBLE, 'max_score': 10},
            {'component': 'Collateral', 'score': s_coll::DOUBLE, 'max_score': 13},
            {'component': 'Rating', 'score': s_rat::DOUBLE, 'max_score': 13},
            {'component': 'Industry', 'score': s_ind::DOUBLE, 'max_score': 10},
            {'component': 'Macro', 'score': s_mac::DOUBLE, 'max_score': 12}], recursive := true)
        FROM graded)
"""
SQL["exposure_list"] = f"""
    SELECT loan_id, company_name, sector, loan_type, {money('outstanding_cents')} AS outstanding_balance,
           {money('collateral_cents')} AS collateral_value, loan_status
    FROM loan_history JOIN customers USING (customer_id) WHERE loan_status = 'ACTIVE'
"""

# --- borrowers ---
SQL["borrower_list"] = "SELECT customer_id, company_name, risk_tier FROM customers"
SQL["borrower_financials"] = f"""
    SELECT customer_id, fiscal_year, fiscal_quarter, {in_unit('revenue_cents', 10**7)} AS revenue_cr,
           {in_unit('ebitda_cents', 10**7)} AS ebitda_cr, {in_unit('net_profit_cents', 10**7)} AS net_profit_cr,
           de::DOUBLE AS de_ratio, icr::DOUBLE AS icr, {tenths('npm_thousandths')} AS npm_pct,
           cr::DOUBLE AS current_ratio, {tenths('roa_thousandths')} AS roa_pct
    FROM company_financials
"""
SQL["borrower_loans"] = f"""
    SELECT customer_id, loan_id, loan_type, {in_unit('sanctioned_cents', 10**7)} AS sanctioned_cr,
           {in_unit('outstanding_cents', 10**7)} AS outstanding_cr, {in_unit('collateral_cents', 10**7)} AS collateral_cr,
           loan_status, {money('rate_hundredths')} AS rate_pct, purpose
    FROM loan_history
"""
SQL["borrower_repayments"] = f"""
    SELECT customer_id, repayment_id, due_date, {in_unit('emi_cents', 10**5)} AS emi_lakhs, payment_status, days_overdue
    FROM loan_repayment
"""

# --- applications ---
APPLICATION_COLUMNS = f"""application_id, company_name, loan_type, {in_unit('requested_cents', 10**7)} AS requested_cr,
    application_status, ai_recommendation, confidence_hundredths::DOUBLE AS confidence, officer_decision,
    application_date"""
SQL["loan_applications"] = f"""
    SELECT {APPLICATION_COLUMNS}, ai_recommendation_reason FROM loan_applications JOIN customers USING (customer_id)
"""
SQL["apps_filtered"] = f"""
    SELECT {APPLICATION_COLUMNS} FROM loan_applications JOIN customers USING (customer_id)
    WHERE application_status IN ('PENDING', 'ESCALATED', 'REJECTED')
"""
SQL["application_kpis"] = """
    SELECT count(*) AS total,
           count(*) FILTER (application_status IN ('PENDING', 'UNDER_REVIEW', 'ESCALATED')) AS in_pipeline,
           count(*) FILTER (application_status = 'APPROVED') AS approved,
           count(*) FILTER (application_status = 'REJECTED') AS rejected
    FROM loan_applications
"""
SQL["decision_alignment"] = """
    SELECT total, advised, decided, agree, round_even(100.0 * agree / nullif(decided, 0), 0)::BIGINT AS agreement_rate
    FROM (SELECT count(*) AS total, count(ai_recommendation) AS advised,
                 count(*) FILTER (ai_recommendation IS NOT NULL AND officer_decision IS NOT NULL) AS decided,
                 count(*) FILTER (contains(upper(ai_recommendation), 'APPROVE')
                                  = contains(upper(officer_decision), 'APPROVE')) AS agree
          FROM loan_applications)
"""
SQL["pending_applications"] = f"""
    SELECT application_id, company_name, loan_type, {money('requested_cents')} AS requested_amount, application_status,
           ai_recommendation
    FROM loan_applications JOIN customers USING (customer_id)
    WHERE application_status IN ('PENDING', 'UNDER_REVIEW', 'ESCALATED')
"""
SQL["macro_headline"] = """
    SELECT max(value) FILTER (indicator_name = 'CPI_GENERAL') AS cpi_general_value,
           round_even(max(change_pct) FILTER (indicator_name = 'CPI_GENERAL'), 1) AS cpi_general_change,
           max(value) FILTER (indicator_name = 'REPO_RATE') AS repo_rate_value,
           round_even(max(change_pct) FILTER (indicator_name = 'REPO_RATE'), 1) AS repo_rate_change,
           max(value) FILTER (indicator_name = 'INR_USD') AS inr_usd_value,
           round_even(max(change_pct) FILTER (indicator_name = 'INR_USD'), 1) AS inr_usd_change,
           max(value) FILTER (indicator_name = 'CRUDE_OIL_BRENT') AS crude_oil_brent_value,
           round_even(max(change_pct) FILTER (indicator_name = 'CRUDE_OIL_BRENT'), 1) AS crude_oil_brent_change
    FROM newest_macro
"""

# --- semantic model ---
SQL["semantic_query"] = """
    SELECT sector AS customers_sector, risk_grade AS risk_scores_risk_grade, total_borrowers, avg_risk_score,
           total_outstanding, active_loan_count, total_applications
    FROM (SELECT sector, risk_grade, count(DISTINCT customer_id) AS total_borrowers,
                 round(sum(tenths) / 10.0::DOUBLE / count(*), 4) AS avg_risk_score FROM graded GROUP BY 1, 2)
    LEFT JOIN (SELECT sector, risk_grade, sum(outstanding_cents) / 100.0::DOUBLE AS total_outstanding,
                      count(*) AS active_loan_count
               FROM loan_history JOIN graded USING (customer_id) GROUP BY 1, 2) USING (sector, risk_grade)
    LEFT JOIN (SELECT sector, risk_grade, count(*) AS total_applications
               FROM loan_applications JOIN graded USING (customer_id) GROUP BY 1, 2) USING (sector, risk_grade)
"""

# --- data rules ---
SQL["dq_pk"] = """
    SELECT * FROM (VALUES
        ('lineitem', 'unique', 'l_orderkey,l_linenumber', (SELECT count(*) FROM (
            SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1))),
        ('loan_repayment', 'unique', 'repayment_id', (SELECT count(*) FROM (
            SELECT 1 FROM loan_repayment GROUP BY repayment_id HAVING count(*) > 1))),
        ('customers', 'unique', 'customer_id', (SELECT count(*) - count(DISTINCT customer_id) FROM customers)),
        ('documents', 'unique', 'file_hash', (SELECT count(*) FROM (
            SELECT 1 FROM documents GROUP BY text HAVING count(*) > 1)))
    ) AS checks(table_name, rule, column_name, violations)
"""
SQL["dq_fk"] = """
    SELECT * FROM (VALUES
        ('loan_repayment', 'reference', 'loan_id', (SELECT count(*) FROM loan_repayment
            WHERE loan_id NOT IN (SELECT loan_id FROM loan_history))),
        ('loan_history', 'reference', 'customer_id', (SELECT count(*) FROM loan_history
            WHERE customer_id NOT IN (SELECT customer_id FROM customers))),
        ('bank_transactions', 'reference', 'customer_id', (SELECT count(*) FROM bank_transactions
            WHERE customer_id NOT IN (SELECT customer_id FROM customers))),
        ('documents', 'reference', 'doc_id', (SELECT count(*) FROM documents
            WHERE doc_id NOT IN (SELECT doc_id FROM labels)))
    ) AS checks(table_name, rule, column_name, violations)
"""
SQL["dq_domain"] = """
    SELECT * FROM (VALUES
        ('loan_applications', 'domain', 'application_status', (SELECT count(*) FROM loan_applications
            WHERE application_status NOT IN ('PENDING', 'UNDER_REVIEW', 'APPROVED', 'REJECTED', 'WITHDRAWN', 'ESCALATED'))),
        ('loan_applications', 'domain', 'officer_decision', (SELECT count(*) FROM loan_applications
            WHERE officer_decision NOT IN ('APPROVED', 'REJECTED'))),
        ('loan_applications', 'not_null', 'ai_recommendation', (SELECT count(*) FROM loan_applications
            WHERE ai_recommendation IS NULL)),
        ('industry_trends', 'domain', 'outlook', (SELECT count(*) FROM industry_trends
            WHERE outlook NOT IN ('POSITIVE', 'STABLE', 'NEGATIVE', 'WATCHLIST'))),
        ('documents', 'domain', 'lang', (SELECT count(*) FROM documents WHERE lang NOT IN ('en', 'fr', 'de'))),
        ('documents', 'length', 'text', (SELECT count(*) FROM documents WHERE length(text) > 2000))
    ) AS checks(table_name, rule, column_name, violations)
"""


# --- scalar functions ---
SQL["scalar_functions"] = """
    SELECT o_orderkey,
        CASE WHEN cents > 20000000 THEN 'big' WHEN cents > 10000000 THEN 'mid' ELSE 'small' END AS case_when,
        CASE WHEN o_orderkey % 2 = 1 THEN o_orderkey ELSE -1 END AS coalesced,
        nullif(o_orderstatus, 'O') AS nulled,
        ((cents + 50) // 100)::DOUBLE AS rounded,
        (2 * cents + 100 - 100 * o_orderkey) / 100.0::DOUBLE AS arithmetic,
        (cents >= 100000 AND (o_orderkey > 5 OR o_orderkey = 0))::BIGINT AS compared,
        (o_orderpriority IN ('1-URGENT', '2-HIGH'))::BIGINT AS in_list,
        (o_orderpriority LIKE '%LOW')::BIGINT AS like_match,
        o_orderpriority || '/' || o_orderstatus AS joined,
        nullif(o_orderstatus, 'O') || 'x' AS joined_null,
        (cents / 100.0)::DECIMAL(18, 2)::VARCHAR AS number_text,
        format('{:,}', (cents + 50) // 100) AS grouped_text,
        strftime(o_orderdate, '%Y%m%d') AS date_text,
        left(c_name, 5) AS left_text,
        c_name AS trimmed,
        length(c_name) AS name_length,
        lpad(o_orderkey::VARCHAR, 8, '0') AS padded,
        replace(c_name, 'Customer#', 'C-') AS replaced,
        split_part(c_name, '#', 2) AS split_part,
        regexp_extract(c_name, '[0-9]+') AS regexp_part,
        regexp_extract(o_orderpriority, '^([0-9])-(.+)$', 2) AS regexp_group,
        upper(c_name) AS upper_text,
        lower(o_orderpriority) AS lower_text,
        contains(upper(o_orderpriority), 'SPEC')::BIGINT AS contained,
        least(o_orderkey, 500) AS least_value,
        (o_orderdate::DATE + 30)::DATE AS date_added,
        try_cast('2024-01-' || lpad((o_orderkey % 40)::VARCHAR, 2, '0') AS DATE) AS date_tried,
        try_cast(left(o_orderpriority, 1) AS BIGINT) AS number_tried,
        CASE WHEN o_orderstatus = 'O' THEN 'z' ELSE o_orderstatus || '; z' END AS array_text,
        o_orderkey AS json_path,
        'x' AS json_item,
        'y' AS json_parsed,
        ('0x' || substr(md5(c_name), 1, 8))::BIGINT % 9000 + 1000 AS hash_suffix
    FROM (SELECT *, round(o_totalprice * 100)::BIGINT AS cents FROM orders) JOIN customer ON o_custkey = c_custkey
"""

# --- documents and policies ---
SQL["doc_listing"] = """
    SELECT doc_id, octet_length(encode(text)) + 1 AS file_size, md5(text || chr(10)) AS file_hash FROM documents
"""
SQL["doc_incremental"] = "SELECT doc_id, file_hash FROM fresh"
SQL["doc_replace"] = """
    SELECT doc_id, file_hash, 'read' AS action FROM fresh
    UNION ALL SELECT doc_id, file_hash, 'kept' FROM known WHERE doc_id NOT IN (SELECT doc_id FROM fresh)
"""
SQL["doc_recent"] = "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"
SQL["doc_chunks"] = """
    SELECT doc_id, 500 * step AS range_start, least(500 * step + 500, n_chars) AS range_end
    FROM (SELECT doc_id, n_chars, unnest(range((n_chars + 499) // 500)) AS step FROM documents)
"""
SQL["doc_reassemble"] = """
    SELECT doc_id, length(whole) AS text_length, md5(whole) AS text_hash
    FROM (SELECT doc_id, CASE WHEN n_chars <= 500 THEN text ELSE (
                 SELECT string_agg(chr(10) || chr(10) || substr(text, 500 * step + 1, 500), '' ORDER BY step)
                 FROM (SELECT unnest(range((n_chars + 499) // 500)) AS step)) END AS whole
          FROM documents WHERE n_chars > 0)
"""
SQL["doc_status"] = """
    SELECT doc_id, processing_status, CASE WHEN processing_status = 'FAILED'
           THEN 'no readable text' END AS error_message FROM doc_state
"""
SQL["doc_fields"] = """
    SELECT doc_id, title, issuing_authority, reference_number, effective_date, category FROM field_values
"""
PAGE = "html"
for _pattern in (r"(?is)<script\b.*?</script>", r"(?is)<style\b.*?</style>", "(?s)<!--.*?-->", "(?s)<[^>]*>"):
    PAGE = f"regexp_replace({PAGE}, '{_pattern}', ' ', 'g')"
TITLE = "regexp_extract(html, '(?is)<title>(.*?)</title>', 1)"


def readable(text: str) -> str:
    for entity, character in (
        ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&copy;", "©"),
        ("&middot;", "·"), ("&amp;", "&"),
    ):
        text = f"replace({text}, '{entity}', '{character}')"
    return f"trim(regexp_replace({text}, '[ \\t\\r\\n]+', ' ', 'g'))"


SQL["page_text"] = f"""
    SELECT page_id, nullif({readable(TITLE)}, '') AS title, length(body) AS text_length, md5(body) AS text_hash
    FROM (SELECT *, {readable(PAGE)} AS body FROM pages)
"""
ERRORS = "string_agg(file_name || ': no readable text', ' | ' ORDER BY file_name) FILTER (processing_status = 'FAILED')"
SQL["doc_errors"] = """
    SELECT file_name, file_name || ': no readable text' AS line FROM doc_state WHERE processing_status = 'FAILED'
"""
SQL["doc_run_log"] = f"""
    SELECT 'run-2' AS run_id, files_detected, files_new, files_processed, files_failed, policies_loaded,
           CASE WHEN files_failed > 0 THEN 'PARTIAL' ELSE 'SUCCESS' END AS status, error_summary,
           'Run run-2 complete. Detected: ' || files_detected || ' | New: ' || files_new || ' | Processed: '
               || files_processed || ' | Failed: ' || files_failed || ' | Policies loaded: ' || policies_loaded AS result
    FROM (SELECT (SELECT count(*) FROM documents) AS files_detected, count(*) AS files_new,
                 count(*) FILTER (processing_status = 'SUCCESS') AS files_processed,
                 count(*) FILTER (processing_status = 'FAILED') AS files_failed, {ERRORS} AS error_summary,
                 (SELECT count(*) FROM usable WHERE doc_id IN (SELECT doc_id FROM doc_state SEMI JOIN fresh USING (doc_id)
                      WHERE processing_status = 'SUCCESS')) AS policies_loaded
          FROM doc_state SEMI JOIN fresh USING (doc_id))
"""
RUNS = """
    WITH read_first AS (SELECT * FROM doc_state SEMI JOIN labels USING (doc_id)),
    read_second AS (SELECT * FROM doc_state WHERE doc_id NOT IN (
        SELECT doc_id FROM read_first WHERE processing_status = 'SUCCESS')),
    first_policies AS (SELECT * FROM usable WHERE doc_id IN (
        SELECT doc_id FROM read_first WHERE processing_status = 'SUCCESS')),
    second_policies AS (SELECT * FROM usable WHERE doc_id IN (
        SELECT doc_id FROM read_second WHERE processing_status = 'SUCCESS')),
    second_titles AS (SELECT DISTINCT title FROM field_values WHERE title IS NOT NULL AND doc_id IN (
        SELECT doc_id FROM read_second WHERE processing_status = 'SUCCESS')),
    live AS (SELECT title, section, content FROM first_policies WHERE title NOT IN (SELECT title FROM second_titles)
             UNION ALL SELECT title, section, content FROM second_policies),
"""


def run_counts(run: str, docs: str, detected: str, loaded: str) -> str:
    return f"""SELECT '{run}' AS run_id, (SELECT count(*) FROM {detected}) AS files_detected, count(*) AS files_new,
        count(*) FILTER (processing_status = 'SUCCESS') AS files_processed,
        count(*) FILTER (processing_status = 'FAILED') AS files_failed, {loaded} AS policies_loaded,
        md5({ERRORS}) AS error_hash FROM {docs}"""


SQL["ingest_log"] = f"""{RUNS} counts AS (
    {run_counts('run-1', 'read_first', 'read_first', '(SELECT count(*) FROM first_policies)')} UNION ALL
    {run_counts('run-2', 'read_second', 'documents', '(SELECT count(*) FROM live) - (SELECT count(*) FROM first_policies)')})
    SELECT *, CASE WHEN files_failed > 0 THEN 'PARTIAL' ELSE 'SUCCESS' END AS status, true AS is_timed,
           'Run ' || run_id || ' complete. Detected: ' || files_detected || ' | New: ' || files_new || ' | Processed: '
               || files_processed || ' | Failed: ' || files_failed || ' | Policies loaded: ' || policies_loaded AS result
    FROM counts
"""
SQL["ingest_policies"] = f"""{RUNS} counted AS (
    SELECT md5(title) AS title_hash, section, md5(content) AS content_hash, count(*) AS times FROM live GROUP BY ALL)
    SELECT *, true AS has_distinct_ids FROM counted
"""
SQL["policy_sections"] = "SELECT doc_id, piece_index, section, content FROM sections"
SQL["policy_quarantine"] = """
    SELECT doc_id, piece_index, section FROM sections JOIN field_values USING (doc_id)
    WHERE title IS NULL OR content IS NULL
"""
SQL["policy_ids"] = "SELECT policy_id, doc_id, piece_index FROM policies"
SQL["policy_replace"] = """
    SELECT policy_id, doc_id, piece_index, md5(title) AS title_hash
    FROM (
        WITH existing AS (SELECT *, row_number() OVER (ORDER BY file_name, piece_index) AS n FROM usable
                          WHERE doc_id IN (SELECT doc_id FROM known WHERE processing_status = 'SUCCESS')),
        added AS (SELECT *, row_number() OVER (ORDER BY file_name, piece_index) AS n FROM usable
                  WHERE doc_id IN (SELECT doc_id FROM fresh)),
        kept AS (SELECT * FROM existing WHERE title NOT IN (SELECT title FROM added)),
        numbered AS (SELECT n, doc_id, piece_index, title FROM kept
                     UNION ALL SELECT n + (SELECT coalesce(max(n), 0) FROM kept), doc_id, piece_index, title FROM added)
        SELECT *, 'REG' || lpad(n::VARCHAR, greatest(3, length(n::VARCHAR))::INT, '0') AS policy_id FROM numbered)
"""
SQL["policy_library"] = """
    SELECT policy_id, title, issuing_authority, category, section, left(content, 200) || '...' AS content_preview,
           effective_date FROM policies
"""
SQL["policy_kpis"] = """
    SELECT count(*) AS policies, count(DISTINCT issuing_authority) AS authorities,
           count(DISTINCT category) AS categories FROM policies
"""
SQL["policies_filtered"] = """
    SELECT policy_id, category FROM policies WHERE category IS NULL OR category = 'PROVISIONING'
"""

# --- feed ---
SQL["feed_load"] = """
    SELECT indicator_id, 0 AS is_broken FROM macro_economic_indicators
    UNION ALL SELECT 'typed-' || report_date, 0 FROM feed_days
    UNION ALL SELECT NULL, 1 FROM feed_days
"""
SQL["feed_raw"] = """
    SELECT indicator_id, value FROM macro_economic_indicators
    UNION ALL SELECT 'typed-' || report_date, NULL FROM feed_days
"""
SQL["feed_parse"] = """
    SELECT indicator_id, indicator_name, indicator_category, value, previous_value, change_pct, unit, report_date,
           frequency, source, region FROM macro_economic_indicators
"""
SQL["feed_quarantine"] = """
    SELECT '{"indicator_id": "broken-' || report_date || '"' AS text, 'not JSON' AS reason FROM feed_days
    UNION ALL
    SELECT '{"indicator_id": "typed-' || report_date || '", "value": "high"}', 'missing or mistyped column' FROM feed_days
"""
SQL["stream_refresh"] = RISK_SCORES
SQL["doc_fields_asked"] = SQL["doc_fields"]
SQL["doc_manifest"] = SQL["doc_listing"]
SQL["ingest_files"] = SQL["ingest_policies"]
SQL["scores_from_changes"] = RISK_SCORES
SQL["latest_macro_stream"] = SQL["latest_macro"]

# --- search, routing, assessments ---
SQL["search_bm25"] = "SELECT query_id, rank, doc_id, score FROM benchmark_hits WHERE rank <= 5"
SQL["search_scan"] = SQL["search_refreshed"] = SQL["search_bm25"]
SIMILARITY = "round(list_cosine_similarity(embedding::DOUBLE[], centre), 6)"
SQL["search_topk"] = f"""
    SELECT label AS query_id, vec_id, similarity, row_number() OVER (PARTITION BY label ORDER BY similarity DESC, vec_id)
               AS rank
    FROM (SELECT c.label, vec_id, {SIMILARITY} AS similarity FROM embeddings CROSS JOIN centres c)
    QUALIFY rank <= 5
"""
SQL["search_filtered"] = f"""
    SELECT label AS query_id, vec_id, similarity, row_number() OVER (PARTITION BY label ORDER BY similarity DESC, vec_id)
               AS rank
    FROM (SELECT label, vec_id, {SIMILARITY} AS similarity FROM embeddings JOIN centres USING (label))
    QUALIFY rank <= 3
"""


def any_word(text: str, words: tuple) -> str:
    return "(" + " OR ".join(f"contains(lower({text}), '{word}')" for word in words) + ")"


FIRST = " ".join(f"WHEN {any_word('text', words)} THEN '{name}'" for name, words in fixed.ROUTES_FIRST)
SQL["route_first"] = f"SELECT conv_id, turn, CASE {FIRST} END AS dataset FROM conversations WHERE role = 'user'"


def all_routes(text: str) -> str:
    found = ", ".join(f"CASE WHEN {any_word(text, words)} THEN '{name}' END" for name, words in fixed.ROUTES_ALL)
    return f"coalesce(nullif(concat_ws(',', {found}), ''), 'risk_scores')"


SQL["route_all"] = f"SELECT conv_id, turn, {all_routes('text')} AS datasets FROM conversations WHERE role = 'user'"
SQL["reply_cleanup"] = "SELECT conv_id, turn, text FROM conversations WHERE role = 'assistant'"


def dataset(heading: str, columns: str, line: str, source: str, order: str) -> str:
    """Heading, CSV head and the sorted lines of one dataset, cut to 2500 characters."""
    return f"""(SELECT left('{heading}' || chr(10) || '{columns}' || chr(10) || string_agg({line}, chr(10) ORDER BY {order})
        || chr(10), 2500) FROM {source})"""


def amount(cents: str) -> str:
    return f"coalesce(({cents} / 100.0)::DECIMAL(18, 2)::VARCHAR, '')"


DATASETS = {
    "risk_scores": dataset(
        "PORTFOLIO RISK SCORES:", "company_name,sector,composite_score,risk_grade,key_risk_drivers",
        "company_name || ',' || sector || ',' || score_text || ',' || risk_grade || ',' || key_risk_drivers", "graded",
        "tenths, customer_id",
    ),
    "loan_exposure": dataset(
        "LOAN EXPOSURE DATA:", "company_name,sector,loan_type,outstanding_balance,collateral_value,loan_status",
        f"company_name || ',' || sector || ',' || loan_type || ',' || {amount('outstanding_cents')} || ',' || "
        f"{amount('collateral_cents')} || ',' || loan_status",
        "loan_history JOIN customers USING (customer_id)", "outstanding_cents DESC, loan_id",
    ),
    "applications": dataset(
        "APPLICATION PIPELINE:",
        "company_name,loan_type,requested_amount,application_status,ai_recommendation,ai_recommendation_reason",
        f"company_name || ',' || loan_type || ',' || {amount('requested_cents')} || ',' || application_status || ',' || "
        "coalesce(ai_recommendation, '') || ',' || ai_recommendation_reason",
        "loan_applications JOIN customers USING (customer_id)", "application_date DESC, application_id",
    ),
    "macro": dataset(
        "MACRO INDICATORS:", "indicator_name,value,change_pct,report_date",
        "indicator_name || ',' || value || ',' || coalesce(change_pct::VARCHAR, '') || ',' || report_date",
        "newest_macro", "indicator_name",
    ),
}
MATCHED = any_word("asked", dict(fixed.ROUTES_ALL)["risk_scores"])
CONTEXT = " || ".join(
    f"CASE WHEN list_contains(string_split(datasets, ','), '{name}') THEN {text} || "
    + (f"CASE WHEN {MATCHED} THEN chr(10) ELSE '' END" if name == "risk_scores" else "chr(10)")
    + " ELSE '' END"
    for name, text in DATASETS.items()
)
SQL["question_context"] = f"""
    SELECT query_id, datasets, left({CONTEXT}, 2500) AS data_context, coalesce(context, '') AS context
    FROM (SELECT item_id AS query_id, text AS asked, {all_routes('text')} AS datasets FROM benchmark)
    LEFT JOIN (SELECT query_id, left(string_agg('[' || source || ' - ' || lang || ']: ' || left(text, 600) || chr(10) || chr(10), ''
                                     ORDER BY rank), 1500) AS context
               FROM benchmark_hits JOIN documents USING (doc_id) WHERE rank <= 3 GROUP BY 1) USING (query_id)
"""


def first_rows(heading: str, columns: str, line: str, source: str, order: str) -> str:
    """The dataset text of the first form: from its first 15 rows."""
    return dataset(heading, columns, line, f"(SELECT * FROM {source} ORDER BY {order} LIMIT 15)", order)


DATASETS_FIRST = {
    "risk_scores": first_rows(
        "RISK SCORES DATA:", "company_name,composite_score,risk_grade,key_risk_drivers",
        "company_name || ',' || score_text || ',' || risk_grade || ',' || key_risk_drivers", "graded", "tenths, customer_id",
    ),
    "loan_exposure": first_rows(
        "LOAN DATA:", "company_name,loan_type,outstanding_balance,collateral_value,loan_status",
        f"company_name || ',' || loan_type || ',' || {amount('outstanding_cents')} || ',' || {amount('collateral_cents')} "
        "|| ',' || loan_status",
        "loan_history JOIN customers USING (customer_id) WHERE loan_status = 'ACTIVE'", "outstanding_cents DESC, loan_id",
    ),
    "applications": first_rows(
        "APPLICATION DATA:", "company_name,loan_type,requested_amount,application_status,ai_recommendation",
        f"company_name || ',' || loan_type || ',' || {amount('requested_cents')} || ',' || application_status || ',' || "
        "coalesce(ai_recommendation, '')",
        "loan_applications JOIN customers USING (customer_id)", "application_date DESC, application_id",
    ),
    "macro": dataset(
        "MACRO DATA:", "indicator_name,value,change_pct,report_date,source",
        "indicator_name || ',' || value || ',' || coalesce(change_pct::VARCHAR, '') || ',' || report_date || ',' || "
        "coalesce(source, '')",
        "newest_macro", "indicator_name",
    ),
}
FIRST_TEXTS = " ".join(f"WHEN '{name}' THEN {text}" for name, text in DATASETS_FIRST.items())
SQL["question_context_first"] = f"""
    SELECT query_id, dataset, coalesce(CASE dataset {FIRST_TEXTS} END, '') AS data_context, coalesce(context, '') AS context
    FROM (SELECT item_id AS query_id, CASE {FIRST} END AS dataset FROM benchmark)
    LEFT JOIN (SELECT query_id, left(string_agg(source || ': ' || left(text, 500), chr(10) ORDER BY rank), 1500) AS context
               FROM benchmark_hits JOIN documents USING (doc_id) WHERE rank <= 2 GROUP BY 1) USING (query_id)
"""
SQL["question_data"] = f"""
    SELECT conv_id, turn, datasets, left({CONTEXT}, 2500) AS data_context
    FROM (SELECT conv_id, turn, text AS asked, {all_routes('text')} AS datasets FROM conversations WHERE role = 'user')
"""


def assessment_id(date: str, run: str) -> str:
    return (
        f"'CA-{date.replace('-', '')}-' || customer_id || '-' || left(md5(customer_id || '|{date}|{run}'), 12)"
    )


NARRATIVE = """
    '## Executive Summary' || chr(10) || company_name || ' (' || industry || ') scores ' || score_text || ' (grade '
    || risk_grade || ', ' || sma_category || ').' || chr(10) || '## Financial Analysis' || chr(10)
    || coalesce(financials, 'N/A') || chr(10) || '## Risk Factors' || chr(10) || key_risk_drivers || chr(10)
    || '## Regulatory Compliance' || chr(10) || coalesce(repayment, 'N/A') || '; ' || coalesce(industry_outlook, 'N/A')
    || '; ' || coalesce(macro_text, 'N/A') || chr(10) || '## Recommendation' || chr(10) || recommendation
"""
SQL["assessments"] = f"""
    SELECT {assessment_id('2024-03-31', 'run-1')} AS assessment_id, customer_id, confidence_score,
           recommendation AS ai_recommendation,
           context AS regulatory_citations, {NARRATIVE} AS ai_narrative,
           'Write a credit assessment as a senior credit analyst. Borrower: ' || company_name || ' (' || industry
           || '). Risk score: ' || score_text || ' of 108 (grade ' || risk_grade || '). Overdue category: '
           || sma_category || '. Risk drivers: ' || key_risk_drivers || '. Financials: ' || coalesce(financials, 'N/A')
           || '. Repayment: ' || coalesce(repayment, 'N/A') || '. Industry: ' || coalesce(industry_outlook, 'N/A')
           || '. Macro: ' || coalesce(macro_text, 'N/A') || '. Regulations: ' || left(coalesce(context, ''), 1500)
           || '. Sections: executive summary, financial analysis, risk factors, regulatory compliance, recommendation.'
               AS prompt
    FROM assessed CROSS JOIN regulations
"""
SQL["latest_assessment"] = f"""
    SELECT {assessment_id('2024-06-30', 'run-2')} AS assessment_id, customer_id, DATE '2024-06-30' AS assessment_date,
           composite_score AS risk_score, risk_grade, sma_category, recommendation AS ai_recommendation, confidence_score,
           {NARRATIVE} AS ai_narrative, '2024-06-30 17:00:00' AS generated_at
    FROM assessed
"""


SQL["search_policies"] = f"""
    SELECT query_id, doc_id, score, lang, source,
           row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank
    FROM benchmark_hits JOIN documents USING (doc_id) WHERE lang IN ('de', 'fr')
    QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) <= {fixed.HITS_POLICY_PAGE}
"""


# Of the columns with a declared rule, those that the derived tables have.
DERIVED_COLUMNS = {
    "customers": ["customer_id", "company_name", "sector", "industry", "country", "risk_tier"],
    "company_financials": ["financial_id", "customer_id", "fiscal_year", "fiscal_quarter"],
    "loan_history": ["loan_id", "customer_id", "loan_type", "sanctioned_amount", "loan_status", "purpose", "currency"],
    "loan_repayment": ["repayment_id", "loan_id", "customer_id", "due_date", "payment_status"],
    "bank_transactions": ["transaction_id", "customer_id", "transaction_date", "transaction_type"],
    "credit_ratings": ["rating_id", "customer_id", "rating_agency", "rating", "rating_date", "rating_outlook"],
    "industry_trends": ["trend_id", "sector", "industry", "report_date", "quarter", "outlook", "key_risk_factors"],
    "macro_economic_indicators": [
        "indicator_id", "indicator_name", "indicator_category", "value", "report_date", "unit", "frequency", "source", "region",
    ],
    "loan_applications": [
        "application_id", "customer_id", "application_date", "loan_type", "application_status", "ai_recommendation",
        "ai_recommendation_reason", "officer_decision", "currency",
    ],
}
# Columns that the check's tables leave out: the derivation gives every row a value that keeps the rule.
KEPT_BY_DERIVATION = {
    ("loan_history", "currency"), ("bank_transactions", "transaction_date"), ("bank_transactions", "transaction_type"),
    ("credit_ratings", "rating_agency"), ("industry_trends", "quarter"), ("loan_applications", "currency"),
}


def rule_sql(table: str, rule) -> str:
    """One row: table, rule, column and violations."""
    column = rule.columns if isinstance(rule, Unique) else rule.column
    shown = "sanctioned_cents" if column == "sanctioned_amount" else column
    if isinstance(rule, Unique):
        kind, count = "unique", f"(SELECT count(*) FROM (SELECT {shown} FROM {table} GROUP BY 1 HAVING count(*) > 1))"
    elif isinstance(rule, Reference):
        kind = "reference"
        count = f"""(SELECT count(*) FROM {table} WHERE {shown} IS NOT NULL
            AND {shown} NOT IN (SELECT {rule.parent_column} FROM {rule.parent}))"""
    else:
        if isinstance(rule, NotNull):
            kind, broken = "not_null", f"{shown} IS NULL"
        elif isinstance(rule, MaxLength):
            kind, broken = "length", f"length({shown}::VARCHAR) > {rule.length}"
        else:
            kind, broken = "domain", f"{shown} NOT IN ({', '.join(repr(value) for value in rule.values)})"
        count = f"(SELECT count(*) FROM {table} WHERE {broken})"
    if (table, column) in KEPT_BY_DERIVATION:
        count = "0"
    return f"SELECT '{table}' AS table_name, '{kind}' AS rule, '{column}' AS column_name, {count} AS violations"


SQL["dq_declared"] = " UNION ALL ".join(
    rule_sql(table, rule)
    for table, columns in DERIVED_COLUMNS.items()
    for rule in RULES[table]
    if (rule.columns if isinstance(rule, Unique) else rule.column) in columns
)


def oracle_sql() -> dict[str, str]:
    return {name: with_ctes(sql) for name, sql in SQL.items()}
