"""SQL for the derived domain tables and the shared score steps, as named CTEs.

Written for the SQL engine of the check, independently of the DataFrame code: exact
rounding is done with whole numbers (tenths, cents), not with decimals.
"""

from __future__ import annotations

import re

CTES: dict[str, str] = {}

CTES["customers"] = """
    SELECT c_custkey AS customer_id, c_name AS company_name, c_mktsegment AS sector, r_name AS industry,
           n_name AS country,
           CASE WHEN c_acctbal < 2000 THEN 'HIGH' WHEN c_acctbal < 6000 THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""
CTES["statement_sums"] = """
    SELECT o_custkey AS customer_id, year(o_orderdate) AS fiscal_year, 'Q' || quarter(o_orderdate) AS fiscal_quarter,
           sum(o_orderkey % 1000000)::BIGINT AS s, sum(round(o_totalprice * 100)::BIGINT)::BIGINT AS revenue_cents
    FROM orders GROUP BY 1, 2, 3
    UNION ALL
    SELECT o_custkey, year(o_orderdate), NULL, sum(o_orderkey % 1000000)::BIGINT,
           sum(round(o_totalprice * 100)::BIGINT)::BIGINT
    FROM orders GROUP BY 1, 2
"""
CTES["company_financials"] = """
    SELECT customer_id, fiscal_year::BIGINT AS fiscal_year, fiscal_quarter, s, revenue_cents,
           customer_id || '-' || fiscal_year || '-' || coalesce(fiscal_quarter, 'FY') AS financial_id,
           (revenue_cents * 20 + 50) // 100 AS ebitda_cents, (revenue_cents * 8 + 50) // 100 AS net_profit_cents,
           (revenue_cents * 10 + 50) // 100 AS fcf_cents,
           CASE WHEN s % 37 <> 0 THEN ((s % 500) * 100)::DECIMAL(18, 4) / 10000 END::DECIMAL(8, 4) AS de,
           (((s * 7 % 300) * 100)::DECIMAL(18, 4) / 10000)::DECIMAL(8, 4) AS cr,
           (((s * 13 % 800) * 100)::DECIMAL(18, 4) / 10000)::DECIMAL(8, 4) AS icr,
           ((s * 17 % 250) * 10 - 500)::DECIMAL(18, 4) / 10000 AS npm_raw,
           (((s * 17 % 250) * 10 - 500)::DECIMAL(18, 4) / 10000)::DECIMAL(8, 4) AS npm,
           (((s * 19 % 200) * 10)::DECIMAL(18, 4) / 10000)::DECIMAL(8, 4) AS roa,
           (s * 17 % 250) - 50 AS npm_thousandths, s * 19 % 200 AS roa_thousandths
    FROM statement_sums
"""
CTES["pledged"] = """
    SELECT l_orderkey, sum(round(l_extendedprice * 100)::BIGINT)::BIGINT AS cents FROM lineitem GROUP BY 1
"""
CTES["loan_history"] = """
    SELECT o_orderkey AS loan_id, o_custkey AS customer_id, o_orderpriority AS loan_type,
           round(o_totalprice * 100)::BIGINT AS sanctioned_cents,
           (round(o_totalprice * 100)::BIGINT + 1) // 2 AS outstanding_cents,
           500 + o_orderkey % 800 AS rate_hundredths, o_orderdate::DATE AS sanction_date,
           pledged.cents AS collateral_cents,
           CASE o_orderstatus WHEN 'O' THEN 'ACTIVE' WHEN 'F' THEN 'CLOSED' WHEN 'P' THEN 'NPA' END AS loan_status,
           'Facility ' || o_orderpriority AS purpose
    FROM orders LEFT JOIN pledged ON o_orderkey = l_orderkey
"""
CTES["loan_repayment"] = """
    SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS repayment_id, l_orderkey AS loan_id,
           o_custkey AS customer_id, o_orderdate::DATE AS due_date, round(l_extendedprice * 100)::BIGINT AS emi_cents,
           CASE WHEN l_returnflag = 'R' AND l_discount >= 0.08 AND o_custkey % 5 > 0 THEN 'LATE' ELSE 'ON_TIME' END
               AS payment_status,
           CASE WHEN l_returnflag = 'R' AND l_discount >= 0.08
                THEN floor(l_quantity * (o_custkey % 5) / 2)::BIGINT ELSE 0 END AS days_overdue
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""
CTES["bank_transactions"] = """
    SELECT event_id AS transaction_id, user_id AS customer_id, debit, credit,
           30000 * (user_id % 4) + sum(credit - debit) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS balance
    FROM (SELECT *, CASE WHEN event_type IN ('view', 'click') THEN round(value * 100)::BIGINT ELSE 0 END AS debit,
                 CASE WHEN event_type IN ('purchase', 'signup') THEN round(value * 100)::BIGINT ELSE 0 END AS credit
          FROM events)
"""
CTES["credit_ratings"] = """
    SELECT o_orderkey AS rating_id, o_custkey AS customer_id, o_orderdate::DATE AS rating_date,
           ['AAA', 'AA+', 'AA', 'AA-', 'A+', 'A', 'A-', 'BBB+', 'BBB', 'BBB-', 'BB+', 'BB', 'BB-', 'B+', 'B', 'B-',
            'CCC', 'Aa1', 'A2', 'Baa3', 'Ba2'][o_orderkey % 21 + 1] AS rating,
           ['Positive', 'Stable', 'Negative', NULL][o_orderkey // 21 % 4 + 1] AS rating_outlook
    FROM orders
"""
CTES["industry_trends"] = """
    SELECT sector, industry, report_date, q, sector || '-' || industry || '-' || q AS trend_id,
           (s % 60) / 10.0::DOUBLE AS default_rate_pct, (s % 70) / 10.0::DOUBLE AS npa_ratio_pct,
           (s % 90) / 10.0::DOUBLE AS sector_growth_pct, s // 240 % 8 AS regulatory_risk_score,
           ['POSITIVE', 'STABLE', 'WATCHLIST', 'NEGATIVE'][s // 60 % 4 + 1] AS outlook,
           'Demand in ' || sector AS key_risk_factors
    FROM (SELECT sector, industry, date_trunc('quarter', o_orderdate)::DATE AS q,
                 sum(o_orderkey % 1000000)::BIGINT AS s, max(o_orderdate::DATE) AS report_date
          FROM orders JOIN customers ON o_custkey = customer_id GROUP BY 1, 2, 3)
"""
CTES["macro_values"] = """
    SELECT CASE event_type WHEN 'view' THEN 'CPI_GENERAL' WHEN 'click' THEN 'REPO_RATE' WHEN 'purchase' THEN 'INR_USD'
                WHEN 'signup' THEN 'GROSS_NPA_RATIO' WHEN 'error' THEN 'CREDIT_GROWTH_INDUSTRY' END AS indicator_name,
           CASE event_type WHEN 'view' THEN 'INFLATION' WHEN 'click' THEN 'RATES' WHEN 'purchase' THEN 'FX'
                WHEN 'signup' THEN 'CREDIT' WHEN 'error' THEN 'GROWTH' END AS indicator_category,
           CASE event_type WHEN 'purchase' THEN 'rupees' ELSE 'percent' END AS unit,
           ts::DATE AS report_date,
           floor((sum(round(value * 100)::BIGINT)::BIGINT / 100.0::DOUBLE) / count(*)
                 / CASE event_type WHEN 'signup' THEN 20 WHEN 'error' THEN 5 ELSE 10 END * 100 + 0.5) / 100 AS value
    FROM events WHERE event_type IN ('view', 'click', 'purchase', 'signup', 'error') GROUP BY event_type, ts::DATE
"""
CTES["macro_economic_indicators"] = """
    SELECT indicator_name || '-' || report_date AS indicator_id, indicator_name, indicator_category, value,
           previous_value, floor(100.0::DOUBLE * (value - previous_value) / nullif(previous_value, 0) * 100 + 0.5) / 100
               AS change_pct,
           unit, report_date, 'DAILY' AS frequency, 'events' AS source,
           CASE WHEN indicator_name = 'INR_USD' THEN 'Global' ELSE 'India' END AS region
    FROM (SELECT *, lag(value) OVER (PARTITION BY indicator_name ORDER BY report_date) AS previous_value
          FROM macro_values)
"""
CTES["loan_applications"] = """
    SELECT o_orderkey AS application_id, o_custkey AS customer_id, o_orderdate::DATE AS application_date,
           o_orderpriority AS loan_type, round(o_totalprice * 100)::BIGINT AS requested_cents,
           ['PENDING', 'UNDER_REVIEW', 'APPROVED', 'REJECTED', 'WITHDRAWN', 'ESCALATED'][o_orderkey % 6 + 1]
               AS application_status,
           ['APPROVE', 'REJECT', 'CONDITIONAL_APPROVE', 'ESCALATE', NULL][o_orderkey // 6 % 5 + 1]
               AS ai_recommendation,
           'Order status ' || o_orderstatus AS ai_recommendation_reason,
           o_orderkey % 100 AS confidence_hundredths,
           ['APPROVED', 'REJECTED', 'DEFERRED', NULL][o_orderkey // 30 % 4 + 1] AS officer_decision
    FROM orders
"""

# --- latest rows ---
CTES["newest_statement"] = """
    SELECT * FROM company_financials
    QUALIFY row_number() OVER (PARTITION BY customer_id
        ORDER BY fiscal_year DESC, fiscal_quarter DESC NULLS FIRST, financial_id DESC) = 1
"""
CTES["newest_rating"] = """
    SELECT * FROM credit_ratings
    QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY rating_date DESC, rating_id DESC) = 1
"""
CTES["newest_trend"] = """
    SELECT * FROM industry_trends
    QUALIFY row_number() OVER (PARTITION BY sector, industry ORDER BY report_date DESC, trend_id DESC) = 1
"""
CTES["newest_macro"] = """
    SELECT * FROM macro_economic_indicators
    QUALIFY row_number() OVER (PARTITION BY indicator_name ORDER BY report_date DESC, indicator_id DESC) = 1
"""

# --- component scores ---
CTES["fin"] = """
    SELECT *, de_score + cr_score + icr_score + npm_score AS total FROM (
        SELECT *,
            CASE WHEN de IS NULL THEN 0 WHEN de < 0.5 THEN 10 WHEN de < 1 THEN 8 WHEN de < 1.5 THEN 6
                 WHEN de < 2.5 THEN 4 WHEN de < 4 THEN 2 ELSE 0 END AS de_score,
            CASE WHEN cr >= 2 THEN 8 WHEN cr >= 1.5 THEN 6 WHEN cr >= 1.2 THEN 4 WHEN cr >= 1 THEN 2 ELSE 0 END
                AS cr_score,
            CASE WHEN icr >= 6 THEN 7 WHEN icr >= 4 THEN 5 WHEN icr >= 2.5 THEN 3 WHEN icr >= 1.5 THEN 1 ELSE 0 END
                AS icr_score,
            CASE WHEN npm >= 0.15 THEN 5 WHEN npm >= 0.08 THEN 4 WHEN npm >= 0.04 THEN 3 WHEN npm >= 0.01 THEN 1
                 ELSE 0 END AS npm_score
        FROM newest_statement)
"""
CTES["rep"] = """
    SELECT *, ontime_tenths + 10 * overdue_score AS total_tenths FROM (
        SELECT customer_id, count(*) AS payments, count(*) FILTER (payment_status = 'ON_TIME') AS on_time,
               max(days_overdue) AS max_overdue,
               (2000 * count(*) FILTER (payment_status = 'ON_TIME') + count(*)) // (2 * count(*)) AS pct_tenths,
               (240 * count(*) FILTER (payment_status = 'ON_TIME') + count(*)) // (2 * count(*)) AS ontime_tenths,
               CASE WHEN max(days_overdue) = 0 THEN 8 WHEN max(days_overdue) <= 15 THEN 6
                    WHEN max(days_overdue) <= 30 THEN 4 WHEN max(days_overdue) <= 60 THEN 2 ELSE 0 END AS overdue_score
        FROM loan_repayment GROUP BY 1)
"""
CTES["cash"] = """
    SELECT *, net_flow_score + balance_stability_score + stress_score AS total,
           CASE WHEN d > 0 THEN (200 * c + d) // (2 * d) END AS ratio_hundredths
    FROM (
        SELECT customer_id, sum(credit) AS c, sum(debit) AS d, min(balance) AS min_cents,
            CASE WHEN sum(debit) = 0 THEN 0 WHEN 10 * sum(credit) >= 11 * sum(debit) THEN 4
                 WHEN sum(credit) >= sum(debit) THEN 3 WHEN 10 * sum(credit) >= 9 * sum(debit) THEN 1 ELSE 0 END
                AS net_flow_score,
            CASE WHEN min(balance) <= 0 THEN 0 WHEN 10 * min(balance) * count(*) >= 7 * sum(balance) THEN 3
                 WHEN 10 * min(balance) * count(*) >= 4 * sum(balance) THEN 2 ELSE 1 END AS balance_stability_score,
            CASE count(*) FILTER (balance < 0) WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 0 END AS stress_score
        FROM bank_transactions GROUP BY 1)
"""
CTES["coll"] = """
    SELECT customer_id, sum(outstanding_cents) AS o, sum(collateral_cents) AS c,
           CASE WHEN sum(collateral_cents) IS NULL OR sum(outstanding_cents) = 0 THEN 2
                WHEN sum(collateral_cents) >= 2 * sum(outstanding_cents) THEN 13
                WHEN 2 * sum(collateral_cents) >= 3 * sum(outstanding_cents) THEN 10
                WHEN 5 * sum(collateral_cents) >= 6 * sum(outstanding_cents) THEN 7
                WHEN sum(collateral_cents) >= sum(outstanding_cents) THEN 4 ELSE 2 END AS collateral_score
    FROM loan_history WHERE loan_status = 'ACTIVE' GROUP BY 1
"""
CTES["rat"] = """
    SELECT *,
        CASE WHEN rating IN ('AAA', 'Aaa') THEN 10 WHEN rating IN ('AA+', 'Aa1') THEN 9
             WHEN rating IN ('AA', 'Aa2') THEN 8 WHEN rating IN ('AA-', 'Aa3') THEN 7
             WHEN rating IN ('A+', 'A1', 'A', 'A2') THEN 6 WHEN rating IN ('A-', 'A3', 'BBB+', 'Baa1') THEN 5
             WHEN rating IN ('BBB', 'Baa2') THEN 4 WHEN rating IN ('BBB-', 'Baa3') THEN 3
             WHEN rating IN ('BB+', 'Ba1') THEN 2 WHEN rating IN ('BB', 'Ba2', 'BB-', 'Ba3') THEN 1 ELSE 0 END
            AS rating_num_score,
        CASE rating_outlook WHEN 'Positive' THEN 3 WHEN 'Stable' THEN 2 WHEN 'Negative' THEN 0 ELSE 1 END
            AS outlook_score
    FROM newest_rating
"""
CTES["ind"] = """
    SELECT *, default_rate_score + industry_outlook_score + reg_risk_score AS total FROM (
        SELECT *,
            CASE WHEN default_rate_pct < 1 THEN 4 WHEN default_rate_pct < 2 THEN 3 WHEN default_rate_pct < 3.5 THEN 2
                 WHEN default_rate_pct < 5 THEN 1 ELSE 0 END AS default_rate_score,
            CASE outlook WHEN 'POSITIVE' THEN 3 WHEN 'STABLE' THEN 2 WHEN 'WATCHLIST' THEN 1 WHEN 'NEGATIVE' THEN 0
                 ELSE 1 END AS industry_outlook_score,
            CASE WHEN regulatory_risk_score <= 2 THEN 3 WHEN regulatory_risk_score <= 3 THEN 2
                 WHEN regulatory_risk_score <= 5 THEN 1 ELSE 0 END AS reg_risk_score
        FROM newest_trend)
"""
CTES["mac"] = """
    SELECT cpi AS latest_cpi, repo AS latest_repo_rate, npa AS latest_npa_ratio,
        CASE WHEN cpi < 4 THEN 3 WHEN cpi < 5.5 THEN 2 WHEN cpi < 7 THEN 1 ELSE 0 END AS cpi_score,
        CASE WHEN repo < 5.5 THEN 3 WHEN repo < 6.5 THEN 2 WHEN repo < 7.5 THEN 1 ELSE 0 END AS repo_score,
        CASE WHEN growth >= 10 THEN 2 WHEN growth >= 6 THEN 1 ELSE 0 END AS credit_growth_score,
        CASE WHEN npa < 2.5 THEN 2 WHEN npa < 4 THEN 1 ELSE 0 END AS system_npa_score,
        CASE WHEN fx < 1 THEN 2 WHEN fx < 3 THEN 1 ELSE 0 END AS fx_score
    FROM (SELECT max(value) FILTER (indicator_name = 'CPI_GENERAL') AS cpi,
                 max(value) FILTER (indicator_name = 'REPO_RATE') AS repo,
                 max(value) FILTER (indicator_name = 'CREDIT_GROWTH_INDUSTRY') AS growth,
                 max(value) FILTER (indicator_name = 'GROSS_NPA_RATIO') AS npa,
                 max(change_pct) FILTER (indicator_name = 'INR_USD') AS fx
          FROM newest_macro)
"""
CTES["scored"] = """
    SELECT c.*, f.fiscal_year, f.fiscal_quarter, f.revenue_cents, f.ebitda_cents, f.fcf_cents, f.de, f.cr, f.icr,
           f.npm, f.npm_thousandths, f.de_score, f.cr_score, f.icr_score, f.npm_score,
           r.payments, r.on_time, r.max_overdue, r.pct_tenths, r.ontime_tenths, r.overdue_score,
           k.net_flow_score, k.stress_score, k.ratio_hundredths, k.min_cents,
           l.o, l.c, i.outlook, i.default_rate_pct, i.sector_growth_pct, i.industry_outlook_score, t.rating,
           t.rating_num_score, m.cpi_score, m.latest_cpi, m.latest_repo_rate, m.latest_npa_ratio,
           coalesce(f.total, 0) AS s_fin, coalesce(r.total_tenths, 0) AS s_rep_tenths, coalesce(k.total, 0) AS s_cash,
           coalesce(l.collateral_score, 0) AS s_coll, coalesce(t.rating_num_score + t.outlook_score, 0) AS s_rat,
           coalesce(i.total, 0) AS s_ind,
           m.cpi_score + m.repo_score + m.credit_growth_score + m.system_npa_score + m.fx_score AS s_mac,
           l.collateral_score
    FROM customers c LEFT JOIN fin f USING (customer_id) LEFT JOIN rep r USING (customer_id)
    LEFT JOIN cash k USING (customer_id) LEFT JOIN coll l USING (customer_id) LEFT JOIN rat t USING (customer_id)
    LEFT JOIN ind i USING (sector, industry) CROSS JOIN mac m
"""
CTES["graded"] = """
    SELECT *,
        CASE WHEN tenths >= 800 THEN 'A' WHEN tenths >= 600 THEN 'B' WHEN tenths >= 400 THEN 'C'
             WHEN tenths >= 200 THEN 'D' ELSE 'E' END AS risk_grade,
        array_to_string([sentence FOR sentence IN [
            CASE WHEN coalesce(de_score, 0) <= 4 THEN 'High leverage (D/E: ' || coalesce(de::VARCHAR, 'N/A') || ')' END,
            CASE WHEN coalesce(icr_score, 0) <= 3
                 THEN 'Weak interest coverage (' || coalesce(icr::VARCHAR, 'N/A') || 'x)' END,
            CASE WHEN coalesce(ontime_tenths, 0) < 100
                 THEN 'Repayment delays (max ' || coalesce(max_overdue::VARCHAR, '0') || ' days overdue)' END,
            CASE WHEN coalesce(net_flow_score, 0) <= 1 THEN 'Cash outflows exceed inflows (ratio: '
                 || coalesce((ratio_hundredths / 100.0)::DECIMAL(18, 2)::VARCHAR, 'N/A') || ')' END,
            CASE WHEN coalesce(stress_score, 0) = 0 THEN 'Account stress: negative balance detected' END,
            CASE WHEN coalesce(collateral_score, 0) <= 4 THEN 'Low collateral coverage' END,
            CASE WHEN coalesce(industry_outlook_score, 0) <= 1
                 THEN 'Adverse industry outlook (' || coalesce(outlook, 'N/A') || ')' END,
            CASE WHEN coalesce(rating_num_score, 0) <= 3
                 THEN 'Sub-investment grade rating (' || coalesce(rating, 'N/A') || ')' END,
            CASE WHEN coalesce(cpi_score, 0) = 0
                 THEN 'High inflation (CPI: ' || coalesce(latest_cpi::VARCHAR, 'N/A') || '%)' END
        ] IF sentence IS NOT NULL], '; ') AS key_risk_drivers,
        (tenths / 10.0)::DECIMAL(18, 1)::VARCHAR AS score_text, tenths / 10.0::DOUBLE AS composite_score
    FROM (SELECT *, 10 * (s_fin + s_cash + s_coll + s_rat + s_ind + s_mac) + s_rep_tenths AS tenths FROM scored)
"""
CTES["classed"] = """
    SELECT *,
        CASE WHEN sma_category = 'NPA' OR risk_grade = 'E' THEN 'REJECT'
             WHEN sma_category = 'SMA_2' OR risk_grade = 'D' THEN 'ESCALATE'
             WHEN sma_category = 'SMA_1' OR risk_grade = 'C' THEN 'CONDITIONAL_APPROVE' ELSE 'APPROVE' END
            AS recommendation
    FROM (SELECT *, CASE WHEN coalesce(max_overdue, 0) > 90 THEN 'NPA' WHEN max_overdue > 60 THEN 'SMA_2'
                         WHEN max_overdue > 30 THEN 'SMA_1' WHEN max_overdue > 0 OR tenths < 400 THEN 'SMA_0'
                         ELSE 'STANDARD' END AS sma_category FROM graded)
"""


# --- documents ---
CTES["docs"] = """
    SELECT doc_id, lpad(doc_id::VARCHAR, 12, '0') AS file_name, md5(text) AS file_hash, n_chars, text FROM documents
"""
CTES["known"] = """
    SELECT doc_id, file_name, CASE WHEN toxic = 0 THEN file_hash ELSE 'changed' END AS file_hash,
           CASE WHEN quality = 1 THEN 'SUCCESS' ELSE 'FAILED' END AS processing_status
    FROM docs JOIN labels USING (doc_id)
"""
CTES["fresh"] = """
    SELECT * FROM docs WHERE NOT EXISTS (SELECT 1 FROM known WHERE known.processing_status = 'SUCCESS'
        AND known.file_name = docs.file_name AND known.file_hash = docs.file_hash)
"""
CTES["doc_state"] = """
    SELECT *, CASE WHEN length(trim(text, ' ')) > 0 AND NOT contains(text, '***')
                   THEN 'SUCCESS' ELSE 'FAILED' END AS processing_status
    FROM docs
"""
CTES["field_values"] = """
    SELECT doc_id, nullif(trim(regexp_extract(text, '^\\s*(?:#+ )?([^\\n]+)', 1)), '') AS title,
           nullif(trim(regexp_extract(text, '(?i)under (?:the )?([a-z0-9 \\-]+license)', 1)), '') AS issuing_authority,
           nullif(trim(regexp_extract(text, '\\b([0-9]{16})\\b', 1)), '') AS reference_number,
           try_cast(nullif(regexp_extract(text, '\\b([0-9]{4}-[0-9]{2}-[0-9]{2})\\b', 1), '') AS DATE) AS effective_date,
           CASE WHEN contains(low, 'npa') OR contains(low, 'asset classification') OR contains(low, 'sub-standard')
                    THEN 'ASSET_CLASSIFICATION'
                WHEN contains(low, 'provision') THEN 'PROVISIONING'
                WHEN contains(low, 'capital') OR contains(low, 'basel') THEN 'CAPITAL_ADEQUACY'
                WHEN contains(low, 'exposure') THEN 'EXPOSURE_LIMITS'
                WHEN contains(low, 'resolution') THEN 'RESOLUTION'
                WHEN contains(low, 'insolven') OR contains(low, 'bankrupt') THEN 'INSOLVENCY' END AS category
    FROM (SELECT *, lower(text) AS low FROM documents)
"""
CTES["pieces"] = """
    SELECT doc_id, file_name, unnest(string_split(text, '## ')) AS piece,
           generate_subscripts(string_split(text, '## '), 1) - 1 AS piece_index
    FROM docs
"""
CTES["sections"] = """
    SELECT doc_id, file_name, piece_index, trim(nullif(regexp_extract(piece, '^[^\\n]+'), '')) AS section,
           trim(nullif(regexp_extract(piece, '(?s)\\n(.+)', 1), '')) AS content
    FROM pieces WHERE length(trim(piece)) > 10
"""
CTES["usable"] = """
    SELECT * FROM sections JOIN field_values USING (doc_id) WHERE title IS NOT NULL AND content IS NOT NULL
"""
CTES["policies"] = """
    SELECT *, 'REG' || lpad(n::VARCHAR, greatest(3, length(n::VARCHAR))::INT, '0') AS policy_id
    FROM (SELECT *, row_number() OVER (ORDER BY file_name, piece_index) AS n FROM usable)
"""

# --- feed ---
CTES["feed_days"] = "SELECT DISTINCT report_date FROM macro_economic_indicators WHERE indicator_name <> 'CPI_GENERAL'"

# --- search ---
CTES["doc_words"] = """
    SELECT doc_id, word FROM (SELECT doc_id, unnest(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+')) AS word
                              FROM documents) WHERE word <> ''
"""
CTES["doc_sizes"] = """
    SELECT doc_id, count(word) AS size FROM documents LEFT JOIN doc_words USING (doc_id) GROUP BY 1
"""
CTES["word_counts"] = "SELECT doc_id, word, count(*) AS times FROM doc_words GROUP BY 1, 2"
CTES["word_rarity"] = """
    SELECT word, ln(1 + ((SELECT count(*) FROM documents) - count(*) + 0.5::DOUBLE) / (count(*) + 0.5::DOUBLE)) AS rarity
    FROM word_counts GROUP BY 1
"""
CTES["word_weights"] = """
    SELECT doc_id, word, rarity * times * 2.2::DOUBLE / (times + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * size
               / (SELECT avg(size) FROM doc_sizes))) AS weight
    FROM word_counts JOIN doc_sizes USING (doc_id) JOIN word_rarity USING (word)
"""
CTES["benchmark_words"] = """
    SELECT DISTINCT query_id, word FROM (
        SELECT item_id AS query_id, unnest(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+')) AS word FROM benchmark)
    WHERE word <> ''
"""
CTES["benchmark_hits"] = """
    SELECT query_id, doc_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank
    FROM (SELECT query_id, doc_id, round(sum(weight), 6) AS score FROM word_weights JOIN benchmark_words USING (word)
          GROUP BY 1, 2)
"""
CTES["norm_docs"] = """
    SELECT doc_id, source, text || chr(10) || ['provisioning norms', 'capital adequacy', 'credit appraisal',
           'other matters'][doc_id % 4 + 1] AS text FROM documents
"""
CTES["norm_words"] = """
    SELECT doc_id, word FROM (SELECT doc_id, unnest(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+')) AS word
                              FROM norm_docs) WHERE word <> ''
"""
CTES["norm_sizes"] = "SELECT doc_id, count(*) AS size FROM norm_words GROUP BY 1"
CTES["norm_counts"] = "SELECT doc_id, word, count(*) AS times FROM norm_words GROUP BY 1, 2"
CTES["norm_rarity"] = """
    SELECT word, ln(1 + ((SELECT count(*) FROM documents) - count(*) + 0.5::DOUBLE) / (count(*) + 0.5::DOUBLE)) AS rarity
    FROM norm_counts GROUP BY 1
"""
CTES["appraisal_hits"] = """
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank
    FROM (SELECT doc_id, round(sum(rarity * times * 2.2::DOUBLE / (times + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * size
                     / (SELECT avg(size) FROM norm_sizes)))), 6) AS score
          FROM norm_counts JOIN norm_sizes USING (doc_id) JOIN norm_rarity USING (word)
          WHERE word IN ('credit', 'appraisal', 'provisioning', 'norms', 'capital', 'adequacy') GROUP BY 1)
"""
CTES["regulations"] = """
    SELECT left(string_agg(source || ': ' || left(text, 2000), chr(10) ORDER BY rank), 2000) AS context
    FROM appraisal_hits JOIN norm_docs USING (doc_id) WHERE rank <= 2
"""
CTES["centres"] = """
    SELECT label, list(x ORDER BY place) AS centre
    FROM (SELECT label, place, sum(x::DOUBLE::DECIMAL(20, 12))::DOUBLE AS x
          FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS place FROM embeddings)
          GROUP BY 1, 2)
    GROUP BY 1
"""
CTES["assessed"] = """
    SELECT *,
        'Revenue: ' || crore(revenue_cents) || ' Cr, EBITDA: ' || crore(ebitda_cents) || ' Cr, D/E: ' || de::VARCHAR
            || ', ICR: ' || icr::VARCHAR || 'x, NPM: ' || (npm_thousandths / 10.0)::DECIMAL(10, 2)::VARCHAR
            || '%, FCF: ' || crore(fcf_cents) || ' Cr' AS financials,
        'Payments: ' || payments || ' total, On-time: ' || on_time || ', Max overdue: ' || max_overdue || ' days'
            AS repayment,
        'Outlook: ' || outlook || ', Default Rate: ' || default_rate_pct || '%, Growth: ' || sector_growth_pct || '%'
            AS industry_outlook,
        'CPI: ' || latest_cpi || '%, Repo: ' || latest_repo_rate || '%' AS macro_text,
        CASE WHEN tenths >= 800 THEN 0.95 WHEN tenths >= 600 THEN 0.85 WHEN tenths >= 400 THEN 0.7 ELSE 0.6
             END::DOUBLE AS confidence_score
    FROM classed
""".replace("crore(revenue_cents)", "((2 * revenue_cents + 10000000) // 20000000 / 100.0)::DECIMAL(18, 2)::VARCHAR").replace(
    "crore(ebitda_cents)", "((2 * ebitda_cents + 10000000) // 20000000 / 100.0)::DECIMAL(18, 2)::VARCHAR"
).replace("crore(fcf_cents)", "((2 * fcf_cents + 10000000) // 20000000 / 100.0)::DECIMAL(18, 2)::VARCHAR")


def with_ctes(sql: str) -> str:
    """Prefix a statement with the CTEs it names, and the ones those name, in definition order."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        words = set(re.findall(r"[a-z_]+", text))
        for name in CTES:
            if name in words and name not in needed:
                needed.add(name)
                visit(CTES[name])

    visit(sql)
    parts = [f"{name} AS ({CTES[name]})" for name in CTES if name in needed]
    if parts and sql.lstrip().startswith("WITH "):
        return f"WITH {', '.join(parts)}, {sql.lstrip()[5:]}"
    return f"WITH {', '.join(parts)} {sql}" if parts else sql
