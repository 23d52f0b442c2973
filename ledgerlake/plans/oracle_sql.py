"""DuckDB SQL for the oracle check: the same layers written as plain SQL.

The Spark side is built from DataFrame operators; this module states the reference
semantics literally (fan-out join then ROW_NUMBER, window-free GROUP BY, ...), so
agreement between the two is a real check. Fragments are CTEs with dependencies;
``sql_with(names, final)`` emits one ``WITH`` statement.
"""

from __future__ import annotations

from .. import constants as K
from ..sources.fixtures import AS_OF, FIXTURES

AS_OF_SQL = f"TIMESTAMP '{AS_OF}'"


def case_map(col: str, mapping: dict, default: str | None) -> str:
    whens = " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in mapping.items())
    tail = f" ELSE '{default}'" if default is not None else ""
    return f"CASE {whens}{tail} END"


def upper_map(values) -> dict:
    return {v: v.upper() for v in values}


def method_case(col: str) -> str:
    return case_map(col, upper_map(K.PAYMENT_METHODS), "UNKNOWN")


def status_case(col: str) -> str:
    return case_map(col, upper_map(K.NORMALIZED_STATUSES), "UNKNOWN")


RISK_LEVEL_SQL = ("CASE WHEN {s} < 0.25 THEN 'LOW' WHEN {s} < 0.5 THEN 'MEDIUM' "
                  "WHEN {s} < 0.75 THEN 'HIGH' ELSE 'CRITICAL' END")
RISK_CLASS_B_SQL = ("CASE WHEN {s} >= 0.8 THEN 'HIGH' WHEN {s} >= 0.5 THEN 'MODERATE' "
                    "WHEN {s} >= 0.2 THEN 'LOW' ELSE 'MINIMAL' END")


def mean_sql(x: str) -> str:
    return f"CAST(SUM({x}) AS DOUBLE) / COUNT({x})"


def layers(src: str = "fx_payments_raw", as_of: str = AS_OF_SQL, days: int = K.RETENTION_DAYS,
           calendar_days: int = K.CALENDAR_DAYS) -> dict[str, tuple[list[str], str]]:
    cutoff = f"({as_of} - INTERVAL {days} DAY)"
    L: dict[str, tuple[list[str], str]] = {}
    L["pc_parsed"] = ([src], f"""
SELECT payment_id, merchant_id, customer_id, TRY_CAST(amount AS DECIMAL(18,2)) AS amount,
       UPPER(currency) AS currency, {method_case('payment_method')} AS payment_method_normalized,
       {status_case('status')} AS status_normalized,
       TRY_CAST(created_at AS TIMESTAMP) AS payment_created_at, TRY_CAST(updated_at AS TIMESTAMP) AS payment_updated_at,
       amount AS raw_amount, created_at AS raw_created, updated_at AS raw_updated
FROM {src}""")
    L["payments_cleaned"] = (["pc_parsed"], f"""
SELECT payment_id, merchant_id, customer_id, amount, currency, payment_method_normalized, status_normalized,
       payment_created_at, payment_updated_at
FROM pc_parsed
WHERE NOT (raw_amount IS NOT NULL AND amount IS NULL)
  AND NOT (raw_created IS NOT NULL AND payment_created_at IS NULL)
  AND NOT (raw_updated IS NOT NULL AND payment_updated_at IS NULL)
  AND payment_created_at >= {cutoff}""")
    L["fraud_signals_cleaned"] = (["fx_fraud_signals_raw"], f"""
SELECT signal_id, transaction_id, TRY_CAST(risk_score AS DECIMAL(3,2)) AS risk_score,
       {RISK_LEVEL_SQL.format(s='TRY_CAST(risk_score AS DOUBLE)')} AS risk_level_derived,
       risk_level, alerts,
       {case_map('decision', K.DECISION_MAP, 'UNKNOWN')} AS decision_normalized,
       {case_map('case_status', upper_map(K.CASE_STATUSES), 'UNKNOWN')} AS case_status_normalized,
       TRY_CAST(created_at AS TIMESTAMP) AS signal_created_at
FROM fx_fraud_signals_raw
WHERE TRY_CAST(risk_score AS DECIMAL(3,2)) IS NOT NULL AND TRY_CAST(created_at AS TIMESTAMP) >= {cutoff}""")
    L["payments_with_fraud"] = (["payments_cleaned", "fraud_signals_cleaned"], """
SELECT p.payment_id, p.merchant_id, p.customer_id, p.amount, p.currency,
       p.payment_method_normalized AS payment_method, p.status_normalized AS status,
       COALESCE(f.risk_score, CAST(0 AS DECIMAL(3,2))) AS risk_score,
       COALESCE(f.risk_level, 'NOT_EVALUATED') AS fraud_risk_level,
       COALESCE(f.decision_normalized, 'NO_DECISION') AS fraud_decision,
       f.alerts AS fraud_alerts,
       CASE WHEN f.decision_normalized IN ('DECLINED', 'BLOCKED') THEN 'HIGH_RISK'
            WHEN f.decision_normalized = 'CHALLENGED' THEN 'MEDIUM_RISK'
            WHEN f.risk_score > 0.5 THEN 'MEDIUM_RISK'
            WHEN f.risk_score > 0.25 THEN 'LOW_RISK'
            ELSE 'APPROVED' END AS overall_risk_category,
       p.payment_created_at, p.payment_updated_at,
       COALESCE(f.signal_created_at, p.payment_created_at) AS latest_event_at,
       f.signal_created_at AS f_created, f.risk_score AS f_score, f.decision_normalized AS f_decision,
       f.risk_level AS f_level, f.alerts AS f_alerts, f.signal_id AS f_id,
       p.payment_method_normalized AS p_method, p.status_normalized AS p_status
FROM payments_cleaned p LEFT JOIN fraud_signals_cleaned f ON p.payment_id = f.transaction_id""")
    L["transactions_fact"] = (["payments_with_fraud"], """
SELECT payment_id AS transaction_id, merchant_id, customer_id, amount, currency, payment_method, status,
       risk_score, fraud_risk_level, fraud_decision, overall_risk_category,
       payment_created_at AS transaction_date, payment_updated_at, latest_event_at
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY payment_id ORDER BY
        payment_updated_at DESC NULLS LAST, payment_created_at DESC NULLS LAST, amount DESC NULLS LAST,
        merchant_id DESC NULLS LAST, customer_id DESC NULLS LAST, currency DESC NULLS LAST,
        p_method DESC NULLS LAST, p_status DESC NULLS LAST,
        f_created DESC NULLS LAST, f_score DESC NULLS LAST, f_decision DESC NULLS LAST,
        f_level DESC NULLS LAST, f_alerts DESC NULLS LAST, f_id DESC NULLS LAST) AS rn
      FROM payments_with_fraud) d
WHERE rn = 1""")
    L["fact_transactions"] = (["transactions_fact"], """
SELECT transaction_id, strftime(transaction_date, '%Y%m%d') AS date_key, merchant_id, customer_id,
       payment_method, amount AS transaction_amount, currency, CAST(amount AS DECIMAL(18,2)) AS amount_usd,
       status AS payment_status, risk_score, fraud_risk_level, fraud_decision, overall_risk_category,
       CAST(CASE WHEN status = 'CAPTURED' THEN amount ELSE 0 END AS DECIMAL(18,2)) AS captured_amount,
       CAST(CASE WHEN status = 'REFUNDED' THEN amount ELSE 0 END AS DECIMAL(18,2)) AS refunded_amount,
       CAST(CASE WHEN status IN ('DECLINED', 'FAILED') THEN amount ELSE 0 END AS DECIMAL(18,2)) AS failed_amount,
       CAST(CASE WHEN fraud_decision = 'DECLINED' THEN amount ELSE 0 END AS DECIMAL(18,2)) AS fraud_blocked_amount,
       transaction_date AS transaction_timestamp, payment_updated_at AS status_updated_at
FROM transactions_fact""")
    L["dim_date"] = ([], f"""
SELECT strftime(d, '%Y%m%d') AS date_key, d AS calendar_date, CAST(year(d) AS INTEGER) AS year,
       CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month_number,
       monthname(d) AS month_name, CAST(week(d) AS INTEGER) AS week_number, CAST(day(d) AS INTEGER) AS day_of_month,
       CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, dayname(d) AS day_name,
       CASE WHEN dayofweek(d) + 1 IN (1, 7) THEN 1 ELSE 0 END AS is_weekend,
       CASE WHEN month(d) IN (1, 4, 7, 10) AND day(d) = 1 THEN 1 ELSE 0 END AS is_quarter_start
FROM (SELECT CAST(CAST({as_of} AS DATE) - CAST(s AS INTEGER) AS DATE) AS d FROM range(0, {calendar_days + 1}) t(s)) x""")
    L["dim_merchant"] = (["transactions_fact"], """
SELECT merchant_id, merchant_id AS merchant_code,
       CASE WHEN length(merchant_id) > 0 THEN 'Merchant_' || merchant_id ELSE 'Unknown' END AS merchant_name,
       COUNT(*) AS total_transactions
FROM transactions_fact GROUP BY merchant_id""")
    L["dim_customer"] = (["transactions_fact"], f"""
SELECT customer_id, customer_id AS customer_code,
       CASE WHEN length(customer_id) > 0 THEN 'Customer_' || customer_id ELSE 'Unknown' END AS customer_name,
       COUNT(*) AS total_transactions, {mean_sql('risk_score')} AS avg_risk_score, MAX(risk_score) AS max_risk_score,
       COUNT(CASE WHEN fraud_decision = 'DECLINED' THEN 1 END) AS fraud_decline_count
FROM transactions_fact GROUP BY customer_id""")
    L["dim_payment_method"] = (["transactions_fact"], f"""
SELECT DISTINCT payment_method, payment_method AS method_code,
       {case_map('payment_method', K.METHOD_DISPLAY_NAMES, 'Other')} AS method_name,
       {case_map('payment_method', K.METHOD_CATEGORIES, 'Other')} AS method_category
FROM transactions_fact WHERE payment_method IS NOT NULL""")
    L["metric_daily_payment_summary"] = (["dim_date", "fact_transactions"], f"""
SELECT d.calendar_date, d.year, d.quarter, d.month_number, d.month_name, d.week_number, d.day_name,
       COUNT(DISTINCT f.transaction_id) AS total_transactions,
       COUNT(DISTINCT f.merchant_id) AS active_merchants,
       COUNT(DISTINCT f.customer_id) AS active_customers,
       CAST(SUM(f.transaction_amount) AS DECIMAL(38,2)) AS total_volume,
       {mean_sql('f.transaction_amount')} AS avg_transaction_amount,
       MIN(f.transaction_amount) AS min_transaction_amount, MAX(f.transaction_amount) AS max_transaction_amount,
       round(stddev_samp(f.transaction_amount), 4) AS stddev_transaction_amount,
       COUNT(CASE WHEN f.payment_status = 'CAPTURED' THEN 1 END) AS successful_transactions,
       COUNT(CASE WHEN f.payment_status IN ('DECLINED', 'FAILED') THEN 1 END) AS failed_transactions,
       COUNT(CASE WHEN f.fraud_decision = 'DECLINED' THEN 1 END) AS fraud_blocked_transactions,
       CAST(COUNT(CASE WHEN f.payment_status = 'CAPTURED' THEN 1 END) AS DOUBLE)
             / NULLIF(COUNT(DISTINCT f.transaction_id), 0) * 100 AS success_rate_pct,
       {mean_sql('f.risk_score')} AS avg_risk_score,
       COUNT(CASE WHEN f.overall_risk_category = 'HIGH_RISK' THEN 1 END) AS high_risk_count,
       COUNT(CASE WHEN f.overall_risk_category = 'MEDIUM_RISK' THEN 1 END) AS medium_risk_count,
       COUNT(CASE WHEN f.overall_risk_category = 'LOW_RISK' THEN 1 END) AS low_risk_count,
       CAST(SUM(f.captured_amount) AS DECIMAL(38,2)) AS captured_volume,
       CAST(SUM(f.refunded_amount) AS DECIMAL(38,2)) AS refunded_volume,
       CAST(SUM(f.fraud_blocked_amount) AS DECIMAL(38,2)) AS fraud_blocked_volume
FROM dim_date d LEFT JOIN fact_transactions f ON d.date_key = strftime(f.transaction_timestamp, '%Y%m%d')
GROUP BY d.calendar_date, d.year, d.quarter, d.month_number, d.month_name, d.week_number, d.day_name""")
    L["metric_fraud_analytics"] = (["fact_transactions", "dim_merchant"], f"""
SELECT f.merchant_id, dm.merchant_name,
       COUNT(DISTINCT f.transaction_id) AS total_transactions,
       COUNT(DISTINCT f.customer_id) AS unique_customers,
       CAST(SUM(f.transaction_amount) AS DECIMAL(38,2)) AS total_volume,
       COUNT(CASE WHEN f.fraud_decision = 'DECLINED' THEN 1 END) AS fraud_blocked_count,
       CAST(SUM(CASE WHEN f.fraud_decision = 'DECLINED' THEN f.transaction_amount ELSE 0 END) AS DECIMAL(38,2)) AS fraud_blocked_volume,
       CAST(COUNT(CASE WHEN f.fraud_decision = 'DECLINED' THEN 1 END) AS DOUBLE)
             / NULLIF(COUNT(DISTINCT f.transaction_id), 0) * 100 AS fraud_block_rate_pct,
       {mean_sql('f.risk_score')} AS avg_risk_score, MAX(f.risk_score) AS max_risk_score,
       COUNT(CASE WHEN f.overall_risk_category = 'HIGH_RISK' THEN 1 END) AS high_risk_transactions,
       COUNT(CASE WHEN f.overall_risk_category = 'MEDIUM_RISK' THEN 1 END) AS medium_risk_transactions,
       COUNT(CASE WHEN f.payment_status = 'CAPTURED' THEN 1 END) AS successful_captures,
       COUNT(CASE WHEN f.payment_status IN ('DECLINED', 'FAILED') THEN 1 END) AS failed_transactions
FROM fact_transactions f LEFT JOIN dim_merchant dm ON f.merchant_id = dm.merchant_id
GROUP BY f.merchant_id, dm.merchant_name""")
    L["metric_customer_risk_profile"] = (["fact_transactions", "dim_customer"], f"""
SELECT f.customer_id, dc.customer_name,
       COUNT(DISTINCT f.transaction_id) AS transaction_count,
       COUNT(DISTINCT f.merchant_id) AS merchant_count,
       CAST(SUM(f.transaction_amount) AS DECIMAL(38,2)) AS total_volume,
       {mean_sql('f.risk_score')} AS avg_risk_score, MAX(f.risk_score) AS max_risk_score,
       round(quantile_cont(CAST(f.risk_score AS DOUBLE), 0.5), 4) AS median_risk_score,
       COUNT(CASE WHEN f.overall_risk_category = 'HIGH_RISK' THEN 1 END) AS high_risk_count,
       COUNT(CASE WHEN f.overall_risk_category = 'MEDIUM_RISK' THEN 1 END) AS medium_risk_count,
       COUNT(CASE WHEN f.payment_status = 'CAPTURED' THEN 1 END) AS successful_transactions,
       COUNT(CASE WHEN f.fraud_decision = 'DECLINED' THEN 1 END) AS fraud_blocked_count,
       CAST(SUM(CASE WHEN f.fraud_decision = 'DECLINED' THEN f.transaction_amount ELSE 0 END) AS DECIMAL(38,2)) AS fraud_blocked_amount,
       CASE WHEN AVG(f.risk_score) > 0.7 THEN 'VERY_HIGH_RISK' WHEN AVG(f.risk_score) > 0.5 THEN 'HIGH_RISK'
            WHEN AVG(f.risk_score) > 0.25 THEN 'MEDIUM_RISK' ELSE 'LOW_RISK' END AS risk_classification,
       MAX(f.transaction_timestamp) AS last_transaction_date
FROM fact_transactions f LEFT JOIN dim_customer dc ON f.customer_id = dc.customer_id
GROUP BY f.customer_id, dc.customer_name""")
    return L


def sql_with(names: list[str], final: str, extra: dict | None = None, **layer_args) -> str:
    """One statement: every fixture / layer CTE that ``names`` need, then ``final``."""
    L = layers(**layer_args)
    if extra:
        L.update(extra)
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        if n in L:
            for d in L[n][0]:
                visit(d)
        elif n in FIXTURES:
            for d in FIXTURES[n][0]:
                visit(d)
        else:
            return  # a driver table, already a view
        order.append(n)

    for n in names:
        visit(n)
    parts = []
    for n in order:
        if n in L:
            parts.append(f"{n} AS ({L[n][1]}\n)")
        else:
            deps, text = FIXTURES[n]
            parts.append(f"{n} AS ({text.format(**{d: d for d in deps})}\n)")
    head = ("WITH " + ",\n".join(parts) + "\n") if parts else ""
    return head + final
