"""Registered queries of the full-refresh medallion pipeline."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from .. import schemas
from ..functions import casts, normalize, risk
from ..operators import gold, joins, silver, usage
from ..operators.daily_state import DailyState
from ..session import scratch_path
from ..sinks.tables import write_table
from ..sources import tables as readers
from ..sources.typed import enforce_schema, to_fraud_signals_typed, to_payment_transactions
from .oracle_sql import (AS_OF_SQL, RISK_CLASS_B_SQL, RISK_LEVEL_SQL, case_map, method_case, sql_with,
                         status_case, upper_map)
from .registry import register

CUTOFF_SQL = f"({AS_OF_SQL} - INTERVAL 90 DAY)"

# ---------------------------------------------------------------------------
# 2.1 sources
# ---------------------------------------------------------------------------


@register("src_payments_raw", sql_with(["fx_payments_raw"], "SELECT * FROM fx_payments_raw"))
def _src_payments_raw(ctx):
    return enforce_schema(ctx.fx("fx_payments_raw"), schemas.PAYMENTS_RAW)


@register("src_fraud_signals_raw", sql_with(["fx_fraud_signals_raw"], "SELECT * FROM fx_fraud_signals_raw"))
def _src_fraud_raw(ctx):
    return enforce_schema(ctx.fx("fx_fraud_signals_raw"), schemas.FRAUD_SIGNALS_RAW)


PAYMENTS_TYPED_SQL = """SELECT payment_id, merchant_id, customer_id, TRY_CAST(amount AS DECIMAL(18,2)) AS amount,
       currency, payment_method, status, TRY_CAST(created_at AS TIMESTAMP) AS created_at,
       TRY_CAST(updated_at AS TIMESTAMP) AS updated_at, metadata FROM fx_payments_raw"""
FRAUD_TYPED_SQL = """SELECT signal_id, transaction_id, TRY_CAST(risk_score AS DECIMAL(5,3)) AS risk_score,
       risk_level AS classification, upper(risk_level) AS alert_level, decision AS case_decision,
       TRY_CAST(created_at AS TIMESTAMP) AS created_at FROM fx_fraud_signals_raw"""


@register("src_payments_typed", sql_with(["fx_payments_raw"], PAYMENTS_TYPED_SQL))
def _src_payments_typed(ctx):
    """The typed landing, written and read back by its declared-schema reader."""
    path = write_table(to_payment_transactions(ctx.fx("fx_payments_raw")), scratch_path(ctx.spark, "payment-transactions"))
    return readers.read_payment_transactions(ctx.spark, path)


@register("src_fraud_typed", sql_with(["fx_fraud_signals_raw"], FRAUD_TYPED_SQL))
def _src_fraud_typed(ctx):
    path = write_table(to_fraud_signals_typed(ctx.fx("fx_fraud_signals_raw")), scratch_path(ctx.spark, "fraud-signals"))
    return readers.read_fraud_signals(ctx.spark, path)


@register("src_file_metadata", "SELECT event_id, 'events.parquet' AS file_name, true AS has_modification_time FROM events")
def _src_file_metadata(ctx):
    events = ctx.spark.read.parquet(f"{ctx.sf_dir}/events.parquet")
    return silver.with_file_metadata(events).select(
        "event_id", F.element_at(F.split("file_path", "/"), -1).alias("file_name"),
        F.col("file_modification_time").isNotNull().alias("has_modification_time"))


# ---------------------------------------------------------------------------
# 2.2 projections, casts, filters
# ---------------------------------------------------------------------------

@register("clean_payments", sql_with(["payments_cleaned"], "SELECT * FROM payments_cleaned"))
def _clean_payments(ctx):
    return ctx.med.payments_cleaned


@register("clean_payments_rejects", sql_with(["pc_parsed"], f"""
SELECT payment_id, raw_amount AS amount, raw_created AS created_at, raw_updated AS updated_at,
       CASE WHEN raw_amount IS NOT NULL AND amount IS NULL THEN 'amount'
            WHEN raw_created IS NOT NULL AND payment_created_at IS NULL THEN 'created_at'
            ELSE 'updated_at' END AS reject_reason
FROM pc_parsed
WHERE ((raw_amount IS NOT NULL AND amount IS NULL) OR (raw_created IS NOT NULL AND payment_created_at IS NULL)
       OR (raw_updated IS NOT NULL AND payment_updated_at IS NULL))
  AND NOT COALESCE(payment_created_at < {CUTOFF_SQL}, false)"""))
def _clean_payments_rejects(ctx):
    return silver.clean_payments_rejects(ctx.fx("fx_payments_raw"), ctx.as_of, ctx.days)


@register("clean_fraud_signals", sql_with(["fraud_signals_cleaned"], "SELECT * FROM fraud_signals_cleaned"))
def _clean_fraud(ctx):
    return ctx.med.fraud_signals_cleaned


@register("cast_money", sql_with(["fx_payments_raw"], """
SELECT payment_id, amount AS amount_text, TRY_CAST(amount AS DECIMAL(18,2)) AS amount FROM fx_payments_raw"""))
def _cast_money(ctx):
    r = ctx.fx("fx_payments_raw")
    return r.select("payment_id", F.col("amount").alias("amount_text"), casts.cast_money("amount").alias("amount"))


@register("cast_score", sql_with(["fx_fraud_signals_raw"], """
SELECT signal_id, risk_score AS score_text, TRY_CAST(risk_score AS DECIMAL(3,2)) AS risk_score FROM fx_fraud_signals_raw"""))
def _cast_score(ctx):
    r = ctx.fx("fx_fraud_signals_raw")
    return r.select("signal_id", F.col("risk_score").alias("score_text"), casts.cast_score("risk_score").alias("risk_score"))


@register("cast_timestamp", sql_with(["fx_payments_raw"], """
SELECT payment_id, created_at AS created_text, TRY_CAST(created_at AS TIMESTAMP) AS created_at FROM fx_payments_raw"""))
def _cast_timestamp(ctx):
    r = ctx.fx("fx_payments_raw")
    return r.select("payment_id", F.col("created_at").alias("created_text"),
                    casts.cast_timestamp("created_at").alias("created_at"))


@register("retention_filter", sql_with(["fx_payments_raw"], f"""
SELECT payment_id, created_at FROM ({PAYMENTS_TYPED_SQL}) t WHERE created_at >= {CUTOFF_SQL}"""))
def _retention(ctx):
    typed = to_payment_transactions(ctx.fx("fx_payments_raw"))
    return silver.retention_filter(typed, "created_at", ctx.as_of, ctx.days).select("payment_id", "created_at")


@register("filter_not_null", sql_with(["transactions_fact"], """
SELECT transaction_id, payment_method FROM transactions_fact WHERE payment_method IS NOT NULL"""))
def _filter_not_null(ctx):
    return ctx.med.transactions_fact.filter(F.col("payment_method").isNotNull()).select("transaction_id", "payment_method")


@register("filter_high_block_rate", sql_with(["metric_fraud_analytics"], """
SELECT * FROM metric_fraud_analytics WHERE fraud_block_rate_pct > 1.0 ORDER BY fraud_block_rate_pct DESC, merchant_id"""))
def _high_block(ctx):
    return usage.filter_high_block_rate(ctx.med.metric_fraud_analytics, 1.0)


@register("filter_recent_days", sql_with(["metric_daily_payment_summary"], f"""
SELECT * FROM metric_daily_payment_summary WHERE calendar_date >= CAST({AS_OF_SQL} AS DATE) - 7
ORDER BY calendar_date DESC"""))
def _recent_days(ctx):
    return usage.recent_daily_summary(ctx.med.dim_date, ctx.med.fact_transactions, ctx.as_of, 7)


@register("filter_risky_customers", sql_with(["metric_customer_risk_profile"], """
SELECT * FROM metric_customer_risk_profile WHERE risk_classification IN ('HIGH_RISK', 'VERY_HIGH_RISK')
ORDER BY transaction_count DESC, customer_id"""))
def _risky_customers(ctx):
    return usage.filter_risky_customers(ctx.med.metric_customer_risk_profile)


@register("signals_for_transaction", sql_with(["fraud_signals_cleaned"], """
SELECT * FROM fraud_signals_cleaned WHERE transaction_id = 'PAY_000003001'"""))
def _signals_for_txn(ctx):
    return usage.rows_with_key(ctx.med.fraud_signals_cleaned, "transaction_id", "PAY_000003001")


# ---------------------------------------------------------------------------
# 2.3 conditional normalisation
# ---------------------------------------------------------------------------

@register("normalize_payment_method", sql_with(["fx_payments_raw"], f"""
SELECT payment_id, payment_method, {method_case('payment_method')} AS method_exact,
       {method_case('lower(payment_method)')} AS method_ignore_case FROM fx_payments_raw"""))
def _norm_method(ctx):
    r = ctx.fx("fx_payments_raw")
    return r.select("payment_id", "payment_method",
                    normalize.normalize_payment_method("payment_method").alias("method_exact"),
                    normalize.normalize_payment_method("payment_method", ignore_case=True).alias("method_ignore_case"))


@register("normalize_status", sql_with(["fx_payments_raw"], f"""
SELECT payment_id, status, {status_case('status')} AS status_exact,
       {status_case('lower(status)')} AS status_ignore_case FROM fx_payments_raw"""))
def _norm_status(ctx):
    r = ctx.fx("fx_payments_raw")
    return r.select("payment_id", "status", normalize.normalize_status("status").alias("status_exact"),
                    normalize.normalize_status("status", ignore_case=True).alias("status_ignore_case"))


@register("normalize_decision", sql_with(["fx_fraud_signals_raw"], f"""
SELECT signal_id, decision, {case_map('decision', K.DECISION_MAP, 'UNKNOWN')} AS decision_normalized
FROM fx_fraud_signals_raw"""))
def _norm_decision(ctx):
    r = ctx.fx("fx_fraud_signals_raw")
    return r.select("signal_id", "decision", normalize.normalize_decision("decision").alias("decision_normalized"))


@register("normalize_case_status", sql_with(["fx_fraud_signals_raw"], f"""
SELECT signal_id, case_status, {case_map('case_status', upper_map(K.CASE_STATUSES), 'UNKNOWN')} AS case_status_normalized
FROM fx_fraud_signals_raw"""))
def _norm_case(ctx):
    r = ctx.fx("fx_fraud_signals_raw")
    return r.select("signal_id", "case_status", normalize.normalize_case_status("case_status").alias("case_status_normalized"))


@register("derive_risk_level", sql_with(["fx_fraud_signals_raw"], f"""
SELECT signal_id, risk_score, {RISK_LEVEL_SQL.format(s='TRY_CAST(risk_score AS DOUBLE)')} AS risk_level_derived
FROM fx_fraud_signals_raw"""))
def _derive_level(ctx):
    r = ctx.fx("fx_fraud_signals_raw")
    return r.select("signal_id", "risk_score",
                    risk.derive_risk_level(F.col("risk_score").try_cast("double")).alias("risk_level_derived"))


@register("derive_risk_class_b", sql_with(["fx_fraud_signals_raw"], f"""
SELECT signal_id, TRY_CAST(risk_score AS DECIMAL(5,3)) AS risk_score,
       {RISK_CLASS_B_SQL.format(s='TRY_CAST(risk_score AS DECIMAL(5,3))')} AS classification
FROM fx_fraud_signals_raw"""))
def _derive_class_b(ctx):
    typed = to_fraud_signals_typed(ctx.fx("fx_fraud_signals_raw"))
    return typed.select("signal_id", "risk_score", risk.derive_risk_class_b("risk_score").alias("classification"))


@register("overall_risk_category", sql_with(["payments_with_fraud"], """
SELECT payment_id, f_decision AS decision, f_score AS signal_score, overall_risk_category FROM payments_with_fraud"""))
def _overall(ctx):
    pwf = ctx.med.payments_cleaned.alias("p").join(
        ctx.med.fraud_signals_cleaned.alias("f"), F.col("p.payment_id") == F.col("f.transaction_id"), "left")
    return pwf.select(F.col("p.payment_id"), F.col("f.decision_normalized").alias("decision"),
                      F.col("f.risk_score").alias("signal_score"),
                      risk.overall_risk_category(F.col("f.decision_normalized"), F.col("f.risk_score"))
                      .alias("overall_risk_category"))


@register("customer_risk_class", sql_with(["metric_customer_risk_profile"], """
SELECT customer_id, avg_risk_score, risk_classification FROM metric_customer_risk_profile"""))
def _customer_class(ctx):
    return ctx.med.metric_customer_risk_profile.select("customer_id", "avg_risk_score", "risk_classification")


@register("method_name", sql_with(["dim_payment_method"], "SELECT payment_method, method_name FROM dim_payment_method"))
def _method_name(ctx):
    return ctx.med.dim_payment_method.select("payment_method", "method_name")


@register("method_category", sql_with(["dim_payment_method"],
                                      "SELECT payment_method, method_category FROM dim_payment_method"))
def _method_category(ctx):
    return ctx.med.dim_payment_method.select("payment_method", "method_category")


@register("amount_buckets", sql_with(["fact_transactions"], """
SELECT transaction_id, captured_amount, refunded_amount, failed_amount, fraud_blocked_amount FROM fact_transactions"""))
def _amount_buckets(ctx):
    return gold.amount_buckets(ctx.med.transactions_fact).select(
        "transaction_id", "captured_amount", "refunded_amount", "failed_amount", "fraud_blocked_amount")


@register("default_fill", sql_with(["payments_with_fraud"], """
SELECT payment_id, risk_score, fraud_risk_level, fraud_decision, latest_event_at FROM payments_with_fraud"""))
def _default_fill(ctx):
    return ctx.med.payments_with_fraud.select("payment_id", "risk_score", "fraud_risk_level", "fraud_decision",
                                              "latest_event_at")


@register("entity_name", sql_with(["transactions_fact"], """
SELECT DISTINCT merchant_id,
       CASE WHEN length(merchant_id) > 0 THEN 'Merchant_' || merchant_id ELSE 'Unknown' END AS name_full_refresh,
       'Merchant ' || merchant_id AS name_incremental
FROM transactions_fact"""))
def _entity_name(ctx):
    m = ctx.med.transactions_fact.select("merchant_id").distinct()
    return m.select("merchant_id", normalize.entity_name("merchant_id", "Merchant_").alias("name_full_refresh"),
                    normalize.entity_name("merchant_id", "Merchant ", require_non_empty=False).alias("name_incremental"))


@register("format_currency", sql_with(["payments_cleaned"], f"""
SELECT payment_id, amount, currency,
       COALESCE({case_map('currency', K.CURRENCY_SYMBOLS, None)}, currency) || printf('%.2f', CAST(amount AS DOUBLE)) AS amount_display
FROM payments_cleaned"""))
def _format_currency(ctx):
    p = ctx.med.payments_cleaned
    return p.select("payment_id", "amount", "currency",
                    normalize.format_currency("amount", "currency").alias("amount_display"))


# ---------------------------------------------------------------------------
# 2.5 joins
# ---------------------------------------------------------------------------

PWF_COLS = ("payment_id, merchant_id, customer_id, amount, currency, payment_method, status, risk_score, "
            "fraud_risk_level, fraud_decision, fraud_alerts, overall_risk_category, payment_created_at, "
            "payment_updated_at, latest_event_at")


@register("join_payment_fraud", sql_with(["payments_with_fraud"], f"SELECT {PWF_COLS} FROM payments_with_fraud"))
def _join_pf(ctx):
    return ctx.med.payments_with_fraud


@register("join_calendar_fact", sql_with(["dim_date", "fact_transactions"], """
SELECT d.date_key, d.calendar_date, f.transaction_id, f.transaction_amount
FROM dim_date d LEFT JOIN fact_transactions f ON d.date_key = f.date_key"""))
def _join_calendar(ctx):
    cal = ctx.med.dim_date.select("date_key", "calendar_date")
    fact = ctx.med.fact_transactions.select("date_key", "transaction_id", "transaction_amount")
    return joins.join_calendar_fact(cal, fact).select("date_key", "calendar_date", "transaction_id",
                                                      "transaction_amount")


@register("join_merchant_dim", sql_with(["fact_transactions", "dim_merchant"], """
SELECT f.transaction_id, f.merchant_id, dm.merchant_name, dm.total_transactions AS merchant_transactions
FROM fact_transactions f LEFT JOIN dim_merchant dm ON f.merchant_id = dm.merchant_id"""))
def _join_merchant(ctx):
    dim = ctx.med.dim_merchant.withColumnRenamed("total_transactions", "merchant_transactions")
    return joins.join_dimension(ctx.med.fact_transactions.select("transaction_id", "merchant_id"), dim,
                                "merchant_id", ["merchant_name", "merchant_transactions"])


@register("join_customer_dim", sql_with(["fact_transactions", "dim_customer"], """
SELECT f.transaction_id, f.customer_id, dc.customer_name, dc.avg_risk_score AS customer_avg_risk
FROM fact_transactions f LEFT JOIN dim_customer dc ON f.customer_id = dc.customer_id"""))
def _join_customer(ctx):
    dim = ctx.med.dim_customer.withColumnRenamed("avg_risk_score", "customer_avg_risk")
    return joins.join_dimension(ctx.med.fact_transactions.select("transaction_id", "customer_id"), dim,
                                "customer_id", ["customer_name", "customer_avg_risk"])


@register("semi_allowed_users", sql_with(["payments_cleaned"], """
SELECT * FROM payments_cleaned
WHERE customer_id IN (SELECT 'C' || CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment = 'BUILDING')"""))
def _semi_allowed(ctx):
    allowed = (ctx.fx("customer").filter(F.col("c_mktsegment") == "BUILDING")
               .select(F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("customer_id")))
    return joins.semi_allowed(ctx.med.payments_cleaned, allowed, "customer_id")


# ---------------------------------------------------------------------------
# 2.6 aggregations / dimensions, 2.9 generation
# ---------------------------------------------------------------------------

@register("metric_daily_payment_summary", sql_with(["metric_daily_payment_summary"],
                                                   "SELECT * FROM metric_daily_payment_summary"))
def _daily(ctx):
    return ctx.med.metric_daily_payment_summary


@register("metric_daily_incremental", sql_with(["metric_daily_payment_summary"],
                                               "SELECT * FROM metric_daily_payment_summary"))
def _daily_incremental(ctx):
    """The same summary from state: two batches, then a late one for days of both, delivered twice."""
    state = DailyState(ctx.spark, scratch_path(ctx.spark, "daily-state"))
    fact = ctx.med.fact_transactions
    number = F.pmod(F.xxhash64("transaction_id"), F.lit(10))
    half = F.col("date_key") < "20240301"
    for batch, rows in enumerate([fact.filter(half & (number < 7)), fact.filter(~half & (number < 7)), fact.filter(number >= 7), fact.filter(number >= 7)]):
        state.add(rows, min(batch, 2))
    return state.summary(ctx.med.dim_date)


@register("metric_fraud_analytics", sql_with(["metric_fraud_analytics"], "SELECT * FROM metric_fraud_analytics"))
def _fraud_metric(ctx):
    return ctx.med.metric_fraud_analytics


@register("metric_customer_risk_profile", sql_with(["metric_customer_risk_profile"],
                                                   "SELECT * FROM metric_customer_risk_profile"))
def _customer_profile(ctx):
    return ctx.med.metric_customer_risk_profile


@register("pct_rate", sql_with(["fact_transactions"], """
SELECT merchant_id, CAST(COUNT(CASE WHEN payment_status = 'CAPTURED' THEN 1 END) AS DOUBLE)
                          / NULLIF(COUNT(*), 0) * 100 AS capture_rate_pct
FROM fact_transactions GROUP BY merchant_id"""))
def _pct_rate(ctx):
    f = ctx.med.fact_transactions
    return f.groupBy("merchant_id").agg(risk.pct_rate(
        gold.count_when(F.col("payment_status") == "CAPTURED"), F.count(F.lit(1))).alias("capture_rate_pct"))


@register("dim_merchant", sql_with(["dim_merchant"], "SELECT * FROM dim_merchant"))
def _dim_merchant(ctx):
    return ctx.med.dim_merchant


@register("dim_customer", sql_with(["dim_customer"], "SELECT * FROM dim_customer"))
def _dim_customer(ctx):
    return ctx.med.dim_customer


@register("dim_payment_method", sql_with(["dim_payment_method"], "SELECT * FROM dim_payment_method"))
def _dim_method(ctx):
    return ctx.med.dim_payment_method


@register("dim_date", sql_with(["dim_date"], "SELECT * FROM dim_date"))
def _dim_date(ctx):
    return ctx.med.dim_date


@register("fact_transactions", sql_with(["fact_transactions"], "SELECT * FROM fact_transactions"))
def _fact(ctx):
    return ctx.med.fact_transactions


# ---------------------------------------------------------------------------
# 2.7 windows
# ---------------------------------------------------------------------------

@register("transactions_fact", sql_with(["transactions_fact"], "SELECT * FROM transactions_fact"))
def _txn_fact(ctx):
    return ctx.med.transactions_fact


@register("window_count", sql_with(["transactions_fact"], """
SELECT transaction_id, merchant_id, COUNT(*) OVER (PARTITION BY merchant_id) AS merchant_transactions
FROM transactions_fact"""))
def _window_count(ctx):
    from ..operators.windows import window_count
    return window_count(ctx.med.transactions_fact.select("transaction_id", "merchant_id"), "merchant_id",
                        "merchant_transactions")


@register("window_avg_max_sum", sql_with(["transactions_fact"], """
SELECT transaction_id, customer_id,
       CAST(SUM(risk_score) OVER (PARTITION BY customer_id) AS DOUBLE)
         / COUNT(risk_score) OVER (PARTITION BY customer_id) AS customer_avg_risk,
       MAX(risk_score) OVER (PARTITION BY customer_id) AS customer_max_risk,
       CAST(SUM(CASE WHEN fraud_decision = 'DECLINED' THEN 1 ELSE 0 END) OVER (PARTITION BY customer_id) AS BIGINT)
         AS customer_declines
FROM transactions_fact"""))
def _window_avg(ctx):
    from ..operators.windows import per_key_totals
    t = ctx.med.transactions_fact.select("transaction_id", "customer_id", "risk_score", "fraud_decision")
    out = per_key_totals(t, "customer_id", [
        gold.mean("risk_score").alias("customer_avg_risk"), F.max("risk_score").alias("customer_max_risk"),
        gold.count_when(F.col("fraud_decision") == "DECLINED").alias("customer_declines")])
    return out.drop("risk_score", "fraud_decision")


# ---------------------------------------------------------------------------
# 2.8 set operations, sort, limit, subqueries
# ---------------------------------------------------------------------------

@register("union_all", sql_with(["payments_cleaned", "fraud_signals_cleaned", "transactions_fact", "dim_merchant"], """
SELECT 'payments_cleaned' AS table_name, COUNT(*) AS row_count FROM payments_cleaned
UNION ALL SELECT 'fraud_signals_cleaned', COUNT(*) FROM fraud_signals_cleaned
UNION ALL SELECT 'transactions_fact', COUNT(*) FROM transactions_fact
UNION ALL SELECT 'dim_merchant', COUNT(*) FROM dim_merchant"""))
def _union_all(ctx):
    m = ctx.med
    parts = [("payments_cleaned", m.payments_cleaned), ("fraud_signals_cleaned", m.fraud_signals_cleaned),
             ("transactions_fact", m.transactions_fact), ("dim_merchant", m.dim_merchant)]
    out = None
    for n, df in parts:
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out


@register("top_n", sql_with(["metric_fraud_analytics"], """
SELECT merchant_id, merchant_name, total_volume FROM metric_fraud_analytics
ORDER BY total_volume DESC, merchant_id LIMIT 10"""))
def _top_n(ctx):
    return usage.top_n(ctx.med.metric_fraud_analytics.select("merchant_id", "merchant_name", "total_volume"),
                       [F.col("total_volume").desc(), "merchant_id"], 10)


@register("cte", sql_with(["dim_date"], "SELECT calendar_date FROM dim_date"))
def _cte(ctx):
    return ctx.med.dim_date.select("calendar_date")


@register("in_list", sql_with(["payments_with_fraud"], """
SELECT payment_id, fraud_decision FROM payments_with_fraud WHERE fraud_decision IN ('DECLINED', 'BLOCKED')"""))
def _in_list(ctx):
    return (ctx.med.payments_with_fraud.filter(F.col("fraud_decision").isin("DECLINED", "BLOCKED"))
            .select("payment_id", "fraud_decision"))


@register("in_subquery", sql_with(["payments_cleaned", "fraud_signals_cleaned"], """
SELECT payment_id, amount FROM payments_cleaned WHERE payment_id IN (SELECT transaction_id FROM fraud_signals_cleaned)"""))
def _in_subquery(ctx):
    return joins.semi_allowed(ctx.med.payments_cleaned, ctx.med.fraud_signals_cleaned, "payment_id",
                              "transaction_id").select("payment_id", "amount")


@register("scalar_subquery", sql_with(["payments_cleaned"], """
SELECT payment_id, amount FROM payments_cleaned
WHERE amount > (SELECT AVG(amount) FROM payments_cleaned)"""))
def _scalar_subquery(ctx):
    p = ctx.med.payments_cleaned
    avg_amount = p.select(F.avg("amount")).scalar()
    return p.filter(F.col("amount") > avg_amount).select("payment_id", "amount")


@register("derived_table", sql_with(["payments_cleaned"], """
SELECT status_normalized, COUNT(*) AS latest_versions
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY payment_id ORDER BY payment_updated_at DESC, payment_created_at DESC,
             amount DESC, merchant_id DESC, customer_id DESC, currency DESC, payment_method_normalized DESC,
             status_normalized DESC) AS rn FROM payments_cleaned) d
WHERE rn = 1 GROUP BY status_normalized"""))
def _derived(ctx):
    from ..operators.windows import latest_per_key
    latest = latest_per_key(ctx.med.payments_cleaned, ["payment_id"], silver.PAYMENT_ORDER)
    return latest.groupBy("status_normalized").agg(F.count(F.lit(1)).alias("latest_versions"))
