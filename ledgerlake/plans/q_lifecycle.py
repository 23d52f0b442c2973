"""Registered queries of validation, lifecycle and ledger.

Requests are the payment events (``fx_payment_events``, one per event). Capture requests
cover every payment plus the orphan ids of the settlement file; refund requests are the
settlement rows (a settled amount above the payment amount is an over-refund).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import functions as F

from .. import constants as K
from ..functions import validation
from ..operators import lifecycle as lc
from ..operators.usage import rows_with_key
from ..sources.typed import to_payment_transactions
from .oracle_sql import AS_OF_SQL, sql_with
from .registry import register

LOOKUP_PAYMENT = "PAY_000003001"

_CUR = ", ".join(f"'{c}'" for c in K.VALID_CURRENCIES)
_METH = ", ".join(f"'{m}'" for m in K.PAYMENT_METHODS)
V_AMOUNT = "COALESCE(CAST(amount AS DECIMAL(18,2)) BETWEEN 0.01 AND 999999.99, false)"
V_CURRENCY = f"COALESCE(upper(currency) IN ({_CUR}), false)"
V_METHOD = f"COALESCE(lower(payment_method) IN ({_METH}), false)"
V_IDS = "COALESCE(length(merchant_id) > 0 AND length(customer_id) > 0, false)"
V_ERROR = (f"CASE WHEN NOT {V_AMOUNT} THEN 'Invalid amount' WHEN NOT {V_CURRENCY} THEN 'Invalid currency' "
           f"WHEN NOT {V_METHOD} THEN 'Invalid payment method' "
           f"WHEN NOT {V_IDS} THEN 'Invalid merchant or customer ID' END")


def stable_id_sql(*parts: str) -> str:
    return f"substr(sha256(concat_ws(':', {', '.join(parts)})), 1, 32)"


class Lifecycle:
    def __init__(self, ctx):
        self.ctx = ctx
        self.events = ctx.fx("fx_payment_events")

    @cached_property
    def requests(self):
        return self.events.select(F.col("transaction_id").alias("request_id"), "amount", "currency", "payment_method",
                                  "merchant_id", "customer_id", "event_ts")

    @cached_property
    def payments(self):
        return self.events.select(F.col("transaction_id").alias("payment_id"), "status", "amount", "currency")

    @cached_property
    def orphans(self):
        return self.ctx.fx("fx_settlement").filter(F.col("transaction_id").startswith("PAY_X")) \
                   .select(F.col("transaction_id").alias("payment_id"))

    @cached_property
    def ledger(self):
        charges = lc.ledger_create(self.payments, "charge", self.ctx.as_of)
        refunds = lc.ledger_create(self.payments.filter(F.col("status") == "refunded"), "refund", self.ctx.as_of)
        return charges.unionByName(refunds)

    @cached_property
    def updates(self):
        status = F.col("status")
        new_status = (F.when(status == "captured", "completed").when(status.isin("failed", "declined"), "failed")
                      .otherwise("processing"))
        err = F.when(status == "failed", F.lit("card declined")).when(status == "declined", F.lit(""))
        known = self.payments.select(lc.stable_id("payment_id", F.lit("charge")).alias("id"),
                                     new_status.alias("status"), err.alias("error_message"), F.lit(1).alias("seq"))
        unknown = self.orphans.select(lc.stable_id("payment_id", F.lit("charge")).alias("id"),
                                      F.lit("completed").alias("status"), F.lit(None).cast("string").alias("error_message"),
                                      F.lit(1).alias("seq"))
        return known.unionByName(unknown)

    @cached_property
    def updated(self):
        return lc.ledger_update_status(self.ledger, self.updates, self.ctx.as_of)


def life(ctx) -> Lifecycle:
    if "_life" not in ctx._memo:
        ctx._memo["_life"] = Lifecycle(ctx)
    return ctx._memo["_life"]


L_LAYERS = {
    "l_req": (["fx_payment_events"], """SELECT transaction_id AS request_id, amount, currency, payment_method,
       merchant_id, customer_id, event_ts FROM fx_payment_events"""),
    "l_pay": (["fx_payment_events"], "SELECT transaction_id AS payment_id, status, amount, currency FROM fx_payment_events"),
    "l_orphans": (["fx_settlement"], "SELECT transaction_id AS payment_id FROM fx_settlement WHERE transaction_id LIKE 'PAY_X%'"),
    "l_ledger": (["l_pay"], f"""
SELECT {stable_id_sql('payment_id', "'charge'")} AS id, payment_id, 'charge' AS type, 'initiated' AS status, amount,
       currency, {AS_OF_SQL} AS created_at, {AS_OF_SQL} AS updated_at, CAST(NULL AS VARCHAR) AS error_message FROM l_pay
UNION ALL
SELECT {stable_id_sql('payment_id', "'refund'")}, payment_id, 'refund', 'initiated', amount, currency, {AS_OF_SQL},
       {AS_OF_SQL}, CAST(NULL AS VARCHAR) FROM l_pay WHERE status = 'refunded'"""),
    "l_updates": (["l_pay", "l_orphans"], f"""
SELECT {stable_id_sql('payment_id', "'charge'")} AS id,
       CASE WHEN status = 'captured' THEN 'completed' WHEN status IN ('failed', 'declined') THEN 'failed'
            ELSE 'processing' END AS status,
       CASE WHEN status = 'failed' THEN 'card declined' WHEN status = 'declined' THEN '' END AS error_message
FROM l_pay
UNION ALL SELECT {stable_id_sql('payment_id', "'charge'")}, 'completed', NULL FROM l_orphans"""),
    "l_updated": (["l_ledger", "l_updates"], f"""
SELECT l.id, l.payment_id, l.type, COALESCE(u.status, l.status) AS status, l.amount, l.currency, l.created_at,
       CASE WHEN u.id IS NOT NULL THEN {AS_OF_SQL} ELSE l.updated_at END AS updated_at,
       COALESCE(CASE WHEN length(u.error_message) > 0 THEN u.error_message END, l.error_message) AS error_message
FROM l_ledger l LEFT JOIN l_updates u ON l.id = u.id"""),
}


def lsql(names, final):
    return sql_with(names, final, extra=L_LAYERS)


@register("validate_amount", lsql(["l_req"], f"SELECT request_id, amount, {V_AMOUNT} AS amount_valid FROM l_req"))
def _v_amount(ctx):
    return life(ctx).requests.select("request_id", "amount", validation.validate_amount("amount").alias("amount_valid"))


@register("validate_currency", lsql(["l_req"], f"SELECT request_id, currency, {V_CURRENCY} AS currency_valid FROM l_req"))
def _v_currency(ctx):
    return life(ctx).requests.select("request_id", "currency",
                                     validation.validate_currency("currency").alias("currency_valid"))


@register("validate_method", lsql(["l_req"], f"SELECT request_id, payment_method, {V_METHOD} AS method_valid FROM l_req"))
def _v_method(ctx):
    return life(ctx).requests.select("request_id", "payment_method",
                                     validation.validate_method("payment_method").alias("method_valid"))


@register("validate_ids", lsql(["l_req"], f"SELECT request_id, {V_IDS} AS ids_valid FROM l_req"))
def _v_ids(ctx):
    return life(ctx).requests.select("request_id",
                                     validation.validate_ids("merchant_id", "customer_id").alias("ids_valid"))


@register("validate_payment", lsql(["l_req"], f"SELECT request_id, {V_ERROR} AS error FROM l_req"))
def _v_payment(ctx):
    valid, rejected = lc.validate_payment(life(ctx).requests)
    return (valid.select("request_id", F.lit(None).cast("string").alias("error"))
            .unionByName(rejected.select("request_id", "error")))


@register("check_payment_record", sql_with(["fx_payments_raw"], """
SELECT payment_id, TRY_CAST(amount AS DECIMAL(18,2)) AS amount, currency,
       COALESCE(TRY_CAST(amount AS DECIMAL(18,2)) > 0 AND length(currency) = 3, false) AS record_ok
FROM fx_payments_raw"""))
def _check_payment(ctx):
    t = to_payment_transactions(ctx.fx("fx_payments_raw"))
    return t.select("payment_id", "amount", "currency",
                    validation.payment_record_ok("amount", "currency").alias("record_ok"))


@register("check_transaction_record", lsql(["l_ledger"], """
SELECT id, amount, COALESCE(amount > 0, false) AS record_ok FROM l_ledger"""))
def _check_txn(ctx):
    return life(ctx).ledger.select("id", "amount", validation.transaction_record_ok("amount").alias("record_ok"))


@register("check_signal_record", sql_with(["fx_fraud_signals_raw", "fx_payment_events"], """
SELECT s.signal_id, TRY_CAST(s.risk_score AS DECIMAL(3,2)) AS risk_score, e.amount,
       COALESCE(TRY_CAST(s.risk_score AS DECIMAL(3,2)) BETWEEN 0 AND 1 AND e.amount >= 0, false) AS record_ok
FROM fx_fraud_signals_raw s LEFT JOIN fx_payment_events e ON s.transaction_id = e.transaction_id"""))
def _check_signal(ctx):
    s = ctx.fx("fx_fraud_signals_raw").select("signal_id", "transaction_id",
                                              F.col("risk_score").try_cast("decimal(3,2)").alias("risk_score"))
    e = life(ctx).events.select("transaction_id", "amount")
    return s.join(e, on="transaction_id", how="left").select(
        "signal_id", "risk_score", "amount", validation.signal_record_ok("risk_score", "amount").alias("record_ok"))


@register("capture_batch", lsql(["l_pay", "l_orphans"], f"""
SELECT r.payment_id, p.status AS old_status,
       CASE WHEN p.status = 'authorized' THEN 'captured' ELSE p.status END AS new_status,
       CASE WHEN p.status = 'authorized' THEN {AS_OF_SQL} END AS updated_at,
       CASE WHEN p.status IS NULL THEN 'Payment not found'
            WHEN p.status <> 'authorized' THEN 'Cannot capture payment with status: ' || p.status END AS error
FROM (SELECT DISTINCT payment_id FROM (SELECT payment_id FROM l_pay UNION ALL SELECT payment_id FROM l_orphans) x) r
LEFT JOIN l_pay p ON r.payment_id = p.payment_id"""))
def _capture(ctx):
    lf = life(ctx)
    req = lf.payments.select("payment_id").unionByName(lf.orphans)
    return lc.capture_batch(lf.payments, req, ctx.as_of)


@register("refund_batch", lsql(["l_pay", "fx_settlement"], f"""
SELECT r.payment_id, r.refund_amount, p.status AS old_status,
       CASE WHEN err IS NULL THEN 'refunded' ELSE p.status END AS new_status,
       CASE WHEN err IS NULL THEN {AS_OF_SQL} END AS updated_at, err AS error
FROM (SELECT r.*, p.status,
             CASE WHEN p.status IS NULL THEN 'Payment not found'
                  WHEN p.status <> 'captured' THEN 'Cannot refund payment with status: ' || p.status
                  WHEN COALESCE(r.refund_amount <> 0, false) AND r.refund_amount > p.amount
                       THEN 'Refund amount exceeds payment amount' END AS err
      FROM (SELECT transaction_id AS payment_id, amount AS refund_amount FROM fx_settlement) r
      LEFT JOIN l_pay p ON r.payment_id = p.payment_id) r
LEFT JOIN l_pay p ON r.payment_id = p.payment_id"""))
def _refund(ctx):
    lf = life(ctx)
    req = ctx.fx("fx_settlement").select(F.col("transaction_id").alias("payment_id"),
                                         F.col("amount").alias("refund_amount"))
    return lc.refund_batch(lf.payments, req, ctx.as_of)


@register("ledger_create", lsql(["l_ledger"], "SELECT * FROM l_ledger"))
def _ledger_create(ctx):
    return life(ctx).ledger


@register("ledger_update_status", lsql(["l_updated"], "SELECT * FROM l_updated"))
def _ledger_update(ctx):
    return life(ctx).updated[0]


@register("ledger_update_errors", lsql(["l_updates", "l_ledger"], """
SELECT DISTINCT u.id, 'Transaction not found: ' || u.id AS error FROM l_updates u
WHERE NOT EXISTS (SELECT 1 FROM l_ledger l WHERE l.id = u.id)"""))
def _ledger_errors(ctx):
    return life(ctx).updated[1]


@register("transactions_for_payment", lsql(["l_updated"], f"SELECT * FROM l_updated WHERE payment_id = '{LOOKUP_PAYMENT}'"))
def _txn_for_payment(ctx):
    return rows_with_key(life(ctx).updated[0], "payment_id", LOOKUP_PAYMENT)


@register("transaction_by_id", lsql(["l_updated"], f"""
SELECT * FROM l_updated WHERE id = {stable_id_sql(f"'{LOOKUP_PAYMENT}'", "'charge'")}"""))
def _txn_by_id(ctx):
    ledger = life(ctx).updated[0]
    target = ctx.spark.range(1).select(lc.stable_id(F.lit(LOOKUP_PAYMENT), F.lit("charge")).alias("id"))
    return ledger.join(target, on="id", how="left_semi")


P_LAYERS = dict(L_LAYERS)
P_LAYERS.update({
    "p_v": (["l_req"], f"SELECT *, {V_ERROR} AS error FROM l_req"),
    "p_ok": (["p_v"], "SELECT * FROM p_v WHERE error IS NULL"),
    "p_sc": (["p_ok"], """SELECT ok.*, (SELECT COUNT(*) FROM p_ok o2 WHERE o2.customer_id = ok.customer_id
                       AND o2.event_ts >= ok.event_ts - INTERVAL 60 MINUTE
                       AND (o2.event_ts < ok.event_ts OR (o2.event_ts = ok.event_ts AND o2.request_id < ok.request_id)))
                     AS prior_count FROM p_ok ok"""),
    "p_rs": (["p_sc"], """SELECT *, CAST(0.10 + CASE WHEN COALESCE(amount > 10000.00, false) THEN 0.30 ELSE 0 END
                      + CASE WHEN COALESCE(prior_count >= 5, false) THEN 0.20 ELSE 0 END AS DECIMAL(4,2)) AS raw_score,
              list_filter([CASE WHEN COALESCE(amount > 10000.00, false) THEN 'amount_anomaly' END,
                           CASE WHEN COALESCE(prior_count >= 5, false) THEN 'velocity_exceeded' END],
                          lambda x: x IS NOT NULL) AS alerts FROM p_sc"""),
    "p_lv": (["p_rs"], """SELECT *, CASE WHEN raw_score >= 0.75 THEN 'critical' WHEN raw_score >= 0.5 THEN 'high'
                      WHEN raw_score >= 0.25 THEN 'medium' ELSE 'low' END AS risk_level FROM p_rs"""),
    "p_dc": (["p_lv"], """SELECT *, CASE WHEN risk_level = 'critical' THEN 'block'
                      WHEN risk_level = 'high' AND (list_contains(alerts, 'bin_blacklist')
                           OR list_contains(alerts, 'velocity_by_ip')) THEN 'decline'
                      WHEN risk_level = 'high' THEN 'review' WHEN risk_level = 'medium' THEN 'challenge'
                      ELSE 'approve' END AS decision FROM p_lv"""),
})


@register("process_payments_batch", sql_with(["p_dc", "p_v"], f"""
SELECT request_id, decision NOT IN ('decline', 'block') AS success,
       CASE WHEN decision IN ('decline', 'block') THEN 'Transaction declined due to fraud risk' END AS error,
       {stable_id_sql('request_id')} AS payment_id,
       CASE WHEN decision IN ('decline', 'block') THEN 'authorized' ELSE 'captured' END AS status, amount, currency,
       CAST(LEAST(raw_score, 1.00) AS DECIMAL(3,2)) AS risk_score, risk_level, decision, alerts
FROM p_dc
UNION ALL
SELECT request_id, false, error, NULL, NULL, amount, currency, NULL, NULL, NULL, NULL FROM p_v WHERE error IS NOT NULL""",
                                             extra=P_LAYERS))
def _process_batch(ctx):
    return lc.process_payments_batch(life(ctx).requests, ctx.as_of)
