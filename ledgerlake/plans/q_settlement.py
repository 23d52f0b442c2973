"""Registered queries of pipeline C batch stages (SURVEY 2.2 canonicalize, 2.5 join_settlement,
2.6 distinct dims, 2.9 fact, 2.11 merge / reconcile / alerts).

Bronze payment events are the batch form of the stream: one event per row of
``fx_payment_events`` with its fraud score and tokenised card. The fact "before
settlement" carries the payment's own amount and the expected T+2 settlement date;
settlement rows come from ``fx_settlement``.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import functions as F

from ..operators import digests
from ..operators import settlement as st
from ..session import scratch_path
from .oracle_sql import sql_with
from .q_pci import token_key, token_sql
from .registry import register


class PipelineC:
    def __init__(self, ctx):
        self.ctx = ctx

    @cached_property
    def bronze(self):
        sig = self.ctx.fx("fx_fraud_signals_raw").select(
            "transaction_id", F.col("risk_score").try_cast("decimal(3,2)").alias("risk_score"))
        cards = self.ctx.fx("fx_cardholders").select(
            F.concat(F.lit("C"), F.substring("holder_id", 2, 1 << 20)).alias("customer_id"), "card_number")
        return st.bronze_events(self.ctx.fx("fx_payment_events"), sig, cards, token_key(self.ctx))

    @cached_property
    def transactions(self):
        return st.canonicalize_payments(self.bronze)

    @cached_property
    def settlement(self):
        return st.canonicalize_settlement(self.ctx.fx("fx_settlement").withColumn("ingestion_date",
                                                                                 F.col("settlement_date")))

    @cached_property
    def fact_before(self):
        b = self.bronze
        return b.select("transaction_id", "merchant_id", "payment_method", "event_ts", "status", "risk_score",
                        F.date_add(F.col("event_ts").cast("date"), 2).alias("settlement_date"), "amount",
                        F.lit(None).cast("decimal(18,2)").alias("fee"),
                        F.lit(None).cast("boolean").alias("chargeback_flag"))

    @cached_property
    def mismatches(self):
        return st.reconcile_mismatches(self.fact_before, self.settlement)


def pc(ctx) -> PipelineC:
    if "_pc" not in ctx._memo:
        ctx._memo["_pc"] = PipelineC(ctx)
    return ctx._memo["_pc"]


C_LAYERS = {
    "c_bronze": (["fx_payment_events", "fx_fraud_signals_raw", "fx_cardholders"], f"""
SELECT e.transaction_id, e.merchant_id, e.customer_id, e.payment_method, e.status, e.event_ts, e.amount,
       TRY_CAST(s.risk_score AS DECIMAL(3,2)) AS risk_score, {token_sql('h.card_number')} AS tokenized_pan,
       CAST(e.event_ts AS DATE) AS ingestion_date
FROM fx_payment_events e
LEFT JOIN fx_fraud_signals_raw s ON e.transaction_id = s.transaction_id
LEFT JOIN (SELECT 'C' || substr(holder_id, 2) AS customer_id, card_number FROM fx_cardholders) h
       ON e.customer_id = h.customer_id"""),
    "c_silver_tx": (["c_bronze"], """SELECT transaction_id, merchant_id, payment_method, event_ts, status, risk_score,
       tokenized_pan, ingestion_date FROM c_bronze"""),
    "c_silver_st": (["fx_settlement"], """SELECT settlement_id, transaction_id, settlement_date, amount, fee,
       chargeback_flag, settlement_date AS ingestion_date FROM fx_settlement"""),
    "c_fact_before": (["c_bronze"], """SELECT transaction_id, merchant_id, payment_method, event_ts, status, risk_score,
       CAST(event_ts AS DATE) + 2 AS settlement_date, amount, CAST(NULL AS DECIMAL(18,2)) AS fee,
       CAST(NULL AS BOOLEAN) AS chargeback_flag FROM c_bronze"""),
    "c_mismatch": (["c_fact_before", "c_silver_st"], """
SELECT f.transaction_id, f.amount AS fact_amount, s.amount AS settlement_amount, f.settlement_date,
       s.settlement_date AS settlement_file_date
FROM c_fact_before f LEFT JOIN c_silver_st s ON f.transaction_id = s.transaction_id
WHERE f.amount <> s.amount OR f.settlement_date <> s.settlement_date"""),
}


def csql(names, final):
    return sql_with(names, final, extra=C_LAYERS)


@register("canonicalize_payments", csql(["c_silver_tx"], "SELECT * FROM c_silver_tx"))
def _canon_pay(ctx):
    return pc(ctx).transactions


@register("canonicalize_settlement", csql(["c_silver_st"], "SELECT * FROM c_silver_st"))
def _canon_st(ctx):
    return pc(ctx).settlement


@register("fact_payment_transactions", csql(["c_silver_tx", "c_silver_st"], """
SELECT t.transaction_id, t.merchant_id, t.payment_method, t.event_ts, t.status, t.risk_score,
       s.settlement_date, s.amount, s.fee, s.chargeback_flag
FROM c_silver_tx t LEFT JOIN c_silver_st s ON t.transaction_id = s.transaction_id"""))
def _fact_c(ctx):
    return st.fact_payment_transactions(pc(ctx).transactions, pc(ctx).settlement)


@register("join_settlement", csql(["c_silver_tx", "c_silver_st"], """
SELECT t.transaction_id, s.settlement_id, s.amount, s.settlement_date
FROM c_silver_tx t LEFT JOIN c_silver_st s ON t.transaction_id = s.transaction_id"""))
def _join_st(ctx):
    s = pc(ctx).settlement.select("transaction_id", "settlement_id", "amount", "settlement_date")
    return pc(ctx).transactions.select("transaction_id").join(s, on="transaction_id", how="left")


@register("distinct_dims_c", csql(["c_silver_tx"], """
SELECT DISTINCT 'merchant_id' AS dimension, merchant_id AS value FROM c_silver_tx
UNION ALL SELECT DISTINCT 'payment_method', payment_method FROM c_silver_tx"""))
def _distinct_c(ctx):
    return st.distinct_values(pc(ctx).transactions, ["merchant_id", "payment_method"])


@register("merge_settlement", csql(["c_fact_before", "c_silver_st"], """
SELECT COALESCE(t.transaction_id, s.transaction_id) AS transaction_id, t.merchant_id, t.payment_method, t.event_ts,
       t.status, t.risk_score,
       CASE WHEN s.transaction_id IS NOT NULL THEN s.settlement_date ELSE t.settlement_date END AS settlement_date,
       CASE WHEN s.transaction_id IS NOT NULL THEN s.amount ELSE t.amount END AS amount,
       CASE WHEN s.transaction_id IS NOT NULL THEN s.fee ELSE t.fee END AS fee,
       CASE WHEN s.transaction_id IS NOT NULL THEN s.chargeback_flag ELSE t.chargeback_flag END AS chargeback_flag
FROM c_fact_before t FULL OUTER JOIN c_silver_st s ON t.transaction_id = s.transaction_id"""))
def _merge(ctx):
    return st.merge_settlement(pc(ctx).fact_before, pc(ctx).settlement)


@register("reconcile_mismatches", csql(["c_mismatch"], "SELECT * FROM c_mismatch"))
def _reconcile(ctx):
    return pc(ctx).mismatches


RECONCILE_SQL = csql(["c_fact_before", "c_silver_st"], """
SELECT COALESCE(f.transaction_id, s.transaction_id) AS transaction_id,
       CASE WHEN s.transaction_id IS NULL THEN 'MISSING_IN_SETTLEMENT'
            WHEN f.transaction_id IS NULL THEN 'MISSING_IN_FACT'
            WHEN f.amount IS DISTINCT FROM s.amount THEN 'AMOUNT_MISMATCH'
            ELSE 'DATE_MISMATCH' END AS issue,
       f.amount AS fact_amount, s.amount AS settlement_amount, f.settlement_date AS fact_date,
       s.settlement_date AS settlement_file_date
FROM c_fact_before f FULL OUTER JOIN c_silver_st s ON f.transaction_id = s.transaction_id
WHERE s.transaction_id IS NULL OR f.transaction_id IS NULL OR f.amount IS DISTINCT FROM s.amount
   OR f.settlement_date IS DISTINCT FROM s.settlement_date""")


@register("reconcile_full", RECONCILE_SQL)
def _reconcile_full(ctx):
    return st.reconcile_full(pc(ctx).fact_before, pc(ctx).settlement)


def _by_day(ctx):
    """Both sides of the reconciliation stored by settlement day."""
    if "_c_by_day" not in ctx._memo:
        sides = []
        for name, df in (("fact", pc(ctx).fact_before), ("settlement", pc(ctx).settlement)):
            rows = df.select("transaction_id", "amount", "settlement_date")
            path = scratch_path(ctx.spark, f"reconcile-{name}")
            rows.withColumn("day", F.col("settlement_date")).repartition("day").write.partitionBy("day").parquet(path)
            sides.append(ctx.spark.read.schema(rows.schema).parquet(path).select(*rows.columns))
        ctx._memo["_c_by_day"] = tuple(sides)
    return ctx._memo["_c_by_day"]


@register("reconcile_full_digest", RECONCILE_SQL)
def _reconcile_full_digest(ctx):
    return digests.reconcile_full(*_by_day(ctx))


@register("reconcile_mismatches_digest", csql(["c_mismatch"], "SELECT * FROM c_mismatch"))
def _reconcile_digest(ctx):
    return digests.reconcile_mismatches(*_by_day(ctx))


@register("dq_alert_mismatch", csql(["c_mismatch"], """
SELECT 'payment_reconciliation_mismatches' AS table_name, COUNT(*) AS mismatch_count, 100 AS threshold,
       COUNT(*) > 100 AS alert FROM c_mismatch"""))
def _dq_alert(ctx):
    return st.dq_alert_mismatch(pc(ctx).mismatches, 100)


@register("alert_fraud_spike", sql_with(["metric_daily_payment_summary"], """
SELECT calendar_date, total_transactions, fraud_blocked_transactions,
       CAST(fraud_blocked_transactions AS DOUBLE) / NULLIF(total_transactions, 0) * 100 AS blocked_pct
FROM metric_daily_payment_summary
WHERE CAST(fraud_blocked_transactions AS DOUBLE) / NULLIF(total_transactions, 0) * 100 > 10.0"""))
def _fraud_spike(ctx):
    return st.alert_fraud_spike(ctx.med.metric_daily_payment_summary, 10.0)


@register("backfill_replay", csql(["c_bronze"], """
SELECT transaction_id, merchant_id, payment_method, event_ts, status, risk_score, tokenized_pan, ingestion_date
FROM c_bronze WHERE ingestion_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-16'"""))
def _backfill(ctx):
    return st.backfill_replay(pc(ctx).bronze, "2024-01-10", "2024-01-16")
