"""Registered queries of the insert-only pipeline B.

Two landings of the same source: the first holds the rows created before SPLIT, the
second the whole table. Run 1 fills empty targets from landing 1; run 2 reads landing 2
against run 1's targets, and the queries return what run 2 appends.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import functions as F

from ..operators import incremental as inc
from ..operators.joins import anti_existing
from ..sources.typed import to_fraud_signals_typed, to_payment_transactions
from .increment import layer_counts
from .oracle_sql import AS_OF_SQL, RISK_CLASS_B_SQL, method_case, sql_with, status_case
from .q_medallion import FRAUD_TYPED_SQL, PAYMENTS_TYPED_SQL
from .registry import register

# FIXED VALUE: boundary between the two landings of the fixtures
SPLIT = "2024-01-20 00:00:00"
SPLIT_SQL = f"TIMESTAMP '{SPLIT}'"


class Runs:
    def __init__(self, ctx):
        self.ctx = ctx
        self.raw = to_payment_transactions(ctx.fx("fx_payments_raw"))
        self.sig = to_fraud_signals_typed(ctx.fx("fx_fraud_signals_raw"))
        split = F.lit(SPLIT).cast("timestamp_ntz")
        self.raw1 = self.raw.filter(F.col("created_at") < split)
        self.sig1 = self.sig.filter(F.col("created_at") < split)

    @cached_property
    def pv1(self):
        return inc.inc_payment_validated(self.raw1, None, self.ctx.as_of, self.ctx.days)

    @cached_property
    def fe1(self):
        return inc.inc_fraud_enriched(self.sig1, None)

    @cached_property
    def dm1(self):
        return inc.inc_dim_merchant(self.pv1, None)

    @cached_property
    def dc1(self):
        return inc.inc_dim_customer(self.pv1, None)

    @cached_property
    def fact1(self):
        return inc.inc_fact_payments(self.pv1, self.fe1, None)

    @cached_property
    def new_pv(self):
        return inc.inc_payment_validated(self.raw, self.pv1, self.ctx.as_of, self.ctx.days)

    @cached_property
    def pv2(self):
        return self.pv1.unionByName(self.new_pv)

    @cached_property
    def new_fe(self):
        return inc.inc_fraud_enriched(self.sig, self.fe1)

    @cached_property
    def fe2(self):
        return self.fe1.unionByName(self.new_fe)

    @cached_property
    def new_dm(self):
        return inc.inc_dim_merchant(self.pv2, self.dm1)

    @cached_property
    def new_dc(self):
        return inc.inc_dim_customer(self.pv2, self.dc1)

    @cached_property
    def new_fact(self):
        return inc.inc_fact_payments(self.pv2, self.fe2, self.fact1)


def runs(ctx) -> Runs:
    if "_runs" not in ctx._memo:
        ctx._memo["_runs"] = Runs(ctx)
    return ctx._memo["_runs"]


def _pv_batch(src: str) -> str:
    return f"""SELECT payment_id, merchant_id, customer_id, amount, currency, payment_method, status, created_at,
       updated_at, pci_classification FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY payment_id ORDER BY updated_at DESC NULLS LAST, created_at DESC NULLS LAST,
         amount DESC NULLS LAST, merchant_id DESC NULLS LAST, customer_id DESC NULLS LAST, currency DESC NULLS LAST,
         payment_method DESC NULLS LAST, status DESC NULLS LAST) AS rn
  FROM (SELECT payment_id, merchant_id, customer_id, amount, UPPER(currency) AS currency,
               {method_case('lower(payment_method)')} AS payment_method, {status_case('lower(status)')} AS status,
               created_at, updated_at, 'PCI_DSS_RESTRICTED' AS pci_classification
        FROM {src} WHERE created_at >= ({AS_OF_SQL} - INTERVAL 90 DAY)) n) d WHERE rn = 1"""


def _fe_batch(src: str) -> str:
    return f"""SELECT signal_id, transaction_id, risk_score, classification, alert_level, case_decision, created_at FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY signal_id ORDER BY created_at DESC NULLS LAST, risk_score DESC NULLS LAST,
         transaction_id DESC NULLS LAST) AS rn
  FROM (SELECT signal_id, transaction_id, risk_score, {RISK_CLASS_B_SQL.format(s='risk_score')} AS classification,
               alert_level, case_decision, created_at FROM {src}) n) d WHERE rn = 1"""


def _fact(pv: str, fe: str) -> str:
    return f"""SELECT pv.payment_id, pv.merchant_id, pv.customer_id, pv.amount, pv.currency, pv.status,
       fe.signal_id AS fraud_signal_id, fe.risk_score, pv.created_at
FROM {pv} pv LEFT JOIN (
  SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY transaction_id ORDER BY created_at DESC NULLS LAST,
                        risk_score DESC NULLS LAST, signal_id DESC NULLS LAST) AS rn FROM {fe}) x WHERE rn = 1
) fe ON pv.payment_id = fe.transaction_id"""


B_LAYERS = {
    "b_raw": (["fx_payments_raw"], PAYMENTS_TYPED_SQL),
    "b_sig": (["fx_fraud_signals_raw"], FRAUD_TYPED_SQL),
    "b_raw1": (["b_raw"], f"SELECT * FROM b_raw WHERE created_at < {SPLIT_SQL}"),
    "b_sig1": (["b_sig"], f"SELECT * FROM b_sig WHERE created_at < {SPLIT_SQL}"),
    "pv1": (["b_raw1"], _pv_batch("b_raw1")),
    "fe1": (["b_sig1"], _fe_batch("b_sig1")),
    "dm1": (["pv1"], "SELECT DISTINCT merchant_id, 'Merchant ' || merchant_id AS merchant_name FROM pv1"),
    "dc1": (["pv1"], "SELECT DISTINCT customer_id, 'Customer ' || customer_id AS customer_name FROM pv1"),
    "fact1": (["pv1", "fe1"], _fact("pv1", "fe1")),
    "new_pv": (["b_raw", "pv1"], f"SELECT * FROM ({_pv_batch('b_raw')}) b "
                                 f"WHERE NOT EXISTS (SELECT 1 FROM pv1 t WHERE t.payment_id = b.payment_id)"),
    "pv2": (["pv1", "new_pv"], "SELECT * FROM pv1 UNION ALL SELECT * FROM new_pv"),
    "new_fe": (["b_sig", "fe1"], f"SELECT * FROM ({_fe_batch('b_sig')}) b "
                                 f"WHERE NOT EXISTS (SELECT 1 FROM fe1 t WHERE t.signal_id = b.signal_id)"),
    "fe2": (["fe1", "new_fe"], "SELECT * FROM fe1 UNION ALL SELECT * FROM new_fe"),
    "new_dm": (["pv2", "dm1"], """SELECT DISTINCT merchant_id, 'Merchant ' || merchant_id AS merchant_name FROM pv2 b
WHERE NOT EXISTS (SELECT 1 FROM dm1 t WHERE t.merchant_id = b.merchant_id)"""),
    "new_dc": (["pv2", "dc1"], """SELECT DISTINCT customer_id, 'Customer ' || customer_id AS customer_name FROM pv2 b
WHERE NOT EXISTS (SELECT 1 FROM dc1 t WHERE t.customer_id = b.customer_id)"""),
    "new_fact_src": (["pv2", "fact1"], """SELECT * FROM pv2 b
WHERE NOT EXISTS (SELECT 1 FROM fact1 t WHERE t.payment_id = b.payment_id)"""),
    "new_fact": (["new_fact_src", "fe2"], _fact("new_fact_src", "fe2")),
}


def bsql(names, final: str) -> str:
    return sql_with(names, final, extra=B_LAYERS)


@register("inc_payment_validated", bsql(["new_pv"], "SELECT * FROM new_pv"))
def _inc_pv(ctx):
    return runs(ctx).new_pv


@register("inc_fraud_enriched", bsql(["new_fe"], "SELECT * FROM new_fe"))
def _inc_fe(ctx):
    return runs(ctx).new_fe


@register("inc_dim_merchant", bsql(["new_dm"], "SELECT * FROM new_dm"))
def _inc_dm(ctx):
    return runs(ctx).new_dm


@register("inc_dim_customer", bsql(["new_dc"], "SELECT * FROM new_dc"))
def _inc_dc(ctx):
    return runs(ctx).new_dc


@register("inc_fact_payments", bsql(["new_fact"], "SELECT * FROM new_fact"))
def _inc_fact(ctx):
    return runs(ctx).new_fact


@register("fact_payments", bsql(["fact1", "new_fact"], "SELECT * FROM fact1 UNION ALL SELECT * FROM new_fact"))
def _fact_payments(ctx):
    r = runs(ctx)
    return r.fact1.unionByName(r.new_fact)


@register("join_fact_b", bsql(["pv2", "fe2"], _fact("pv2", "fe2")))
def _join_fact_b(ctx):
    r = runs(ctx)
    return inc.join_fact_b(r.pv2, r.fe2)


@register("constant_tag", bsql(["pv2"], "SELECT payment_id, pci_classification FROM pv2"))
def _constant_tag(ctx):
    return runs(ctx).pv2.select("payment_id", "pci_classification")


@register("sample_flagged_facts", bsql(["fact1", "new_fact"], """
SELECT payment_id, amount, status, risk_score, fraud_signal_id
FROM (SELECT * FROM fact1 UNION ALL SELECT * FROM new_fact) f
WHERE fraud_signal_id IS NOT NULL ORDER BY payment_id LIMIT 10"""))
def _sample_flagged(ctx):
    r = runs(ctx)
    f = r.fact1.unionByName(r.new_fact)
    return (f.filter(F.col("fraud_signal_id").isNotNull()).orderBy("payment_id").limit(10)
            .select("payment_id", "amount", "status", "risk_score", "fraud_signal_id"))


def _anti(name, key, src_layer, target_layer, build):
    @register(name, bsql([src_layer, target_layer], f"""SELECT DISTINCT b.{key} FROM {src_layer} b
WHERE NOT EXISTS (SELECT 1 FROM {target_layer} t WHERE t.{key} = b.{key})"""))
    def _q(ctx):
        src, target = build(runs(ctx))
        return anti_existing(src.select(key).distinct(), target, key)
    return _q


B_LAYERS["pv_batch2"] = (["b_raw"], _pv_batch("b_raw"))
B_LAYERS["fe_batch2"] = (["b_sig"], _fe_batch("b_sig"))
_anti("anti_existing_payments", "payment_id", "pv_batch2", "pv1",
      lambda r: (inc.payment_validated_batch(r.raw, r.ctx.as_of, r.ctx.days), r.pv1))
_anti("anti_existing_signals", "signal_id", "fe_batch2", "fe1", lambda r: (inc.fraud_enriched_batch(r.sig), r.fe1))
_anti("anti_existing_merchants", "merchant_id", "pv2", "dm1", lambda r: (r.pv2, r.dm1))
_anti("anti_existing_customers", "customer_id", "pv2", "dc1", lambda r: (r.pv2, r.dc1))
_anti("anti_existing_facts", "payment_id", "pv2", "fact1", lambda r: (r.pv2, r.fact1))


@register("layer_counts", bsql(["b_raw", "b_sig", "pv2", "fe2", "dm1", "new_dm", "dc1", "new_dc", "fact1", "new_fact"], """
SELECT COUNT(*) AS raw_payment_records,
       (SELECT COUNT(*) FROM b_sig) AS raw_fraud_signals,
       (SELECT COUNT(*) FROM pv2) AS silver_payments,
       (SELECT COUNT(*) FROM fe2) AS silver_fraud,
       (SELECT COUNT(*) FROM (SELECT * FROM dm1 UNION ALL SELECT * FROM new_dm) x) AS gold_merchants,
       (SELECT COUNT(*) FROM (SELECT * FROM dc1 UNION ALL SELECT * FROM new_dc) x) AS gold_customers,
       (SELECT COUNT(*) FROM (SELECT * FROM fact1 UNION ALL SELECT * FROM new_fact) x) AS gold_facts
FROM b_raw"""))
def _layer_counts(ctx):
    r = runs(ctx)
    tables = {"payment_validated": r.pv2, "fraud_enriched": r.fe2,
              "dim_merchant": r.dm1.unionByName(r.new_dm), "dim_customer": r.dc1.unionByName(r.new_dc),
              "fact_payments": r.fact1.unionByName(r.new_fact)}
    return layer_counts(r.raw, r.sig, tables)
