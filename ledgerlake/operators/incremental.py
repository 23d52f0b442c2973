"""Insert-only increments of pipeline B.

Each step returns the *new* rows for its target: the batch is normalised, de-duplicated
on the target key inside the batch, and anti-joined against the keys already in the
target (NOT EXISTS semantics, decision D-06). Appending the result is idempotent: a
second run with the same input returns no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import normalize, risk
from . import silver
from .joins import anti_existing
from .windows import latest_per_key

PAYMENT_VALIDATED_COLS = ["payment_id", "merchant_id", "customer_id", "amount", "currency", "payment_method",
                          "status", "created_at", "updated_at", "pci_classification"]
FRAUD_ENRICHED_COLS = ["signal_id", "transaction_id", "risk_score", "classification", "alert_level",
                       "case_decision", "created_at"]
DIM_COLS = {"merchant": ["merchant_id", "merchant_name"], "customer": ["customer_id", "customer_name"]}
FACT_PAYMENTS_COLS = ["payment_id", "merchant_id", "customer_id", "amount", "currency", "status",
                      "fraud_signal_id", "risk_score", "created_at"]


def payment_validated_batch(raw: DataFrame, as_of, days: int = K.RETENTION_DAYS) -> DataFrame:
    """raw.payment_transactions -> silver.payment_validated rows (before the anti join)."""
    out = raw.select(
        "payment_id", "merchant_id", "customer_id", "amount", F.upper("currency").alias("currency"),
        normalize.normalize_payment_method("payment_method", ignore_case=True).alias("payment_method"),
        normalize.normalize_status("status", ignore_case=True).alias("status"),
        "created_at", "updated_at", F.lit("PCI_DSS_RESTRICTED").alias("pci_classification"))
    out = silver.retention_filter(out, "created_at", as_of, days)
    return latest_per_key(out, ["payment_id"], ["updated_at", "created_at", "amount", "merchant_id", "customer_id",
                                                "currency", "payment_method", "status"])


def _recent(target: DataFrame, as_of, days: int) -> DataFrame:
    """Target rows a batch key can still match: a payment keeps its created_at across
    versions and the batch holds only the last ``days``, so older target rows never match.
    On a target partitioned (or clustered) by creation date this is partition pruning,
    and the anti join shuffles a retention window of keys instead of the whole history."""
    return silver.retention_filter(target, "created_at", as_of, days)


def inc_payment_validated(raw: DataFrame, target: DataFrame | None, as_of, days: int = K.RETENTION_DAYS,
                          prune_target: bool = False) -> DataFrame:
    batch = payment_validated_batch(raw, as_of, days)
    if target is not None and prune_target:
        target = _recent(target, as_of, days)
    new = batch if target is None else anti_existing(batch, target, "payment_id")
    return new.select(*PAYMENT_VALIDATED_COLS)


def fraud_enriched_batch(raw: DataFrame) -> DataFrame:
    out = raw.select("signal_id", "transaction_id", "risk_score",
                     risk.derive_risk_class_b("risk_score").alias("classification"),
                     "alert_level", "case_decision", "created_at")
    return latest_per_key(out, ["signal_id"], ["created_at", "risk_score", "transaction_id"])


def inc_fraud_enriched(raw: DataFrame, target: DataFrame | None) -> DataFrame:
    batch = fraud_enriched_batch(raw)
    new = batch if target is None else anti_existing(batch, target, "signal_id")
    return new.select(*FRAUD_ENRICHED_COLS)


def _inc_dim(validated: DataFrame, target: DataFrame | None, kind: str) -> DataFrame:
    key, name = DIM_COLS[kind]
    batch = validated.select(key).distinct()
    new = batch if target is None else anti_existing(batch, target, key)
    return new.select(key, normalize.entity_name(key, f"{kind.capitalize()} ", require_non_empty=False).alias(name))


def inc_dim_merchant(validated: DataFrame, target: DataFrame | None) -> DataFrame:
    return _inc_dim(validated, target, "merchant")


def inc_dim_customer(validated: DataFrame, target: DataFrame | None) -> DataFrame:
    return _inc_dim(validated, target, "customer")


def join_fact_b(validated: DataFrame, enriched: DataFrame) -> DataFrame:
    """validated LEFT JOIN enriched; each payment pairs with its latest signal so the fact
    keeps one row per payment_id (its insert-only key)."""
    latest = latest_per_key(enriched, ["transaction_id"], ["created_at", "risk_score", "signal_id"])
    return (validated.alias("pv")
            .join(latest.alias("fe"), F.col("pv.payment_id") == F.col("fe.transaction_id"), "left")
            .select("pv.payment_id", "pv.merchant_id", "pv.customer_id", "pv.amount", "pv.currency", "pv.status",
                    F.col("fe.signal_id").alias("fraud_signal_id"), F.col("fe.risk_score"), F.col("pv.created_at")))


def inc_fact_payments(validated: DataFrame, enriched: DataFrame, target: DataFrame | None,
                      as_of=None, days: int = K.RETENTION_DAYS, prune_target: bool = False,
                      stage: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """New facts only: a late signal never updates a fact that already exists.
    With ``stage`` (a writer that reads back) the new payments are materialised first and
    only their signals are ranked, not the whole history of signals.
    With ``prune_target`` both sides are cut to the retention window first (same result
    when validated rows are themselves inside the window, as increments produce them)."""
    if target is not None and prune_target:
        validated = _recent(validated, as_of, days)
        target = _recent(target, as_of, days)
    source = validated if target is None else anti_existing(validated, target, "payment_id")
    if stage is not None:
        source = stage(source)
        enriched = enriched.join(source.select(F.col("payment_id").alias("transaction_id")), on="transaction_id", how="left_semi")
    return join_fact_b(source, enriched).select(*FACT_PAYMENTS_COLS)
