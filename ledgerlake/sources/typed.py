"""Typed landing tables of the incremental pipeline, derived from the text landing tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import casts


def enforce_schema(df: DataFrame, schema) -> DataFrame:
    """Select exactly the declared columns with the declared types (ANSI-safe casts)."""
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def to_payment_transactions(raw: DataFrame) -> DataFrame:
    """payments_raw text -> raw.payment_transactions (DECIMAL amount, TIMESTAMP times)."""
    return raw.select(
        "payment_id", "merchant_id", "customer_id", casts.cast_money("amount").alias("amount"),
        "currency", "payment_method", "status",
        casts.cast_timestamp("created_at").alias("created_at"),
        casts.cast_timestamp("updated_at").alias("updated_at"), "metadata")


def to_fraud_signals_typed(raw: DataFrame) -> DataFrame:
    """fraud_signals_raw text -> raw.fraud_signals: DECIMAL(5,3) score, classification =
    the producer's risk level, alert_level = upper-cased level, case_decision = decision."""
    return raw.select(
        "signal_id", "transaction_id", casts.cast_score("risk_score", 5, 3).alias("risk_score"),
        F.col("risk_level").alias("classification"), F.upper("risk_level").alias("alert_level"),
        F.col("decision").alias("case_decision"), casts.cast_timestamp("created_at").alias("created_at"))


PAYMENTS_RAW_SCHEMA = schemas.PAYMENTS_RAW
FRAUD_RAW_SCHEMA = schemas.FRAUD_SIGNALS_RAW
