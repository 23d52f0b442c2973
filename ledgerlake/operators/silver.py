"""Raw -> silver: cleaning, retention, payment/fraud join and the de-duplicated fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import casts, normalize, risk
from .windows import latest_per_key


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def retention_filter(df: DataFrame, col: str, as_of, days: int = K.RETENTION_DAYS) -> DataFrame:
    """Keep rows with ``col >= as_of - days``."""
    cutoff = casts.as_of_ts(as_of) - F.make_interval(days=F.lit(days))
    return df.filter(F.col(col) >= cutoff)


def with_file_metadata(df: DataFrame) -> DataFrame:
    """Source file path and modification time, selected at the file scan."""
    return df.select("*", F.col("_metadata.file_path").alias("file_path"),
                     F.col("_metadata.file_modification_time").alias("file_modification_time"))


def _payments_parsed(raw: DataFrame, ignore_case: bool = False) -> DataFrame:
    extra = [c for c in ("file_path", "file_modification_time") if c in raw.columns]
    base = raw.select(
        "payment_id", "merchant_id", "customer_id", "amount", "currency", "payment_method", "status",
        "created_at", "updated_at", *extra)
    parsed = casts.with_parsed(base, {
        "_amount": casts.cast_money("amount"),
        "_created": casts.cast_timestamp("created_at"),
        "_updated": casts.cast_timestamp("updated_at"),
    })
    return parsed.select(
        "payment_id", "merchant_id", "customer_id",
        F.col("_amount").alias("amount"),
        F.upper("currency").alias("currency"),
        normalize.normalize_payment_method("payment_method", ignore_case).alias("payment_method_normalized"),
        normalize.normalize_status("status", ignore_case).alias("status_normalized"),
        F.col("_created").alias("payment_created_at"),
        F.col("_updated").alias("payment_updated_at"),
        *extra,
        F.col("amount").alias("_raw_amount"), F.col("created_at").alias("_raw_created"),
        F.col("updated_at").alias("_raw_updated"),
    )


def _payment_reject_reason() -> Column:
    return (F.when(casts.parse_failed("_raw_amount", "amount"), F.lit("amount"))
            .when(casts.parse_failed("_raw_created", "payment_created_at"), F.lit("created_at"))
            .when(casts.parse_failed("_raw_updated", "payment_updated_at"), F.lit("updated_at")))


def clean_payments(raw: DataFrame, as_of, days: int = K.RETENTION_DAYS, audit: bool = False) -> DataFrame:
    """payments_raw -> payments_cleaned: typed, normalised, last ``days`` days only.
    Rows whose amount or timestamps do not parse go to ``clean_payments_rejects``."""
    parsed = _payments_parsed(raw)
    out = retention_filter(parsed.filter(_payment_reject_reason().isNull()), "payment_created_at", as_of, days)
    out = out.drop("_raw_amount", "_raw_created", "_raw_updated")
    if audit:
        out = out.withColumn("processed_at", F.current_timestamp())
    return out


def clean_payments_rejects(raw: DataFrame, as_of, days: int = K.RETENTION_DAYS) -> DataFrame:
    """Rows of payments_raw that could not be typed, with the first failing field."""
    parsed = _payments_parsed(raw).withColumn("reject_reason", _payment_reject_reason())
    cutoff = casts.as_of_ts(as_of) - F.make_interval(days=F.lit(days))
    too_old = F.coalesce(F.col("payment_created_at") < cutoff, F.lit(False))
    return (parsed.filter(F.col("reject_reason").isNotNull() & ~too_old)
            .select("payment_id", F.col("_raw_amount").alias("amount"), F.col("_raw_created").alias("created_at"),
                    F.col("_raw_updated").alias("updated_at"), "reject_reason"))


def clean_fraud_signals(raw: DataFrame, as_of, days: int = K.RETENTION_DAYS, audit: bool = False) -> DataFrame:
    """fraud_signals_raw -> fraud_signals_cleaned. The derived level reads the raw score,
    as the reference's CASE does."""
    base = casts.with_parsed(raw.select("signal_id", "transaction_id", "risk_score", "risk_level", "alerts",
                                        "decision", "case_status", "created_at"),
                             {"_score": casts.cast_score("risk_score"), "_created": casts.cast_timestamp("created_at")})
    parsed = base.select(
        "signal_id", "transaction_id",
        F.col("_score").alias("risk_score"),
        risk.derive_risk_level(F.col("risk_score").try_cast("double")).alias("risk_level_derived"),
        "risk_level", "alerts",
        normalize.normalize_decision("decision").alias("decision_normalized"),
        normalize.normalize_case_status("case_status").alias("case_status_normalized"),
        F.col("_created").alias("signal_created_at"),
        F.col("risk_score").alias("_raw_score"), F.col("created_at").alias("_raw_created"),
    )
    ok = ~casts.parse_failed("_raw_score", "risk_score") & ~casts.parse_failed("_raw_created", "signal_created_at")
    out = retention_filter(parsed.filter(ok), "signal_created_at", as_of, days).drop("_raw_score", "_raw_created")
    if audit:
        out = out.withColumn("processed_at", F.current_timestamp())
    return out


def _enriched_columns(p: str = "p", f: str = "f") -> list[Column]:
    fdec = F.col(f"{f}.decision_normalized")
    fscore = F.col(f"{f}.risk_score")
    return [
        F.col(f"{p}.payment_id"), F.col(f"{p}.merchant_id"), F.col(f"{p}.customer_id"),
        F.col(f"{p}.amount"), F.col(f"{p}.currency"),
        F.col(f"{p}.payment_method_normalized").alias("payment_method"),
        F.col(f"{p}.status_normalized").alias("status"),
        F.coalesce(fscore, F.lit(0).cast("decimal(3,2)")).alias("risk_score"),
        F.coalesce(F.col(f"{f}.risk_level"), F.lit("NOT_EVALUATED")).alias("fraud_risk_level"),
        F.coalesce(fdec, F.lit("NO_DECISION")).alias("fraud_decision"),
        F.col(f"{f}.alerts").alias("fraud_alerts"),
        risk.overall_risk_category(fdec, fscore).alias("overall_risk_category"),
        F.col(f"{p}.payment_created_at"), F.col(f"{p}.payment_updated_at"),
        F.coalesce(F.col(f"{f}.signal_created_at"), F.col(f"{p}.payment_created_at")).alias("latest_event_at"),
    ]


def join_payment_fraud(payments: DataFrame, signals: DataFrame) -> DataFrame:
    """payments_with_fraud: payments LEFT JOIN signals ON payment_id = transaction_id.
    A payment with several signals appears once per signal, as in the reference."""
    return (payments.alias("p")
            .join(signals.alias("f"), F.col("p.payment_id") == F.col("f.transaction_id"), "left")
            .select(*_enriched_columns()))


# Total order for "latest": payment version first, then signal (decision D-04).
PAYMENT_ORDER = ["payment_updated_at", "payment_created_at", "amount", "merchant_id", "customer_id",
                 "currency", "payment_method_normalized", "status_normalized"]
SIGNAL_ORDER = ["signal_created_at", "risk_score", "decision_normalized", "risk_level", "alerts", "signal_id"]


def transactions_fact(payments: DataFrame, signals: DataFrame) -> DataFrame:
    """One row per payment with its fraud information: the ``row_number() = 1`` of
    payments_with_fraud ordered by updated_at DESC with a total tie-break.

    Because the order ranks the payment version before the signal, the winner pairs the
    latest payment version with the latest signal of that id. Each side is reduced to one
    row per id *before* the join, so the join is 1:1 and the fan-out of duplicate ids is
    never built.
    """
    p = latest_per_key(payments, ["payment_id"], PAYMENT_ORDER)
    f = latest_per_key(signals, ["transaction_id"], SIGNAL_ORDER)
    joined = (p.alias("p").join(f.alias("f"), F.col("p.payment_id") == F.col("f.transaction_id"), "left")
              .select(*_enriched_columns()))
    return joined.select(
        F.col("payment_id").alias("transaction_id"), "merchant_id", "customer_id", "amount", "currency",
        "payment_method", "status", "risk_score", "fraud_risk_level", "fraud_decision",
        "overall_risk_category", F.col("payment_created_at").alias("transaction_date"),
        "payment_updated_at", "latest_event_at")
