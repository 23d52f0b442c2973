"""Payment validation, lifecycle (authorise / capture / refund), ledger and the batch API.

The reference handles one request at a time with objects in a process. Here each step
is a table operation: requests are validated by a column expression, state changes
are joins of request tables against the payment table, and the ledger is a table with
deterministic ids (a re-run or a retried task produces the same ids).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import casts, risk, validation
from . import fraud
from .windows import latest_per_key, velocity_count


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def stable_id(*parts) -> Column:
    """Deterministic 32-hex id from the given columns (replaces random uuids)."""
    return F.substring(F.sha2(F.concat_ws(":", *[_c(p).cast("string") for p in parts]), 256), 1, 32)


def validate_payment(requests: DataFrame, amount="amount", currency="currency", method="payment_method",
                     merchant="merchant_id", customer="customer_id") -> tuple[DataFrame, DataFrame]:
    """Split requests into (valid, rejected); rejected rows carry the first failing check."""
    err = validation.validation_error(amount, currency, method, merchant, customer)
    tagged = requests.withColumn("error", err)
    return tagged.filter(F.col("error").isNull()).drop("error"), tagged.filter(F.col("error").isNotNull())


def _apply_transition(payments: DataFrame, requests: DataFrame, key: str, allowed_from: str, to: str,
                      as_of, extra_error: Column | None = None) -> DataFrame:
    p = payments.select(key, F.col("status").alias("old_status"), F.col("amount").alias("payment_amount"))
    j = requests.join(p, on=key, how="left")
    error = (F.when(F.col("old_status").isNull(), F.lit("Payment not found"))
             .when(F.col("old_status") != allowed_from,
                   F.concat(F.lit(f"Cannot {'capture' if to == 'captured' else 'refund'} payment with status: "),
                            F.col("old_status"))))
    if extra_error is not None:
        error = F.coalesce(error, extra_error)
    j = j.withColumn("error", error)
    return j.select(
        "*",
        F.when(F.col("error").isNull(), F.lit(to)).otherwise(F.col("old_status")).alias("new_status"),
        F.when(F.col("error").isNull(), casts.as_of_ts(as_of)).alias("updated_at"))


def capture_batch(payments: DataFrame, requests: DataFrame, as_of, key: str = "payment_id") -> DataFrame:
    """Only AUTHORIZED payments become CAPTURED; others are rejected with the reason."""
    out = _apply_transition(payments, requests.select(key).distinct(), key, "authorized", "captured", as_of)
    return out.select(key, "old_status", "new_status", "updated_at", "error")


def refund_batch(payments: DataFrame, requests: DataFrame, as_of, key: str = "payment_id",
                 request_order: list[str] | None = None) -> DataFrame:
    """Only CAPTURED payments; a refund larger than the amount is rejected; the status
    becomes REFUNDED even for a partial refund, and a zero/NULL amount skips the check.

    Requests for one payment are taken in the order of ``request_order`` (without one: by falling amount, NULL
    last): the first valid one refunds it, all later ones meet a refunded payment."""
    order = request_order or []
    req = requests.select(key, "refund_amount", *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)])
    too_much = F.when(F.coalesce(F.col("refund_amount") != 0, F.lit(False))
                      & (F.col("refund_amount") > F.col("payment_amount")),
                      F.lit("Refund amount exceeds payment amount"))
    out = _apply_transition(payments, req, key, "captured", "refunded", as_of, too_much)
    turn = Window.partitionBy(key).orderBy(*[F.col(f"_o{i}") for i in range(len(order))], F.col("refund_amount").desc_nulls_last())
    done = F.coalesce(F.max(F.col("error").isNull().cast("int")).over(turn.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) == 1
    out = out.withColumn("_done", done).withColumns({
        "error": F.when(F.col("_done"), F.lit("Cannot refund payment with status: refunded")).otherwise(F.col("error")),
        "old_status": F.when(F.col("_done"), F.lit("refunded")).otherwise(F.col("old_status")),
        "new_status": F.when(F.col("_done"), F.lit("refunded")).otherwise(F.col("new_status")),
        "updated_at": F.when(~F.col("_done"), F.col("updated_at"))})
    return out.select(key, "refund_amount", "old_status", "new_status", "updated_at", "error")


LEDGER_COLS = ["id", "payment_id", "type", "status", "amount", "currency", "created_at", "updated_at",
               "error_message"]


def ledger_create(payments: DataFrame, tx_type: str, as_of) -> DataFrame:
    """New ledger rows in state 'initiated' for every payment."""
    ts = casts.as_of_ts(as_of)
    return payments.select(stable_id("payment_id", F.lit(tx_type)).alias("id"), "payment_id",
                           F.lit(tx_type).alias("type"), F.lit("initiated").alias("status"), "amount", "currency",
                           ts.alias("created_at"), ts.alias("updated_at"),
                           F.lit(None).cast("string").alias("error_message"))


def ledger_update_status(ledger: DataFrame, updates: DataFrame, as_of, seq: str = "seq") -> tuple[DataFrame, DataFrame]:
    """Apply status updates (the last one per id by ``seq``). Unknown ids are returned as
    errors; an empty or missing error message keeps the previous one."""
    last = latest_per_key(updates, ["id"], [seq]).select(
        "id", F.col("status").alias("_new_status"), F.col("error_message").alias("_new_error"),
        F.lit(True).alias("_upd"))
    j = ledger.join(last, on="id", how="left")
    new_error = F.when(F.length(F.col("_new_error")) > 0, F.col("_new_error"))
    updated = j.select(
        "id", "payment_id", "type",
        F.coalesce("_new_status", "status").alias("status"), "amount", "currency", "created_at",
        F.when(F.col("_upd"), casts.as_of_ts(as_of)).otherwise(F.col("updated_at")).alias("updated_at"),
        F.coalesce(new_error, F.col("error_message")).alias("error_message"))
    errors = (updates.select("id").distinct().join(ledger.select("id"), on="id", how="left_anti")
              .select("id", F.concat(F.lit("Transaction not found: "), F.col("id")).alias("error")))
    return updated, errors


def process_payments_batch(requests: DataFrame, as_of, rules=None, capture: bool = True, fraud_check: bool = True,
                           ts: str = "event_ts", order_id: str = "request_id",
                           window_minutes: int = 60) -> DataFrame:
    """validate -> authorise -> score -> decline on DECLINE/BLOCK -> capture, one row per request.

    Scoring uses the context-free rules (amount and velocity) as the reference's API does;
    velocity counts earlier *authorised* requests of the customer in event time.
    """
    valid, rejected = validate_payment(requests)
    auth = valid.withColumns({"payment_id": stable_id(order_id), "status": F.lit("authorized")})
    if fraud_check:
        ctx = velocity_count(auth, "customer_id", ts, order_id, window_minutes, "prior_count")
        rules = rules or [fraud.Rule("amount_anomaly", fraud.rule_amount_anomaly("amount"), "0.30"),
                          fraud.Rule("velocity_exceeded", fraud.rule_velocity("prior_count"), "0.20")]
        scored = fraud.score_transactions(ctx, rules)
        declined = risk.should_decline(F.col("decision"))
    else:
        scored = auth.withColumns({"risk_score": F.lit(None).cast("decimal(3,2)"),
                                   "risk_level": F.lit(None).cast("string"),
                                   "alerts": F.lit(None).cast("array<string>"), "decision": F.lit(None).cast("string")})
        declined = F.lit(False)
    final_status = F.when(declined, F.lit("authorized")).otherwise(F.lit("captured" if capture else "authorized"))
    ok = scored.select(
        order_id, (~declined).alias("success"),
        F.when(declined, F.lit("Transaction declined due to fraud risk")).alias("error"),
        "payment_id", final_status.alias("status"), "amount", "currency",
        "risk_score", "risk_level", "decision", "alerts")
    bad = rejected.select(
        order_id, F.lit(False).alias("success"), "error", F.lit(None).cast("string").alias("payment_id"),
        F.lit(None).cast("string").alias("status"), "amount", "currency",
        F.lit(None).cast("decimal(3,2)").alias("risk_score"), F.lit(None).cast("string").alias("risk_level"),
        F.lit(None).cast("string").alias("decision"), F.lit(None).cast("array<string>").alias("alerts"))
    return ok.unionByName(bad)
