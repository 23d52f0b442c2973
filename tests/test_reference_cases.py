"""The reference's unit-test cases, restated as rows through the table operators."""

import datetime as dt
import json
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerlake.functions import risk, validation
from ledgerlake.operators import fraud, lifecycle
from ledgerlake.operators.usage import rows_with_key

AS_OF = "2024-01-01 00:00:00"


def test_signal_bounds(spark):
    rows = [(Decimal(s), Decimal("100.00"), True) for s in ("0.1", "0.3", "0.5", "0.7", "0.75", "0.8", "0.9")]
    rows += [(Decimal("1.5"), Decimal("100.00"), False), (Decimal("0.5"), Decimal("-10.00"), False)]
    df = spark.createDataFrame(rows, "score decimal(3,2), amount decimal(18,2), ok boolean")
    out = df.select(validation.signal_record_ok("score", "amount").alias("got"), "ok").collect()
    assert all(r["got"] == r["ok"] for r in out)


def test_high_risk_and_decline_flags(spark):
    df = spark.createDataFrame([("high", "decline"), ("critical", "block"), ("low", "approve"), ("medium", "review")],
                               "level string, decision string")
    out = [(r[0], r[1]) for r in df.select(risk.is_high_risk("level"), risk.should_decline("decision")).collect()]
    assert out == [(True, True), (True, True), (False, False), (False, False)]


def test_signal_document_has_fifteen_fields(spark):
    df = spark.createDataFrame(
        [("txn_1", Decimal("0.40"), "medium", ["unusual_location"], "challenge", "pending", "M1", "C1",
          Decimal("50.00"), "USD", dt.datetime(2024, 1, 1, 12, 0))],
        "transaction_id string, risk_score decimal(3,2), risk_level string, alerts array<string>, decision string, "
        "case_status string, merchant_id string, customer_id string, amount decimal(18,2), currency string, "
        "created_at timestamp_ntz")
    doc = json.loads(df.select(fraud.signal_json(df, "created_at").alias("j")).first()["j"])
    assert list(doc) == fraud.SIGNAL_JSON_FIELDS
    assert doc["risk_score"] == "0.40" and doc["amount"] == "50.00" and doc["case_id"] is None
    assert doc["alerts"] == ["unusual_location"] and doc["metadata"] == {"engine": "simple", "context_used": True}


def test_signals_for_a_transaction(spark):
    df = spark.createDataFrame([("s1", "txn_100"), ("s2", "txn_100"), ("s3", "txn_200")],
                               "signal_id string, transaction_id string")
    assert rows_with_key(df, "transaction_id", "txn_100").count() == 2
    assert rows_with_key(df, "transaction_id", "txn_200").count() == 1


def test_ledger_initiated_then_completed(spark):
    pays = spark.createDataFrame([("pay_1", Decimal("50.00"), "USD")], "payment_id string, amount decimal(18,2), currency string")
    ledger = lifecycle.ledger_create(pays, "charge", AS_OF)
    row = ledger.first()
    assert (row["payment_id"], row["type"], row["status"], row["amount"]) == ("pay_1", "charge", "initiated",
                                                                            Decimal("50.00"))
    updates = ledger.select("id", F.lit("completed").alias("status"), F.lit(None).cast("string").alias("error_message"),
                            F.lit(1).alias("seq"))
    updated, errors = lifecycle.ledger_update_status(ledger, updates, "2024-01-02 00:00:00")
    assert updated.first()["status"] == "completed" and errors.count() == 0
    assert lifecycle.ledger_create(pays, "charge", AS_OF).first()["id"] == row["id"]  # same id on a re-run


def test_authorize_then_capture_via_batch_api(spark):
    req = spark.createDataFrame(
        [("r1", Decimal("100.00"), "USD", "credit_card", "M1", "C1", dt.datetime(2024, 1, 1)),
         ("r2", Decimal("-10.00"), "USD", "credit_card", "M1", "C1", dt.datetime(2024, 1, 1)),
         ("r3", Decimal("10.00"), "INVALID", "credit_card", "M1", "C1", dt.datetime(2024, 1, 1))],
        "request_id string, amount decimal(18,2), currency string, payment_method string, merchant_id string, "
        "customer_id string, event_ts timestamp_ntz")
    out = {r["request_id"]: r for r in lifecycle.process_payments_batch(req, AS_OF).collect()}
    assert out["r1"]["success"] and out["r1"]["status"] == "captured" and out["r1"]["decision"] == "approve"
    assert out["r2"]["error"] == "Invalid amount" and out["r3"]["error"] == "Invalid currency"
