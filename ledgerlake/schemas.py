"""Declared schemas: every source reads with one of these, never with inference."""

from pyspark.sql import types as T

S = T.StringType()

PAYMENTS_RAW = T.StructType([
    T.StructField("payment_id", S, False),
    T.StructField("merchant_id", S, False),
    T.StructField("customer_id", S, False),
    T.StructField("amount", S, False),
    T.StructField("currency", S, False),
    T.StructField("payment_method", S, False),
    T.StructField("status", S, False),
    T.StructField("created_at", S, False),
    T.StructField("updated_at", S, False),
    T.StructField("metadata", S, True),
])

FRAUD_SIGNALS_RAW = T.StructType([
    T.StructField("signal_id", S, False),
    T.StructField("transaction_id", S, False),
    T.StructField("risk_score", S, False),
    T.StructField("risk_level", S, False),
    T.StructField("alerts", S, False),
    T.StructField("decision", S, False),
    T.StructField("case_status", S, False),
    T.StructField("created_at", S, False),
])

MONEY = T.DecimalType(18, 2)

PAYMENT_TRANSACTIONS = T.StructType([
    T.StructField("payment_id", S, False),
    T.StructField("merchant_id", S, False),
    T.StructField("customer_id", S, False),
    T.StructField("amount", MONEY, True),
    T.StructField("currency", S, False),
    T.StructField("payment_method", S, False),
    T.StructField("status", S, False),
    T.StructField("created_at", T.TimestampNTZType(), True),
    T.StructField("updated_at", T.TimestampNTZType(), True),
    T.StructField("metadata", S, True),
])

FRAUD_SIGNALS_TYPED = T.StructType([
    T.StructField("signal_id", S, False),
    T.StructField("transaction_id", S, False),
    T.StructField("risk_score", T.DecimalType(5, 3), True),
    T.StructField("classification", S, True),
    T.StructField("alert_level", S, True),
    T.StructField("case_decision", S, True),
    T.StructField("created_at", T.TimestampNTZType(), True),
])

SETTLEMENT = T.StructType([
    T.StructField("settlement_id", S, True),
    T.StructField("transaction_id", S, True),
    T.StructField("settlement_date", T.DateType(), True),
    T.StructField("amount", MONEY, True),
    T.StructField("fee", MONEY, True),
    T.StructField("chargeback_flag", T.BooleanType(), True),
])

# settlement CSV as it lands: all text, validated before typing
SETTLEMENT_CSV = T.StructType([T.StructField(c, S, True) for c in
                               ["settlement_id", "transaction_id", "settlement_date", "amount", "fee",
                                "chargeback_flag"]])

# JSON payload carried on the payment and signal streams
PAYMENT_EVENT = T.StructType([
    T.StructField("transaction_id", S, True),
    T.StructField("merchant_id", S, True),
    T.StructField("customer_id", S, True),
    T.StructField("payment_method", S, True),
    T.StructField("amount", MONEY, True),
    T.StructField("status", S, True),
    T.StructField("card_number", S, True),
    T.StructField("event_ts", T.TimestampType(), True),
])
PAYMENT_EVENT_REQUIRED = ["transaction_id", "merchant_id", "amount", "event_ts"]

SIGNAL_EVENT = T.StructType([
    T.StructField("transaction_id", S, True),
    T.StructField("risk_score", T.DecimalType(3, 2), True),
    T.StructField("risk_level", S, True),
    T.StructField("decision", S, True),
    T.StructField("signal_ts", T.TimestampType(), True),
])
SIGNAL_EVENT_REQUIRED = ["transaction_id", "risk_score", "signal_ts"]
