"""Rule-based fraud scoring, routing and the ML scorer, as DataFrame operators.

The reference scores one payment at a time against an in-memory history list. Here a
rule is a named boolean Column with a weight; scoring a table is one projection, and
the only stateful input (velocity: earlier transactions of the customer in a time
window) comes from ``windows.velocity_count``.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import risk
from . import windows


@dataclass(frozen=True)
class Rule:
    name: str          # alert raised when the predicate holds
    predicate: Column  # boolean Column
    weight: str        # decimal text added to the score


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _truthy(c) -> Column:
    col = _c(c)
    return col.isNotNull() & (col.cast("string") != "")


# ---- rule predicates -------------------------------------------------------

def rule_amount_anomaly(amount, limit: str = K.ENGINE_MAX_AMOUNT) -> Column:
    return F.coalesce(_c(amount) > F.lit(Decimal(limit)), F.lit(False))


def rule_velocity(prior_count, limit: int = K.ENGINE_VELOCITY_LIMIT) -> Column:
    return F.coalesce(_c(prior_count) >= F.lit(limit), F.lit(False))


def rule_location(previous, current) -> Column:
    """Both locations present (non-empty) and different."""
    return F.coalesce(_truthy(previous) & _truthy(current) & (_c(previous) != _c(current)), F.lit(False))


def rule_device(mismatch) -> Column:
    return F.coalesce(_c(mismatch).cast("boolean"), F.lit(False))


def default_rules(amount="amount", prior_count="prior_count", previous_location="previous_location",
                  current_location="current_location", device_mismatch="device_mismatch",
                  amount_limit: str = K.ENGINE_MAX_AMOUNT, velocity_limit: int = K.ENGINE_VELOCITY_LIMIT) -> list[Rule]:
    """The four rules of the simple engine, in the order their alerts are listed."""
    w = K.RULE_WEIGHTS
    return [
        Rule("amount_anomaly", rule_amount_anomaly(amount, amount_limit), w["amount_anomaly"]),
        Rule("velocity_exceeded", rule_velocity(prior_count, velocity_limit), w["velocity_exceeded"]),
        Rule("unusual_location", rule_location(previous_location, current_location), w["unusual_location"]),
        Rule("device_fingerprint_mismatch", rule_device(device_mismatch), w["device_fingerprint_mismatch"]),
    ]


# ---- scoring ---------------------------------------------------------------

def score_transactions(df: DataFrame, rules: list[Rule], extra_alerts: Column | None = None,
                       base: str = K.ENGINE_BASE_SCORE) -> DataFrame:
    """Adds risk_score (base + weights, capped at 1.00), risk_level, alerts (rule order,
    then any caller-supplied alerts such as bin_blacklist), decision and case_status."""
    score = F.lit(Decimal(base)).cast("decimal(4,2)")
    for r in rules:
        score = score + F.when(r.predicate, F.lit(Decimal(r.weight))).otherwise(F.lit(Decimal("0.00")))
    score = score.cast("decimal(4,2)")
    alerts = F.array_compact(F.array(*[F.when(r.predicate, F.lit(r.name)) for r in rules]))
    if extra_alerts is not None:
        alerts = F.concat(alerts, F.coalesce(extra_alerts, F.array().cast("array<string>")))
    out = df.withColumns({"_raw_score": score, "alerts": alerts})
    out = out.withColumns({
        "risk_score": F.least(F.col("_raw_score"), F.lit(Decimal("1.00"))).cast("decimal(3,2)"),
        "risk_level": risk.score_to_level(F.col("_raw_score")),
    })
    out = out.withColumns({
        "decision": risk.decide(F.col("risk_level"), F.col("alerts")),
        "case_status": F.lit("pending"),
    })
    return out.drop("_raw_score")


def blacklist_alerts(df: DataFrame, blacklist: DataFrame, key: str, alert: str = "bin_blacklist") -> DataFrame:
    """``extra_alerts`` column: [alert] for rows whose key is listed in ``blacklist``."""
    listed = blacklist.select(F.col(key)).distinct().withColumn("_listed", F.lit(True))
    return (df.join(listed, on=key, how="left")
            .withColumn("extra_alerts", F.when(F.col("_listed"), F.array(F.lit(alert)))
                        .otherwise(F.array().cast("array<string>")))
            .drop("_listed"))


def with_scoring_context(df: DataFrame, customer: str = "customer_id", ts: str = "ts", order_id: str = "event_id",
                         location: str = "current_location", window_minutes: int = K.ENGINE_WINDOW_MINUTES) -> DataFrame:
    """prior_count (velocity) and previous_location (LAG) per customer, in event time, from one
    pass over (customer, time bucket) partitions."""
    return windows.velocity_and_previous(df, customer, ts, order_id, location, window_minutes,
                                         "prior_count", "previous_location")


# ---- routing ---------------------------------------------------------------

SIGNAL_JSON_FIELDS = ["transaction_id", "risk_score", "risk_level", "alerts", "decision", "case_status",
                      "case_id", "merchant_id", "customer_id", "amount", "currency", "ml_scores",
                      "created_at", "updated_at", "metadata"]


def signal_json(df: DataFrame, created_at: str = "created_at", engine: str = "simple",
                context_used: Column | None = None) -> Column:
    """The 15-field signal document (decimals as text, timestamps ISO-8601)."""
    ctx_used = F.lit(True) if context_used is None else context_used
    ts_iso = F.date_format(F.col(created_at), "yyyy-MM-dd'T'HH:mm:ss")
    doc = F.struct(
        F.col("transaction_id"), F.col("risk_score").cast("string").alias("risk_score"), F.col("risk_level"),
        F.col("alerts"), F.col("decision"), F.col("case_status"), F.lit(None).cast("string").alias("case_id"),
        F.col("merchant_id"), F.col("customer_id"), F.col("amount").cast("string").alias("amount"),
        F.col("currency"), F.create_map().cast("map<string,double>").alias("ml_scores"),
        ts_iso.alias("created_at"), ts_iso.alias("updated_at"),
        F.struct(F.lit(engine).alias("engine"), ctx_used.alias("context_used")).alias("metadata"))
    return F.to_json(doc, {"ignoreNullFields": "false"})


def route_signals(signals: DataFrame, prefix: str = "fraud", value: Column | None = None) -> DataFrame:
    """(topic, key, value) rows: high/critical -> <prefix>.alerts, else <prefix>.signals;
    every non-approve decision is also sent to <prefix>.decisions. Key = transaction_id.
    The result can be written by the Kafka sink (topic column) or to files."""
    high = risk.is_high_risk(F.col("risk_level"))
    main = F.when(high, F.lit(f"{prefix}.{K.TOPIC_ALERTS}")).otherwise(F.lit(f"{prefix}.{K.TOPIC_SIGNALS}"))
    decision_topic = F.when(F.lower(F.col("decision")) != "approve", F.lit(f"{prefix}.{K.TOPIC_DECISIONS}"))
    val = value if value is not None else F.to_json(F.struct(*[F.col(c) for c in signals.columns]))
    return (signals.select(F.explode(F.array_compact(F.array(main, decision_topic))).alias("topic"),
                           F.col("transaction_id").alias("key"), val.alias("value")))
