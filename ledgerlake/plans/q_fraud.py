"""Registered queries of the fraud engine.

Scoring input (FIXTURES.md section 4): one transaction per event; amount = value with
a 200 limit; velocity = 24 h with >= 3 earlier rows; location = 'L' || (k % 4) where
k comes from ``props``; device mismatch when k % 10 = 0.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import risk
from ..operators import fraud, ml
from ..session import scratch_path
from .registry import register

AMOUNT_LIMIT = "200"
VELOCITY_LIMIT = 3
WINDOW_MINUTES = 24 * 60


def scoring_base(ctx):
    e = ctx.fx("events").select("event_id", "user_id", "ts", "value", "props")
    k = F.get_json_object("props", "$.k").cast("int")
    return e.select(
        "event_id", "ts",
        F.concat(F.lit("PAY_"), F.lpad(F.col("event_id").cast("string"), 9, "0")).alias("transaction_id"),
        F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("customer_id"),
        F.concat(F.lit("M"), (F.col("event_id") % 20).cast("string")).alias("merchant_id"),
        F.col("value").cast("decimal(18,2)").alias("amount"), F.lit("USD").alias("currency"),
        F.concat(F.lit("L"), (k % 4).cast("string")).alias("current_location"),
        ((k % 10) == 0).alias("device_mismatch"))


def scoring_context(ctx):
    if "_scoring_ctx" not in ctx._memo:
        ctx._memo["_scoring_ctx"] = fraud.with_scoring_context(scoring_base(ctx), "customer_id", "ts", "event_id",
                                                               "current_location", WINDOW_MINUTES)
    return ctx._memo["_scoring_ctx"]


def rules():
    return fraud.default_rules(amount_limit=AMOUNT_LIMIT, velocity_limit=VELOCITY_LIMIT)


def scored(ctx, extra=None):
    return fraud.score_transactions(scoring_context(ctx), rules(), extra)


SCORING_SQL = """WITH sb AS (
  SELECT event_id, ts, 'PAY_' || lpad(CAST(event_id AS VARCHAR), 9, '0') AS transaction_id,
         'C' || CAST(user_id AS VARCHAR) AS customer_id, 'M' || CAST(event_id % 20 AS VARCHAR) AS merchant_id,
         CAST(value AS DECIMAL(18,2)) AS amount, 'USD' AS currency,
         'L' || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 4 AS VARCHAR) AS current_location,
         CAST(json_extract_string(props, '$.k') AS INTEGER) % 10 = 0 AS device_mismatch
  FROM events),
sc AS (
  SELECT sb.*,
         (SELECT COUNT(*) FROM sb b2 WHERE b2.customer_id = sb.customer_id AND b2.ts >= sb.ts - INTERVAL 24 HOUR
            AND (b2.ts < sb.ts OR (b2.ts = sb.ts AND b2.event_id < sb.event_id))) AS prior_count,
         LAG(current_location) OVER (PARTITION BY customer_id ORDER BY ts, event_id) AS previous_location
  FROM sb),
ru AS (
  SELECT *, COALESCE(amount > 200, false) AS r_amt, COALESCE(prior_count >= 3, false) AS r_vel,
         COALESCE(previous_location IS NOT NULL AND previous_location <> '' AND current_location <> ''
                  AND previous_location <> current_location, false) AS r_loc,
         COALESCE(device_mismatch, false) AS r_dev
  FROM sc),
raw AS (
  SELECT *, CAST(0.10 + CASE WHEN r_amt THEN 0.30 ELSE 0 END + CASE WHEN r_vel THEN 0.20 ELSE 0 END
                 + CASE WHEN r_loc THEN 0.15 ELSE 0 END + CASE WHEN r_dev THEN 0.15 ELSE 0 END AS DECIMAL(4,2)) AS raw_score,
         list_filter([CASE WHEN r_amt THEN 'amount_anomaly' END, CASE WHEN r_vel THEN 'velocity_exceeded' END,
                      CASE WHEN r_loc THEN 'unusual_location' END,
                      CASE WHEN r_dev THEN 'device_fingerprint_mismatch' END], lambda x: x IS NOT NULL) AS base_alerts
  FROM ru),
bl AS (SELECT DISTINCT 'C' || CAST(c_custkey AS VARCHAR) AS customer_id FROM customer WHERE c_acctbal < 0),
lv AS (
  SELECT raw.*, CAST(LEAST(raw_score, 1.00) AS DECIMAL(3,2)) AS risk_score,
         CASE WHEN raw_score >= 0.75 THEN 'critical' WHEN raw_score >= 0.5 THEN 'high'
              WHEN raw_score >= 0.25 THEN 'medium' ELSE 'low' END AS risk_level,
         CASE WHEN bl.customer_id IS NOT NULL THEN list_concat(base_alerts, ['bin_blacklist']) ELSE base_alerts END AS bl_alerts
  FROM raw LEFT JOIN bl ON raw.customer_id = bl.customer_id),
scored AS (
  SELECT *, base_alerts AS alerts,
         CASE WHEN risk_level = 'critical' THEN 'block'
              WHEN risk_level = 'high' AND (list_contains(base_alerts, 'bin_blacklist') OR list_contains(base_alerts, 'velocity_by_ip')) THEN 'decline'
              WHEN risk_level = 'high' THEN 'review' WHEN risk_level = 'medium' THEN 'challenge' ELSE 'approve' END AS decision,
         CASE WHEN risk_level = 'critical' THEN 'block'
              WHEN risk_level = 'high' AND (list_contains(bl_alerts, 'bin_blacklist') OR list_contains(bl_alerts, 'velocity_by_ip')) THEN 'decline'
              WHEN risk_level = 'high' THEN 'review' WHEN risk_level = 'medium' THEN 'challenge' ELSE 'approve' END AS bl_decision
  FROM lv)
"""


def _sql(final: str) -> str:
    return SCORING_SQL + final


@register("velocity_count", _sql("SELECT transaction_id, customer_id, ts, prior_count FROM scored"))
def _velocity(ctx):
    return scoring_context(ctx).select("transaction_id", "customer_id", "ts", "prior_count")


@register("location_change", _sql("""SELECT transaction_id, previous_location, current_location, r_loc AS location_changed
FROM scored"""))
def _location(ctx):
    c = scoring_context(ctx)
    return c.select("transaction_id", "previous_location", "current_location",
                    fraud.rule_location("previous_location", "current_location").alias("location_changed"))


@register("rule_amount_anomaly", _sql("SELECT transaction_id, amount, r_amt AS amount_anomaly FROM scored"))
def _rule_amount(ctx):
    c = scoring_base(ctx)  # needs no history
    return c.select("transaction_id", "amount", fraud.rule_amount_anomaly("amount", AMOUNT_LIMIT).alias("amount_anomaly"))


@register("rule_velocity", _sql("SELECT transaction_id, prior_count, r_vel AS velocity_exceeded FROM scored"))
def _rule_velocity(ctx):
    c = scoring_context(ctx)
    return c.select("transaction_id", "prior_count",
                    fraud.rule_velocity("prior_count", VELOCITY_LIMIT).alias("velocity_exceeded"))


@register("rule_location", _sql("SELECT transaction_id, r_loc AS unusual_location FROM scored"))
def _rule_location(ctx):
    c = scoring_context(ctx)
    return c.select("transaction_id", fraud.rule_location("previous_location", "current_location").alias("unusual_location"))


@register("rule_device", _sql("SELECT transaction_id, r_dev AS device_fingerprint_mismatch FROM scored"))
def _rule_device(ctx):
    c = scoring_base(ctx)  # needs no history
    return c.select("transaction_id", fraud.rule_device("device_mismatch").alias("device_fingerprint_mismatch"))


SCORED_COLS = "transaction_id, customer_id, merchant_id, amount, risk_score, risk_level, alerts, decision"


@register("score_transactions", _sql(f"SELECT {SCORED_COLS}, 'pending' AS case_status FROM scored"))
def _score(ctx):
    return scored(ctx).select(*[c.strip() for c in SCORED_COLS.split(",")], "case_status")


@register("score_to_level", _sql("""SELECT risk_level, COUNT(*) AS transactions,
       CAST(SUM(risk_score) AS DECIMAL(38,2)) AS score_sum FROM scored GROUP BY risk_level"""))
def _score_levels(ctx):
    return scored(ctx).groupBy("risk_level").agg(F.count(F.lit(1)).alias("transactions"),
                                                 F.sum("risk_score").cast("decimal(38,2)").alias("score_sum"))


@register("decide", _sql("SELECT transaction_id, risk_level, alerts, decision FROM scored"))
def _decide(ctx):
    return scored(ctx).select("transaction_id", "risk_level", "alerts", "decision")


@register("extra_alerts", _sql("""SELECT transaction_id, risk_level, bl_alerts AS alerts, bl_decision AS decision
FROM scored"""))
def _extra_alerts(ctx):
    blacklist = (ctx.fx("customer").filter(F.col("c_acctbal") < 0)
                 .select(F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("customer_id")))
    base = fraud.blacklist_alerts(scoring_context(ctx), blacklist, "customer_id")
    out = fraud.score_transactions(base, rules(), F.col("extra_alerts"))
    return out.select("transaction_id", "risk_level", "alerts", "decision")


@register("is_high_risk", _sql("""SELECT transaction_id, risk_level, risk_level IN ('high', 'critical') AS is_high_risk
FROM scored"""))
def _is_high(ctx):
    return scored(ctx).select("transaction_id", "risk_level", risk.is_high_risk("risk_level").alias("is_high_risk"))


@register("should_decline", _sql("""SELECT transaction_id, decision, decision IN ('decline', 'block') AS should_decline
FROM scored"""))
def _should_decline(ctx):
    return scored(ctx).select("transaction_id", "decision", risk.should_decline("decision").alias("should_decline"))


@register("sink_topic_routing", _sql("""SELECT topic, transaction_id AS key,
       CAST(to_json({'transaction_id': transaction_id, 'risk_score': CAST(risk_score AS VARCHAR),
                'risk_level': risk_level, 'decision': decision}) AS VARCHAR) AS value
FROM scored, unnest(list_filter([CASE WHEN risk_level IN ('high', 'critical') THEN 'fraud.alerts' ELSE 'fraud.signals' END,
                                 CASE WHEN decision <> 'approve' THEN 'fraud.decisions' END], lambda x: x IS NOT NULL)) t(topic)"""))
def _routing(ctx):
    s = scored(ctx)
    value = F.to_json(F.struct("transaction_id", F.col("risk_score").cast("string").alias("risk_score"),
                               "risk_level", "decision"))
    return fraud.route_signals(s, "fraud", value)


@register("signal_to_json", _sql("""SELECT transaction_id, CAST(to_json({
    'transaction_id': transaction_id, 'risk_score': CAST(risk_score AS VARCHAR), 'risk_level': risk_level,
    'alerts': alerts, 'decision': decision, 'case_status': 'pending', 'case_id': CAST(NULL AS VARCHAR),
    'merchant_id': merchant_id, 'customer_id': customer_id, 'amount': CAST(amount AS VARCHAR), 'currency': currency,
    'ml_scores': MAP {}::MAP(VARCHAR, DOUBLE), 'created_at': strftime(ts, '%Y-%m-%dT%H:%M:%S'),
    'updated_at': strftime(ts, '%Y-%m-%dT%H:%M:%S'), 'metadata': {'engine': 'simple', 'context_used': true}})
  AS VARCHAR) AS signal_json
FROM scored"""))
def _signal_json(ctx):
    s = scored(ctx)
    return s.select("transaction_id", fraud.signal_json(s, "ts").alias("signal_json"))


# FIXED VALUES: a stored model version of the registered query (weights of features, intercept, threshold)
STORED_MODEL = ml.FraudModel({"amount": 0.0125, "prior_count": 0.375, "location_changed": 0.8125, "device_mismatch": 1.4375}, -3.5, 0.3125)


@register("ml_score", _sql("""
, f AS (SELECT transaction_id, COALESCE(CAST(amount AS DOUBLE), 0.0) AS a, COALESCE(CAST(prior_count AS DOUBLE), 0.0) AS v,
               CAST(r_loc AS INTEGER) AS l, CAST(r_dev AS INTEGER) AS d FROM scored),
p AS (SELECT transaction_id, 1.0::DOUBLE / (1.0::DOUBLE + exp(-(-3.5::DOUBLE + 0.0125::DOUBLE * a + 0.375::DOUBLE * v + 0.8125::DOUBLE * l + 1.4375::DOUBLE * d))) AS p FROM f),
s AS (SELECT transaction_id, p, CAST(round(CASE WHEN p < 0.3125 THEN p / 0.625::DOUBLE ELSE 0.5::DOUBLE + (p - 0.3125::DOUBLE) / 1.375::DOUBLE END, 2) AS DECIMAL(3,2)) AS risk_score FROM p),
lv2 AS (SELECT *, CASE WHEN risk_score >= 0.75 THEN 'critical' WHEN risk_score >= 0.5 THEN 'high' WHEN risk_score >= 0.25 THEN 'medium' ELSE 'low' END AS risk_level FROM s)
SELECT transaction_id, risk_score, risk_level,
       CASE risk_level WHEN 'critical' THEN 'block' WHEN 'high' THEN 'review' WHEN 'medium' THEN 'challenge' ELSE 'approve' END AS decision,
       'ml_prediction' AS alert, round(p, 6) AS model_score, round(greatest(p, 1 - p), 6) AS confidence
FROM lv2"""))
def _ml_score(ctx):
    """Signals of a stored model version: saved, published, loaded, scored."""
    root = scratch_path(ctx.spark, "fraud-model")
    ml.save_model(ctx.spark, STORED_MODEL, root)
    return _ml_signals(ctx, ml.load_model(ctx.spark, root))


def _ml_signals(ctx, model):
    s = ml.ml_score(ml.features(scoring_context(ctx)), model)
    return s.select("transaction_id", "risk_score", "risk_level", "decision", F.array_join("alerts", ",").alias("alert"),
                    F.round(F.col("ml_scores")["model_score"], 6).alias("model_score"), F.round(F.col("ml_scores")["confidence"], 6).alias("confidence"))


@register("ml_train_score")
def _ml_train_score(ctx):
    """Train on the chargebacks of the settlement table, publish the version and score with it (no SQL form: a fitted model)."""
    root = scratch_path(ctx.spark, "fraud-model")
    labels = ctx.fx("fx_settlement").select("transaction_id", F.col("chargeback_flag").cast("int").alias("label"))
    ml.train(ml.features(scoring_context(ctx)), labels, root)
    return _ml_signals(ctx, ml.load_model(ctx.spark, root))
