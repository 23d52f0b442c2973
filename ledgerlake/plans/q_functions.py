"""Registered queries of the scalar-function families the pipelines use,
each over the cleaned payments or the silver fact."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import casts, crypto
from .oracle_sql import AS_OF_SQL, sql_with
from .registry import register


@register("string", sql_with(["payments_cleaned"], """
SELECT payment_id, upper(currency) AS currency_upper, lower(payment_method_normalized) AS method_lower,
       concat('Merchant_', merchant_id) AS merchant_label, customer_id || '/' || merchant_id AS pair_key,
       CAST(length(payment_id) AS INTEGER) AS id_length, payment_id LIKE 'PAY_00000%' AS low_id,
       format('{:04d}{:02d}{:02d}', year(payment_created_at), month(payment_created_at), day(payment_created_at)) AS date_key
FROM payments_cleaned"""))
def _string(ctx):
    p = ctx.med.payments_cleaned
    t = F.col("payment_created_at")
    return p.select("payment_id", F.upper("currency").alias("currency_upper"),
                    F.lower("payment_method_normalized").alias("method_lower"),
                    F.concat(F.lit("Merchant_"), "merchant_id").alias("merchant_label"),
                    F.concat_ws("/", "customer_id", "merchant_id").alias("pair_key"),
                    F.length("payment_id").alias("id_length"), F.col("payment_id").like("PAY_00000%").alias("low_id"),
                    F.format_string("%04d%02d%02d", F.year(t), F.month(t), F.dayofmonth(t)).alias("date_key"))


@register("date", sql_with(["transactions_fact"], """
SELECT transaction_id, CAST(year(transaction_date) AS INTEGER) AS year, CAST(quarter(transaction_date) AS INTEGER) AS quarter,
       CAST(month(transaction_date) AS INTEGER) AS month, CAST(day(transaction_date) AS INTEGER) AS day,
       CAST(dayofweek(transaction_date) + 1 AS INTEGER) AS day_of_week, monthname(transaction_date) AS month_name,
       dayname(transaction_date) AS day_name, CAST(date_trunc('month', transaction_date) AS DATE) AS month_start,
       CAST(transaction_date AS DATE) - 7 AS week_before, CAST(week(transaction_date) AS INTEGER) AS week_number
FROM transactions_fact"""))
def _date(ctx):
    t = F.col("transaction_date")
    return ctx.med.transactions_fact.select(
        "transaction_id", F.year(t).alias("year"), F.quarter(t).alias("quarter"), F.month(t).alias("month"),
        F.dayofmonth(t).alias("day"), F.dayofweek(t).alias("day_of_week"),
        F.date_format(t, "MMMM").alias("month_name"), F.date_format(t, "EEEE").alias("day_name"),
        F.date_trunc("month", t).cast("date").alias("month_start"), F.date_sub(t.cast("date"), 7).alias("week_before"),
        F.weekofyear(t).alias("week_number"))


@register("time", sql_with(["transactions_fact"], f"""
SELECT transaction_id, date_diff('second', transaction_date, payment_updated_at) AS seconds_to_update,
       transaction_date >= {AS_OF_SQL} - INTERVAL 30 DAY AS last_30_days,
       CAST({AS_OF_SQL} - INTERVAL 90 DAY AS TIMESTAMP) AS retention_cutoff
FROM transactions_fact"""))
def _time(ctx):
    t = ctx.med.transactions_fact
    as_of = casts.as_of_ts(ctx.as_of)
    return t.select(
        "transaction_id",
        F.timestamp_diff("SECOND", F.col("transaction_date"), F.col("payment_updated_at")).alias("seconds_to_update"),
        (F.col("transaction_date") >= as_of - F.make_interval(days=F.lit(30))).alias("last_30_days"),
        (as_of - F.make_interval(days=F.lit(90))).alias("retention_cutoff"))


@register("null", sql_with(["payments_with_fraud"], """
SELECT payment_id, COALESCE(f_decision, 'NO_DECISION') AS decision, NULLIF(fraud_risk_level, 'NOT_EVALUATED') AS level_or_null,
       COALESCE(f_score, CAST(0 AS DECIMAL(3,2))) AS score
FROM payments_with_fraud"""))
def _null(ctx):
    p = ctx.med.payments_cleaned.alias("p").join(ctx.med.fraud_signals_cleaned.alias("f"),
                                                  F.col("p.payment_id") == F.col("f.transaction_id"), "left")
    level = F.coalesce(F.col("f.risk_level"), F.lit("NOT_EVALUATED"))
    return p.select(F.col("p.payment_id"), F.coalesce(F.col("f.decision_normalized"), F.lit("NO_DECISION")).alias("decision"),
                    F.nullif(level, F.lit("NOT_EVALUATED")).alias("level_or_null"),
                    F.coalesce(F.col("f.risk_score"), F.lit(0).cast("decimal(3,2)")).alias("score"))


@register("array", sql_with(["transactions_fact"], """
SELECT transaction_id, CAST(d AS DATE) AS active_day
FROM transactions_fact, unnest(generate_series(CAST(transaction_date AS DATE), CAST(payment_updated_at AS DATE),
                                               INTERVAL 1 DAY)) t(d)"""))
def _array(ctx):
    t = ctx.med.transactions_fact
    return t.select("transaction_id", F.explode(F.sequence(F.col("transaction_date").cast("date"),
                                                           F.col("payment_updated_at").cast("date"))).alias("active_day"))


@register("struct", sql_with(["transactions_fact"], """
SELECT transaction_id, customer_id AS who, risk_score AS score FROM transactions_fact"""))
def _struct(ctx):
    t = ctx.med.transactions_fact
    packed = t.select("transaction_id", F.struct(F.col("customer_id").alias("who"),
                                                 F.col("risk_score").alias("score")).alias("s"))
    return packed.select("transaction_id", "s.who", "s.score")


@register("json", sql_with(["fraud_signals_cleaned"], """
SELECT signal_id, CAST(json_array_length(alerts) AS INTEGER) AS n_alerts,
       list_contains(from_json(alerts, '["VARCHAR"]'), 'amount_anomaly') AS has_amount_alert
FROM fraud_signals_cleaned"""))
def _json(ctx):
    s = ctx.med.fraud_signals_cleaned
    arr = F.from_json("alerts", "array<string>")
    return s.select("signal_id", F.size(arr).alias("n_alerts"),
                    F.array_contains(arr, "amount_anomaly").alias("has_amount_alert"))


@register("hash", sql_with(["payments_cleaned"], "SELECT payment_id, sha256(payment_id) AS id_sha256 FROM payments_cleaned"))
def _hash(ctx):
    return ctx.med.payments_cleaned.select("payment_id", crypto.hash_column("payment_id", 256).alias("id_sha256"))


@register("identity", sql_with(["payments_cleaned"], "SELECT payment_id, true AS loaded_by_session_user FROM payments_cleaned"))
def _identity(ctx):
    """Every row carries the session's user (its name differs by machine, so the row states the match)."""
    rows = ctx.med.payments_cleaned.select("payment_id", F.current_user().alias("loaded_by"))
    user = ctx.spark.sparkContext.sparkUser()
    return rows.select("payment_id", (F.col("loaded_by") == user).alias("loaded_by_session_user"))


@register("math", sql_with(["transactions_fact"], """
SELECT transaction_id, CAST(LEAST(risk_score * 2, 1.00) AS DECIMAL(5,2)) AS doubled_score_capped,
       CAST(round(amount / 3, 2) AS DECIMAL(18,2)) AS third_of_amount, CAST(risk_score AS DOUBLE) * 100 AS score_pct
FROM transactions_fact"""))
def _math(ctx):
    t = ctx.med.transactions_fact
    return t.select("transaction_id",
                    F.least(F.col("risk_score") * 2, F.lit(1).cast("decimal(3,2)")).alias("doubled_score_capped"),
                    F.round(F.col("amount") / 3, 2).cast("decimal(18,2)").alias("third_of_amount"),
                    (F.col("risk_score").cast("double") * 100).alias("score_pct"))
