"""Silver -> gold: dimensions, the gold fact and the three metric views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import casts, normalize, risk

MONEY_SUM = "decimal(38,2)"


def mean(c) -> Column:
    """AVG of a decimal column as DOUBLE: the exact decimal sum converted once, then one
    division. Any engine computing it this way gets the same double, bit for bit (a
    rounded average would not be: rounding a half differs between decimal and binary)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.sum(col).cast("double") / F.count(col)


def round4(c: Column) -> Column:
    return F.round(c.cast("double"), 4)


def money_sum(c) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.sum(col).cast(MONEY_SUM)


def count_when(cond: Column) -> Column:
    """COUNT(CASE WHEN cond THEN 1 END)."""
    return F.count(F.when(cond, F.lit(1)))


def date_key(ts) -> Column:
    """yyyyMMdd text key (equal to FORMAT_STRING('%04d%02d%02d', year, month, day))."""
    col = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(col, "yyyyMMdd")


# ---------------------------------------------------------------------------
# dimensions
# ---------------------------------------------------------------------------

def dim_date(spark: SparkSession, as_of, days: int = K.CALENDAR_DAYS) -> DataFrame:
    """Calendar of ``days + 1`` dates ending at the as_of date (731 rows by default).
    Generated from one row with ``explode(sequence(...))`` - no driver-side list."""
    end = casts.as_of_ts(as_of).cast("date")
    cal = spark.range(1).select(F.explode(F.sequence(F.date_sub(end, days), end)).alias("calendar_date"))
    d = F.col("calendar_date")
    return cal.select(
        date_key(d).alias("date_key"), d.alias("calendar_date"),
        F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"), F.weekofyear(d).alias("week_number"),
        F.dayofmonth(d).alias("day_of_month"), F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.when(F.dayofweek(d).isin(1, 7), 1).otherwise(0).alias("is_weekend"),
        F.when(F.month(d).isin(1, 4, 7, 10) & (F.dayofmonth(d) == 1), 1).otherwise(0).alias("is_quarter_start"),
    )


def dim_merchant(txn: DataFrame) -> DataFrame:
    """Distinct merchants with their transaction count (decision D-08: a true count)."""
    return (txn.groupBy("merchant_id").agg(F.count(F.lit(1)).alias("total_transactions"))
            .select("merchant_id", F.col("merchant_id").alias("merchant_code"),
                    normalize.entity_name("merchant_id", "Merchant_").alias("merchant_name"),
                    "total_transactions"))


def dim_customer(txn: DataFrame) -> DataFrame:
    """Distinct customers with count, AVG/MAX risk and DECLINED count (one aggregate,
    equal to the reference's DISTINCT over window totals)."""
    return (txn.groupBy("customer_id")
            .agg(F.count(F.lit(1)).alias("total_transactions"),
                 mean("risk_score").alias("avg_risk_score"),
                 F.max("risk_score").alias("max_risk_score"),
                 count_when(F.col("fraud_decision") == "DECLINED").alias("fraud_decline_count"))
            .select("customer_id", F.col("customer_id").alias("customer_code"),
                    normalize.entity_name("customer_id", "Customer_").alias("customer_name"),
                    "total_transactions", "avg_risk_score", "max_risk_score", "fraud_decline_count"))


def dim_payment_method(txn: DataFrame) -> DataFrame:
    m = F.col("payment_method")
    return (txn.select("payment_method").filter(m.isNotNull()).distinct()
            .select(m, m.alias("method_code"), normalize.method_name(m).alias("method_name"),
                    normalize.method_category(m).alias("method_category")))


# ---------------------------------------------------------------------------
# fact
# ---------------------------------------------------------------------------

def amount_buckets(df: DataFrame, amount: str = "amount", status: str = "status",
                   decision: str = "fraud_decision") -> DataFrame:
    a, s, d = F.col(amount), F.col(status), F.col(decision)
    zero = F.lit(0).cast("decimal(18,2)")

    def bucket(cond):
        return F.when(cond, a).otherwise(zero).cast("decimal(18,2)")

    return df.withColumns({
        "captured_amount": bucket(s == "CAPTURED"),
        "refunded_amount": bucket(s == "REFUNDED"),
        "failed_amount": bucket(s.isin("DECLINED", "FAILED")),
        "fraud_blocked_amount": bucket(d == "DECLINED"),
    })


def fact_transactions(txn: DataFrame) -> DataFrame:
    """gold.fact_transactions: projection of the silver fact + date key + amount buckets."""
    t = amount_buckets(txn)
    return t.select(
        "transaction_id", date_key("transaction_date").alias("date_key"), "merchant_id", "customer_id",
        "payment_method", F.col("amount").alias("transaction_amount"), "currency",
        F.col("amount").cast("decimal(18,2)").alias("amount_usd"),
        F.col("status").alias("payment_status"), "risk_score", "fraud_risk_level", "fraud_decision",
        "overall_risk_category", "captured_amount", "refunded_amount", "failed_amount",
        "fraud_blocked_amount", F.col("transaction_date").alias("transaction_timestamp"),
        F.col("payment_updated_at").alias("status_updated_at"))


# ---------------------------------------------------------------------------
# metric views
# ---------------------------------------------------------------------------

def metric_daily_payment_summary(calendar: DataFrame, fact: DataFrame) -> DataFrame:
    """Per calendar day, empty days included.

    The fact is first cut to the calendar's first..last day (scalar subqueries, so a fact
    partitioned or clustered by date_key is pruned at the scan) and semi-joined to the
    broadcast calendar (days + 1 rows, a bound set by the caller). The survivors are
    aggregated per day (map-side combine), so the per-day result has at most days + 1
    rows and is broadcast into the calendar join."""
    amt = F.col("transaction_amount")
    status = F.col("payment_status")
    keys = calendar.select("date_key")
    first_day, last_day = keys.select(F.min("date_key")).scalar(), keys.select(F.max("date_key")).scalar()
    in_calendar = (fact.filter(F.col("date_key").between(first_day, last_day))  # prunes date partitions
                   .join(F.broadcast(keys), on="date_key", how="left_semi"))
    per_day = in_calendar.groupBy("date_key").agg(
        F.count("transaction_id").alias("total_transactions"),
        F.count_distinct("merchant_id").alias("active_merchants"),
        F.count_distinct("customer_id").alias("active_customers"),
        money_sum(amt).alias("total_volume"),
        mean(amt).alias("avg_transaction_amount"),
        F.min(amt).alias("min_transaction_amount"),
        F.max(amt).alias("max_transaction_amount"),
        round4(F.stddev_samp(amt)).alias("stddev_transaction_amount"),
        count_when(status == "CAPTURED").alias("successful_transactions"),
        count_when(status.isin("DECLINED", "FAILED")).alias("failed_transactions"),
        count_when(F.col("fraud_decision") == "DECLINED").alias("fraud_blocked_transactions"),
        mean("risk_score").alias("avg_risk_score"),
        count_when(F.col("overall_risk_category") == "HIGH_RISK").alias("high_risk_count"),
        count_when(F.col("overall_risk_category") == "MEDIUM_RISK").alias("medium_risk_count"),
        count_when(F.col("overall_risk_category") == "LOW_RISK").alias("low_risk_count"),
        money_sum("captured_amount").alias("captured_volume"),
        money_sum("refunded_amount").alias("refunded_volume"),
        money_sum("fraud_blocked_amount").alias("fraud_blocked_volume"),
    )
    zero_if_empty = ["total_transactions", "active_merchants", "active_customers", "successful_transactions",
                     "failed_transactions", "fraud_blocked_transactions", "high_risk_count",
                     "medium_risk_count", "low_risk_count"]
    d = calendar.select("date_key", "calendar_date", "year", "quarter", "month_number", "month_name",
                        "week_number", "day_name")
    j = d.join(F.broadcast(per_day), on="date_key", how="left")
    return j.select(
        "calendar_date", "year", "quarter", "month_number", "month_name", "week_number", "day_name",
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) if c in zero_if_empty else F.col(c)
          for c in per_day.columns if c != "date_key"],
    ).withColumn("success_rate_pct",
                 risk.pct_rate(F.col("successful_transactions"), F.col("total_transactions")))


def metric_fraud_analytics(fact: DataFrame, merchants: DataFrame) -> DataFrame:
    """Per merchant fraud metrics. Aggregated before the dimension join, so the join is
    merchant-sized on both sides. Conditional counts follow decision D-07."""
    dec = F.col("fraud_decision")
    amt = F.col("transaction_amount")
    per_m = fact.groupBy("merchant_id").agg(
        F.count("transaction_id").alias("total_transactions"),
        F.count_distinct("customer_id").alias("unique_customers"),
        money_sum(amt).alias("total_volume"),
        count_when(dec == "DECLINED").alias("fraud_blocked_count"),
        money_sum(F.when(dec == "DECLINED", amt).otherwise(F.lit(0).cast("decimal(18,2)"))).alias(
            "fraud_blocked_volume"),
        mean("risk_score").alias("avg_risk_score"),
        F.max("risk_score").alias("max_risk_score"),
        count_when(F.col("overall_risk_category") == "HIGH_RISK").alias("high_risk_transactions"),
        count_when(F.col("overall_risk_category") == "MEDIUM_RISK").alias("medium_risk_transactions"),
        count_when(F.col("payment_status") == "CAPTURED").alias("successful_captures"),
        count_when(F.col("payment_status").isin("DECLINED", "FAILED")).alias("failed_transactions"),
    ).withColumn("fraud_block_rate_pct",
                 risk.pct_rate(F.col("fraud_blocked_count"), F.col("total_transactions")))
    return per_m.join(merchants.select("merchant_id", "merchant_name"), on="merchant_id", how="left")


def metric_customer_risk_profile(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Per customer risk profile with an exact median (percentile state is bounded by the
    number of distinct scores, at most 101 for DECIMAL(3,2))."""
    dec = F.col("fraud_decision")
    amt = F.col("transaction_amount")
    per_c = fact.groupBy("customer_id").agg(
        F.count("transaction_id").alias("transaction_count"),
        F.count_distinct("merchant_id").alias("merchant_count"),
        money_sum(amt).alias("total_volume"),
        mean("risk_score").alias("avg_risk_score"),
        (F.sum("risk_score") / F.count("risk_score")).alias("_avg_exact"),
        F.max("risk_score").alias("max_risk_score"),
        round4(F.median(F.col("risk_score").cast("double"))).alias("median_risk_score"),
        count_when(F.col("overall_risk_category") == "HIGH_RISK").alias("high_risk_count"),
        count_when(F.col("overall_risk_category") == "MEDIUM_RISK").alias("medium_risk_count"),
        count_when(F.col("payment_status") == "CAPTURED").alias("successful_transactions"),
        count_when(dec == "DECLINED").alias("fraud_blocked_count"),
        money_sum(F.when(dec == "DECLINED", amt).otherwise(F.lit(0).cast("decimal(18,2)"))).alias(
            "fraud_blocked_amount"),
        F.max("transaction_timestamp").alias("last_transaction_date"),
    )
    per_c = per_c.withColumn("risk_classification", risk.customer_risk_class(F.col("_avg_exact"))).drop("_avg_exact")
    return per_c.join(customers.select("customer_id", "customer_name"), on="customer_id", how="left")
