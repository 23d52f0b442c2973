"""The reference's documented usage queries over the metric views, plus lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import casts


def filter_high_block_rate(fraud_metrics: DataFrame, min_pct: float = 1.0) -> DataFrame:
    return (fraud_metrics.filter(F.col("fraud_block_rate_pct") > F.lit(min_pct))
            .orderBy(F.col("fraud_block_rate_pct").desc(), "merchant_id"))


def filter_recent_days(daily: DataFrame, as_of, days: int = 7) -> DataFrame:
    start = F.date_sub(casts.as_of_ts(as_of).cast("date"), days)
    return daily.filter(F.col("calendar_date") >= start).orderBy(F.col("calendar_date").desc())


def recent_daily_summary(calendar: DataFrame, fact: DataFrame, as_of, days: int = 7) -> DataFrame:
    """The same rows as ``filter_recent_days`` over the full daily view, but the view is
    built over the last ``days`` of the calendar, so only those days of the fact are read
    (the calendar bounds reach the fact scan)."""
    from .gold import metric_daily_payment_summary
    start = F.date_sub(casts.as_of_ts(as_of).cast("date"), days)
    daily = metric_daily_payment_summary(calendar.filter(F.col("calendar_date") >= start), fact)
    return daily.orderBy(F.col("calendar_date").desc())


def filter_risky_customers(profile: DataFrame, classes=("HIGH_RISK", "VERY_HIGH_RISK"),
                           order_by: str = "transaction_count") -> DataFrame:
    return (profile.filter(F.col("risk_classification").isin(*classes))
            .orderBy(F.col(order_by).desc(), "customer_id"))


def top_n(df: DataFrame, order: list, n: int) -> DataFrame:
    """ORDER BY ... LIMIT n with a total order (callers append key columns, D-05).
    Spark plans this as TakeOrderedAndProject: a per-partition top-n, then a final merge."""
    return df.orderBy(*order).limit(n)


def rows_with_key(df: DataFrame, col: str, value) -> DataFrame:
    """All rows of one key (signals of a transaction, ledger rows of a payment, one id)."""
    return df.filter(F.col(col) == F.lit(value))
