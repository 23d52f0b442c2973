"""Pipeline C batch stages: canonical silver, fact with settlement, MERGE, reconciliation, alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import crypto
from ..sinks.tables import overwrite_partitions

SILVER_TRANSACTION_COLS = ["transaction_id", "merchant_id", "payment_method", "event_ts", "status", "risk_score",
                           "tokenized_pan", "ingestion_date"]
SILVER_SETTLEMENT_COLS = ["settlement_id", "transaction_id", "settlement_date", "amount", "fee", "chargeback_flag",
                          "ingestion_date"]
FACT_C_COLS = ["transaction_id", "merchant_id", "payment_method", "event_ts", "status", "risk_score",
               "settlement_date", "amount", "fee", "chargeback_flag"]
MERGE_UPDATE_COLS = ["settlement_date", "amount", "fee", "chargeback_flag"]


def bronze_events(payments: DataFrame, signals: DataFrame, cards: DataFrame, key: str | crypto.KeyRef) -> DataFrame:
    """Batch form of the streaming bronze: payment events with the fraud score of their
    signal and the card number replaced by its token (cards: customer_id, card_number)."""
    tok = cards.select("customer_id", crypto.token_for("card_number", key).alias("tokenized_pan"))
    sig = signals.select(F.col("transaction_id"), F.col("risk_score"))
    return (payments.join(sig, on="transaction_id", how="left")
            .join(tok, on="customer_id", how="left")
            .withColumn("ingestion_date", F.col("event_ts").cast("date")))


def canonicalize_payments(bronze: DataFrame) -> DataFrame:
    return bronze.select(*SILVER_TRANSACTION_COLS)


def canonicalize_settlement(bronze: DataFrame) -> DataFrame:
    return bronze.select(*SILVER_SETTLEMENT_COLS)


def fact_payment_transactions(transactions: DataFrame, settlement: DataFrame) -> DataFrame:
    """transactions LEFT JOIN settlement on transaction_id."""
    s = settlement.select("transaction_id", "settlement_date", "amount", "fee", "chargeback_flag")
    return transactions.join(s, on="transaction_id", how="left").select(*FACT_C_COLS)


def distinct_values(transactions: DataFrame, cols: list[str]) -> DataFrame:
    """SELECT DISTINCT per dimension, in long form (dimension, value)."""
    out = None
    for c in cols:
        one = transactions.select(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("value")).distinct()
        out = one if out is None else out.unionByName(one)
    return out


def merge_settlement(fact: DataFrame, settlement: DataFrame, key: str = "transaction_id") -> DataFrame:
    """MERGE INTO fact USING settlement ON key: matched rows take the four settlement
    columns from the source, unmatched source rows are inserted with the other columns
    NULL, unmatched target rows stay. Written as one full outer join (one shuffle of
    each side on the key). The source key must be unique (checked by ``assert_unique``)."""
    src = settlement.select(key, *MERGE_UPDATE_COLS).withColumn("_src", F.lit(True))
    joined = fact.alias("t").join(src.alias("s"), on=key, how="full_outer")
    matched = F.col("s._src").isNotNull()
    cols = []
    for c in fact.columns:
        if c == key:
            cols.append(F.col(key))
        elif c in MERGE_UPDATE_COLS:
            cols.append(F.when(matched, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            cols.append(F.col(f"t.{c}").alias(c))
    return joined.select(*cols)


def merge_settlement_by_day(spark: SparkSession, fact_path: str, settlement: DataFrame, schema, day_col: str,
                            staging_path: str, key: str = "transaction_id") -> str:
    """MERGE into a fact stored by ``day_col``, rewriting only the days that the settlement touches: those
    that hold a matched row, and the day-less partition where unmatched settlement rows are inserted.
    The merged days are written to ``staging_path`` first and replace their partitions from there, so the
    fact is never overwritten by a plan that reads it. Running it again changes nothing.

    The list of touched days (one value per day of the fact, whatever its rows) is read by the
    driver, so that the scan prunes the other partitions."""
    fact = spark.read.schema(schema).parquet(fact_path)
    keys = settlement.select(key)
    days = [r[0] for r in fact.select(key, day_col).join(keys, on=key, how="left_semi").select(day_col).distinct().collect()]
    touched = fact.filter(F.col(day_col).isin([d for d in days if d is not None]) | F.col(day_col).isNull())
    merged = merge_settlement(touched, settlement, key)
    merged.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields]).write.mode("overwrite").parquet(staging_path)
    return overwrite_partitions(spark.read.schema(schema).parquet(staging_path), fact_path, [day_col])


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once (a MERGE source must return none)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def assert_unique(df: DataFrame, key: str) -> None:
    dup = duplicate_keys(df, key).limit(1).collect()
    if dup:
        raise ValueError(f"MERGE source has duplicate {key}: {dup[0][key]!r}")


def reconcile_mismatches(fact: DataFrame, settlement: DataFrame, key: str = "transaction_id") -> DataFrame:
    """fact LEFT JOIN settlement WHERE amount or date differ (unmatched rows drop out by
    three-valued logic, as in the specification)."""
    f, s = fact.alias("f"), settlement.alias("s")
    j = f.join(s, F.col(f"f.{key}") == F.col(f"s.{key}"), "left")
    cond = (F.col("f.amount") != F.col("s.amount")) | (F.col("f.settlement_date") != F.col("s.settlement_date"))
    return j.filter(cond).select(F.col(f"f.{key}").alias(key), F.col("f.amount").alias("fact_amount"),
                                 F.col("s.amount").alias("settlement_amount"), F.col("f.settlement_date"),
                                 F.col("s.settlement_date").alias("settlement_file_date"))


def reconcile_full(fact: DataFrame, settlement: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Every disagreement, missing rows included: MISSING_IN_SETTLEMENT, MISSING_IN_FACT,
    AMOUNT_MISMATCH, DATE_MISMATCH (null-safe comparisons)."""
    f = fact.select(key, F.col("amount").alias("fact_amount"), F.col("settlement_date").alias("fact_date"),
                    F.lit(True).alias("_in_f"))
    s = settlement.select(key, F.col("amount").alias("settlement_amount"),
                          F.col("settlement_date").alias("settlement_file_date"), F.lit(True).alias("_in_s"))
    j = f.join(s, on=key, how="full_outer")
    issue = (F.when(F.col("_in_s").isNull(), F.lit("MISSING_IN_SETTLEMENT"))
             .when(F.col("_in_f").isNull(), F.lit("MISSING_IN_FACT"))
             .when(~F.col("fact_amount").eqNullSafe(F.col("settlement_amount")), F.lit("AMOUNT_MISMATCH"))
             .when(~F.col("fact_date").eqNullSafe(F.col("settlement_file_date")), F.lit("DATE_MISMATCH")))
    return (j.withColumn("issue", issue).filter(F.col("issue").isNotNull())
            .select(key, "issue", "fact_amount", "settlement_amount", "fact_date", "settlement_file_date"))


def dq_alert_mismatch(mismatches: DataFrame, max_count: int = K.MAX_MISMATCH_COUNT) -> DataFrame:
    """One row: mismatch count, threshold, whether to alert."""
    return mismatches.agg(F.count(F.lit(1)).alias("mismatch_count")).select(
        F.lit("payment_reconciliation_mismatches").alias("table_name"), "mismatch_count",
        F.lit(max_count).alias("threshold"), (F.col("mismatch_count") > max_count).alias("alert"))


def alert_fraud_spike(daily: DataFrame, max_pct: float = K.FRAUD_SPIKE_PCT) -> DataFrame:
    """Days whose fraud-blocked share of transactions exceeds ``max_pct`` percent."""
    share = (F.col("fraud_blocked_transactions").cast("double")
             / F.when(F.col("total_transactions") != 0, F.col("total_transactions")) * F.lit(100.0))
    return (daily.withColumn("blocked_pct", share).filter(F.col("blocked_pct") > F.lit(max_pct))
            .select("calendar_date", "total_transactions", "fraud_blocked_transactions", "blocked_pct"))


def backfill_replay(bronze: DataFrame, start, end, date_col: str = "ingestion_date") -> DataFrame:
    """Rebuild silver rows for [start, end] from bronze; the date filter prunes partitions
    of a bronze table partitioned by ``date_col``."""
    rows = bronze.filter(F.col(date_col).between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return canonicalize_payments(rows)


def backfill_replay_write(bronze: DataFrame, start, end, silver_path: str, date_col: str = "ingestion_date") -> str:
    """Replay [start, end] from bronze into a silver table partitioned by ``date_col``,
    replacing only those days (dynamic partition overwrite); other days stay as they are."""
    return overwrite_partitions(backfill_replay(bronze, start, end, date_col), silver_path, [date_col])
