"""Pipeline B runner: five insert-only steps in order, each appending to its table.

The steps run in the reference's order, each reading its source and its target. There
is no transaction across steps; a crash between two steps is repaired by running
again, because every step only appends keys its target does not hold yet.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..operators import incremental as inc
from ..session import scratch_path
from ..sinks.tables import append_table, read_if_exists

TABLES = ["payment_validated", "fraud_enriched", "dim_merchant", "dim_customer", "fact_payments"]


def _path(state_dir: str, name: str) -> str:
    return os.path.join(state_dir, name)


def _read_target(spark: SparkSession, state_dir: str, name: str) -> DataFrame | None:
    return read_if_exists(spark, _path(state_dir, name))


def run_increment(spark: SparkSession, payments: DataFrame, signals: DataFrame, state_dir: str, as_of,
                  days: int = K.RETENTION_DAYS, prune_targets: bool = True) -> dict[str, int]:
    """Append the new rows of every step; returns the number of rows appended per table.
    ``prune_targets`` restricts the payment and fact anti joins to the retention window
    of the target (see ``incremental._recent``). The fact step stages its new payments first,
    so that only their signals are ranked."""
    appended: dict[str, int] = {}

    def stage(rows: DataFrame) -> DataFrame:
        path = scratch_path(spark, "increment-new-payments")
        rows.write.parquet(path)
        return spark.read.schema(rows.schema).parquet(path)

    def step(name: str, new_rows: DataFrame, columns: list[str]) -> None:
        # the new rows are written once; their count comes from the written files
        tmp = _path(state_dir, f"_staging_{name}")
        new_rows.select(*columns).write.mode("overwrite").parquet(tmp)
        staged = spark.read.parquet(tmp)
        appended[name] = staged.count()
        if appended[name]:
            append_table(staged, _path(state_dir, name), columns)

    step("payment_validated",
         inc.inc_payment_validated(payments, _read_target(spark, state_dir, "payment_validated"), as_of, days,
                                   prune_targets),
         inc.PAYMENT_VALIDATED_COLS)
    step("fraud_enriched", inc.inc_fraud_enriched(signals, _read_target(spark, state_dir, "fraud_enriched")),
         inc.FRAUD_ENRICHED_COLS)
    validated = spark.read.parquet(_path(state_dir, "payment_validated"))
    enriched = _read_target(spark, state_dir, "fraud_enriched")
    if enriched is None:  # no signal has ever landed: an empty table of the right shape
        enriched = inc.inc_fraud_enriched(signals, None).limit(0)
    step("dim_merchant", inc.inc_dim_merchant(validated, _read_target(spark, state_dir, "dim_merchant")),
         inc.DIM_COLS["merchant"])
    step("dim_customer", inc.inc_dim_customer(validated, _read_target(spark, state_dir, "dim_customer")),
         inc.DIM_COLS["customer"])
    step("fact_payments", inc.inc_fact_payments(validated, enriched, _read_target(spark, state_dir, "fact_payments"),
                                                as_of, days, prune_targets, stage),
         inc.FACT_PAYMENTS_COLS)
    return appended


def layer_counts(raw_payments: DataFrame, raw_signals: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """One row of table counts: the raw count plus scalar subqueries for the others."""
    sub = {
        "raw_fraud_signals": raw_signals,
        "silver_payments": tables["payment_validated"],
        "silver_fraud": tables["fraud_enriched"],
        "gold_merchants": tables["dim_merchant"],
        "gold_customers": tables["dim_customer"],
        "gold_facts": tables["fact_payments"],
    }
    cols = [F.count(F.lit(1)).alias("raw_payment_records")]
    out = raw_payments.agg(*cols)
    return out.select("raw_payment_records",
                      *[df.select(F.count(F.lit(1))).scalar().alias(name) for name, df in sub.items()])


KEYS = {"payment_validated": "payment_id", "fraud_enriched": "signal_id", "dim_merchant": "merchant_id",
        "dim_customer": "customer_id", "fact_payments": "payment_id"}


def run_increment_bucketed(spark: SparkSession, payments: DataFrame, signals: DataFrame, database: str, as_of,
                           buckets: int, days: int = K.RETENTION_DAYS) -> dict[str, int]:
    """Pipeline B with catalog targets bucketed (and sorted) by their key.

    Every increment anti-joins its batch against the whole target; with the target stored in
    ``buckets`` buckets of its key, that join reads the target bucket by bucket and only the
    (small) batch is shuffled into the same layout, so the growing history is never shuffled.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    appended: dict[str, int] = {}

    def target(name: str) -> DataFrame | None:
        full = f"{database}.{name}"
        return spark.table(full) if spark.catalog.tableExists(full) else None

    def step(name: str, new_rows: DataFrame, columns: list[str]) -> None:
        staged_path = scratch_path(spark, f"increment-{name}")
        new_rows.select(*columns).write.parquet(staged_path)  # written once, then counted and appended
        staged = spark.read.parquet(staged_path)
        appended[name] = staged.count()
        if appended[name] or target(name) is None:
            (staged.write.mode("append").format("parquet").bucketBy(buckets, KEYS[name]).sortBy(KEYS[name])
             .saveAsTable(f"{database}.{name}"))

    step("payment_validated", inc.inc_payment_validated(payments, target("payment_validated"), as_of, days),
         inc.PAYMENT_VALIDATED_COLS)
    step("fraud_enriched", inc.inc_fraud_enriched(signals, target("fraud_enriched")), inc.FRAUD_ENRICHED_COLS)
    validated, enriched = target("payment_validated"), target("fraud_enriched")
    step("dim_merchant", inc.inc_dim_merchant(validated, target("dim_merchant")), inc.DIM_COLS["merchant"])
    step("dim_customer", inc.inc_dim_customer(validated, target("dim_customer")), inc.DIM_COLS["customer"])
    step("fact_payments", inc.inc_fact_payments(validated, enriched, target("fact_payments")), inc.FACT_PAYMENTS_COLS)
    return appended
