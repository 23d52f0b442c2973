"""Full-refresh medallion job: raw -> silver -> gold, as one lazy DAG.

``Medallion`` exposes every layer as a DataFrame. Nothing is materialised until a
caller writes or collects; ``run`` writes the two tables worth persisting (the silver
fact and the gold fact) and serves the metric views from them.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from .. import constants as K
from ..operators import gold, silver


@dataclass
class Medallion:
    spark: SparkSession
    payments_raw: DataFrame
    fraud_raw: DataFrame
    as_of: str
    days: int = K.RETENTION_DAYS
    calendar_days: int = K.CALENDAR_DAYS
    overrides: dict = field(default_factory=dict)

    def _get(self, name: str, build):
        return self.overrides[name] if name in self.overrides else build()

    @cached_property
    def payments_cleaned(self) -> DataFrame:
        return self._get("payments_cleaned", lambda: silver.clean_payments(self.payments_raw, self.as_of, self.days))

    @cached_property
    def fraud_signals_cleaned(self) -> DataFrame:
        return self._get("fraud_signals_cleaned",
                         lambda: silver.clean_fraud_signals(self.fraud_raw, self.as_of, self.days))

    @cached_property
    def payments_with_fraud(self) -> DataFrame:
        return silver.join_payment_fraud(self.payments_cleaned, self.fraud_signals_cleaned)

    @cached_property
    def transactions_fact(self) -> DataFrame:
        return self._get("transactions_fact",
                         lambda: silver.transactions_fact(self.payments_cleaned, self.fraud_signals_cleaned))

    @cached_property
    def dim_date(self) -> DataFrame:
        return gold.dim_date(self.spark, self.as_of, self.calendar_days)

    @cached_property
    def dim_merchant(self) -> DataFrame:
        return self._get("dim_merchant", lambda: gold.dim_merchant(self.transactions_fact))

    @cached_property
    def dim_customer(self) -> DataFrame:
        return self._get("dim_customer", lambda: gold.dim_customer(self.transactions_fact))

    @cached_property
    def dim_payment_method(self) -> DataFrame:
        return self._get("dim_payment_method", lambda: gold.dim_payment_method(self.transactions_fact))

    @cached_property
    def fact_transactions(self) -> DataFrame:
        return self._get("fact_transactions", lambda: gold.fact_transactions(self.transactions_fact))

    @cached_property
    def metric_daily_payment_summary(self) -> DataFrame:
        return gold.metric_daily_payment_summary(self.dim_date, self.fact_transactions)

    @cached_property
    def metric_fraud_analytics(self) -> DataFrame:
        return gold.metric_fraud_analytics(self.fact_transactions, self.dim_merchant)

    @cached_property
    def metric_customer_risk_profile(self) -> DataFrame:
        return gold.metric_customer_risk_profile(self.fact_transactions, self.dim_customer)

    def run(self, out_dir: str, partition_by: list[str] | None = None, views: tuple[str, ...] = ()) -> "Medallion":
        """Write silver.transactions_fact, gold.fact_transactions, the three key dimensions and the
        ``views`` asked for as a new version of ``out_dir`` and publish it; returns a Medallion whose metric
        views read the tables back (this also cuts the lineage of everything built on top).

        All tables of a refresh become visible together: they go to ``out_dir/v=<n>`` and a marker written
        last publishes the version (``tables.published_path`` finds a table). A refresh that fails leaves the
        version before it in place.

        The gold fact is range-clustered by (date_key, transaction_id), so files cover
        contiguous dates and parquet statistics skip files and row groups on date filters; pass
        ``partition_by=["date_key"]`` when days are large enough to deserve their own folders.
        """
        from ..sinks.tables import next_version, publish_version, version_path, write_table
        version = next_version(self.spark, out_dir)
        base = version_path(out_dir, version)
        txn_path = f"{base}/silver/transactions_fact"
        write_table(self.transactions_fact, txn_path)
        txn = self.spark.read.parquet(txn_path)
        fact_path = f"{base}/gold/fact_transactions"
        fact = gold.fact_transactions(txn)
        # range-clustered by day: files cover contiguous dates, so date filters skip whole files;
        # transaction_id as the second key lets one very large day spread over several files
        clustered = fact.repartitionByRange("date_key", "transaction_id").sortWithinPartitions("date_key")
        write_table(clustered, fact_path, partition_by=partition_by)
        fact = self.spark.read.schema(fact.schema).parquet(fact_path).select(*fact.columns)
        overrides = {"transactions_fact": txn, "fact_transactions": fact}

        def staged() -> "Medallion":
            return Medallion(self.spark, self.payments_raw, self.fraud_raw, self.as_of, self.days, self.calendar_days,
                             overrides=overrides)

        for dim in ("dim_merchant", "dim_customer", "dim_payment_method"):  # per-key tables, built from txn
            path = f"{base}/gold/{dim}"
            write_table(getattr(staged(), dim), path)
            overrides[dim] = self.spark.read.parquet(path)
        done = staged()
        for view in views:
            write_table(getattr(done, view), f"{base}/gold/{view}")
        publish_version(self.spark, out_dir, version)
        return done
