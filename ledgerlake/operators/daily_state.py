"""The daily payment summary as mergeable state: a late batch is merged into its days, nothing is counted again.

Every batch of fact rows leaves one row of sums per day and, for the exact distinct counts, bitmaps: merchants and customers get dense numbers
from a growing dictionary, and a bitmap of 32,768 numbers is one 4 KB value per (day, measure, number range). Merging days is adding
sums and OR-ing bitmaps, so the summary of any day is exact whatever the order and number of the batches that held its rows.

    root/ids/batch=<n>/measure=<m>     the batch's new values and their numbers
    root/sums/batch=<n>                one row per day of the batch
    root/bits/batch=<n>/measure=<m>    bitmaps of the batch

A batch reads the dictionary of earlier batches only and overwrites its own folders: delivering it again changes nothing. The rows of a batch are
reduced to distinct (day, value) pairs on the map side before they meet the dictionary; numbers are dealt out by range partition (rank within it
plus the counts of those before), never in one task. The standard deviation comes from exact decimal sums of squares.

A transaction is taken to be in one batch only, as the fact has one row per transaction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import risk
from ..sinks.tables import read_if_exists
from .gold import round4

MEASURES = {"active_merchants": "merchant_id", "active_customers": "customer_id"}
SUMMED = ["total_transactions", "successful_transactions", "failed_transactions", "fraud_blocked_transactions", "high_risk_count", "medium_risk_count", "low_risk_count"]
VOLUMES = {"total_volume": "transaction_amount", "captured_volume": "captured_amount", "refunded_volume": "refunded_amount", "fraud_blocked_volume": "fraud_blocked_amount"}


def _mean(total: Column, n: Column) -> Column:
    return total.cast("double") / F.when(n != 0, n)


class DailyState:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # ---- batches ------------------------------------------------------------------

    def add(self, fact: DataFrame, batch: int) -> None:
        """Merge a batch of fact rows (an earlier attempt of the same batch is replaced)."""
        fact = fact.filter(F.col("date_key").isNotNull())
        self._sums(fact).write.mode("overwrite").parquet(f"{self.root}/sums/batch={batch}")
        for measure, column in MEASURES.items():
            pairs = fact.select("date_key", F.col(column).cast("string").alias("value")).filter("value is not null").distinct()
            staged = f"{self.root}/staged/batch={batch}/measure={measure}"
            pairs.write.mode("overwrite").parquet(staged)
            pairs = self.spark.read.parquet(staged)
            known = self._ids(measure, batch)
            fresh = self._numbered(pairs.select("value").distinct().join(known, "value", "left_anti"), known, f"{staged}-ranges")
            ids = f"{self.root}/ids/batch={batch}/measure={measure}"
            fresh.write.mode("overwrite").parquet(ids)
            numbers = known.unionByName(self.spark.read.schema("value string, id long").parquet(ids))
            bits = (pairs.join(numbers, "value").groupBy("date_key", F.bitmap_bucket_number("id").alias("bucket"))
                    .agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits")))
            bits.write.mode("overwrite").parquet(f"{self.root}/bits/batch={batch}/measure={measure}")

    def _ids(self, measure: str, before: int) -> DataFrame:
        rows = read_if_exists(self.spark, f"{self.root}/ids", "value string, id long, batch int, measure string")
        if rows is None:
            return self.spark.createDataFrame([], "value string, id long")
        return rows.filter((F.col("measure") == measure) & (F.col("batch") < before)).select("value", "id")

    def _numbered(self, values: DataFrame, known: DataFrame, staged: str) -> DataFrame:
        """value, id: numbers after the known ones, without gaps."""
        start = known.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
        values.repartitionByRange("value").withColumn("part", F.spark_partition_id()).write.mode("overwrite").parquet(staged)
        spread = self.spark.read.schema("value string, part int").parquet(staged)
        earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range partition
        heads = spread.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("head"))
        rank = F.row_number().over(Window.partitionBy("part").orderBy("value"))
        return spread.withColumn("rank", rank).join(heads, "part").select("value", (F.col("rank") + F.col("head") + F.lit(start)).cast("long").alias("id"))

    @staticmethod
    def _sums(fact: DataFrame) -> DataFrame:
        amount, status, category = F.col("transaction_amount"), F.col("payment_status"), F.col("overall_risk_category")

        def count(cond):
            return F.count_if(F.coalesce(cond, F.lit(False)))

        return fact.groupBy("date_key").agg(
            F.count("transaction_id").alias("total_transactions"), count(status == "CAPTURED").alias("successful_transactions"),
            count(status.isin("DECLINED", "FAILED")).alias("failed_transactions"), count(F.col("fraud_decision") == "DECLINED").alias("fraud_blocked_transactions"),
            *[count(category == f"{level}_RISK").alias(f"{level.lower()}_risk_count") for level in ("HIGH", "MEDIUM", "LOW")],
            *[F.sum(c).cast("decimal(38,2)").alias(n) for n, c in VOLUMES.items()],
            F.count(amount).alias("n_amounts"), F.sum(amount * amount).cast("decimal(38,4)").alias("squares"), F.min(amount).alias("min_transaction_amount"),
            F.max(amount).alias("max_transaction_amount"), F.sum("risk_score").cast("decimal(38,2)").alias("risk_sum"), F.count("risk_score").alias("n_risks"))

    # ---- the summary ----------------------------------------------------------------

    def per_day(self) -> DataFrame:
        """date_key and every measure, merged over all batches."""
        sums = self.spark.read.parquet(f"{self.root}/sums").drop("batch").groupBy("date_key").agg(
            *[F.sum(c).alias(c) for c in SUMMED], *[F.sum(c).cast("decimal(38,2)").alias(c) for c in VOLUMES], F.sum("n_amounts").alias("n_amounts"),
            F.sum("squares").cast("decimal(38,4)").alias("squares"), F.min("min_transaction_amount").alias("min_transaction_amount"),
            F.max("max_transaction_amount").alias("max_transaction_amount"), F.sum("risk_sum").cast("decimal(38,2)").alias("risk_sum"), F.sum("n_risks").alias("n_risks"))
        n, total = F.col("n_amounts"), F.col("total_volume")
        spread = (n.cast("decimal(20,0)") * F.col("squares") - total * total).cast("double") / F.when(n > 1, n.cast("double") * (n - 1))
        sums = sums.select("date_key", *SUMMED, *VOLUMES, _mean(total, n).alias("avg_transaction_amount"), "min_transaction_amount", "max_transaction_amount",
                           round4(F.sqrt(spread)).alias("stddev_transaction_amount"), _mean(F.col("risk_sum"), F.col("n_risks")).alias("avg_risk_score"))
        bits = (self.spark.read.parquet(f"{self.root}/bits").groupBy("measure", "date_key", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
                .groupBy("date_key").agg(*[F.sum(F.when(F.col("measure") == m, F.bitmap_count("bits"))).alias(m) for m in MEASURES]))
        return sums.join(bits, "date_key", "left")

    def summary(self, calendar: DataFrame) -> DataFrame:
        """The rows of ``gold.metric_daily_payment_summary`` for a calendar."""
        zero = [*SUMMED, *MEASURES]
        days = calendar.select("date_key", "calendar_date", "year", "quarter", "month_number", "month_name", "week_number", "day_name")
        merged = self.per_day()
        rows = days.join(merged, "date_key", "left")
        return rows.select(*[c for c in days.columns if c != "date_key"], *[F.coalesce(c, F.lit(0)).alias(c) if c in zero else F.col(c) for c in merged.columns if c != "date_key"]) \
                   .withColumn("success_rate_pct", risk.pct_rate(F.col("successful_transactions"), F.col("total_transactions")))
