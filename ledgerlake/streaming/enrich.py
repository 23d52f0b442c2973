"""LEFT JOIN of a payment stream with a signal stream on the id alone, however far apart the two arrive.

A watermarked stream-stream join needs a time bound and loses what lies outside it. Here both sides are kept as tables, written
per micro-batch and partitioned by event day, and every batch joins what is new with what is known:

    new payments  x  signals known so far (this batch included)
    known payments  x  new signals

A payment without a signal stays pending. It expires once the newest payment time is more than ``expiry`` ahead of it; it then goes to the
enriched output with empty signal columns, as a LEFT JOIN has it, and to the dead-letter queue. Signals that come for an expired payment go to the
dead-letter queue too, and a signal waits for its payment as long as a payment for its signal. Rows older than the expiry are not read (their days are pruned), so a batch costs what the expiry holds.

    root/payments|signals/batch_id=<n>/day=<d>     what arrived
    root/joined/batch_id=<n>/day=<payment's day>   enriched payments of batch n
    root/dlq/batch_id=<n>                          expired payments and signals too late for them
    root/mark/batch_id=<n>                         newest payment time after batch n

Every batch reads only folders of earlier batches and overwrites its own, so a repeated batch decides the same. Both inputs come in one
streaming query as rows (side, p, s), so its checkpoint holds the order in which the two sides were seen. Hot ids: plain equi-joins
(adaptive execution splits skewed partitions); nothing is broadcast or collected but the mark, one value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sinks.tables import read_if_exists

PAYMENT, SIGNAL = "payment", "signal"


def both_sides(payments: DataFrame, signals: DataFrame) -> DataFrame:
    """One stream of rows (side, p, s): the structs hold the columns of their side."""
    p = F.struct(*[F.col(c) for c in payments.columns])
    s = F.struct(*[F.col(c) for c in signals.columns])
    p_type, s_type = payments.schema.simpleString(), signals.schema.simpleString()
    left = payments.select(F.lit(PAYMENT).alias("side"), p.alias("p"), F.lit(None).cast(s_type).alias("s"))
    return left.unionByName(signals.select(F.lit(SIGNAL).alias("side"), F.lit(None).cast(p_type).alias("p"), s.alias("s")))


class PendingJoin:
    def __init__(self, spark: SparkSession, root: str, payments: T.StructType, signals: T.StructType, key: str = "transaction_id",
                 p_ts: str = "event_ts", s_ts: str = "signal_ts", expiry: str = "7 days"):
        self.spark, self.root, self.key, self.p_ts, self.s_ts = spark, root.rstrip("/"), key, p_ts, s_ts
        self.schemas = {"payments": payments, "signals": signals}
        self.expiry = F.expr(f"INTERVAL {expiry}")

    def _known(self, name: str, ts: str, batch_id: int, since: Column | None) -> DataFrame | None:
        """Rows of earlier batches not older than ``since`` (days before it are not read)."""
        stored = T.StructType([*self.schemas[name].fields, T.StructField("batch_id", T.LongType()), T.StructField("day", T.DateType())])
        rows = read_if_exists(self.spark, f"{self.root}/{name}", stored)
        if rows is None:
            return None
        rows = rows.filter(F.col("batch_id") < batch_id)
        if since is not None:
            rows = rows.filter((F.col("day") >= since.cast("date")) & (F.col(ts) >= since))
        return rows.select(*self.schemas[name].fieldNames())

    def _store(self, rows: DataFrame, name: str, ts: str, batch_id: int) -> None:
        rows.withColumn("day", F.col(ts).cast("date")).write.mode("overwrite").partitionBy("day").parquet(f"{self.root}/{name}/batch_id={batch_id}")

    def _mark(self, batch_id: int) -> object:
        marks = read_if_exists(self.spark, f"{self.root}/mark", "mark timestamp, batch_id long")
        return None if marks is None else marks.filter(F.col("batch_id") < batch_id).agg(F.max("mark")).first()[0]

    def _matched_before(self, batch_id: int, since: Column | None) -> DataFrame | None:
        """Ids of the payments not older than ``since`` that an earlier batch joined with a signal."""
        rows = read_if_exists(self.spark, f"{self.root}/joined", f"{self.key} string, {self.p_ts} timestamp, {self.s_ts} timestamp, batch_id long, day date")
        if rows is None or since is None:
            return None
        return (rows.filter(F.col("batch_id") < batch_id).filter((F.col("day") >= since.cast("date")) & (F.col(self.p_ts) >= since) & F.col(self.s_ts).isNotNull())
                .select(F.col(self.key).alias("_met")))

    def _joined(self, payments: DataFrame, signals: DataFrame) -> DataFrame:
        s = signals.withColumnRenamed(self.key, "_s_key")
        return payments.join(s, F.col(self.key) == F.col("_s_key"), "inner").drop("_s_key")

    def _no_signal(self, payments: DataFrame) -> DataFrame:
        empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.schemas["signals"].fields if f.name != self.key]
        return payments.select("*", *empty)

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """The ``foreachBatch`` function."""
        spark, key = self.spark, self.key
        before = self._mark(batch_id)
        self._store(batch.filter(F.col("side") == PAYMENT).select("p.*"), "payments", self.p_ts, batch_id)
        self._store(batch.filter(F.col("side") == SIGNAL).select("s.*"), "signals", self.s_ts, batch_id)
        new = {n: spark.read.schema(self.schemas[n]).parquet(f"{self.root}/{n}/batch_id={batch_id}").select(*self.schemas[n].fieldNames()) for n in self.schemas}
        newest = new["payments"].agg(F.max(self.p_ts)).first()[0]
        now = max((m for m in (before, newest) if m is not None), default=None)

        since = None if before is None else F.lit(before).cast("timestamp") - self.expiry
        old_p, old_s = self._known("payments", self.p_ts, batch_id, since), self._known("signals", self.s_ts, batch_id, since)
        all_s = new["signals"] if old_s is None else old_s.unionByName(new["signals"])
        out = self._joined(new["payments"], all_s)
        pending = new["payments"]
        if old_p is not None:
            out = out.unionByName(self._joined(old_p, new["signals"]))
            pending = pending.unionByName(old_p)
        dead = spark.createDataFrame([], self._dead_schema())
        if now is not None:
            over = pending.filter(F.col(self.p_ts) < F.lit(now).cast("timestamp") - self.expiry)
            met = all_s.select(F.col(key).alias("_met"))
            before_met = self._matched_before(batch_id, since)  # their signals may be older than what is read of them now
            met = met if before_met is None else met.unionByName(before_met)
            expired = over.join(met, F.col(key) == F.col("_met"), "left_anti")
            out = out.unionByName(self._no_signal(expired))
            dead = dead.unionByName(self._dead(expired, self.p_ts, "no signal before expiry"))
        gone = read_if_exists(spark, f"{self.root}/dlq", T.StructType([*self._dead_schema().fields, T.StructField("batch_id", T.LongType())]))
        if gone is not None:
            gone = gone.filter((F.col("batch_id") < batch_id) & (F.col("error") == "no signal before expiry")).select(F.col(key).alias("_gone"))
            dead = dead.unionByName(self._dead(new["signals"].join(gone, F.col(key) == F.col("_gone"), "left_semi"), self.s_ts, "signal after its payment expired"))
        self._store(out, "joined", self.p_ts, batch_id)
        dead.write.mode("overwrite").parquet(f"{self.root}/dlq/batch_id={batch_id}")
        spark.createDataFrame([(now,)], "mark timestamp").coalesce(1).write.mode("overwrite").parquet(f"{self.root}/mark/batch_id={batch_id}")

    def _dead_schema(self) -> T.StructType:
        return T.StructType([T.StructField(self.key, T.StringType()), T.StructField("event_ts", T.TimestampType()), T.StructField("error", T.StringType())])

    def _dead(self, rows: DataFrame, ts: str, error: str) -> DataFrame:
        return rows.select(F.col(self.key), F.col(ts).alias("event_ts"), F.lit(error).alias("error"))

    def enriched(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/joined").drop("batch_id", "day")

    def dead_letters(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/dlq").drop("batch_id")
