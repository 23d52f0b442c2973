"""Streaming upsert: the latest row per key, whatever time lies between its versions.

A session window or a watermark forgets a key; here the versions go to a table instead. Every micro-batch keeps its latest row per
key and writes it to a change log, partitioned by key bucket. Every ``compact_every`` batches the buckets that changed are folded into a new
base (one row per key) and the new bases are published by one small table of (bucket, upto), written last. A reader takes, per
bucket, the published base and the log batches after it.

    root/log/batch_id=<n>/bucket=<b>     latest row per key of batch n
    root/base/upto=<n>/bucket=<b>        one row per key over all batches up to n
    root/published/upto=<n>              the buckets whose base is ``upto=<n>``

A repeated batch overwrites its own folders and a batch that a base already holds is not read again, so delivering a batch twice changes
nothing; a compaction that dies before it publishes leaves a base that nobody reads. A compaction rewrites the changed buckets only, and the
bucket count is fixed for the life of the table, so its cost follows the changes. Within a batch the latest row is taken on the map side first:
a key with a third of all rows leaves each task as one row.

"Latest" is a total order: ``order_by`` columns, then all columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sinks.tables import read_if_exists

BUCKETS = 32


def latest_rows(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """One row per key: the greatest by ``order_by``, then by all columns. Null keys are one key."""
    cols = df.columns
    row = F.struct(*[F.col(c) for c in cols])
    order = F.struct(*[F.col(c) for c in order_by], *[F.col(c) for c in cols])
    return df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.max_by(row, order).alias("_r")).select("_r.*")


class UpsertTable:
    """The paths and rules of one upserted table; ``schema`` is that of its rows."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, keys: list[str], order_by: list[str], buckets: int = BUCKETS):
        self.spark, self.root, self.schema, self.keys, self.order_by, self.buckets = spark, root.rstrip("/"), schema, keys, order_by, buckets

    def _read(self, name: str, tag: str) -> DataFrame | None:
        stored = T.StructType([*self.schema.fields, T.StructField(tag, T.LongType()), T.StructField("bucket", T.IntegerType())])
        return read_if_exists(self.spark, f"{self.root}/{name}", stored)

    def published(self) -> DataFrame | None:
        """bucket, upto: the newest published base of every bucket that has one (at most ``buckets`` rows)."""
        marks = read_if_exists(self.spark, f"{self.root}/published", "bucket int, upto long")
        return None if marks is None else marks.groupBy("bucket").agg(F.max("upto").alias("upto"))

    def append(self, batch: DataFrame, batch_id: int) -> None:
        """Write the batch's latest rows to the log (replacing an earlier attempt of the same batch)."""
        bucket = F.pmod(F.hash(*self.keys), F.lit(self.buckets))
        (latest_rows(batch.select(*self.schema.fieldNames()), self.keys, self.order_by).withColumn("bucket", bucket)
         .write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/log/batch_id={batch_id}"))

    def _open_log(self, marks: DataFrame | None, last: int | None = None) -> DataFrame:
        log = self._read("log", "batch_id")
        if log is None:
            return self.spark.createDataFrame([], T.StructType([*self.schema.fields, T.StructField("bucket", T.IntegerType())]))
        if last is not None:
            log = log.filter(F.col("batch_id") <= last)
        if marks is not None:
            log = log.join(F.broadcast(marks), "bucket", "left").filter("upto is null or batch_id > upto")
        return log.select(*self.schema.fieldNames(), "bucket")

    def _bases(self, marks: DataFrame | None) -> DataFrame | None:
        base = None if marks is None else self._read("base", "upto")
        return None if base is None else base.join(F.broadcast(marks), ["bucket", "upto"]).select(*self.schema.fieldNames(), "bucket")

    def compact(self, last: int) -> None:
        """Fold the log up to batch ``last`` into new bases of the buckets it touches, then publish them."""
        marks = self.published()
        if marks is not None:
            done = marks.agg(F.max("upto")).first()[0]
            if done is not None and done >= last:  # a repeated batch: this compaction is published
                return
        changes = self._open_log(marks, last)
        touched = changes.select("bucket").distinct()
        bases = self._bases(marks)
        rows = changes if bases is None else changes.unionByName(bases.join(F.broadcast(touched), "bucket", "left_semi"))
        target = f"{self.root}/base/upto={last}"
        (latest_rows(rows, self.keys, self.order_by).write.mode("overwrite").partitionBy("bucket").parquet(target))
        self.spark.read.schema("bucket int").parquet(target).distinct().coalesce(1).write.mode("overwrite").parquet(f"{self.root}/published/upto={last}")

    def read(self) -> DataFrame:
        """One row per key: the published bases and the log after them."""
        marks = self.published()
        bases, log = self._bases(marks), self._open_log(marks)
        rows = log if bases is None else bases.unionByName(log)
        return latest_rows(rows, self.keys, self.order_by).select(*self.schema.fieldNames())

    def writer(self, compact_every: int = 16) -> Callable[[DataFrame, int], None]:
        """The ``foreachBatch`` function of a stream of versions."""
        def write(batch: DataFrame, batch_id: int) -> None:
            self.append(batch, batch_id)
            if (batch_id + 1) % compact_every == 0:
                self.compact(batch_id)

        return write
