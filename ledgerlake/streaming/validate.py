"""Schema validation, dead-letter routing and late-row routing for streams.

Validation is one projection (PERMISSIVE JSON parse + required-field checks) that adds
``is_valid``/``error``; routing happens in ``foreachBatch`` where the micro-batch is
persisted once and written to two sinks. Each batch writes into its own
``batch_id=<n>`` folder with overwrite, so a retried batch replaces its own output and
the result stays exactly-once.
"""

from __future__ import annotations

import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sinks.tables import read_if_exists

CORRUPT = "_corrupt_record"


def schema_validate(stream: DataFrame, payload: str, schema: T.StructType, required: list[str]) -> DataFrame:
    """Adds the parsed fields, ``is_valid`` and ``error`` (malformed JSON or the first
    missing required field). The raw payload is kept for the dead-letter queue."""
    with_corrupt = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType(), True)])
    doc = F.from_json(F.col(payload), with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    # The parse is the output of a one-row explode: a later filter on validity can then not be
    # pushed below it by inlining the parse, so every payload is parsed exactly once.
    parsed = stream.select("*", F.explode(F.array(doc)).alias("_p"))
    err = F.when(F.col(payload).isNull(), F.lit("empty payload")).when(F.col(f"_p.{CORRUPT}").isNotNull(),
                                                                       F.lit("malformed json"))
    for name in required:
        err = err.when(F.col(f"_p.{name}").isNull(), F.lit(f"missing {name}"))
    fields = [F.col(f"_p.{f.name}").alias(f.name) for f in schema.fields]
    return parsed.select(payload, *fields, err.alias("error")).withColumn("is_valid", F.col("error").isNull())


def _batch_path(root: str, batch_id: int) -> str:
    return os.path.join(root, f"batch_id={batch_id}")


def dlq_writer(good_path: str, dlq_path: str, good_cols: list[str] | None = None,
               partition_by: list[str] | None = None) -> Callable[[DataFrame, int], None]:
    """foreachBatch function: valid rows -> good sink, invalid rows + dlq_ts -> DLQ."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            good = batch.filter(F.col("is_valid"))
            good = good.select(*good_cols) if good_cols else good.drop("is_valid", "error")
            w = good.write.mode("overwrite")
            if partition_by:
                w = w.partitionBy(*partition_by)
            w.parquet(_batch_path(good_path, batch_id))
            (batch.filter(~F.col("is_valid")).withColumn("dlq_ts", F.current_timestamp())
             .write.mode("overwrite").parquet(_batch_path(dlq_path, batch_id)))
        finally:
            batch.unpersist()

    return write


def write_files(rows: DataFrame, path: str, files: int) -> None:
    """Write ``rows`` as exactly ``files`` files; where they fill fewer, each file in their place holds one row of nulls."""
    rows.coalesce(files).write.mode("overwrite").option("maxRecordsPerFile", 0).parquet(path)
    missing = files - len(rows.sparkSession.read.schema(rows.schema).parquet(path).inputFiles())
    if missing:
        empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields]
        rows.sparkSession.range(0, missing, 1, missing).select(*empty).write.mode("append").parquet(path)


def late_router(ts: str, delay_seconds: int, good_path: str, dlq_path: str, hwm_path: str,
                validated: bool = False, good_files: int = 0) -> Callable:
    """foreachBatch function that sends rows older than (high-water mark - delay) to the
    DLQ instead of dropping them silently. The high-water mark of every batch is stored
    in ``hwm_path`` (one small file per batch), so a restart continues from it. With
    ``validated`` the rows come from ``schema_validate``: invalid ones go to the DLQ with
    their own error and do not move the mark, and the good sink gets no payload. With
    ``good_files`` every batch of the good sink has that number of files (``write_files``) and its
    files are at least a second older than those of the next, so a file stream can take them batch by batch."""

    def current_hwm(spark, batch_id: int) -> object:
        marks = read_if_exists(spark, hwm_path)
        if marks is None:
            return None
        # a retried batch must not see its own earlier attempt
        return marks.filter(F.col("batch_id") < batch_id).agg(F.max("hwm")).first()[0]

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        hwm = current_hwm(spark, batch_id)
        batch.persist()
        try:
            if hwm is None:
                late = F.lit(False)
            else:
                late = F.col(ts) < (F.lit(hwm).cast("timestamp") - F.expr(f"INTERVAL {delay_seconds} SECONDS"))
            error = F.when(F.coalesce(late, F.lit(False)), F.lit("late event"))
            if validated:
                error = F.coalesce(F.col("error"), error)
            tagged = batch.withColumn("error", error)
            good = tagged.filter(F.col("error").isNull()).drop("error", *(["payload", "is_valid"] if validated else []))
            if good_files:
                write_files(good, _batch_path(good_path, batch_id), good_files)
            else:
                good.write.mode("overwrite").parquet(_batch_path(good_path, batch_id))
            written = time.monotonic()
            (tagged.filter(F.col("error").isNotNull()).withColumn("dlq_ts", F.current_timestamp())
             .write.mode("overwrite").parquet(_batch_path(dlq_path, batch_id)))
            seen = batch.filter("is_valid") if validated else batch
            (seen.agg(F.max(ts).alias("hwm")).withColumn("batch", F.lit(batch_id))
             .write.mode("overwrite").parquet(_batch_path(hwm_path, batch_id)))
            if good_files:  # a storage may keep times in whole seconds
                time.sleep(max(0.0, written + 1.1 - time.monotonic()))
        finally:
            batch.unpersist()

    return write
