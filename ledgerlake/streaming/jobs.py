"""Streaming jobs of the specification: each returns a started ``StreamingQuery``.

Every query has its own checkpoint folder (under the shared checkpoint dir), so a
restarted driver or a lost executor resumes from the last committed batch.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sinks.tables import read_if_exists
from .. import constants as K
from .. import schemas
from ..functions import crypto
from ..operators import fraud
from . import sources, stateful, validate


def _trigger(writer, available_now: bool):
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")


@contextmanager
def session_conf(spark: SparkSession, conf: dict[str, str]):
    """Start a query with ``conf``. A streaming query snapshots the session conf when it starts (its
    state partitions and state provider hold for the life of its checkpoint), so the session
    values are set only around ``start()`` and then restored."""
    before = {key: spark.conf.get(key, None) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def state_partitions(spark: SparkSession, n: int | None):
    """Start a stateful query with ``n`` state partitions."""
    return session_conf(spark, {"spark.sql.shuffle.partitions": str(n)} if n else {})


# State in RocksDB, on the executors' disks: their heap does not hold it. Its caches and write buffers share one bounded part of
# an executor's memory, however many state partitions it has; counting the state's rows would read before every write. Evicted
# rows are compacted away with their batch: the search for a key's sessions would otherwise step over all those next to it.
STATE_ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.compactOnCommit": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


def start_file_sink(df: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None,
                    available_now: bool = True, mode: str = "append",
                    n_state_partitions: int | None = None, state_on_disk: bool = False) -> StreamingQuery:
    """st6: append a stream to a (partitioned) parquet table with a checkpoint."""
    w = df.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint)
    if partition_by:
        w = w.partitionBy(*partition_by)
    spark = df.sparkSession
    with state_partitions(spark, n_state_partitions), session_conf(spark, STATE_ON_DISK if state_on_disk else {}):
        return _trigger(w, available_now).start(path)


def start_validated_ingest(spark: SparkSession, src_path: str, good_path: str, dlq_path: str, checkpoint: str,
                           schema=schemas.PAYMENT_EVENT, required=None, max_files: int = 1,
                           available_now: bool = True) -> StreamingQuery:
    """st1 + st2: validate JSON payloads, valid rows -> good sink, invalid -> DLQ with dlq_ts."""
    required = required or schemas.PAYMENT_EVENT_REQUIRED
    stream = sources.payload_stream(spark, src_path, max_files)
    checked = validate.schema_validate(stream, "payload", schema, required)
    w = checked.writeStream.foreachBatch(validate.dlq_writer(good_path, dlq_path)).option("checkpointLocation",
                                                                                          checkpoint)
    return _trigger(w, available_now).start()


def run_bronze_pipeline(spark: SparkSession, payments_path: str, signals_path: str, bronze_path: str, dlq_path: str,
                        work_dir: str, key: str | crypto.KeyRef, late_after_seconds: int, n_state_partitions: int | None = None,
                        max_files: int = 1, max_signal_files: int | None = None) -> None:
    """The whole payment stream: validate -> tokenise -> late and invalid rows to the DLQ -> join the
    fraud signals -> dedupe -> bronze partitioned by ``ingestion_date``.

    Two queries, as rows must be routed before a stateful operator drops the late ones. The first
    reads payloads and writes accepted, tokenised events and the DLQ; no card number is stored. The
    second joins and dedupes the accepted events, with its state on disk. Those of one micro-batch of the
    first span any time, so they must meet the watermark together: each accepted batch has the same number
    of files, and the second query takes one batch at a time. Its state so holds what the watermark
    leaves open, not the backlog. Both resume from their checkpoints in ``work_dir``."""
    accepted = f"{work_dir}/accepted"
    files = accepted_batch_files(spark, work_dir, accepted, max(max_files, n_state_partitions or 1))
    raw = sources.payload_stream(spark, payments_path, max_files)
    checked = validate.schema_validate(raw, "payload", schemas.PAYMENT_EVENT, schemas.PAYMENT_EVENT_REQUIRED)
    tokenised = tokenize_stream(checked, "card_number", key)
    router = validate.late_router("event_ts", late_after_seconds, accepted, dlq_path, f"{work_dir}/high_water", validated=True,
                                  good_files=files)
    first = _trigger(tokenised.writeStream.foreachBatch(router)
                     .option("checkpointLocation", f"{work_dir}/checkpoint_accept"), True).start()
    first.awaitTermination()

    schema = spark.read.parquet(accepted).drop("batch_id").schema
    reader = spark.readStream.schema(schema)
    if files:
        reader = reader.option("maxFilesPerTrigger", files)
    events = reader.parquet(f"{accepted}/batch_id=*").filter(F.col("transaction_id").isNotNull())  # not the rows of filling files
    delay = f"{late_after_seconds} seconds"
    signals = sources.stream_signals(spark, signals_path, max_signal_files or max_files)
    # a watermark drops a row of just its time, which the router accepts: one second more
    joined = stateful.stream_join(events, signals, bound="1 hour", before="1 hour", delay=f"{late_after_seconds + 1} seconds")
    enriched = joined.select("p.*", "s.risk_score", "s.decision")
    latest = stateful.dedupe_latest(enriched, "transaction_id", "event_ts", delay, watermarked=True)
    out = latest.withColumn("ingestion_date", F.col("event_ts").cast("date"))
    start_file_sink(out, bronze_path, f"{work_dir}/checkpoint_bronze", ["ingestion_date"],
                    n_state_partitions=n_state_partitions, state_on_disk=True).awaitTermination()


def accepted_batch_files(spark: SparkSession, work_dir: str, accepted: str, wanted: int) -> int:
    """The number of files of an accepted batch, fixed by the first start for the life of ``work_dir``; 0 (any
    number, read without limit) where accepted batches are older than this rule."""
    def first() -> str:
        return str(wanted if read_if_exists(spark, accepted) is None else 0)

    return int(_kept_value(spark, f"{work_dir}/accepted_files", first))


def _kept_value(spark: SparkSession, marker: str, first: Callable[[], str]) -> str:
    """The text in ``marker``; the first caller writes it."""
    known = read_if_exists(spark, marker, "value string", "text")
    if known is None:
        value = first()
        spark.createDataFrame([(value,)], "value string").coalesce(1).write.mode("errorifexists").text(marker)
        return value
    return known.first()[0]


def first_start_time(spark: SparkSession, checkpoint: str) -> str:
    """The time this query first started, kept next to its checkpoint so that restarts
    reuse it (files that arrive while the query is down are still read)."""
    def now() -> str:
        return spark.range(1).select(F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]

    return _kept_value(spark, f"{checkpoint.rstrip('/')}_first_start", now)


def start_settlement_ingest(spark: SparkSession, src_dir: str, bronze_path: str, dlq_path: str, checkpoint: str,
                            max_files: int = K.SETTLEMENT_FILES_PER_TRIGGER, available_now: bool = True,
                            include_existing: bool = True) -> StreamingQuery:
    """st11: settlement CSV drop -> typed, validated bronze partitioned by settlement_date; bad rows -> DLQ.
    ``include_existing=False`` ignores files already in the folder when the query first started."""
    since = None if include_existing else first_start_time(spark, checkpoint)
    raw = sources.stream_settlement(spark, src_dir, max_files, since)
    typed = raw.select(
        "settlement_id", "transaction_id",
        F.col("settlement_date").try_cast("date").alias("settlement_date"),
        F.col("amount").try_cast("decimal(18,2)").alias("amount"),
        F.col("fee").try_cast("decimal(18,2)").alias("fee"),
        F.col("chargeback_flag").try_cast("boolean").alias("chargeback_flag"),
        F.struct(*[F.col(c) for c in raw.columns]).alias("_raw"))
    err = (F.when(F.col("transaction_id").isNull(), F.lit("missing transaction_id"))
           .when(F.col("settlement_date").isNull(), F.lit("bad settlement_date"))
           .when(F.col("amount").isNull(), F.lit("bad amount"))
           .when(F.col("_raw.fee").isNotNull() & F.col("fee").isNull(), F.lit("bad fee"))
           .when(F.col("_raw.chargeback_flag").isNotNull() & F.col("chargeback_flag").isNull(),
                 F.lit("bad chargeback_flag")))
    checked = (typed.withColumn("error", err).withColumn("is_valid", F.col("error").isNull())
               .withColumn("ingestion_date", F.current_date()))
    good_cols = [f.name for f in schemas.SETTLEMENT.fields] + ["ingestion_date"]
    writer = validate.dlq_writer(bronze_path, dlq_path, good_cols, partition_by=["settlement_date"])
    w = checked.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint)
    return _trigger(w, available_now).start()


def tokenize_stream(stream: DataFrame, col: str, key: str | crypto.KeyRef, out_col: str = "tokenized_pan") -> DataFrame:
    """st10: replace a card column by its deterministic token (stateless, so in-flight)."""
    return stream.withColumn(out_col, crypto.token_for(col, key)).drop(col)


def route_signals_stream(signals: DataFrame, prefix: str = "fraud") -> DataFrame:
    """st8: topic routing on a stream (the same operator as in batch)."""
    value = F.to_json(F.struct(*[F.col(c) for c in signals.columns]))
    return fraud.route_signals(signals, prefix, value)


def subscribe(stream: DataFrame, callback: Callable[[DataFrame, int], None], checkpoint: str,
              errors: list | None = None, available_now: bool = True) -> StreamingQuery:
    """st9: call ``callback(batch_df, batch_id)`` per micro-batch. A failing callback stops the query, so
    the batch is delivered again after a restart; with a list ``errors`` it is recorded there and the
    stream goes on without that batch."""

    def safe(batch: DataFrame, batch_id: int) -> None:
        try:
            callback(batch, batch_id)
        except Exception as e:  # noqa: BLE001 - a subscriber may fail in any way
            if errors is None:
                raise
            errors.append((batch_id, repr(e)))

    w = stream.writeStream.foreachBatch(safe).option("checkpointLocation", checkpoint)
    return _trigger(w, available_now).start()


def lag_rows(query: StreamingQuery) -> list[dict]:
    """Per recent batch: event-time watermark and its lag behind the batch's trigger time."""
    rows = []
    for p in query.recentProgress:
        wm = (p.get("eventTime") or {}).get("watermark")
        rows.append({"batch_id": int(p["batchId"]), "trigger_ts": p["timestamp"], "watermark": wm,
                     "num_input_rows": int(p.get("numInputRows", 0))})
    return rows


def alert_stream_lag(spark: SparkSession, progress: list[dict], max_seconds: int = K.STREAM_LAG_SECONDS) -> DataFrame:
    """Rows per batch with lag_seconds = trigger time - watermark and alert = lag > max."""
    schema = "batch_id long, trigger_ts string, watermark string, num_input_rows long"
    df = spark.createDataFrame(progress, schema)
    trig = F.to_timestamp("trigger_ts")
    wm = F.to_timestamp("watermark")
    lag = F.unix_timestamp(trig) - F.unix_timestamp(wm)
    return df.select("batch_id", "num_input_rows", trig.alias("trigger_ts"), wm.alias("watermark"),
                     lag.alias("lag_seconds"), F.coalesce(lag > F.lit(max_seconds), F.lit(False)).alias("alert"))
