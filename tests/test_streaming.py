"""Stream behaviours that a single SQL statement cannot state."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.conftest import SF_SMALL

QUERIES = E.queries()


def test_late_rows_go_to_the_dlq_and_nothing_is_lost(spark):
    routed = QUERIES["st5_late_to_dlq"](spark, SF_SMALL)
    valid = QUERIES["src_stream_payments"](spark, SF_SMALL)
    counts = {r["route"]: r["n"] for r in routed.groupBy("route").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert counts.get("dlq", 0) > 0, counts       # out-of-order arrival produces late rows
    assert sum(counts.values()) == valid.count()  # every valid event is either on time or in the DLQ


def test_subscribe_sees_every_signal_once(spark):
    per_decision = QUERIES["st9_subscribe"](spark, SF_SMALL)
    total = per_decision.agg(F.sum("signals")).first()[0]
    assert total == QUERIES["src_stream_signals"](spark, SF_SMALL).count()


def test_stream_lag_rows(spark):
    lag = QUERIES["alert_stream_lag"](spark, SF_SMALL).collect()
    assert lag and all(r["batch_id"] is not None for r in lag)
    assert any(r["lag_seconds"] is not None and r["lag_seconds"] > 60 for r in lag)  # replayed history lags


def test_settlement_ingest_can_skip_existing_files(spark):
    import time

    from ledgerlake.session import scratch_path
    from ledgerlake.streaming import jobs
    drop = scratch_path(spark, "test-drop")
    header = ["settlement_id", "transaction_id", "settlement_date", "amount", "fee", "chargeback_flag"]
    old = spark.createDataFrame([("S1", "T1", "2024-01-01", "1.00", "0.01", "false")], header)
    old.write.option("header", "true").csv(drop)
    ckpt = scratch_path(spark, "test-drop-ckpt")
    jobs.first_start_time(spark, ckpt)          # the query "starts" now
    time.sleep(1.5)
    new = spark.createDataFrame([("S2", "T2", "2024-01-02", "2.00", "0.02", "true"),
                                 ("S3", "T3", "2024-01-02", "x", "0.02", "true")], header)
    new.write.mode("append").option("header", "true").csv(drop)
    bronze, dlq = scratch_path(spark, "test-bronze"), scratch_path(spark, "test-dlq")
    jobs.start_settlement_ingest(spark, drop, bronze, dlq, ckpt, include_existing=False).awaitTermination()
    assert [r["settlement_id"] for r in spark.read.parquet(bronze).collect()] == ["S2"]
    assert [r["error"] for r in spark.read.parquet(dlq).collect()] == ["bad amount"]


def test_kafka_source_needs_the_connector(spark):
    import pytest

    from ledgerlake.streaming import sources
    with pytest.raises(Exception, match="(?i)kafka"):
        sources.kafka_payload_stream(spark, "localhost:9092", "fraud_signals")
