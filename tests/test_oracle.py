"""Every registered query against its DuckDB oracle on sf0.001 (the driver runs sf0.01)."""

import pytest

import __spark_entry__ as E
from ledgerlake.plans import registry
from tests.conftest import SF_SMALL
from tools.oracle_check import compare_one

QUERIES = registry.queries()
SQLS = registry.oracle_sql()
BATCH = sorted(n for n in QUERIES if not n.startswith("st") and n not in (
    "pipeline_bronze_events", "pipeline_dlq", "src_stream_payments", "src_stream_signals", "src_settlement_files", "join_fraud_stream",
    "dedupe_stream_latest", "alert_stream_lag"))
STREAM = sorted(n for n in QUERIES if n not in BATCH)


def test_every_query_has_a_check():
    rows_only = sorted(n for n in QUERIES if n not in SQLS)
    # the operators that cannot be one SQL statement (model fit, a stream's own progress)
    assert set(rows_only) <= {"ml_train_score", "alert_stream_lag"}, rows_only


@pytest.mark.parametrize("name", BATCH)
def test_batch_query_matches_oracle(spark, duck, name):
    status, detail = compare_one(spark, duck, QUERIES, SQLS, name, SF_SMALL)
    assert status in ("OK", "ROWS"), f"{name}: {status} {detail}"


@pytest.mark.parametrize("name", STREAM)
def test_stream_query_matches_oracle(spark, duck, name):
    status, detail = compare_one(spark, duck, QUERIES, SQLS, name, SF_SMALL)
    assert status in ("OK", "ROWS"), f"{name}: {status} {detail}"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "fraud_block_rate_pct" in df.columns
