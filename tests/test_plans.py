"""Physical-plan assertions: the plans we rely on for scale are the plans Spark picks."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

QUERIES = E.queries()
SQLS = E.oracle_sql()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in SQLS if not n.startswith("st") and "stream" not in n
                                        and n not in ("src_settlement_files", "sink_view")))
def test_no_python_in_batch_plans(spark, name):
    p = plan(QUERIES[name](spark, SF_SMALL))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_dedupe_limits_before_the_shuffle(spark):
    p = plan(QUERIES["transactions_fact"](spark, SF_SMALL))
    # one WindowGroupLimit below the exchange (map side) and one above it, per side
    assert p.count("WindowGroupLimit") >= 4, p


def test_not_in_is_an_anti_join(spark):
    for name in ("anti_existing_payments", "inc_payment_validated", "inc_fact_payments"):
        p = plan(QUERIES[name](spark, SF_SMALL))
        assert "LeftAnti" in p and "BroadcastNestedLoopJoin" not in p, name


def test_calendar_is_broadcast_and_fact_not_shuffled_for_it(spark):
    p = plan(QUERIES["join_calendar_fact"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in p and "BuildRight" in p


def test_metrics_aggregate_before_dimension_join(spark):
    p = plan(QUERIES["metric_fraud_analytics"](spark, SF_SMALL))
    # the merchant join sits above the per-merchant aggregate, not below it
    join_at = min(i for i in (p.find("SortMergeJoin"), p.find("BroadcastHashJoin")) if i >= 0)
    assert p.find("HashAggregate") > join_at


def test_scan_prunes_columns_and_pushes_filters(spark):
    df = QUERIES["signals_for_transaction"](spark, SF_SMALL)
    p = plan(df)
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in p or "PushedFilters" in p


def test_velocity_windows_are_bucketed(spark):
    p = plan(QUERIES["velocity_count"](spark, SF_SMALL))
    assert "Window" in p and "_b" in p and "Join" not in p  # by (customer, time bucket), no self-join


def test_daily_summary_prunes_date_partitions(spark):
    from ledgerlake.plans.context import Ctx
    from ledgerlake.session import scratch_path
    published = Ctx(spark, SF_SMALL).med.run(scratch_path(spark, "test-dpp"), partition_by=["date_key"])
    df = published.metric_daily_payment_summary
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "date_key" in p and ("dynamicpruning" in p or "Subquery" in p)
    assert df.count() == 731


def test_parses_run_once_per_row(spark):
    p = plan(QUERIES["clean_payments"](spark, SF_SMALL))
    assert p.count("try_cast(") <= 3, p.count("try_cast(")  # amount, created_at, updated_at: once each
