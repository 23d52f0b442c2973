"""The command-line jobs end to end on sf0.001 landings."""

import io
import json
from contextlib import redirect_stdout

from pyspark.sql import functions as F

import __spark_entry__ as E
from ledgerlake.__main__ import main
from ledgerlake.plans.context import Ctx
from ledgerlake.session import scratch_path
from ledgerlake.sinks import tables as sinks
from ledgerlake.sources.fixtures import AS_OF
from ledgerlake.sources.typed import to_fraud_signals_typed, to_payment_transactions
from tests.conftest import SF_SMALL


def run(argv):
    buf = io.StringIO()
    with redirect_stdout(buf):
        main(argv)
    return json.loads(buf.getvalue().strip().splitlines()[-1])


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_medallion_job_matches_registered_query(spark):
    ctx = Ctx(spark, SF_SMALL)
    raw = scratch_path(spark, "cli-raw")
    ctx.fx("fx_payments_raw").write.parquet(f"{raw}/payments")
    ctx.fx("fx_fraud_signals_raw").write.parquet(f"{raw}/signals")
    out = scratch_path(spark, "cli-out")
    run(["medallion", "--payments", f"{raw}/payments", "--signals", f"{raw}/signals", "--out", out, "--as-of", AS_OF])
    got = spark.read.parquet(sinks.published_path(spark, out, "gold/metric_fraud_analytics"))
    want = E.queries()["metric_fraud_analytics"](spark, SF_SMALL)
    assert rows(got.select(*want.columns)) == rows(want)


def test_increment_job_twice(spark):
    ctx = Ctx(spark, SF_SMALL)
    raw = scratch_path(spark, "cli-typed")
    to_payment_transactions(ctx.fx("fx_payments_raw")).write.parquet(f"{raw}/payments")
    to_fraud_signals_typed(ctx.fx("fx_fraud_signals_raw")).write.parquet(f"{raw}/signals")
    state = scratch_path(spark, "cli-state")
    args = ["increment", "--payments", f"{raw}/payments", "--signals", f"{raw}/signals", "--state", state,
            "--as-of", AS_OF]
    first = run(args)["appended"]
    second = run(args)["appended"]
    assert first["payment_validated"] > 0 and set(second.values()) == {0}


def test_merge_job_publishes_a_new_version(spark):
    ctx = Ctx(spark, SF_SMALL)
    settlement = scratch_path(spark, "cli-settlement")
    ctx.fx("fx_settlement").select(*[F.col(c).cast("string") for c in ctx.fx("fx_settlement").columns]) \
        .write.option("header", "true").csv(settlement)
    root = scratch_path(spark, "cli-fact")
    fact = E.queries()["fact_payment_transactions"](spark, SF_SMALL)
    sinks.write_versioned(fact, root)
    out = run(["merge", "--fact-root", root, "--settlement", settlement])
    assert out["published"].endswith("v=2")
    merged = sinks.read_current(spark, root)
    want = E.queries()["merge_settlement"](spark, SF_SMALL)
    assert merged.count() >= fact.count() and merged.select("transaction_id").distinct().count() == merged.count()
    assert want.count() > 0
