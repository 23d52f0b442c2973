"""Command-line jobs.

  python -m ledgerlake medallion --payments P --signals S --out DIR [--as-of TS] [--format parquet]
  python -m ledgerlake increment --payments P --signals S --state DIR [--as-of TS]
  python -m ledgerlake merge --fact-root DIR --settlement PATH [--format csv]
  python -m ledgerlake settlement-stream --src DIR --bronze DIR --dlq DIR --checkpoint DIR [--once]

Each job reads its inputs with the declared schemas, writes its outputs, and prints a
one-line JSON summary. Spark settings come from spark-submit / spark-defaults; the
session is only created here when none exists.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import SparkSession


def _session() -> SparkSession:
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    from .session import DEFAULT_CONF
    b = SparkSession.builder.appName("ledgerlake")
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    return b.getOrCreate()


def _now() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


def cmd_medallion(a) -> dict:
    from .plans.medallion import Medallion
    from .sources import tables
    spark = _session()
    m = Medallion(spark, tables.read_payments_raw(spark, a.payments, a.format),
                  tables.read_fraud_raw(spark, a.signals, a.format), a.as_of or _now(), a.days)
    views = ("dim_date", "metric_daily_payment_summary", "metric_fraud_analytics", "metric_customer_risk_profile")
    m.run(a.out, partition_by=["date_key"] if a.partition_by_day else None, views=views)
    from .sinks.tables import current_version
    return {"job": "medallion", "out": a.out, "version": current_version(spark, a.out)}


def cmd_increment(a) -> dict:
    from .plans.increment import run_increment, run_increment_bucketed
    from .sources import tables
    spark = _session()
    pays = tables.read_payment_transactions(spark, a.payments, a.format)
    sigs = tables.read_fraud_signals(spark, a.signals, a.format)
    if a.catalog_db:
        appended = run_increment_bucketed(spark, pays, sigs, a.catalog_db, a.as_of or _now(), a.buckets, a.days)
    else:
        appended = run_increment(spark, pays, sigs, a.state, a.as_of or _now(), a.days, not a.whole_targets)
    return {"job": "increment", "appended": appended}


def cmd_merge(a) -> dict:
    from . import schemas
    from .operators import settlement as st
    from .sinks import tables as sinks
    spark = _session()
    reader = spark.read.schema(schemas.SETTLEMENT)
    src = reader.option("header", "true").csv(a.settlement) if a.format == "csv" else reader.parquet(a.settlement)
    st.assert_unique(src, "transaction_id")
    merged = st.merge_settlement(sinks.read_current(spark, a.fact_root), src)
    path = sinks.write_versioned(merged, a.fact_root)
    return {"job": "merge", "published": path}


def cmd_settlement_stream(a) -> dict:
    from .streaming import jobs
    spark = _session()
    q = jobs.start_settlement_ingest(spark, a.src, a.bronze, a.dlq, a.checkpoint, available_now=a.once,
                                     include_existing=not a.skip_existing)
    q.awaitTermination()
    return {"job": "settlement-stream", "batches": len(q.recentProgress)}


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="ledgerlake")
    sub = ap.add_subparsers(dest="cmd", required=True)
    m = sub.add_parser("medallion")
    m.add_argument("--payments", required=True)
    m.add_argument("--signals", required=True)
    m.add_argument("--out", required=True)
    m.add_argument("--as-of")
    m.add_argument("--days", type=int, default=90)
    m.add_argument("--format", default="parquet")
    m.add_argument("--partition-by-day", action="store_true")
    i = sub.add_parser("increment")
    i.add_argument("--payments", required=True)
    i.add_argument("--signals", required=True)
    i.add_argument("--state", help="folder of path-based targets")
    i.add_argument("--catalog-db", help="catalog database of bucketed targets instead of --state")
    i.add_argument("--buckets", type=int, default=256)
    i.add_argument("--as-of")
    i.add_argument("--days", type=int, default=90)
    i.add_argument("--format", default="parquet")
    i.add_argument("--whole-targets", action="store_true", help="anti-join the whole history, not the retention window")
    g = sub.add_parser("merge")
    g.add_argument("--fact-root", required=True)
    g.add_argument("--settlement", required=True)
    g.add_argument("--format", default="csv")
    s = sub.add_parser("settlement-stream")
    s.add_argument("--src", required=True)
    s.add_argument("--bronze", required=True)
    s.add_argument("--dlq", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--once", action="store_true")
    s.add_argument("--skip-existing", action="store_true", help="ignore files present at the first start")
    a = ap.parse_args(argv)
    fn = {"medallion": cmd_medallion, "increment": cmd_increment, "merge": cmd_merge,
          "settlement-stream": cmd_settlement_stream}[a.cmd]
    print(json.dumps(fn(a)))


if __name__ == "__main__":
    main()
