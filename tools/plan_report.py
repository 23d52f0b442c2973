"""Physical-plan summary of the headline queries (initial AQE plan): shuffles, join kinds,
partial top-1, Expand, Python. usage: python tools/plan_report.py [--sf DIR]"""

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerlake.plans import registry  # noqa: E402
from ledgerlake.plans.context import Ctx  # noqa: E402
from ledgerlake.session import build_session  # noqa: E402

NAMES = ["transactions_fact", "fact_transactions", "metric_daily_payment_summary", "metric_fraud_analytics",
         "metric_customer_risk_profile", "join_calendar_fact", "score_transactions", "velocity_count",
         "inc_fact_payments", "merge_settlement", "reconcile_full", "scan_sensitive_values", "redact_text",
         "process_payments_batch", "ledger_update_status"]


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    args = ap.parse_args()
    registry.queries()
    spark = build_session(shuffle_partitions=8)
    print("| query | shuffles | broadcast joins | sort-merge joins | partial top-1 | Expand | Python |")
    print("| --- | --- | --- | --- | --- | --- | --- |")
    for n in NAMES:
        p = registry.REGISTRY[n].build(Ctx(spark, args.sf))._jdf.queryExecution().executedPlan().toString()
        shuffles = p.count("Exchange hashpartitioning") + p.count("Exchange rangepartitioning") \
            + p.count("Exchange SinglePartition")
        print(f"| `{n}` | {shuffles} | {p.count('BroadcastHashJoin')} | {p.count('SortMergeJoin')} | "
              f"{'yes' if 'WindowGroupLimit' in p else '-'} | {'yes' if 'Expand' in p else '-'} | "
              f"{'yes' if ('ArrowEvalPython' in p or 'BatchEvalPython' in p) else '-'} |")
    spark.stop()


if __name__ == "__main__":
    main()
