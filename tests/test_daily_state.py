"""The mergeable daily summary against the summary of all rows at once."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import gold
from ledgerlake.operators.daily_state import DailyState
from ledgerlake.session import scratch_path

FACT = ("transaction_id string, date_key string, merchant_id string, customer_id string, transaction_amount decimal(18,2), payment_status string, fraud_decision string, "
        "risk_score decimal(3,2), overall_risk_category string, captured_amount decimal(18,2), refunded_amount decimal(18,2), fraud_blocked_amount decimal(18,2)")


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)

    def money():
        return Decimal(rng.randint(0, 99_999)) / 100

    return [(f"t{i}", None if i % 97 == 0 else f"202401{rng.randint(1, 9):02d}", rng.choice([None, "m1", "m2", f"m{i % 50}"]), f"c{rng.randint(0, 300)}", None if i % 31 == 0 else money(),
             rng.choice(["CAPTURED", "DECLINED", "FAILED", None]), rng.choice(["DECLINED", "APPROVED", None]), None if i % 5 == 0 else Decimal(rng.randint(0, 100)) / 100,
             rng.choice(["HIGH_RISK", "MEDIUM_RISK", "LOW_RISK", None]), money(), money(), money()) for i in range(1200)]


def calendar(spark):
    return gold.dim_date(spark, dt.datetime(2024, 1, 12), 15).filter("date_key <= '20240110'")


def listed(df):
    def plain(v):
        return round(v, 4) if isinstance(v, float) else v

    return sorted((tuple(plain(v) for v in r) for r in df.select(*sorted(df.columns)).collect()), key=str)


def test_batches_in_any_order_and_repeated(spark, rows):
    fact = spark.createDataFrame(rows, FACT)
    want = listed(gold.metric_daily_payment_summary(calendar(spark), fact))
    state = DailyState(spark, scratch_path(spark, "test-daily"))
    parts = [rows[0::3], rows[1::3], rows[2::3]]
    for n, part in enumerate(parts):
        for _ in range(1 + n % 2):
            state.add(spark.createDataFrame(part, FACT), n)
    assert listed(state.summary(calendar(spark))) == want
    state.add(spark.createDataFrame(parts[2], FACT), 2)  # the last one again, its numbers are known already
    state.add(spark.createDataFrame([], FACT), 3)
    assert listed(state.summary(calendar(spark))) == want
    ids = spark.read.parquet(f"{state.root}/ids").filter("measure = 'active_customers'")
    assert ids.count() == ids.select("id").distinct().count() == ids.agg(F.max("id")).first()[0] == ids.select("value").distinct().count()


def test_numbers_beyond_one_bitmap(spark):
    one = [(f"t{i}", "20240101", "m", f"c{i}", Decimal(1), None, None, None, None, None, None, None) for i in range(40_000)]
    state = DailyState(spark, scratch_path(spark, "test-daily"))
    state.add(spark.createDataFrame(one[:30_000], FACT), 0)
    state.add(spark.createDataFrame(one[20_000:], FACT).withColumn("date_key", F.when(F.col("customer_id") < "c3", "20240101").otherwise("20240102")), 1)
    days = {r["date_key"]: r["active_customers"] for r in state.per_day().collect()}
    late = {f"c{i}" for i in range(20_000, 40_000)}
    assert days == {"20240101": len({f"c{i}" for i in range(30_000)} | {c for c in late if c < "c3"}), "20240102": len({c for c in late if c >= "c3"})}
