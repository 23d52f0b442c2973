"""Operators against brute force on small fixtures, and the reference's workflow cases."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import fraud, lifecycle, pci, settlement, silver, windows
from ledgerlake.plans.increment import run_increment
from ledgerlake.session import scratch_path
from ledgerlake.sinks import tables as sinks

T0 = dt.datetime(2024, 1, 1)


def _events(spark, n=300, users=4, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        # many equal timestamps and rows around bucket edges
        ts = T0 + dt.timedelta(minutes=rnd.choice([0, 59, 60, 61, 119, 120, 121]) + 30 * rnd.randrange(40))
        rows.append((i, f"C{rnd.randrange(users)}", ts, f"L{rnd.randrange(3)}"))
    return rows, spark.createDataFrame(rows, "id long, customer_id string, ts timestamp_ntz, loc string")


def test_velocity_count_matches_brute_force(spark):
    rows, df = _events(spark)
    for minutes in (60, 7, 1440):
        out = windows.velocity_count(df, "customer_id", "ts", "id", minutes)
        assert out.columns == df.columns + ["prior_count"]
        got = {r["id"]: r["prior_count"] for r in out.collect()}
        assert len(got) == len(rows)
        for i, c, ts, _ in rows:
            want = sum(1 for j, c2, t2, _ in rows if c2 == c and t2 >= ts - dt.timedelta(minutes=minutes)
                       and (t2 < ts or (t2 == ts and j < i)))
            assert got[i] == want, (minutes, i, got[i], want)


def test_velocity_keeps_rows_without_key_or_time(spark):
    df = spark.createDataFrame([(1, "C1", T0), (2, None, T0), (3, "C1", None), (4, "C1", T0)],
                               "id long, customer_id string, ts timestamp_ntz")
    got = {r["id"]: r["prior_count"] for r in windows.velocity_count(df, "customer_id", "ts", "id").collect()}
    assert got == {1: 0, 2: None, 3: None, 4: 1}


def test_velocity_keeps_every_row_of_null_and_repeated_ids(spark):
    df = spark.createDataFrame([(None, "C1", T0), (2, "C1", T0), (2, "C1", T0 + dt.timedelta(minutes=5)), (4, "C1", T0 + dt.timedelta(minutes=6)), (2, "C1", T0)],
                               "id long, customer_id string, ts timestamp_ntz")
    for out in (windows.velocity_count(df, "customer_id", "ts", "id"),
                windows.velocity_and_previous(df, "customer_id", "ts", "id", "id").drop("previous_value")):
        got = sorted(((r["id"] is not None, r["id"] or 0, r["ts"], r["prior_count"]) for r in out.collect()))
        assert got == [(False, 0, T0, 0), (True, 2, T0, 1), (True, 2, T0, 1), (True, 2, T0 + dt.timedelta(minutes=5), 3),
                       (True, 4, T0 + dt.timedelta(minutes=6), 4)]


def test_window_count_of_null_keys(spark):
    df = spark.createDataFrame([("a",), (None,), (None,)], "k string")
    assert sorted((r["k"] or "", r["n"]) for r in windows.window_count(df, "k", "n").collect()) == [("", 2), ("", 2), ("a", 1)]


def test_only_the_first_valid_refund_of_a_payment(spark):
    pay = spark.createDataFrame([("p", "captured", 100.0)], "payment_id string, status string, amount double")
    req = spark.createDataFrame([("p", 90.0, 2), ("p", 80.0, 3), ("p", 500.0, 1), ("q", 1.0, 1)], "payment_id string, refund_amount double, at int")
    got = {(r["payment_id"], r["refund_amount"]): (r["new_status"], r["error"]) for r in
           lifecycle.refund_batch(pay, req, "2024-01-01 00:00:00", request_order=["at"]).collect()}
    assert got == {("p", 500.0): ("captured", "Refund amount exceeds payment amount"), ("p", 90.0): ("refunded", None),
                   ("p", 80.0): ("refunded", "Cannot refund payment with status: refunded"), ("q", 1.0): (None, "Payment not found")}


def test_missing_path_is_empty_and_other_errors_are_raised(spark, tmp_path):
    import pytest
    from ledgerlake.sinks.tables import read_if_exists
    assert read_if_exists(spark, str(tmp_path / "none")) is None
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0.parquet").write_bytes(b"not parquet at all")
    with pytest.raises(Exception):
        read_if_exists(spark, str(tmp_path / "bad"))


def test_landed_files_keep_rows_without_a_time(spark, tmp_path):
    from ledgerlake.sources.fixtures import land_files
    df = spark.range(100).selectExpr("id", "if(id % 10 = 0, null, timestamp_seconds(id)) as t")
    assert spark.read.parquet(land_files(df, str(tmp_path / "land"), ["1970-01-01 00:00:20", "1970-01-01 00:01:00"], "t")).count() == 100


def test_scan_names_columns_with_underscores(spark):
    df = spark.createDataFrame([("4111111111111111",)], "my__col string")
    assert {(r["column_name"], r["pattern"]): r["matches"] for r in pci.scan_sensitive_values(df, "t").collect()}[("my__col", "card")] == 1


def test_latest_per_key_keeps_total_order(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "q"), ("b", 0, "r")],
                               "k string, u int, v string")
    out = {r["k"]: r["v"] for r in windows.latest_per_key(df, ["k"], ["u", "v"]).collect()}
    assert out == {"a": "z", "b": "r"}


def test_transactions_fact_equals_join_then_rank(spark):
    ts = T0
    pays = spark.createDataFrame([
        ("P1", "M", "C", Decimal("1.00"), "USD", "ACH", "CAPTURED", ts, ts + dt.timedelta(hours=1)),
        ("P1", "M", "C", Decimal("2.00"), "USD", "ACH", "REFUNDED", ts, ts + dt.timedelta(hours=2)),
        ("P2", "M", "C", Decimal("3.00"), "USD", "WIRE", "FAILED", ts, ts),
    ], "payment_id string, merchant_id string, customer_id string, amount decimal(18,2), currency string, "
       "payment_method_normalized string, status_normalized string, payment_created_at timestamp_ntz, "
       "payment_updated_at timestamp_ntz")
    sigs = spark.createDataFrame([
        ("S1", "P1", Decimal("0.30"), "LOW", "medium", "[]", "APPROVED", "PENDING", ts),
        ("S2", "P1", Decimal("0.90"), "CRITICAL", "critical", "[]", "DECLINED", "PENDING", ts + dt.timedelta(minutes=5)),
    ], "signal_id string, transaction_id string, risk_score decimal(3,2), risk_level_derived string, risk_level string, "
       "alerts string, decision_normalized string, case_status_normalized string, signal_created_at timestamp_ntz")
    fact = {r["transaction_id"]: r for r in silver.transactions_fact(pays, sigs).collect()}
    assert fact["P1"]["status"] == "REFUNDED" and fact["P1"]["fraud_decision"] == "DECLINED"
    assert fact["P1"]["overall_risk_category"] == "HIGH_RISK"
    assert fact["P2"]["fraud_risk_level"] == "NOT_EVALUATED" and fact["P2"]["risk_score"] == Decimal("0.00")
    # literal form: fan-out join, then the first row per payment in the same total order
    lit = silver.join_payment_fraud(pays, sigs).collect()
    assert len(lit) == 5


def test_scoring_reference_cases(spark):
    df = spark.createDataFrame([
        ("t1", Decimal("50.00"), 0, None, None, False),
        ("t2", Decimal("5000.00"), 0, None, None, False),
        ("t3", Decimal("50.00"), 0, "New York", "Tokyo", True),
    ], "transaction_id string, amount decimal(18,2), prior_count int, previous_location string, "
       "current_location string, device_mismatch boolean")
    rules = fraud.default_rules(amount_limit="1000")
    out = {r["transaction_id"]: r for r in fraud.score_transactions(df, rules).collect()}
    assert (out["t1"]["risk_level"], out["t1"]["decision"], out["t1"]["alerts"]) == ("low", "approve", [])
    assert out["t2"]["alerts"] == ["amount_anomaly"] and out["t2"]["risk_level"] in ("medium", "high")
    assert out["t3"]["alerts"] == ["unusual_location", "device_fingerprint_mismatch"]
    assert out["t3"]["risk_level"] in ("medium", "high") and out["t3"]["risk_score"] == Decimal("0.40")


def test_route_signals(spark):
    df = spark.createDataFrame([("a", "high", "review"), ("b", "low", "approve"), ("c", "critical", "block")],
                               "transaction_id string, risk_level string, decision string")
    got = sorted((r["topic"], r["key"]) for r in fraud.route_signals(df).collect())
    assert got == [("fraud.alerts", "a"), ("fraud.alerts", "c"), ("fraud.decisions", "a"), ("fraud.decisions", "c"),
                   ("fraud.signals", "b")]


def test_tokens_round_trip_and_revoke(spark):
    df = spark.createDataFrame([("h1", "4532015112830366"), ("h2", "4000000000000002")], "h string, card string")
    tok, vault = pci.tokenize_column(df, "card", "key", "token")
    back = {r["h"]: r["value"] for r in pci.detokenize(tok, "token", vault).collect()}
    assert back == {"h1": "4532015112830366", "h2": "4000000000000002"}
    first = tok.filter("h = 'h1'").select("token")
    remaining, result = pci.revoke_tokens(vault, first.unionByName(spark.createDataFrame([("tok_nope",)], "token string")))
    assert remaining.count() == 1
    assert sorted(r["revoked"] for r in result.collect()) == [False, True]


def test_mask_table_workflow(spark):
    rec = spark.createDataFrame([("4532015112830366", "123", "John Smith", "john.smith@example.com", "555-123-4567")],
                                "card_number string, cvv string, name string, email string, phone string")
    classified = pci.classify_columns(pci.columns_frame(spark, {"rec": rec}))
    out = pci.mask_table(rec, classified, "rec").first()
    assert out["card_number"].endswith("0366") and out["card_number"] != "4532015112830366"
    assert out["cvv"] == "***" and out["name"] == "John Smith"  # 'name' alone is not classified
    assert out["email"] == "j***@example.com" and out["phone"].endswith("4567")


def test_lifecycle_capture_refund(spark):
    pays = spark.createDataFrame([("p1", "authorized", Decimal("50.00")), ("p2", "captured", Decimal("50.00"))],
                                 "payment_id string, status string, amount decimal(18,2)")
    cap = {r["payment_id"]: r for r in lifecycle.capture_batch(pays, pays.select("payment_id"), "2024-01-01 00:00:00")
           .collect()}
    assert cap["p1"]["new_status"] == "captured" and cap["p1"]["error"] is None
    assert cap["p2"]["error"] == "Cannot capture payment with status: captured"
    req = spark.createDataFrame([("p2", Decimal("60.00")), ("p2", Decimal("0.00")), ("p9", None)],
                                "payment_id string, refund_amount decimal(18,2)")
    ref = lifecycle.refund_batch(pays, req, "2024-01-01 00:00:00").collect()
    errs = sorted(str(r["error"]) for r in ref)
    assert errs == ["None", "Payment not found", "Refund amount exceeds payment amount"]


def test_increment_is_idempotent(spark):
    from ledgerlake.plans.context import Ctx
    from ledgerlake.sources.typed import to_fraud_signals_typed, to_payment_transactions
    ctx = Ctx(spark, "/root/testdata/sf0.001")
    pays = to_payment_transactions(ctx.fx("fx_payments_raw"))
    sigs = to_fraud_signals_typed(ctx.fx("fx_fraud_signals_raw"))
    state = scratch_path(spark, "test-increment")
    first = run_increment(spark, pays, sigs, state, ctx.as_of)
    assert first["payment_validated"] > 0 and first["fact_payments"] == first["payment_validated"]
    second = run_increment(spark, pays, sigs, state, ctx.as_of)
    assert all(v == 0 for v in second.values()), second
    fact = spark.read.parquet(f"{state}/fact_payments")
    assert fact.count() == fact.select("payment_id").distinct().count()


def test_merge_publish_versions(spark):
    root = scratch_path(spark, "test-merge")
    fact = spark.createDataFrame([("t1", Decimal("1.00")), ("t2", Decimal("2.00"))], "transaction_id string, amount decimal(18,2)")
    fact = fact.select("transaction_id", F.lit(None).cast("date").alias("settlement_date"), "amount",
                       F.lit(None).cast("decimal(18,2)").alias("fee"), F.lit(None).cast("boolean").alias("chargeback_flag"))
    src = spark.createDataFrame([("t2", dt.date(2024, 1, 3), Decimal("2.50"), Decimal("0.05"), False),
                                 ("t3", dt.date(2024, 1, 4), Decimal("3.00"), Decimal("0.06"), True)],
                                "transaction_id string, settlement_date date, amount decimal(18,2), fee decimal(18,2), "
                                "chargeback_flag boolean")
    sinks.write_versioned(fact, root)
    assert sinks.current_version(spark, root) == 1
    settlement.assert_unique(src, "transaction_id")
    sinks.write_versioned(settlement.merge_settlement(sinks.read_current(spark, root), src), root)
    assert sinks.current_version(spark, root) == 2
    got = {r["transaction_id"]: r["amount"] for r in sinks.read_current(spark, root).collect()}
    assert got == {"t1": Decimal("1.00"), "t2": Decimal("2.50"), "t3": Decimal("3.00")}
    assert spark.read.parquet(f"{root}/v=1").count() == 2  # the old version is untouched


def test_pruned_anti_join_gives_the_same_increment(spark):
    from ledgerlake.operators import incremental as inc
    from ledgerlake.plans.context import Ctx
    from ledgerlake.plans.q_incremental import runs
    r = runs(Ctx(spark, "/root/testdata/sf0.001"))
    a = inc.inc_payment_validated(r.raw, r.pv1, r.ctx.as_of, r.ctx.days)
    b = inc.inc_payment_validated(r.raw, r.pv1, r.ctx.as_of, r.ctx.days, prune_target=True)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    fa = inc.inc_fact_payments(r.pv2, r.fe2, r.fact1)
    fb = inc.inc_fact_payments(r.pv2, r.fe2, r.fact1, r.ctx.as_of, r.ctx.days, prune_target=True)
    assert sorted(map(tuple, fa.collect())) == sorted(map(tuple, fb.collect()))


def test_route_and_write_topics(spark):
    df = spark.createDataFrame([("a", "high", "review"), ("b", "low", "approve")],
                               "transaction_id string, risk_level string, decision string")
    path = scratch_path(spark, "test-topics")
    sinks.write_topics(fraud.route_signals(df), path)
    got = sorted((r["topic"], r["key"]) for r in spark.read.parquet(path).collect())
    assert got == [("fraud.alerts", "a"), ("fraud.decisions", "a"), ("fraud.signals", "b")]


def test_recent_daily_summary_equals_filtered_view(spark):
    from ledgerlake.operators import gold, usage
    from ledgerlake.plans.context import Ctx
    m = Ctx(spark, "/root/testdata/sf0.001").med
    a = usage.filter_recent_days(gold.metric_daily_payment_summary(m.dim_date, m.fact_transactions), m.as_of, 7)
    b = usage.recent_daily_summary(m.dim_date, m.fact_transactions, m.as_of, 7)
    assert a.collect() == b.collect()


def test_velocity_and_previous_in_one_pass(spark):
    rows, df = _events(spark, seed=5)
    rows = [(i, c, t, (None if i % 17 == 0 else l)) for i, c, t, l in rows]  # some NULL values
    df = spark.createDataFrame(rows, "id long, customer_id string, ts timestamp_ntz, loc string")
    got = {r["id"]: (r["prior_count"], r["prev"]) for r in
           windows.velocity_and_previous(df, "customer_id", "ts", "id", "loc", 60, "prior_count", "prev").collect()}
    assert len(got) == len(rows)
    for i, c, ts, _ in rows:
        cnt = sum(1 for j, c2, t2, _ in rows if c2 == c and t2 >= ts - dt.timedelta(minutes=60)
                  and (t2 < ts or (t2 == ts and j < i)))
        earlier = sorted((t2, j, l2) for j, c2, t2, l2 in rows if c2 == c and (t2, j) < (ts, i))
        assert got[i] == (cnt, earlier[-1][2] if earlier else None), i


def test_governance_over_catalog_views(spark):
    spark.range(1).createOrReplaceTempView("payments_raw")
    spark.range(1).createOrReplaceTempView("dim_customer")
    tables = pci.catalog_tables(spark, ["default"])
    got = {r["table_name"]: (r["layer"], r["data_sensitivity"], r["requires_encryption"])
           for r in pci.governance_summary(tables).collect()}
    assert got["payments_raw"] == ("RAW (Bronze)", "PCI-DSS Restricted", True)
    assert got["dim_customer"] == ("GOLD (Analytics)", "PII Restricted", True)


def test_backfill_rewrites_only_replayed_days(spark):
    from ledgerlake.plans.context import Ctx
    from ledgerlake.plans.q_settlement import pc
    bronze = pc(Ctx(spark, "/root/testdata/sf0.001")).bronze
    path = scratch_path(spark, "test-backfill")
    sinks.write_table(settlement.canonicalize_payments(bronze), path, partition_by=["ingestion_date"])
    before = spark.read.parquet(path).groupBy("ingestion_date").count().collect()
    # replay two days from a bronze whose risk scores were corrected
    fixed = bronze.withColumn("risk_score", F.lit(None).cast("decimal(3,2)"))
    settlement.backfill_replay_write(fixed, "2024-01-10", "2024-01-11", path)
    after = spark.read.parquet(path)
    assert sorted(map(tuple, after.groupBy("ingestion_date").count().collect())) == sorted(map(tuple, before))
    replayed = after.filter(F.col("ingestion_date").between("2024-01-10", "2024-01-11"))
    others = after.filter(~F.col("ingestion_date").between("2024-01-10", "2024-01-11"))
    assert replayed.count() > 0 and replayed.filter(F.col("risk_score").isNotNull()).count() == 0
    assert others.filter(F.col("risk_score").isNotNull()).count() > 0


def test_persisted_medallion_equals_lazy_dag(spark):
    from ledgerlake.plans.context import Ctx
    lazy = Ctx(spark, "/root/testdata/sf0.001").med
    published = lazy.run(scratch_path(spark, "test-run"))
    for view in ("metric_daily_payment_summary", "metric_fraud_analytics", "metric_customer_risk_profile",
                 "dim_merchant", "dim_customer", "dim_payment_method"):
        a, b = getattr(lazy, view), getattr(published, view)
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.select(*a.columns).collect())), view


def test_a_refresh_is_published_as_a_whole(spark):
    from ledgerlake.plans.context import Ctx
    from ledgerlake.plans.medallion import Medallion
    from ledgerlake.sinks.tables import current_version, published_path
    med = Ctx(spark, "/root/testdata/sf0.001").med
    root = scratch_path(spark, "test-publish")
    med.run(root, views=("dim_date",))
    assert current_version(spark, root) == 1 and spark.read.parquet(published_path(spark, root, "gold/dim_date")).count() == 731
    first = spark.read.parquet(published_path(spark, root, "gold/dim_merchant")).count()
    broken = Medallion(spark, med.payments_raw.withColumn("merchant_id", F.raise_error(F.lit("boom"))), med.fraud_raw, med.as_of)
    with pytest.raises(Exception, match="boom"):
        broken.run(root)
    assert current_version(spark, root) == 1 and spark.read.parquet(published_path(spark, root, "gold/dim_merchant")).count() == first
    med.run(root)
    assert current_version(spark, root) == 2


def test_bucketed_increment_is_idempotent_and_keeps_the_target_in_place(spark):
    import uuid

    from ledgerlake.operators import incremental as inc
    from ledgerlake.plans.context import Ctx
    from ledgerlake.plans.increment import run_increment_bucketed
    from ledgerlake.sources.typed import to_fraud_signals_typed, to_payment_transactions
    ctx = Ctx(spark, "/root/testdata/sf0.001")
    pays = to_payment_transactions(ctx.fx("fx_payments_raw"))
    sigs = to_fraud_signals_typed(ctx.fx("fx_fraud_signals_raw"))
    db = f"inc_{uuid.uuid4().hex[:8]}"
    first = run_increment_bucketed(spark, pays, sigs, db, ctx.as_of, buckets=4)
    second = run_increment_bucketed(spark, pays, sigs, db, ctx.as_of, buckets=4)
    assert first["payment_validated"] > 0 and set(second.values()) == {0}
    # the anti join reads the bucketed target without shuffling it: one exchange fewer than the
    # same join against the same rows stored as plain files
    plain_path = scratch_path(spark, "test-plain-target")
    spark.table(f"{db}.payment_validated").write.parquet(plain_path)

    def exchanges(target):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            p = inc.inc_payment_validated(pays, target, ctx.as_of)._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        return p, p.count("Exchange hashpartitioning")
    bucketed_plan, n_bucketed = exchanges(spark.table(f"{db}.payment_validated"))
    _, n_plain = exchanges(spark.read.parquet(plain_path))
    assert "Bucketed: true" in bucketed_plan and n_bucketed == n_plain - 1, (n_bucketed, n_plain)
