"""Stream operators whose state outlives a watermark: upsert, pending join, velocity keys."""

import datetime as dt
import json
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.session import scratch_path
from ledgerlake.streaming import jobs
from ledgerlake.streaming.enrich import PendingJoin, both_sides
from ledgerlake.streaming.upsert import UpsertTable
from ledgerlake.streaming.velocity import placed_events, prior_counts

ROW = "id string, status string, amount int, ts timestamp"
T0 = dt.datetime(2024, 1, 1)


def at(hours: float) -> dt.datetime:
    return T0 + dt.timedelta(hours=hours)


@pytest.fixture
def table(spark):
    schema = spark.createDataFrame([], ROW).schema
    return UpsertTable(spark, scratch_path(spark, "test-upsert"), schema, ["id"], ["ts"], buckets=4)


def rows_of(table):
    out = {r["id"]: (r["status"], r["amount"]) for r in table.read().collect()}
    assert table.read().count() == len(out)
    return out


def test_upsert_keeps_one_row_per_key_whatever_lies_between_versions(spark, table):
    rng = random.Random(4)
    want, write = {}, table.writer(compact_every=3)
    for batch_id in range(8):
        rows = [(None if k == 0 else f"k{k}", f"s{batch_id}", rng.randint(0, 9), at(rng.randint(0, 5_000))) for k in (rng.randint(0, 40) for _ in range(30))]
        rows += [("hot", "h", i, at(i)) for i in range(50)]
        for r in rows:
            want[r[0]] = max(want.get(r[0], r), r, key=lambda x: (x[3], x[0] or "", x[1], x[2]))
        write(spark.createDataFrame(rows, ROW), batch_id)
        assert rows_of(table) == {k: (v[1], v[2]) for k, v in want.items()}
    assert table.published().count() > 0


def test_a_repeated_batch_changes_nothing(spark, table):
    batches = [[("a", "x", 1, at(0)), ("b", "x", 1, at(0))], [("a", "y", 2, at(70))], [("b", "z", 3, at(900)), ("c", "n", 4, at(1))]]
    write = table.writer(compact_every=2)
    for n, rows in enumerate(batches):
        for _ in range(2):  # batch 1 ends with a compaction, which the second delivery meets
            write(spark.createDataFrame(rows, ROW), n)
    want = {"a": ("y", 2), "b": ("z", 3), "c": ("n", 4)}
    assert rows_of(table) == want
    write(spark.createDataFrame(batches[0], ROW), 0)  # even one that a base already holds
    assert rows_of(table) == want


def test_a_compaction_that_dies_is_not_read_and_untouched_buckets_stay(spark, table):
    table.append(spark.createDataFrame([(f"k{i}", "x", i, at(i)) for i in range(40)], ROW), 0)
    table.compact(0)
    first = {(r["bucket"], r["upto"]) for r in table.published().collect()}
    assert {b for b, _ in first} == {0, 1, 2, 3}
    table.append(spark.createDataFrame([("k3", "new", 0, at(500))], ROW), 1)
    # a base without its mark
    spark.createDataFrame([("k3", "lost", 0, at(999), 1)], ROW + ", bucket int").write.partitionBy("bucket").parquet(f"{table.root}/base/upto=1")
    assert rows_of(table)["k3"] == ("new", 0) and len(rows_of(table)) == 40
    table.compact(1)
    moved = {(r["bucket"], r["upto"]) for r in table.published().collect()}
    assert len(moved - first) == 1 and rows_of(table)["k3"] == ("new", 0) and len(rows_of(table)) == 40


def test_an_empty_upsert_table(spark, table):
    assert rows_of(table) == {}
    table.writer(compact_every=1)(spark.createDataFrame([], ROW), 0)
    assert rows_of(table) == {}


P, S = "transaction_id string, event_ts timestamp, status string", "transaction_id string, signal_ts timestamp, score double"


def run_join(spark, batches, repeat=()):
    job = PendingJoin(spark, scratch_path(spark, "test-pending"), spark.createDataFrame([], P).schema, spark.createDataFrame([], S).schema, expiry="24 hours")
    for n, (payments, signals) in enumerate(batches):
        for _ in range(2 if n in repeat else 1):
            job.write(both_sides(spark.createDataFrame(payments, P), spark.createDataFrame(signals, S)), n)
    joined = sorted((r["transaction_id"] or "none", r["status"], r["score"]) for r in job.enriched().select("transaction_id", "status", F.coalesce("score", F.lit(-1.0)).alias("score")).collect())
    return joined, sorted((r["transaction_id"] or "none", r["error"]) for r in job.dead_letters().collect())


JOIN_BATCHES = [
    ([("now", at(1), "a"), ("late", at(1), "a"), ("twice", at(1), "a"), ("never", at(1), "a"), (None, at(1), "n")], [("now", at(1), 0.1), ("early", at(0), 0.2), ("twice", at(1), 0.3)]),
    ([("early", at(20), "a"), ("now", at(20), "version 2")], [("twice", at(19), 0.4), (None, at(1), 0.9)]),
    ([("x", at(24), "a")], [("late", at(23), 0.5)]),            # 23 hours after its payment
    ([("y", at(60), "a")], []),                                  # "never" expires
    ([("z", at(200), "a")], [("never", at(61), 0.6), ("x", at(25), 0.7)]),
]


@pytest.mark.parametrize("repeat", [(), (0, 1, 2, 3, 4)])
def test_pending_join_on_the_id_alone(spark, repeat):
    joined, dead = run_join(spark, JOIN_BATCHES, repeat)
    # "z" is still pending; null ids join nothing
    assert joined == sorted([("now", "a", 0.1), ("now", "version 2", 0.1), ("twice", "a", 0.3), ("twice", "a", 0.4), ("early", "a", 0.2), ("late", "a", 0.5),
                             ("never", "a", -1.0), ("none", "n", -1.0), ("x", "a", -1.0), ("y", "a", -1.0)])
    expired, late = "no signal before expiry", "signal after its payment expired"
    assert dead == sorted([("never", expired), ("none", expired), ("x", expired), ("y", expired), ("never", late), ("x", late)])


def test_pending_join_is_the_left_join_once_all_have_expired(spark):
    rng = random.Random(9)
    pay = [(f"t{i}", at(rng.uniform(0, 100)), rng.choice("ab")) for i in range(60)]
    sig = [(f"t{rng.randint(0, 80)}", at(rng.uniform(0, 100)), float(k)) for k in range(60)]
    sig = [(i, min(max(ts, dict((p[0], p[1]) for p in pay).get(i, ts) - dt.timedelta(hours=5)), dict((p[0], p[1]) for p in pay).get(i, ts) + dt.timedelta(hours=15)), s) for i, ts, s in sig]
    cuts = [0, 25, 50, 75, 130]
    batches = [([p for p in pay if at(a) <= p[1] < at(b)], [s for s in sig if (at(a) if a else at(-99)) <= s[1] < at(b)]) for a, b in zip(cuts, cuts[1:])]
    joined, _ = run_join(spark, batches + [([("end", at(9_999), "z")], [])])
    want = [(p[0], p[2], s) for p in pay for s in ([x[2] for x in sig if x[0] == p[0]] or [-1.0])]
    assert joined == sorted(want)


def test_prior_counts_against_brute_force():
    rng = random.Random(1)
    for _ in range(50):
        rows = [(rng.randint(0, 30), rng.choice("abcde") + str(k % 7)) for k in range(rng.randint(1, 25))]
        cut = rng.randint(0, len(rows) - 1)
        us, ids = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], object)
        got = prior_counts(us[:cut], ids[:cut], us[cut:], ids[cut:], 10)
        want = [sum(t - 10 <= u < t or (u == t and j < i) for u, j in rows) for t, i in rows[cut:]]
        assert got.tolist() == want


def test_a_hot_customer_spreads_over_keys(spark):
    schema = T.StructType([T.StructField("customer_id", T.StringType()), T.StructField("transaction_id", T.StringType()), T.StructField("event_ts", T.TimestampType())])
    rows = [("hot", f"h{i}", at(i * 0.7)) for i in range(1000)] + [(None, f"n{i}", at(1)) for i in range(1000)] + [(f"c{i % 50}", f"t{i}", at(i % 700)) for i in range(1000)]
    placed = placed_events(spark.createDataFrame(rows, schema), 24 * 3600 * 10 ** 6)
    assert placed.filter("counted").count() == len(rows)        # every event is counted once
    largest = placed.groupBy("customer_id", "bucket").count().agg(F.max("count")).first()[0]
    assert largest <= 2 * 36                                     # two windows of the hot customer at most


def test_a_landed_range_is_one_micro_batch_whatever_its_files(spark, tmp_path):
    from ledgerlake.sources.fixtures import land_files
    cuts = ["1970-01-01 00:16:40", "1970-01-01 00:33:20"]
    seconds = [*range(0, 1000), 1500, *range(2000, 4000)]  # the second range has one row
    df = spark.createDataFrame([(s, f"{k}:{s}") for s in seconds for k in range(2)], "s long, payload string").select(
        F.timestamp_seconds("s").alias("t"), "payload", F.split("payload", ":")[0].alias("k"))
    path = land_files(df, str(tmp_path / "land"), cuts, "t", files=3, key="k")
    batches = {}
    stream = spark.readStream.schema("t timestamp, payload string").option("maxFilesPerTrigger", 3).parquet(path)

    def take(batch, batch_id):
        rows = batch.select("payload", F.input_file_name().alias("f")).collect()
        batches[batch_id] = rows

    stream.writeStream.foreachBatch(take).trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "ck")).start().awaitTermination()
    got = [sorted(r.payload for r in batches[b]) for b in sorted(batches)]
    assert got == [sorted(f"{k}:{s}" for s in part for k in range(2)) for part in (range(0, 1000), [1500], range(2000, 4000))]
    for rows in batches.values():  # the rows of one key are in one file, in order of time
        for k in "01":
            mine = [(r.f, int(r.payload[2:])) for r in rows if r.payload[0] == k]
            assert len({f for f, _ in mine}) == 1 and [s for _, s in mine] == sorted(s for _, s in mine)


def test_prior_counts_of_many_owners_against_brute_force():
    rng = random.Random(2)
    for _ in range(50):
        rows = [(rng.randint(0, 30), rng.choice("abcde") + str(k % 7), rng.randint(0, 4)) for k in range(rng.randint(1, 40))]
        cut = rng.randint(0, len(rows) - 1)
        us, ids, owners = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], object), np.array([r[2] for r in rows])
        got = prior_counts(us[:cut], ids[:cut], us[cut:], ids[cut:], 10, owners[:cut], owners[cut:])
        want = [sum(o == p and (t - 10 <= u < t or (u == t and j < i)) for u, j, p in rows) for t, i, o in rows[cut:]]
        assert got.tolist() == want


def test_velocity_calls_follow_shards_not_customers(spark, tmp_path):
    from ledgerlake.session import ship_package
    from ledgerlake.streaming import velocity as V
    rng = random.Random(3)
    ship_package(spark)
    rows = [(None if i % 40 == 0 else f"c{rng.randint(0, 300)}", f"t{i}", at(rng.randint(0, 200) / 2)) for i in range(3000)]
    for n, part in enumerate([[r for r in rows if r[2] < at(50)], [r for r in rows if r[2] >= at(50)], [("end", "end", at(9_999))]]):
        spark.createDataFrame(part, "customer_id string, transaction_id string, event_ts timestamp").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("customer_id string, transaction_id string, event_ts timestamp").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    with V.rocksdb_state(spark):
        q = (V.velocity(stream, minutes=24 * 60, delay="30 minutes").writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ck"))
             .trigger(availableNow=True).start(str(tmp_path / "out")))
        q.awaitTermination()
    got = sorted((r.transaction_id, r.customer_id, r.event_ts, r.prior_count) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    by_customer = {}
    for c, i, t in rows:
        by_customer.setdefault(c, []).append((t, i))
    want = [(i, c, t, 0 if c is None else sum(t - dt.timedelta(hours=24) <= u < t or (u == t and j < i) for u, j in by_customer[c])) for c, i, t in rows]
    assert got == sorted(want + [("end", "end", at(9_999), 0)])
    keys = max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"])
    assert keys < 3000  # list entries are blocks of a shard's events, of the two batches


def payment(id_: str, minute: float, status: str = "captured") -> str:
    return json.dumps({"transaction_id": id_, "merchant_id": "m", "customer_id": "c", "payment_method": "ach", "amount": 1.0, "status": status,
                       "card_number": "4000", "event_ts": str(T0 + dt.timedelta(minutes=minute))})


def signal(id_: str, minute: float) -> str:
    return json.dumps({"transaction_id": id_, "risk_score": 0.5, "risk_level": "low", "decision": "review", "signal_ts": str(T0 + dt.timedelta(minutes=minute))})


def land(spark, path: str, payloads: list[str]) -> None:
    spark.createDataFrame([(p,) for p in payloads], "payload string").coalesce(1).write.mode("append").parquet(path)


def test_bronze_pipeline_joins_one_accepted_batch_at_a_time_with_its_state_on_disk(spark):
    work = scratch_path(spark, "test-bronze-job")
    pay, sig, bronze, dlq = (f"{work}/{n}" for n in ("pay", "sig", "bronze", "dlq"))
    key = "spark.sql.streaming.stateStore.providerClass"
    conf_before = spark.conf.get(key), spark.conf.get("spark.sql.shuffle.partitions")

    def run(max_files: int) -> None:
        jobs.run_bronze_pipeline(spark, pay, sig, bronze, dlq, work, "key", 1800, n_state_partitions=2, max_files=max_files)

    land(spark, pay, [payment("a", 0), payment("b", 60), payment("c", 50, "authorized")])
    land(spark, pay, [payment("late", 10), payment("c", 58), payment("d", 30), payment("e", 90)])  # "d" is just not late
    land(spark, pay, ["{", payment("f", 60), payment("g", 85)])
    # the signals' watermark runs ahead, so that of the payments decides
    land(spark, sig, [signal("a", 5), signal("c", 55), signal("g", 200), signal("h", 61), signal("x", 500)])
    run(1)
    land(spark, pay, [payment("h", 60)])  # just not late, after a run whose watermark stands at its time
    land(spark, pay, [payment("end", 1_000_000)])
    land(spark, sig, [signal("end", 1_000_000)])
    run(2)

    got = sorted((r["transaction_id"], r["status"], r["decision"]) for r in spark.read.parquet(bronze).collect() if r["transaction_id"] != "end")
    assert got == [("a", "captured", "review"), ("b", "captured", None), ("c", "captured", "review"), ("d", "captured", None), ("e", "captured", None),
                   ("f", "captured", None), ("g", "captured", None), ("h", "captured", "review")]
    assert sorted(r["error"] for r in spark.read.parquet(dlq).collect()) == ["late event", "malformed json"]

    checkpoint = f"{work}/checkpoint_bronze"
    taken = spark.read.text(f"{checkpoint}/sources/0/*").filter(F.col("value").startswith("{")).collect()
    batches: dict[int, list[int]] = {}
    for entry in (json.loads(r["value"]) for r in taken):
        batches.setdefault(entry["batchId"], []).append(int(re.search(r"batch_id=(\d+)", entry["path"])[1]))
    assert sorted(batches.values()) == [[0, 0], [1, 1], [2, 2], [3, 3]]
    started = [json.loads(r["value"]) for r in spark.read.text(f"{checkpoint}/offsets/0").collect() if '"conf"' in r["value"]]
    assert started[0]["conf"][key].endswith("RocksDBStateStoreProvider")
    assert (spark.conf.get(key), spark.conf.get("spark.sql.shuffle.partitions")) == conf_before


def test_accepted_batches_older_than_the_rule_are_read_without_limit(spark):
    work = scratch_path(spark, "test-accepted")
    assert jobs.accepted_batch_files(spark, work, f"{work}/accepted", 3) == 3
    land(spark, f"{work}/accepted", ["p"])
    assert jobs.accepted_batch_files(spark, work, f"{work}/accepted", 5) == 3  # for the life of the folder
    older = scratch_path(spark, "test-accepted-older")
    land(spark, f"{older}/accepted", ["p"])
    assert jobs.accepted_batch_files(spark, older, f"{older}/accepted", 3) == 0
