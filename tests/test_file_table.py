"""MERGE by file and point lookups on the manifest table."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import settlement as st
from ledgerlake.session import scratch_path
from ledgerlake.sinks.file_table import FileTable

FACT = ("transaction_id string, merchant_id string, payment_method string, event_ts timestamp, status string, risk_score decimal(3,2), "
        "settlement_date date, amount decimal(18,2), fee decimal(18,2), chargeback_flag boolean")
SOURCE = "transaction_id string, settlement_date date, amount decimal(18,2), fee decimal(18,2), chargeback_flag boolean"
DAY = dt.date(2024, 1, 5)


def fact(spark, ids):
    return spark.createDataFrame([(i, "M", "ach", dt.datetime(2024, 1, 1), "captured", None, None, None, None, None) for i in ids], FACT)


def source(spark, ids):
    return spark.createDataFrame([(i, DAY, None, None, True) for i in ids], SOURCE)


@pytest.fixture
def table(spark):
    t = FileTable(spark, scratch_path(spark, "test-files"), fact(spark, []).schema, "transaction_id")
    t.create(fact(spark, [f"T{i:04d}" for i in range(1000)] + [None]), n_files=20)
    return t


def rows(df):
    return sorted(df.collect(), key=str)


def test_untouched_files_keep_their_names_and_the_result_is_the_full_outer_join(spark, table):
    before, whole = table.files(), table.read()
    assert len(before) >= 15
    ids = ["T0101", "T0102", "T0990", "U1", "T0555x", None]
    night = source(spark, ids)
    want = rows(st.merge_settlement(whole, night))
    done = table.merge(night, st.merge_settlement)
    after = table.files()
    assert rows(table.read()) == want and done["version"] == 2
    assert len(done["rewritten"]) <= 3 and set(before) - set(after) == set(done["rewritten"])
    assert rows(table.read(version=1)) == rows(whole)                       # the old version stays readable
    assert {r["file"] for r in table.unreferenced().collect()} == set(done["rewritten"])


def test_a_repeated_merge_changes_no_row(spark, table):
    night = source(spark, ["T0001", "T0500", "NEW"])
    table.merge(night, st.merge_settlement)
    first = rows(table.read())
    table.merge(night, st.merge_settlement)
    assert rows(table.read()) == first


def test_sources_without_a_match_and_empty_ones(spark, table):
    before = table.files()
    assert table.touched(source(spark, ["T0500x"]).select("transaction_id")) == []  # in a file's range, but in no file
    done = table.merge(source(spark, ["T0500x"]), st.merge_settlement)
    assert done["rewritten"] == [] and set(before) < set(table.files()) and table.read().count() == 1002
    table.merge(source(spark, []), st.merge_settlement)
    assert table.read().count() == 1002


def test_a_failed_merge_is_not_seen(spark, table):
    def fails(target, night):
        return st.merge_settlement(target, night).withColumn("status", F.raise_error(F.lit("boom")))

    before = rows(table.read())
    with pytest.raises(Exception, match="boom"):
        table.merge(source(spark, ["T0003"]), fails)
    assert table.version() == 1 and rows(table.read()) == before


def test_lookup_reads_one_file_and_skips_row_groups(spark):
    ids = [f"T{(i * 7919) % 1_000_003:07d}" for i in range(60_000)]
    absent = next(f"T{n:07d}" for n in range(500_000, 600_000) if f"T{n:07d}" not in set(ids))
    read = {}
    for bloom in (True, False):
        t = FileTable(spark, scratch_path(spark, "test-lookup"), fact(spark, []).schema, "transaction_id", bloom=bloom, row_group_bytes=64 << 10)
        t.create(fact(spark, ids), n_files=4)
        one = t.lookup([ids[12345]])
        assert [r["transaction_id"] for r in one.collect()] == [ids[12345]] and len(one.inputFiles()) == 1
        assert 0 < scanned(one) < 60_000 / 4 / 2  # of one file's rows
        read[bloom] = scanned(t.lookup([absent]))
    assert read[True] == 0 < read[False]          # within a row group's range, but not in its Bloom filter


def scanned(df):
    """The number of rows that the file scans of a query put out."""
    df.collect()
    found = []

    def walk(node):
        if "Scan parquet" in node.nodeName():
            metric = node.metrics().get("numOutputRows")
            found.append(metric.get().value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    plan = df._jdf.queryExecution().executedPlan()
    walk(plan.executedPlan() if "AdaptiveSparkPlan" in plan.nodeName() else plan)
    return sum(found)
