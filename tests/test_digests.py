"""Reconciliation by digests equals the plain join and joins differing cells only."""

import datetime as dt
import random
from decimal import Decimal

import pytest

from ledgerlake.operators import digests
from ledgerlake.operators import settlement as st

ROW = "transaction_id string, amount decimal(18,2), settlement_date date"


def day(n):
    return None if n is None else dt.date(2024, 1, 1) + dt.timedelta(days=n)


def frame(spark, rows):
    return spark.createDataFrame([(k, None if a is None else Decimal(a), day(d)) for k, a, d in rows], ROW)


def rows(df):
    return sorted(df.collect(), key=str)


BASE = [(f"t{i}", i % 97, i % 30) for i in range(3000)]
CASES = {
    "equal": (BASE, BASE),
    "amount and date": (BASE, [(k, a + (k == "t77"), 29 if k == "t5" else d) for k, a, d in BASE]),
    "missing": (BASE[:-3], BASE[2:]),
    "nulls": (BASE + [("n1", None, 3), ("n2", 5, None), (None, 1, 1), ("n3", None, None)], BASE + [("n1", 4, 3), ("n2", 5, 4), (None, 1, 1), ("n3", None, None)]),
    "a day only one side has": (BASE, BASE + [("late", 1, 99)]),
    "empty": ([], []), "no settlement": (BASE[:50], []), "no fact": ([], BASE[:50]),
}


@pytest.mark.parametrize("name", CASES)
def test_same_rows_as_the_plain_join(spark, name):
    fact, settlement = (frame(spark, r) for r in CASES[name])
    assert rows(digests.reconcile_full(fact, settlement)) == rows(st.reconcile_full(fact, settlement))
    assert rows(digests.reconcile_mismatches(fact, settlement)) == rows(st.reconcile_mismatches(fact, settlement))


def test_random_differences(spark):
    rng = random.Random(6)
    for _ in range(4):
        other = [(k, a + rng.choice([0] * 99 + [1]), d) for k, a, d in BASE if rng.random() > 0.01]
        fact, settlement = frame(spark, BASE), frame(spark, other)
        assert rows(digests.reconcile_full(fact, settlement, buckets=16)) == rows(st.reconcile_full(fact, settlement))


def test_only_differing_cells_reach_the_join(spark):
    fact, settlement = frame(spark, BASE), frame(spark, [(k, a + (k == "t77"), d) for k, a, d in BASE])
    f, s = digests.differing_rows(fact, settlement)
    assert f.count() == s.count() <= 5 and f.filter("transaction_id = 't77'").count() == 1
    f, s = digests.differing_rows(fact, fact)
    assert f.count() == s.count() == 0


def test_stored_digests_of_closed_days(spark):
    changed = [(k, a + (k in ("t77", "t29")), d) for k, a, d in BASE]  # days 17 and 29
    fact, settlement = frame(spark, BASE), frame(spark, changed)

    def closed(df):
        cells = digests.with_cells(df, "transaction_id", "settlement_date")
        return digests.digests(cells, ["_day"], "transaction_id", digests.COMPARED).filter("_day < '2024-01-21'")

    f, s = digests.differing_rows(fact, settlement, closed=(closed(fact), closed(settlement)))
    assert rows(st.reconcile_full(f, s)) == rows(st.reconcile_full(fact, settlement))
