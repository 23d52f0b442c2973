"""Property tests: de-duplication does not depend on row order or partitioning;
threshold functions equal a plain Python statement of the rules."""

from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlake.functions import risk
from ledgerlake.operators.windows import latest_per_key

ROWS = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 5), st.integers(0, 3)),
                min_size=1, max_size=40)


@settings(max_examples=25, deadline=None)
@given(ROWS, st.randoms())
def test_latest_per_key_is_order_independent(spark, rows, rnd):
    shuffled = list(rows)
    rnd.shuffle(shuffled)
    a = spark.createDataFrame(rows, "k string, u int, v int")
    b = spark.createDataFrame(shuffled, "k string, u int, v int").repartition(3)
    got_a = sorted(tuple(r) for r in latest_per_key(a, ["k"], ["u", "v"]).collect())
    got_b = sorted(tuple(r) for r in latest_per_key(b, ["k"], ["u", "v"]).collect())
    want = sorted({k: max((u, v) for k2, u, v in rows if k2 == k) for k, _, _ in rows}.items())
    assert got_a == got_b == [(k, u, v) for k, (u, v) in want]


def _level(s):
    if s is None:
        return "CRITICAL"
    return "LOW" if s < 0.25 else "MEDIUM" if s < 0.5 else "HIGH" if s < 0.75 else "CRITICAL"


def _class_b(s):
    return "HIGH" if s >= 0.8 else "MODERATE" if s >= 0.5 else "LOW" if s >= 0.2 else "MINIMAL"


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(0, 100), min_size=1, max_size=50))
def test_thresholds_match_python(spark, cents):
    scores = [Decimal(c) / 100 for c in cents]
    df = spark.createDataFrame([(s,) for s in scores], "s decimal(3,2)")
    out = df.select("s", risk.derive_risk_level("s").alias("a"), risk.derive_risk_class_b("s").alias("b"),
                    risk.score_to_level("s").alias("c")).collect()
    for r in out:
        s = float(r["s"])
        assert r["a"] == _level(s) and r["b"] == _class_b(s) and r["c"] == _level(s).lower()
