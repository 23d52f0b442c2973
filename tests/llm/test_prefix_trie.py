"""The prefix trie against a plain dictionary of prefixes and its SQL twin."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest

from ledgerlake.llm import prefix_trie as P
from ledgerlake.llm import queries as Qs
from ledgerlake.llm.oracle import ORACLE_SQL
from tests.conftest import SF_SMALL

TURN = "conv_id long, turn long, role string, text string, depth int, name string"


def brute(rows):
    """{(conv_id, depth): (parent, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)} of (conv_id, turn, role, text)."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v, key=lambda x: (x[0], x[1], x[2], hashlib.sha256(f"{len(x[2])}:{x[2]}{x[3]}".encode()).digest()[:16]))] for c, v in convs.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        built[c] = tuple(own.get(base, [])[:h] + turns[h:])
    member = defaultdict(list)
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            member[seq[:d]].append(c)
    kids = defaultdict(list)
    for p in member:
        if p:
            kids[p[:-1]].append(p)
    out = {}

    def walk(p):
        leaves, saved = (0, 0) if kids[p] else (1, 0)
        for k in kids[p]:
            a, b = walk(k)
            leaves, saved = leaves + a, saved + b
        saved += (len(member[p]) - 1) * len(p[-1][1]) if p else 0
        ends = ",".join(str(c) for c in sorted(c for c in member[p] if built[c] == p))
        out[min(member[p]), len(p)] = (min(member[p[:-1]]) if p else None, len(member[p]), len(kids[p]), leaves, saved, hashlib.sha256(ends.encode()).hexdigest())
        return leaves, saved

    if member:
        walk(())
    return out


def result(df):
    rows = df.collect()
    got = {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in rows}
    assert len(got) == len(rows)
    return got


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "clash") for r in rows], TURN).repartition(5)


@pytest.mark.parametrize("seed, longest, words", [(1, 6, 2), (2, 13, 1), (3, 40, 1), (4, 1, 3)])
def test_random_conversations(spark, seed, longest, words):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-120, 420), 60):
        for turn in range(rng.randint(1, longest)):
            rows.append((c, turn, "ua"[turn % 2], "w" * rng.randint(1, words)))
    assert result(P.conversation_trie(table(spark, rows))) == brute(rows)


def test_odd_turns(spark):
    long = "é🙂" * 40_000
    rows = [(1, None, None, None), (1, 3, "user", "x"), (1, 3, "user", "x"), (1, 3, "user", "y"), (1, 0, "assistant", ""), (None, 0, "user", "lost"), (2, 5, "user", long), (2, 6, "assistant", long),
            (4, 0, "user", long), (4, 1, "user", long), (4, 2, "u", long), (0, 0, "user", "x"), (700, 0, "a", "b"), (701, 0, "a", "b"), (705, None, "a", "b"), (705, None, "a", "b")]
    rows += [(c, t, "user", "same") for c in range(1000, 1060) for t in range(7)]
    assert result(P.conversation_trie(table(spark, rows))) == brute(rows)


def test_a_conversation_with_most_turns_and_a_node_with_many_members(spark, monkeypatch):
    monkeypatch.setattr(P, "CHUNK", 7)
    rows = [(3, t, "user", str(t % 5)) for t in range(300)] + [(c, t, "user", "common") for c in range(200, 300) for t in range(6)] + [(c, t, "user", f"{c}") for c in range(500, 520) for t in range(3)]
    assert result(P.conversation_trie(table(spark, rows))) == brute(rows)


def test_empty_table(spark):
    out = P.conversation_trie(table(spark, [(1, 1, "a", "b")]).limit(0))
    assert out.count() == 0 and out.columns[:3] == ["conv_id", "depth", "parent_conv_id"]
    assert P.conversation_trie(table(spark, [(None, 1, "a", "b")])).count() == 0


def test_query_and_sql(spark):
    got = result(Qs.queries()["op12_prefix_trie"](spark, SF_SMALL))
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got == brute(rows)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{SF_SMALL}/conversations.parquet')")
    assert {tuple(r[:2]): tuple(r[2:]) for r in con.execute(ORACLE_SQL["op12_prefix_trie"]).fetchall()} == got
