"""SimHash components, nearest neighbours, string tiling against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash

from ledgerlake.llm import block_neighbours as B
from ledgerlake.llm import simhash_dedup as S
from ledgerlake.llm import string_tiling as G
from ledgerlake.llm import textvec as tv
from ledgerlake.llm.components import local_components

from .conftest import ODD_ROWS


def slow_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [b" ".join(words)]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(fps, distance):
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(fps))]


def test_word_spans_and_hashes():
    import pyarrow as pa
    texts = ["", "a bb  a\n", None, "bb", " \t ", "é日 a"]
    data, off = tv.text_bytes(pa.array(texts))
    s, e, r = tv.word_spans(data, off, tv.whitespace())
    got = [[] for _ in texts]
    for a, b, i in zip(s, e, r):
        got[i].append(bytes(data[a:b]).decode())
    assert got == [(t or "").split() for t in texts]
    h = tv.span_hashes(tv.prefix_sums(data), s, e)
    words = [bytes(data[a:b]) for a, b in zip(s, e)]
    assert len(set(h.tolist())) == len(set(words)) and len({(w, x) for w, x in zip(words, h.tolist())}) == len(set(words))


def test_fingerprints_match_the_definition():
    texts = [r[1] for r in ODD_ROWS] + ["A b\x0bC d e", "a b c d E", "one two three four"]
    got = S._fingerprints([t.encode() if t is not None else None for t in texts], 4, 42)
    assert got.tolist() == [slow_fingerprint(t) for t in texts]


@pytest.mark.parametrize("limit", [4096, 8])
def test_ball_links_give_all_components(spark, limit):
    rnd = random.Random(5)
    fps = {rnd.getrandbits(64) for _ in range(150)} | {0, (1 << 64) - 1}
    for f in list(fps)[:60]:  # chains and balls of near fingerprints
        for _ in range(rnd.randint(1, 5)):
            g = f
            for b in rnd.sample(range(64), rnd.randint(1, 6)):
                g ^= 1 << b
            fps.add(g)
    centre = rnd.getrandbits(64)
    fps |= {centre ^ 1 << a ^ 1 << b for a in range(12) for b in range(12)}
    fps = sorted(fps)
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    at = {f: i for i, f in enumerate(fps)}
    links = [(at[r.u % (1 << 64)], at[r.v % (1 << 64)]) for r in S.fingerprint_links(df, 4, 12, limit).collect()]
    root = local_components(len(fps), np.array([a for a, _ in links]), np.array([b for _, b in links]))
    assert root.tolist() == slow_components(fps, 4)


def test_report_and_kept_rows(spark, odd_docs, no_docs):
    rows = [(r[0], r[1]) for r in ODD_ROWS]
    fps = [slow_fingerprint(t) for _, t in rows]
    root = slow_components(fps, 4)
    smallest = {}
    for (i, _), c in zip(rows, root):
        if i is not None:
            smallest[c] = min(smallest.get(c, i), i)
    want = sorted(((i, f"{f:016x}", smallest.get(c)) for (i, _), f, c in zip(rows, fps, root)), key=repr)
    got = S.near_duplicate_report(odd_docs)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want
    kept = S.keep_one_of_each_group(odd_docs)
    assert kept.schema.names == odd_docs.schema.names
    out = [tuple(r) for r in kept.collect()]
    assert len(out) == len(set(root)) and all(r in ODD_ROWS for r in out)
    assert sorted(root[rows.index((r[0], r[1]))] for r in out) == sorted(set(root))
    assert all(r[0] == smallest.get(root[rows.index((r[0], r[1]))]) for r in out)
    assert S.near_duplicate_report(no_docs).count() == 0 and S.keep_one_of_each_group(no_docs).count() == 0


def test_long_chain_is_one_component(spark):
    f, rows = 0, []
    for i in range(64):
        rows.append((f - (1 << 64) if f >> 63 else f,))
        f |= 1 << i
    from ledgerlake.llm.components import connected_components
    links = S.fingerprint_links(spark.createDataFrame(rows, "fp long"), 2)
    assert {r.label for r in connected_components(links).collect()} == {min(x for x, in rows)}


def slow_nearest(rows, step, k):
    ok = [(i, v) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for q in sorted({i for i, _ in ok if i % step == 0}):
        best = {}
        for qi, qv in ok:
            for ci, cv in ok:
                if qi == q and ci != q and len(qv) == len(cv):
                    s = 0.0
                    for a, b in zip(qv, cv):
                        s += a * b
                    best[ci] = max(best.get(ci, -np.inf), s)
        out += [(q, n + 1, c, s) for n, (s, c) in enumerate(sorted(((s, c) for c, s in best.items()), key=lambda x: (-x[0], x[1]))[:k])]
    return out


def test_nearest_matches_brute_force(spark):
    rnd = np.random.default_rng(3)
    rows = [(i, rnd.normal(size=9).astype(np.float32).astype(float).tolist()) for i in range(300)]
    rows += [(300 + i, rows[7][1]) for i in range(60)] + [(7, rows[7][1]), (11, rows[12][1])]  # ties, repeated rows, one id with two vectors
    rows += [(1000, None), (1020, []), (1040, [0.0] * 9), (1060, [float("nan")] * 9), (1080, [None] * 9), (None, rows[0][1]), (1100, [1.0, 2.0]), (1120, [2.0, 1.0]), (1140, [float("inf")] * 9)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, rank int").repartition(4)
    got = B.nearest_of_every(df, 20, B.BlockParams(k=5, query_block=7, candidate_block=40))
    assert sorted(tuple(r) for r in got.collect()) == slow_nearest(rows, 20, 5)
    assert B.nearest_of_every(df.limit(0), 20).count() == 0


def test_nearest_of_extreme_vectors(spark):
    rng = np.random.default_rng(9)
    sizes = [1.0, 1e-200, 1e160, 1e-310, 3e5, 1e100]
    rows = [(i, [float(x) * sizes[i % 6] for x in rng.normal(size=6)]) for i in range(300)]
    rows += [(300, [5e-324] * 6), (301, [0.0, 0.0, 1.7e308, 0.0, 0.0, 0.0]), (302, [1e-320, 1.0, 0.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in B.nearest_of_every(df, 20, B.BlockParams(k=5, query_block=7, candidate_block=64)).collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    for q, x in rows[::20]:
        every = []
        for c, z in rows:
            total = 0.0
            for a, b in zip(x, z):
                total += a * b
            if c != q:
                every.append((-total if total == total else float("inf"), c))
        assert got[q] == [(c, -s) for s, c in sorted(every)[:5]]
    assert len(got) == len(rows[::20])


def test_quantised_products_stay_within_their_bounds():
    rnd = np.random.default_rng(4)
    x, y = rnd.normal(size=(40, 1500)), rnd.normal(size=(30, 1500)) * np.logspace(-6, 6, 30)[:, None]
    qx, sx, nx, ex = B.quantise(x)
    qy, sy, _, ey = B.quantise(y)
    guess = B.int8_products(qx, qy) * sx[:, None] * sy
    bound = ex[:, None] * np.linalg.norm(y, axis=1) + nx[:, None] * ey
    assert (np.abs(guess - x @ y.T) <= bound * (1 + 1e-9)).all()
    assert (B.int8_products(qx, qy) == qx.astype(np.int64) @ qy.T.astype(np.int64)).all()


ITEM = "the red fox jumps over a lazy dog while seven grey owls watch from their old oak tree at night"


def contaminated(spark, docs, items, **params):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string, coverage string")
    return {r.doc_id: (r.item_ids, round(r.coverage, 3)) for r in G.contaminated_documents(d, b, G.TilingParams(**params)).collect()}


def test_tiling_finds_moved_passages_and_leaves_others(spark, no_docs):
    w = ITEM.split()
    moved = " ".join(["filler words"] + w[10:] + ["in between them"] + w[:10] + ["end"])
    partly = " ".join(w[:8] + ["nothing", "else", "of", "it"])
    docs = [(1, "Before. " + ITEM.upper() + "! after"), (2, moved), (3, partly), (4, "clean text about nothing at all"), (5, None), (6, ""), (7, "x " * 3000), (1, "Before. " + ITEM.upper() + "! after"),
            (None, ITEM), (8, "say hello world twice"), (9, "hello big world")]
    items = [(10, ITEM, "a"), (11, None, None), (12, "", "b"), (13, "Hello, world", "c"), (14, ITEM, "d"), (None, "only this one has no id whatsoever", "e"), (15, "?!", "f")]
    got = contaminated(spark, docs, items)
    assert set(got) == {1, 2, None, 8}
    assert got[1] == ([10, 14], 1.0) and got[2] == ([10, 14], 1.0) and got[8] == ([13], 1.0)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string, coverage string")
    assert sorted((r.doc_id for r in G.drop_contaminated(d, b).collect()), key=str) == [3, 4, 5, 6, 7, 9]
    assert G.contaminated_documents(no_docs, b).count() == 0
    assert G.contaminated_documents(d, b.limit(0)).count() == 0 and G.drop_contaminated(d, b.limit(0)).count() == len(docs)


def slow_tiles(item, text, least):
    a, b, tiles = [True] * len(item), [True] * len(text), []
    while True:
        best = []
        for p in range(len(item)):
            for t in range(len(text)):
                n = 0
                while p + n < len(item) and t + n < len(text) and a[p + n] and b[t + n] and item[p + n] == text[t + n]:
                    n += 1
                if n >= least:
                    best.append((-n, t, p))
        if not best:
            return tiles
        n, t, p = min(best)
        a[p:p - n] = [False] * -n
        b[t:t - n] = [False] * -n
        tiles.append(-n)


def test_tiles_match_the_greedy_definition():
    rnd = random.Random(8)
    for _ in range(60):
        item = np.array([rnd.randint(0, 6) for _ in range(rnd.randint(1, 25))], dtype=np.uint64)
        text = np.array([rnd.randint(0, 6) for _ in range(rnd.randint(0, 60))], dtype=np.uint64)
        got = [n for n, _, _ in G.tile(item, text, 3)]
        want = slow_tiles(item.tolist(), text.tolist(), 3)
        assert max(got, default=0) == max(want, default=0) and abs(sum(got) - sum(want)) <= 3
        assert all(item[p:p + n].tolist() == text[t:t + n].tolist() for n, p, t in G.tile(item, text, 3))


def test_tiles_of_moved_passages_are_the_greedy_ones_exactly():
    rnd = random.Random(21)
    for case in range(1500):
        item = [rnd.randint(0, 4) for _ in range(rnd.randint(1, 24))]
        cut = sorted(rnd.randint(0, len(item)) for _ in range(3))
        parts = [item[:cut[0]], item[cut[0]:cut[1]], item[cut[1]:cut[2]], item[cut[2]:], [rnd.randint(0, 4) for _ in range(6)]]
        rnd.shuffle(parts)
        text = sum(parts, [])
        got = G.tile(np.array(item, dtype=np.uint64), np.array(text, dtype=np.uint64), 2 + case % 3)
        assert [n for n, _, _ in got] == slow_tiles(item, text, 2 + case % 3)
        assert all(item[p:p + n] == text[t:t + n] for n, p, t in got)
        assert len({w for n, p, _ in got for w in range(p, p + n)}) == sum(n for n, _, _ in got) == len({w for n, _, t in got for w in range(t, t + n)})


def test_tiles_of_one_word_repeated():
    item, text = np.zeros(200, dtype=np.uint64), np.zeros(20_000, dtype=np.uint64)
    assert G.tile(item, text, 5) == [(200, 0, 0)]
    assert G.tile(item, text[:190], 5) == [(190, 0, 0)]
    mixed = text.copy()
    mixed[::150] = 1
    assert [n for n, _, _ in G.tile(item, mixed, 5)] == [149, 51]


def test_skipping_frequent_seeds_loses_nothing(spark):
    rnd = random.Random(2)
    vocabulary = [f"w{i}" for i in range(12)]
    docs = [(i, " ".join(rnd.choice(vocabulary) for _ in range(80))) for i in range(60)]
    items = [(i, " ".join(docs[i][1].split()[10:10 + rnd.randint(6, 30)]), "") for i in range(20)] + [(50, " ".join(vocabulary), "")]
    got = contaminated(spark, docs, items, seed_words=2, min_match=2, coverage=0.9)

    def hashes(t):
        import pyarrow as pa
        return G.word_hashes(pa.array([t]))[0]

    want = {}
    for i, t in docs:
        hit = sorted(j for j, u, _ in items if G.coverage(hashes(u), hashes(t), 2)[0] >= 0.9)
        if hit:
            want[i] = hit
    assert {i: x[0] for i, x in got.items()} == want
