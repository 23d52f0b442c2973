"""Nearest neighbours by a block matrix join of int8 product tiles.

Queries and candidates are dealt into blocks by a hash of their id; a tile is one query block against one candidate
block and comes together in a shuffle on the tile's key. In a tile, vectors are quantised to int8 and multiplied as a
matrix (exactly, in float32 sums below 2**24). With x = x' + e, |x.y - x'.y'| <= |e_x| |y| + |x'| |e_y| bounds the
error, so a pair stays out only if its upper bound is below the lower bounds of k others of its query. The pairs left
are recomputed on the original vectors in double precision, and the tiles' k best are merged per query by a heap. The result is
therefore exact (recall 1).

Tiles have at most about ``query_block`` x ``candidate_block`` pairs whatever the input's size; only their number grows.

Defined results: vectors that are null, empty, zero, or hold a null or non-finite component, and rows with a null id take no part.
Vectors of different lengths never meet. Rows repeated in id and vector count once; an id with several vectors is near by its
best one, and is one query, whose results leave out its own id. Ties go to the smaller id. A score whose
double sum overflows is infinite, or no number and then last. Other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class BlockParams:
    k: int = 20
    query_block: int = 2048
    candidate_block: int = 8192


def usable_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, v, d): distinct rows that take part; v is array<double>, d its length."""
    v = F.col("v")
    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).filter("id is not null and v is not null and size(v) > 0")
    inf = float("inf")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf)) & F.exists(v, lambda x: x != 0.0)
    return src.filter(fine).dropDuplicates(["id", "v"]).withColumn("d", F.size(v))


def quantise(x: np.ndarray):
    """int8 rows, their scales, the norms of the quantised rows and of the errors (rounded up a little)."""
    scale = np.abs(x).max(axis=1) / 127.0
    q = np.rint(x / scale[:, None])
    back = q * scale[:, None]
    slack = 1.0 + 1e-9
    return q.astype(np.int8), scale, np.sqrt((back * back).sum(axis=1)) * slack, np.sqrt(((x - back) ** 2).sum(axis=1)) * slack + 1e-300


def unit_exponent(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows divided by a power of two, so that the largest component is in [0.5, 1); the exponents of those powers).

    Norms of such rows neither overflow nor vanish, whatever the finite non-zero row was."""
    exponent = np.frexp(np.abs(x).max(axis=1))[1].astype(np.int64)
    half = exponent // 2  # in two steps: 2**1074 is no double
    return np.ldexp(np.ldexp(x, -half[:, None]), -(exponent - half)[:, None]), exponent


def int8_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of int8 matrices, exactly: at most 1,024 products of 127 * 127 stay below 2**24 in float32."""
    out = np.zeros((len(a), len(b)))
    for lo in range(0, a.shape[1], 1024):
        out += a[:, lo:lo + 1024].astype(np.float32) @ b[:, lo:lo + 1024].astype(np.float32).T
    return out


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products, added in the order of the components, so equal vectors get equal sums."""
    total = np.zeros(len(a))
    with np.errstate(over="ignore", invalid="ignore"):
        for j in range(a.shape[1]):
            total += a[:, j] * b[:, j]
    return total


def tile_nearest(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int, rows_at_once: int = 256):
    """(query id, id, score): a tile's k best for every query row, by rising query row."""
    plain_q, q_exp = unit_exponent(queries)
    plain_c, c_exp = unit_exponent(vectors)
    q8, q_scale, q_norm, q_err = quantise(plain_q)
    c8, c_scale, _, c_err = quantise(plain_c)
    c_norm = np.sqrt((plain_c * plain_c).sum(axis=1)) * (1.0 + 1e-9)
    c_err += 1e-11 * c_norm  # double sums round
    wide = max((int(np.abs(e).max()) for e in (q_exp, c_exp) if len(e)), default=0) > 450
    if not wide:
        q_scale, q_norm, q_err = (np.ldexp(a, q_exp) for a in (q_scale, q_norm, q_err))
        c_scale, c_norm, c_err = (np.ldexp(a, c_exp) for a in (c_scale, c_norm, c_err))
    # an id may have several vectors here; the bound must pass k different ids
    need = k * int(np.unique(ids, return_counts=True)[1].max()) if len(ids) else k
    out = []
    for lo in range(0, len(queries), rows_at_once):
        hi = min(lo + rows_at_once, len(queries))
        guess = int8_products(q8[lo:hi], c8) * q_scale[lo:hi, None] * c_scale
        error = q_err[lo:hi, None] * c_norm + q_norm[lo:hi, None] * c_err
        if wide:  # where a product may leave the range of doubles the bounds decide nothing and the pair stays
            exponent = q_exp[lo:hi, None] + c_exp
            safe = np.abs(exponent) <= 900
            exponent = np.where(safe, exponent, 0)
            guess, error = np.ldexp(guess, exponent), np.where(safe, np.ldexp(error, exponent), np.inf)
        own = query_ids[lo:hi, None] == ids
        low = np.where(own, -np.inf, guess - error)
        bar = np.partition(low, -need, axis=1)[:, -need] if need <= len(ids) else np.full(hi - lo, -np.inf)
        r, c = np.nonzero((guess + error >= bar[:, None]) & ~own)
        score = exact_products(queries[lo + r], vectors[c])
        order = np.lexsort((ids[c], -score, r))
        r, c, score = r[order], c[order], score[order]
        if need > k and len(r):  # an id's best vector only
            _, first = np.unique(np.stack([r, ids[c]]), axis=1, return_index=True)
            first.sort()
            r, c, score = r[first], c[first], score[first]
        place = np.arange(len(r)) - np.searchsorted(r, r)
        top = place < k
        out.append((query_ids[lo + r[top]], ids[c[top]], score[top]))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 2 + (np.zeros(0),)


def _matrix(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    v = t.column("v").combine_chunks()
    return np.asarray(t.column("id").combine_chunks()), np.asarray(v.flatten()).reshape(len(t), -1)


def _tile(left: pa.Table, right: pa.Table, k: int) -> pa.Table:
    if len(left) and len(right):
        q, c, s = tile_nearest(*_matrix(left), *_matrix(right), k)
    else:
        q, c, s = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(c, pa.int64()), "score": pa.array(s, pa.float64())})


def _merge_batches(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """k best of each query by a heap; the input is sorted by query."""
    held_id, best = None, {}

    def close():
        # a sum that is no number (infinities of both signs) comes last
        top = [(best[v], v) for _, v in heapq.nsmallest(k, ((-s if s == s else np.inf, v) for v, s in best.items()))]
        return pa.RecordBatch.from_arrays(
            [pa.array([held_id] * len(top), pa.int64()), pa.array(range(1, len(top) + 1), pa.int32()), pa.array([v for _, v in top], pa.int64()), pa.array([s for s, _ in top], pa.float64())],
            ["query_id", "rank", "vec_id", "score"])

    out = []
    for batch in batches:
        for q, v, s in zip(*(batch.column(c).to_pylist() for c in ("query_id", "vec_id", "score"))):
            if q != held_id:
                if best:
                    out.append(close())
                held_id, best = q, {}
            if v not in best or s > best[v] or best[v] != best[v]:
                best[v] = s
        if out:
            yield from pa.Table.from_batches(out).combine_chunks().to_batches()
            out = []
    if best:
        yield close()


def nearest(vectors: DataFrame, queries: DataFrame, params: BlockParams = BlockParams()) -> DataFrame:
    """query_id, rank, vec_id, score; both inputs come from ``usable_vectors``."""
    sizes = {r["d"]: r["n"] for r in vectors.groupBy("d").agg(F.count(F.lit(1)).alias("n")).collect()}
    wanted = {r["d"]: r["n"] for r in queries.groupBy("d").agg(F.count(F.lit(1)).alias("n")).collect()}
    most, most_q = max(sizes.values(), default=0), max(wanted.values(), default=0)
    c_blocks, q_blocks = max(1, -(-most // params.candidate_block)), max(1, -(-most_q // params.query_block))
    block = lambda n: F.pmod(F.xxhash64("id", "v"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = queries.withColumn("qb", block(q_blocks)).withColumn("cb", every(c_blocks))
    right = vectors.withColumn("cb", block(c_blocks)).withColumn("qb", every(q_blocks))
    tiles = (left.groupBy("d", "qb", "cb").cogroup(right.groupBy("d", "qb", "cb"))
             .applyInArrow(partial(_tile, k=params.k), "query_id long, vec_id long, score double"))
    return (tiles.repartition("query_id").sortWithinPartitions("query_id")
            .mapInArrow(partial(_merge_batches, k=params.k), "query_id long, rank int, vec_id long, score double"))


def nearest_of_every(df: DataFrame, step: int = 20, params: BlockParams = BlockParams()) -> DataFrame:
    """Queries: the rows whose id is divisible by ``step``; candidates: all rows of other ids."""
    vectors = usable_vectors(df)
    return nearest(vectors, vectors.filter(F.col("id") % step == 0), params)
