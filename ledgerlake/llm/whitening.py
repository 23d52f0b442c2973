"""Embedding whitening from a bit-sliced scatter.

Every entry c of a vector becomes the integer x = floor(256 c). The fit list holds each distinct x vector once. Tasks cut their rows
of the list into blocks, shift every dimension of a block by its own minimum and pack each bit plane across the rows into 64-bit words;
the popcount of the AND of two planes, weighed by both planes' powers of two, sums to the exact cross-products. Shifts are undone in integers,
so every task gives one exact (dimension x dimension) sum whatever its rows, and Spark adds those up per entry. The scatter is centred
as integers (n * sum(x y) - sum(x) * sum(y)) before one division and the eigen-decomposition, which the driver does on that
matrix alone; its size is the dimension squared and does not grow with the rows.

Memory per task: one block of ``BLOCK_ROWS`` rows, its planes and two matrices of the dimension squared.

Defined results: a row takes part if its vector has no null and no non-finite entry, every x fits a long and it has the table's dimension
(the most frequent length of such vectors; ties: the longer). Other rows give no rows. Repeated rows and null ids are
reported each; extra columns are ignored. Components without variance (eigenvalue at most 1e-12 of the largest) can't be whitened
and give no rows, so a table of one distinct vector, of empty vectors or of no rows gives none. A deviation that does not fit a long is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE = 256
BLOCK_ROWS = 16384
LIMB_BITS = 48
ROWS = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


@dataclass(frozen=True)
class Whitening:
    """The fitted list: n vectors, exact sums; components by falling eigenvalue (columns of ``axes``)."""
    dim: int
    n: int
    sums: tuple[int, ...]
    eigenvalues: np.ndarray
    axes: np.ndarray
    explained: np.ndarray
    identity_error: float


def dimension(df: DataFrame, column: str = "embedding") -> int:
    """The most frequent length of vectors without null or non-finite entries (0: no such vector)."""
    v = F.col(column)
    whole = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    top = df.filter(v.isNotNull() & whole).groupBy(F.size(v).alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    return top["dim"] if top else 0


def _integers(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers that take part, their x vectors as int64)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = np.flatnonzero(column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False) == dim)
    if not len(rows):
        return rows, np.zeros((0, dim), np.int64)
    entries = column.take(pa.array(rows)).flatten()
    x = np.floor(SCALE * entries.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(rows), dim))  # null entries become NaN
    keep = (np.isfinite(x) & (x >= -2.0 ** 63) & (x < 2.0 ** 63)).all(axis=1)
    return rows[keep], x[keep].astype(np.int64)


def _distinct_vectors(df: DataFrame, column: str, dim: int) -> DataFrame:
    """One row per distinct x vector, as bytes: ``dim`` little-endian integers of the least width that holds them all."""
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, x = _integers(batch.column(0), dim)
            large = np.maximum(x.max(axis=1, initial=0), -1 - x.min(axis=1, initial=0))
            width = np.select([large < 2 ** 7, large < 2 ** 15, large < 2 ** 31], [1, 2, 4], 8)
            for w in np.unique(width):
                data = x[width == w].astype(f"<i{w}")
                offsets = np.arange(len(data) + 1, dtype=np.int32) * np.int32(w * dim)
                yield pa.RecordBatch.from_arrays([pa.Array.from_buffers(pa.binary(), len(data), [None, pa.py_buffer(offsets), pa.py_buffer(data.tobytes())])], ["x"])

    return df.select(F.col(column).alias("v")).mapInArrow(packed, "x binary").distinct()


def block_sums(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums, cross-products) of the rows of ``x`` as Python integers, counted on packed bit planes."""
    n, dim = x.shape
    low = x.min(axis=0)
    shifted = x.view(np.uint64) - low.view(np.uint64)  # modulo 2**64, so a range of 2**63 and more is right too
    bits = [int(v).bit_length() for v in shifted.max(axis=0)]
    words = -(-n // 64)
    planes, of = [], []
    for p in range(max(bits, default=0)):
        dims = [d for d in range(dim) if bits[d] > p]
        ones = np.zeros((words * 64, len(dims)), np.uint8)
        ones[:n] = (shifted[:, dims] >> np.uint64(p)) & np.uint64(1)
        planes.append(np.ascontiguousarray(np.packbits(ones, axis=0).T).view(np.uint64))
        of.extend((d, p) for d in dims)
    exact = np.int64 if max(bits, default=0) <= 20 else object  # 2 * 20 bits, 2**14 rows, 20 * 20 pairs of planes
    sums, cross = np.zeros(dim, object), np.zeros((dim, dim), object)
    if of:
        packed = np.concatenate(planes)
        counts = np.zeros((len(of), len(of)), np.int64)
        for i in range(len(of)):
            counts[i, i:] = counts[i:, i] = np.bitwise_count(packed[i] & packed[i:]).sum(axis=1, dtype=np.int64)
        weights = np.zeros((len(of), dim), exact)
        for i, (d, p) in enumerate(of):
            weights[i, d] = 1 << p
        sums = (np.diagonal(counts).astype(exact) @ weights).astype(object)
        cross = (weights.T @ counts.astype(exact) @ weights).astype(object)
    low = np.array([int(v) for v in low], object)
    return sums + n * low, cross + np.outer(low, sums) + np.outer(sums, low) + n * np.outer(low, low)


def _task_sums(dim: int):
    """Per task: n as (-1, -1), sums as (i, -1) and cross-products as (i, j >= i), each cut into signed limbs."""
    schema = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("limb", pa.int32()), ("value", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, cross = 0, np.zeros(dim, object), np.zeros((dim, dim), object)
        for batch in batches:
            raw = batch.column(0)
            lengths = np.asarray(raw.to_pandas().str.len()) if len(raw) else np.zeros(0, int)
            for length in np.unique(lengths):
                data = b"".join(raw.filter(pa.array(lengths == length)).to_pylist())
                x = np.frombuffer(data, dtype=f"<i{length // dim}").reshape(-1, dim).astype(np.int64)
                for at in range(0, len(x), BLOCK_ROWS):
                    s, c = block_sums(np.ascontiguousarray(x[at:at + BLOCK_ROWS]))
                    sums, cross = sums + s, cross + c
                n += len(x)
        if not n:
            return
        out = [(-1, -1, n)] + [(i, -1, int(sums[i])) for i in range(dim)] + [(i, j, int(cross[i, j])) for i in range(dim) for j in range(i, dim)]
        rows = []
        for i, j, value in out:
            sign, rest, limb = (-1 if value < 0 else 1), abs(value), 0
            while rest:
                rows.append((i, j, limb, sign * (rest & ((1 << LIMB_BITS) - 1))))
                rest, limb = rest >> LIMB_BITS, limb + 1
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return run


def fit_whitening(df: DataFrame, column: str = "embedding", components: int = 4) -> Whitening | None:
    """The first ``components`` whitened components of the distinct x vectors; None where there are none."""
    dim = dimension(df, column)
    if not dim:
        return None
    parts = _distinct_vectors(df, column, dim).mapInArrow(_task_sums(dim), "i int, j int, limb int, value long")
    total = parts.groupBy("i", "j", "limb").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    n, sums, cross = 0, [0] * dim, [[0] * dim for _ in range(dim)]
    for r in total.collect():  # bounded by the dimension squared
        value = int(r["value"]) << (LIMB_BITS * r["limb"])
        if r["i"] < 0:
            n += value
        elif r["j"] < 0:
            sums[r["i"]] += value
        else:
            cross[r["i"]][r["j"]] += value
    return whitening_of(n, sums, cross, components)


def whitening_of(n: int, sums: list[int], cross: list[list[int]], components: int) -> Whitening | None:
    """Centre the scatter (upper triangle) as integers, divide once and decompose."""
    dim = len(sums)
    if not n:
        return None
    cov = np.zeros((dim, dim))
    for i in range(dim):
        for j in range(i, dim):
            cov[i, j] = cov[j, i] = (n * cross[i][j] - sums[i] * sums[j]) / (n * n)
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    k = int((values[:components] > max(values[0], 0) * 1e-12).sum())
    if not k:
        return None
    values, axes = values[:k].copy(), np.ascontiguousarray(axes[:, :k])
    scaled = axes / np.sqrt(values)
    error = float(np.abs(scaled.T @ cov @ scaled - np.eye(k)).max())
    return Whitening(dim, n, tuple(sums), values, axes, values / np.trace(cov), error)


def whiten(df: DataFrame, model: Whitening | None, column: str = "embedding", key: str = "vec_id") -> DataFrame:
    """One row per row that takes part and component: its whitened coordinate, with the fit's figures."""
    src = df.select(F.col(key).cast("long").alias("vec_id"), F.col(column).alias("v"))
    if model is None:
        return src.filter(F.lit(False)).select(*[F.lit(None).cast(t).alias(c) for c, t in (f.split() for f in ROWS.split(", "))])
    dim, n, k = model.dim, model.n, len(model.eigenvalues)
    sums, axes = model.sums, model.axes / np.sqrt(model.eigenvalues)
    explained, error = model.explained, model.identity_error

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = np.array(sums, object)
        for batch in batches:
            rows, x = _integers(batch.column(1), dim)
            if not len(rows):
                continue
            most = n * max(int(x.max()), -int(x.min())) + max(abs(v) for v in sums)
            if dim * most * most < 2 ** 63:
                centred = n * x - s.astype(np.int64)
                deviation = (centred * centred).sum(axis=1).tolist()
            else:
                centred = n * x.astype(object) - s
                deviation = [int(v) if v < 2 ** 63 else None for v in (centred * centred).sum(axis=1)]
            whitened = (centred / n).astype(np.float64) @ axes
            m = len(rows)
            ids = batch.column(0).take(pa.array(np.repeat(rows, k)))
            yield pa.RecordBatch.from_arrays([
                ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n, np.int64)),
                pa.array([d for d in deviation for _ in range(k)], pa.int64()), pa.array(whitened.reshape(-1)),
                pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return src.mapInArrow(run, ROWS)


def whitened_components(df: DataFrame, components: int = 4) -> DataFrame:
    """Fit on the table's distinct x vectors and whiten all of its rows."""
    return whiten(df, fit_whitening(df, components=components))
