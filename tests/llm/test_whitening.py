"""Embedding whitening against plain integer and floating-point sums."""

import numpy as np
import pytest

from ledgerlake.llm import queries as Qs
from ledgerlake.llm import whitening as W
from tests.conftest import SF_CHECK

VEC = "vec_id long, embedding array<double>, component int, n long, x string"


@pytest.mark.parametrize("low, high, rows", [(-160, 160, 1000), (0, 1, 65), (5, 6, 64), (-2 ** 62, 2 ** 62, 130), (-2 ** 30, 3, 7), (4, 5, 1)])
def test_bit_planes_give_exact_sums(low, high, rows):
    x = np.random.default_rng(rows).integers(low, high, (rows, 5))
    x[:, 3] = x[0, 3]  # a constant dimension has no planes
    sums, cross = W.block_sums(x)
    o = x.astype(object)
    assert list(sums) == list(o.sum(axis=0)) and (cross == o.T @ o).all()


def brute(vectors):
    x = np.array([[int(np.floor(256 * c)) for c in v] for v in vectors], float)
    fit = np.unique(x, axis=0)
    mean, cov = fit.mean(axis=0), np.cov(fit.T, bias=True)
    values, axes = np.linalg.eigh(cov)
    return x, len(fit), mean, cov, values[::-1], axes[:, ::-1]


def test_whitening_against_numpy(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SF_CHECK}/embeddings.parquet").collect()]
    x, n, mean, cov, values, axes = brute([v for _, v in rows])
    got = Qs.queries()["op13_whitening"](spark, SF_CHECK).toPandas()
    assert len(got) == 4 * len(rows) and set(got.n) == {n}
    assert got.identity_error.max() <= 1e-9 and got.identity_error.nunique() == 1
    at = {i: x[k] for k, (i, _) in enumerate(rows)}
    for c in range(1, 5):
        part = got[got.component == c]
        want = (np.array([at[i] for i in part.vec_id]) - mean) @ axes[:, c - 1] / np.sqrt(values[c - 1])
        sign = np.sign(np.dot(want, part.whitened))
        assert np.abs(sign * want - part.whitened).max() < 1e-9
        assert np.abs(part.explained - values[c - 1] / np.trace(cov)).max() < 1e-12
    sums = np.unique(x, axis=0).astype(np.int64).sum(axis=0)
    assert all(d == int(((n * at[i].astype(np.int64) - sums) ** 2).sum()) for i, d in zip(got.vec_id, got.deviation))


def test_odd_vectors(spark):
    rng = np.random.default_rng(5)
    good = [(i, rng.normal(size=6).tolist()) for i in range(40)]
    odd = [(100, None), (101, [None] + [0.5] * 5), (102, [float("nan")] * 6), (103, [float("inf")] + [0.0] * 5), (104, [1e300] * 6), (105, [1.0] * 3), (106, [])]
    again = [good[3], good[3], (None, good[4][1]), (200, good[5][1])]
    df = spark.createDataFrame([(i, v, 7, 8, "clash") for i, v in good + odd + again], VEC).repartition(5)
    got = W.whitened_components(df).toPandas()
    assert len(got) == 4 * (len(good) + len(again)) and set(got.n) == {40}
    assert (got.vec_id == 3).sum() == 12 and got.vec_id.isna().sum() == 4
    model = W.fit_whitening(df)
    x, n, mean, cov, values, axes = brute([v for _, v in good])
    assert model.n == n and np.allclose(model.eigenvalues, values[:4])
    fitted = got.drop_duplicates(["vec_id", "component"]).dropna().query("vec_id < 100").pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    assert np.abs(np.cov(fitted.T, bias=True) - np.eye(4)).max() < 1e-9


def test_tables_without_variance(spark):
    one = spark.createDataFrame([(1, [0.1, 0.2], 1, 1, ""), (2, [0.1, 0.2], 1, 1, "")], VEC)
    for df in (one, one.limit(0), spark.createDataFrame([(1, [], 1, 1, ""), (2, None, 1, 1, "")], VEC)):
        out = W.whitened_components(df)
        assert out.columns == [f.split()[0] for f in W.ROWS.split(", ")] and out.count() == 0
    # two distinct vectors span one component
    line = spark.createDataFrame([(1, [0.0, 0.0], 1, 1, ""), (2, [1.0, 1.0], 1, 1, "")], VEC)
    rows = W.whitened_components(line).collect()
    assert len(rows) == 2 and sorted(round(r.whitened, 9) for r in rows) == [-1.0, 1.0]


def test_large_values_stay_exact(spark):
    df = spark.createDataFrame([(i, [2.0 ** 52 + i, -2.0 ** 51 * i], 1, 1, "") for i in range(5)], VEC)
    model = W.fit_whitening(df)
    want = [sum(int(256 * (2.0 ** 52 + i)) for i in range(5)), sum(int(-256 * 2.0 ** 51 * i) for i in range(5))]
    assert list(model.sums) == want
    assert all(r.deviation is None for r in W.whiten(df, model).filter("vec_id <> 2").collect())  # does not fit a long
