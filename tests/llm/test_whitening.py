"""Bit-sliced covariance against exact integers, whitening against its definition, edge rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import whitening as wh

SCHEMA = "vec_id long, embedding array<float>"


def table(spark, x, extra=()):
    rows = [(k, [float(c) for c in v]) for k, v in enumerate(x)] + list(extra)
    return spark.createDataFrame(rows, SCHEMA)


def integers(x):
    return np.floor(1024 * np.asarray(x, np.float32).astype(np.float64)).astype(np.int64) + 100_000


@pytest.mark.parametrize(("n", "dims", "scale"), [(1, 3, 1), (63, 5, 0.01), (64, 1, 1), (700, 7, 3), (5000, 4, 1000)])
def test_products_are_exact(spark, n, dims, scale):
    x = np.random.default_rng(n).normal(0, scale, (n, dims)) - 5
    vectors = wh.whole_vectors(table(spark, x).repartition(3))
    model = wh.fit(vectors)
    z = integers(x).astype(object)
    s = z.sum(0)
    exact = n * (z.T @ z) - np.outer(s, s)
    assert model.n == n and model.sums == s.tolist()
    want = np.array([[exact[i, j] / (n * n) for j in range(dims)] for i in range(dims)])
    assert (model.covariance == want).all()  # to the last bit


def test_wide_spreads_use_large_integers(spark):
    x = np.array([[0, 1e9], [1e9, -3e9], [5e8, 7]])
    model = wh.fit(wh.whole_vectors(table(spark, x)))
    z = integers(x).astype(object)
    s = z.sum(0)
    assert model.sums == s.tolist()
    assert (model.covariance == np.array([[(3 * (z[:, i] @ z[:, j]) - s[i] * s[j]) / 9 for j in range(2)] for i in range(2)])).all()
    rows = wh.whiten(table(spark, x)).collect()
    assert {r.id: int(r.deviation) for r in rows} == {k: int(((3 * z[k] - s) ** 2).sum()) for k in range(3)}
    with pytest.raises(ValueError, match="spreads"):
        wh.fit(wh.whole_vectors(table(spark, [[0.0], [1e14]])))
    with pytest.raises(Exception, match="too large"):
        wh.whole_vectors(table(spark, [[0.0], [-1e30]])).collect()


def test_whitened_rows(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(900, 12)) @ rng.normal(size=(12, 12))
    odd = [(1000, None), (1001, [None] * 12), (1002, [float("nan")] + [0.0] * 11), (1003, [float("-inf")] + [0.0] * 11), (1004, [])]
    got = wh.whiten(table(spark, x, odd), 8).orderBy("id").collect()
    assert [r.id for r in got] == list(range(900))
    z = integers(x)
    n, s = len(z), z.sum(0)
    v = np.cov(z.T, bias=True)
    e, u = np.linalg.eigh(v)
    order = np.argsort(e)[::-1][:8]
    want = (z - s / n) @ u[:, order] / np.sqrt(e[order])
    w = np.array([r.whitened for r in got])
    assert np.abs(np.abs(w) - np.abs(want)).max() < 1e-9 and np.abs(np.cov(w.T, bias=True) - np.eye(8)).max() < 1e-9
    assert [int(r.deviation) for r in got] == ((n * z - s) ** 2).sum(1).tolist()
    assert np.allclose(got[0].explained, e[order] / np.trace(v)) and got[0].identity_error < 1e-9
    assert len({(r.n, r.identity_error, tuple(r.explained)) for r in got}) == 1


def test_ties_repeated_rows_and_clashing_columns(spark):
    x = [[1.0, 2.0, 3.0]] * 4 + [[2.0, 0.0, 3.0]] * 4  # one component has variance, the third dimension none
    df = table(spark, x, [(0, [1.0, 2.0, 3.0]), (None, [2.0, 0.0, 3.0])]).withColumns({"id": F.lit(1), "x": F.lit("a"), "n": F.lit(2)})
    got = wh.whiten(df).collect()
    assert len(got) == 10 and {len(r.whitened) for r in got} == {1} and {r.n for r in got} == {10}
    assert np.isclose(np.var([r.whitened[0] for r in got]), 1) and got[0].identity_error < 1e-9


@pytest.mark.parametrize("x", [[], [[1.0, 2.0]], [[1.0, 2.0]] * 5])
def test_nothing_to_whiten(spark, x):
    got = wh.whiten(table(spark, x))
    assert got.collect() == [] and got.columns == ["id", "n", "deviation", "whitened", "explained", "identity_error"]


def test_lengths_differ(spark):
    with pytest.raises(ValueError, match="lengths"):
        wh.whiten(table(spark, [[1.0, 2.0], [1.0]]))
