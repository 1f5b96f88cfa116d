import math

import numpy as np
import pytest

from llm_helpers import odd  # noqa: F401
from tripstar.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int, id string, x string, n string, component string"


def _frame(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(i, v, 0, "a", "b", "c", "d") for i, v in zip(ids, vectors, strict=True)], SCHEMA).repartition(3)


def _check(spark, rows, vectors, ids, k=4):
    """Against the eigenvectors of the covariance of the distinct integer vectors."""
    usable = [(i, v) for i, v in zip(ids, vectors, strict=True) if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    dims = max(len(v) for _, v in usable)
    x = np.array([[math.floor(256 * float(np.float32(c))) for c in v] + [0] * (dims - len(v)) for _, v in usable], dtype=np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    values, basis = np.linalg.eigh(np.cov(fit.T, bias=True).reshape(dims, dims))
    values, basis = values[::-1], basis[:, ::-1]
    k = min(k, int((values > 1e-12 * values[0]).sum()))
    want = (x - fit.mean(axis=0)) @ basis[:, :k] / np.sqrt(values[:k])
    got = sorted(rows, key=lambda r: (str(r.vec_id), r.deviation, r.component))
    assert len(got) == len(usable) * k
    assert {r.n for r in got} == {n} and max(r.identity_error for r in got) < 1e-9
    deviation = [int(d) for d in ((n * x.astype(object) - sums.astype(object)) ** 2).sum(axis=1)]
    by_id = {}
    for r in got:
        by_id.setdefault((str(r.vec_id), r.deviation), {}).setdefault(r.component, set()).add(r.whitened)
        assert abs(r.explained / (values[r.component - 1] / values.sum()) - 1) < 1e-9
    signs = None
    for (i, _), d, w in zip(usable, deviation, want, strict=True):
        mine = np.array([by_id[(str(i), d)][c + 1].copy().pop() for c in range(k)])
        signs = np.sign(mine * w) if signs is None and np.all(np.abs(w) > 1e-3) else signs
        assert np.allclose(np.abs(mine), np.abs(w), atol=1e-8)
        assert signs is None or np.allclose(mine, w * signs, atol=1e-8)


def test_close_spectrum_against_eigenvectors(spark):
    rng = np.random.default_rng(0)
    vectors = rng.normal(0, 0.13, (900, 64)).astype(np.float32).tolist()
    vectors += vectors[:200]
    rows = W.whiten(_frame(spark, vectors)).collect()
    _check(spark, rows, vectors, range(len(vectors)))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [None, [], [1.0, nan, 2.0], [1.0, inf, 0.0], [None, 1.0, 1.0], [0.5, -0.25, 1.5], [0.5, -0.25, 1.5], [0.1, 0.2], [-0.0, 3.0, -4.0], [9.0, 1.0, 0.001], [2.0, 2.0, 2.0]]
    ids = [1, 2, 3, 4, 5, 6, 6, 7, None, 8, 9]
    rows = W.whiten(_frame(spark, vectors, ids)).collect()
    _check(spark, rows, vectors, ids)
    assert {r.vec_id for r in rows} == {2, 6, 7, None, 8, 9}


def test_no_variance_and_no_rows(spark):
    for vectors in ([], [None, [float("nan")]], [[]], [[1.0, 2.0]] * 5, [[0.001], [0.002]]):
        assert W.whiten(_frame(spark, vectors)).collect() == []
    line = [[float(i), 2.0 * i, 0.0] for i in range(6)]
    assert {r.component for r in W.whiten(_frame(spark, line)).collect()} == {1}


def test_large_entries(spark):
    vectors = [[1e30, 1.0], [-1e30, 2.0], [1e15, -3.0]]
    rows = W.whiten(_frame(spark, vectors)).collect()
    assert {r.deviation for r in rows} == {None} and {r.vec_id for r in rows} == {0, 1, 2}


def test_tied_eigenvalues(spark):
    axes = [[s * 1.0 if i == j else 0.0 for j in range(40)] for i in range(40) for s in (1, -1)]
    rows = W.whiten(_frame(spark, axes), guard=2).collect()
    assert len(rows) == 80 * 4 and max(r.identity_error for r in rows) < 1e-9
    assert all(abs(r.explained - 1 / 40) < 1e-9 for r in rows)


def test_uncertified_components_raise(spark):
    fit = W.fit_list(W.integer_vectors(_frame(spark, np.random.default_rng(0).normal(0, 1, (300, 50)).tolist())))
    with pytest.raises(RuntimeError, match="no certified components"):
        W.leading_components(fit, 4, guard=1, rounds=2)
