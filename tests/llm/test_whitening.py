"""Whitening against numpy's eigenvectors of the covariance, over distinct vectors gathered in one place."""

import math

import numpy as np
import pytest

from millrace.llm import whitening as w
from millrace.llm.common import table

VECTORS = "vec_id bigint, embedding array<float>, label int, x int, n string"


def frame(spark, vectors):
    floats = [(i, v and [None if c is None else float(c) for c in v]) for i, v in vectors]
    return spark.createDataFrame([(i, v, 0, 1, "c") for i, v in floats], VECTORS)


def check(got, vectors, most):
    """``got`` against a plain computation in Python integers and numpy."""
    good = [(i, v) for i, v in vectors if v and all(c is not None and math.isfinite(c) for c in v)]
    xs = [[math.floor(256 * float(np.float32(c))) for c in v] for _, v in good]
    distinct = np.array(sorted(set(map(tuple, xs))), float)
    n, d = distinct.shape
    sums = [int(s) for s in distinct.sum(axis=0)]
    centred = distinct - np.array(sums) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(most, int((values > 1e-12 * values.sum()).sum()))
    assert len(got) == k * len(good)
    by = {}
    for r in got:
        by.setdefault(r["component"], []).append(r)
    for c in range(1, k + 1):
        rows = by[c]
        want = sorted(zip([i for i, _ in good], xs), key=repr)
        rows = sorted(rows, key=lambda r: (repr(r["vec_id"]), r["deviation"]))
        far = sorted(((i, sum((n * v - s) ** 2 for v, s in zip(x, sums))) for i, x in want), key=lambda p: (repr(p[0]), p[1]))
        assert [(r["vec_id"], r["deviation"]) for r in rows] == far
        assert {r["n"] for r in rows} == {n} and rows[0]["identity_error"] < 1e-10
        assert rows[0]["explained"] == pytest.approx(values[c - 1] / values.sum(), rel=1e-11)
        gap = min([abs(values[c - 1] - v) for j, v in enumerate(values) if j != c - 1] or [values[0]])
        if gap > 1e-6 * values[0]:
            plain = sorted(round(float((np.array(x) - np.array(sums) / n) @ axes[:, c - 1] / math.sqrt(values[c - 1])), 6) for _, x in want)
            mine = sorted(round(r["whitened"], 6) for r in rows)
            assert np.allclose(mine, plain, atol=1e-5) or np.allclose(mine, sorted(-v for v in plain), atol=1e-5)
    return by


def test_odd_rows(spark):
    rng = np.random.default_rng(1)
    basis = rng.normal(size=(6, 6)) * [3, 2, 1, .5, .3, .1]
    vectors = [(i, [float(c) for c in rng.normal(size=6) @ basis]) for i in range(400)]
    vectors += [(3, vectors[3][1]), (900, vectors[4][1]), (None, vectors[5][1]), (901, None), (902, []), (903, [1.0, None, 0, 0, 0, 0]),
                (904, [float("nan")] + [0.0] * 5), (905, [float("-inf")] + [0.0] * 5), (906, [-0.0] * 6)]
    by = check(w.whiten(frame(spark, vectors), 4).collect(), vectors, 4)
    assert len(by) == 4


@pytest.mark.parametrize("kind", ["constant", "dependent", "few", "one", "wide"])
def test_ranks(spark, kind):
    rng = np.random.default_rng(2)
    data = rng.normal(size=(60, 8))
    if kind == "constant":
        data[:, 2:] = 0.5
    elif kind == "dependent":
        data[:, 4:] = data[:, :4]
    elif kind == "few":
        data = data[:3]
    elif kind == "one":
        data = data[:1]
    else:
        data *= 10.0 ** np.arange(4, -4, -1)  # variances from 1e8 down to less than one step
    vectors = [(i, [float(c) for c in row]) for i, row in enumerate(data)]
    got = w.whiten(frame(spark, vectors), 4).collect()
    assert not got if kind == "one" else check(got, vectors, 4)
    assert max((r["component"] for r in got), default=0) == {"constant": 2, "few": 2, "one": 0}.get(kind, 4)


def test_ill_conditioned_factors_are_composed():
    rng = np.random.default_rng(5)
    a = rng.normal(size=(500, 12)) @ np.diag(10.0 ** -np.arange(12)) @ np.linalg.qr(rng.normal(size=(12, 12)))[0]
    y, product = a.copy(), np.eye(12)
    for _ in range(4):
        r = w._shifted_cholesky(y.T @ y)
        y, product = w.solved(y, r), r @ product
    assert np.abs(y.T @ y - np.eye(12)).max() < 1e-12
    assert np.allclose(np.linalg.svd(product)[1], np.linalg.svd(a)[1], rtol=1e-4)


def test_lengths_and_limits(spark):
    rows = [(i, [float(i % 7), float(i % 3)]) for i in range(30)] + [(50, [1.0]), (51, [1.0, 2.0, 3.0]), (52, [1e38, 0.0])]
    got = w.whiten(frame(spark, rows), 4).collect()
    assert {r["vec_id"] for r in got} == set(range(30)) and {r["component"] for r in got} == {1, 2}
    assert w.whiten(frame(spark, []), 4).count() == 0
    assert w.whiten(frame(spark, [(1, None)]), 4).count() == 0
    far = w._deviation(np.array([[1 << 40, 0], [1, 2]]), 1 << 30, np.array([0, 0]), (0, 0))
    assert far == [None, 5 << 60]


def test_given_embeddings(spark, sf):
    rows = table(spark, sf, "embeddings")
    vectors = [(r["vec_id"], r["embedding"]) for r in rows.collect()]
    check(w.whiten(rows, 4).collect(), vectors, 4)
