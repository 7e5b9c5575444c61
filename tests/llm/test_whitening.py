"""Whitening against NumPy on whole numbers."""

import math

import numpy as np
import pytest

from quarrymill.llm.whitening import fit_whitening, whiten

KIND = "vec_id long, embedding array<float>, deviation string, label int"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, "old", 1) for i, v in enumerate(vectors)], KIND).repartition(3)


def expected(vectors):
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors], dtype=object)
    n, s = len(x), x.sum(0)
    deviation = ((n * x - s) ** 2).sum(1)
    c = np.array((n * x - s) / n, dtype=float)
    e, u = np.linalg.eigh(c.T @ c / n)
    return n, deviation, c, e[::-1], u[:, ::-1]


@pytest.mark.parametrize(("dims", "n", "components"), [(6, 200, 32), (5, 40, 3), (1, 9, 4), (2, 30, 2), (7, 60, 7)])
def test_against_numpy(spark, dims, n, components):
    rng = np.random.default_rng(dims)
    vectors = (rng.normal(size=(n, dims)) @ rng.normal(size=(dims, dims)) + 3).tolist()
    bad = [None, [1.0] * (dims - 1) + [None], [float("nan")] * dims, [1.0] * (dims - 1) + [float("inf")], [0.5] * (dims + 1), []]
    df = frame(spark, vectors + bad)
    fit = fit_whitening(df, components=components)
    n_, deviation, c, e, u = expected(vectors)
    k = min(components, dims)
    assert fit.n == n_ and fit.dims == dims and fit.identity_error < 1e-9
    np.testing.assert_allclose(fit.eigenvalues, e[:k], rtol=1e-9)
    np.testing.assert_allclose(fit.explained, e[:k] / e.sum(), rtol=1e-9)
    rows = whiten(df, fit).collect()
    assert sorted(r["vec_id"] for r in rows) == list(range(n)) and rows[0].asDict().keys() == {"vec_id", "embedding", "deviation", "label", "whitened"}
    got = np.array([r["whitened"] for r in sorted(rows, key=lambda r: r["vec_id"])])
    want = c @ u[:, :k] / np.sqrt(e[:k])
    want *= np.sign((got * want).sum(0))
    np.testing.assert_allclose(got, want, atol=1e-8)
    assert [r["deviation"] for r in sorted(rows, key=lambda r: r["vec_id"])] == deviation.tolist()


def test_no_variance_ties_and_nothing(spark):
    flat = frame(spark, [[1.0, 2.0, 3.0]] * 5 + [[1.0, 4.0, 3.0]])
    fit = fit_whitening(flat)
    rows = whiten(flat, fit).collect()
    assert len(rows) == 6 and all(r["whitened"][1:] == [None, None] and r["whitened"][0] is not None for r in rows)
    same = frame(spark, [[1.0, 2.0]] * 3)
    fit = fit_whitening(same)
    assert fit.identity_error is None and [r["whitened"] for r in whiten(same, fit).collect()] == [[None, None]] * 3
    for nothing in (frame(spark, []), frame(spark, [None, [], [float("nan")]])):
        fit = fit_whitening(nothing)
        assert whiten(nothing, fit).count() == 0
    assert fit is None


def test_very_large_entries(spark):
    df = frame(spark, [[3e38, 1.0], [-3e38, 2.0], [1.0, 2.0]])
    rows = whiten(df, fit_whitening(df)).collect()
    assert len(rows) == 3 and any(r["deviation"] is None for r in rows)
