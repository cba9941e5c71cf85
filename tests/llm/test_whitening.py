"""Whitening against numpy's eigendecomposition of the exact covariance."""

import math

import numpy as np
import pytest

from callfunnel.llm import whitening

VECTORS = "vec_id long, embedding array<float>, label int, x string, v string, component int"


def data(seed=3, n=700, width=24):
    rng = np.random.default_rng(seed)
    mixed = rng.normal(size=(n, width)) * np.geomspace(2, 0.05, width) @ np.linalg.qr(rng.normal(size=(width, width)))[0]
    rows = [(i, [float(c) for c in row.astype(np.float32)], 1, "x", "v", 1) for i, row in enumerate(mixed)]
    rows += [(2000 + i, rows[0][1], None, None, None, None) for i in range(300)]                      # a hot vector
    rows += [rows[5], (None, rows[6][1], 0, "", "", 0), (3000, None, 0, "", "", 0), (3001, [float("nan")] * width, 0, "", "", 0),
             (3002, [None] * width, 0, "", "", 0), (3003, [float("inf")] * width, 0, "", "", 0), (3004, [1.0], 0, "", "", 0), (3005, [], 0, "", "", 0),
             (3006, [0.0] * width, 0, "", "", 0)]
    return rows


def brute(rows, width, k=16):
    kept = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v, *_ in rows
            if v and len(v) == width and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array(sorted({tuple(r) for _, r in kept}), dtype=object)
    n, s = len(x), x.sum(axis=0)
    centred = ((x * n - s) / n).astype(float)
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    u = u * np.sign(u[np.abs(u).argmax(axis=0), np.arange(u.shape[1])])
    out = []
    for i, r in kept:
        gaps = np.array(r, dtype=object) * n - s
        y = (gaps / n).astype(float) @ u / np.sqrt(e)
        out += [(i, c + 1, n, int((gaps ** 2).sum()), y[c], e[c] / (centred ** 2).sum() * n) for c in range(min(k, width))]
    return out


def close(got, want):
    assert len(got) == len(want)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    for g, w in zip(sorted((tuple(r) for r in got), key=key), sorted(want, key=key)):
        assert g[:4] == w[:4]
        assert g[4] == pytest.approx(w[4], rel=1e-8, abs=1e-9) and g[5] == pytest.approx(w[5], rel=1e-10)
        assert 0 <= g[6] <= 1e-9


@pytest.mark.parametrize("width", [24, 5])
def test_equals_the_eigendecomposition(spark, width):
    rows = data(width=width)
    got = whitening.whiten(spark.createDataFrame(rows, VECTORS).repartition(5)).collect()
    close(got, brute(rows, width))


def test_bidiagonal_form(spark):
    """X V = U B with orthonormal V; also through repeated eigenvalues and directions without variance."""
    for spread in ([3, 3, 3, 2, 2, 1, 0, 0], [1] * 8, [5, 0, 0, 0, 0, 0, 0, 0]):
        rows = [[s * c for c in row] for s in (1, -1) for row in (np.diag(spread) * 10).tolist()]
        x = np.array(rows, float)
        blocks = spark.createDataFrame([(x[i:i + 4].tobytes(),) for i in range(0, len(x), 4)], "block binary")
        right, small = whitening.bidiagonalise(blocks, 8, 8)
        assert np.allclose(right.T @ right, np.eye(8), atol=1e-12)
        assert np.allclose(np.linalg.svd(small)[1], sorted((10 * math.sqrt(2) * abs(s) for s in spread), reverse=True), atol=1e-9)
        assert np.allclose(np.tril(small, -1), 0) and np.allclose(np.triu(small, 2), 0)


def test_exact_beyond_64_bits():
    x = np.array([[2 ** 61, 5], [-2 ** 61, 7]], np.int64)
    gaps = whitening.numerators(x, 2, [0, 12])
    assert gaps.tolist() == [[2 ** 62, -2], [-2 ** 62, 2]]
    assert whitening.deviations(gaps) == [None, None]
    assert whitening.deviations(np.array([[3, -4]], object)) == [25]


def test_few_alike_and_no_rows(spark):
    make = lambda rows: spark.createDataFrame(rows, VECTORS)
    assert whitening.whiten(make([])).collect() == []
    assert whitening.whiten(make([(1, [1.0, 2.0], 0, "", "", 0)] * 3)).collect() == []
    two = whitening.whiten(make([(1, [1.0, 2.0], 0, "", "", 0), (2, [2.0, 2.0], 0, "", "", 0), (2, [2.0, 2.0], 0, "", "", 0)])).collect()
    assert sorted((r.vec_id, r.component, r.n, r.deviation, round(r.whitened, 12), round(r.explained, 12)) for r in two) == [
        (1, 1, 2, 4096, -1.0, 1.0), (2, 1, 2, 4096, 1.0, 1.0), (2, 1, 2, 4096, 1.0, 1.0)]
    huge = whitening.whiten(make([(1, [3e38], 0, "", "", 0), (2, [0.0], 0, "", "", 0)])).collect()
    assert [r.deviation for r in huge] == [None, None]
