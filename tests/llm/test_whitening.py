"""Whitening against plain linear algebra."""

import numpy as np
import pytest

from starmart.llm import whitening

KINDS = "vec_id long, embedding array<float>, x string, at int"


def table(spark, vectors):
    rows = [(i, None if v is None else [None if c is None else float(c) for c in v], "x", 1)
            for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, KINDS).repartition(3, "vec_id")


def plain(vectors, most=16):
    """{(row, component): (n, deviation, |whitened|, explained)} by a dense eigenvalue routine."""
    usable = {i: v for i, v in enumerate(vectors)
              if v is not None and all(c is not None and np.isfinite(np.float32(c)) for c in v)}
    x = {i: [int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for i, v in usable.items()}
    fit = np.array(sorted(set(map(tuple, x.values()))), float)
    mean = fit.mean(axis=0)
    values, turn = np.linalg.eigh((fit - mean).T @ (fit - mean) / len(fit))
    order = np.argsort(-values)[:most]
    sums = [sum(column) for column in zip(*set(map(tuple, x.values())))]
    out = {}
    for i, v in x.items():
        off = sum((len(fit) * c - s) ** 2 for c, s in zip(v, sums))
        for k, at in enumerate(order):
            if values[at] > 1e-12 * values.sum():
                out[i, k + 1] = (len(fit), off, abs((np.array(v) - mean) @ turn[:, at]) / np.sqrt(values[at]),
                                 values[at] / values.sum())
    return out


def compare(rows, wanted):
    assert sorted((r.vec_id, r.component) for r in rows) == sorted(wanted)
    for r in rows:
        n, off, whitened, explained = wanted[r.vec_id, r.component]
        assert (r.n, r.deviation) == (n, off)
        assert abs(r.whitened) == pytest.approx(whitened, abs=1e-7) and r.explained == pytest.approx(explained, rel=1e-9)
        assert 0 <= r.identity_error < 1e-9


@pytest.mark.parametrize("size, rows", [(40, 300), (5, 60), (64, 30)])
def test_whiten(spark, size, rows):
    """More dimensions than components, fewer, and fewer rows than dimensions."""
    random = np.random.default_rng(size)
    vectors = (random.standard_normal((rows, size)) * np.geomspace(3, 0.3, size)) @ np.linalg.qr(
        random.standard_normal((size, size)))[0]
    vectors = [*vectors, *vectors[:20]]
    compare(whitening.whiten(table(spark, vectors)).collect(), plain(vectors))


def test_whitened_covariance_is_the_identity(spark):
    random = np.random.default_rng(2)
    vectors = random.standard_normal((200, 20)) @ random.standard_normal((20, 20))
    rows = whitening.whiten(table(spark, vectors)).collect()
    z = np.zeros((200, 16))
    for r in rows:
        z[r.vec_id, r.component - 1] = r.whitened
    assert np.abs(np.cov(z.T, bias=True) - np.eye(16)).max() < 1e-9


def test_unusable_vectors(spark):
    random = np.random.default_rng(4)
    good = random.standard_normal((50, 6)).tolist()
    vectors = [None, [1.0, None, 0, 0, 0, 0], [float("nan")] * 6, [float("inf"), 0, 0, 0, 0, 0], *good]
    rows = whitening.whiten(table(spark, vectors)).collect()
    compare(rows, plain(vectors))
    assert {r.vec_id for r in rows} == set(range(4, 54))


def test_nothing_to_whiten(spark):
    for vectors in ([], [None], [[1.0, 2.0]], [[1.0, 2.0]] * 5, [[]]):
        found = whitening.whiten(table(spark, vectors))
        assert found.count() == 0 and len(found.columns) == 7


def test_short_vectors_get_zeros(spark):
    vectors = [[1.0, 2.0], [3.0], [0.5, 1.0, 4.0], [2.0, 2.0, 1.0], [1.5, 0.25, 3.0]]
    padded = [v + [0.0] * (3 - len(v)) for v in vectors]
    compare(whitening.whiten(table(spark, vectors)).collect(), plain(padded))


@pytest.mark.parametrize("values", [np.geomspace(1e6, 1, 300), np.r_[[50.0] * 3, [49.9] * 2, np.linspace(40, 1, 195)],
                                    np.r_[[9.0] * 20, np.ones(180)], np.r_[[1.0], np.zeros(30)]])
def test_jacobi_davidson(values):
    """Spread, close and equal eigenvalues: residuals of rounding size, orthonormal vectors."""
    random = np.random.default_rng(8)
    turn = np.linalg.qr(random.standard_normal((len(values), len(values))))[0]
    matrix = (turn * values) @ turn.T
    found, vectors = whitening.leading_eigenpairs(lambda block: matrix @ block, len(values), 16)
    assert np.allclose(found, np.sort(values)[::-1][:16], rtol=0, atol=1e-12 * values.max())
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-12 * values.max()
    assert np.abs(vectors.T @ vectors - np.eye(16)).max() < 1e-12


def test_minres_solves():
    random = np.random.default_rng(5)
    half = random.standard_normal((12, 12))
    matrix, right = half + half.T, random.standard_normal((12, 3))
    assert np.allclose(matrix @ whitening.minres(lambda block: matrix @ block, right, 14), right, atol=1e-6)
