"""Whitening against dense eigenvectors of the exact covariance."""

import math
from fractions import Fraction

import numpy as np
import pytest

from logwarden.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, label int, component int, n string, x double"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, 0, 7, "n", 0.5) for i, v in vectors], SCHEMA)


def plain(vectors, components=4):
    """{(vec_id, component): (n, deviation, whitened, explained)} with a covariance of exact numbers."""
    kept = [(i, [math.floor(float(np.float32(c)) * 256) for c in v]) for i, v in vectors
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, dims = len(fit), len(fit[0])
    S = [sum(x[j] for x in fit) for j in range(dims)]
    centred = [[n * x[j] - S[j] for j in range(dims)] for x in fit]
    V = np.array([[float(Fraction(sum(r[i] * r[j] for r in centred), n**3)) for j in range(dims)] for i in range(dims)])
    e, u = np.linalg.eigh(V)
    e, u = e[::-1], u[:, ::-1]
    out = []
    for i, x in kept:
        away = np.array([float(Fraction(n * x[j] - S[j], n)) for j in range(dims)])
        deviation = sum((n * x[j] - S[j]) ** 2 for j in range(dims))
        for k in range(min(components, int((e > 1e-12 * e[0]).sum()))):
            out.append((i, k + 1, n, deviation, away @ u[:, k] / math.sqrt(e[k]), e[k] / np.trace(V)))
    return out


def same(found, want):
    """Equal up to one sign per component."""
    key = lambda r: (r[0] is None, r[0] or 0, r[1], abs(round(r[4], 6)))
    got = [(r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained) for r in found]
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    for k in {r[1] for r in want}:
        a, b = (np.array([r[4] for r in rows if r[1] == k]) for rows in (got, want))
        assert np.allclose(a * np.sign(a @ b), b, rtol=0, atol=1e-9)
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-9)
    assert all(r.identity_error < 1e-9 for r in found)


def test_rank_one_updates_against_dense_eigenvalues():
    rng = np.random.default_rng(3)
    for case in range(60):
        size = int(rng.integers(1, 20))
        q, _ = np.linalg.qr(rng.normal(size=(size, size)))
        d = np.sort(rng.choice([0.0, 1.0, 1.0 + 1e-15, 2.5, 1e6, *rng.normal(size=4) ** 2], size))
        x = rng.normal(size=size) * 10.0 ** rng.integers(-8, 4)
        x[rng.random(size) < 0.3] = 0
        values, vectors = whitening.rank_one(d, q, q @ x)
        matrix = q @ (np.diag(d) + np.outer(x, x)) @ q.T
        assert np.allclose(values, np.linalg.eigvalsh(matrix), rtol=1e-12, atol=1e-13 * max(1, abs(matrix).max()))
        assert np.allclose(vectors.T @ vectors, np.eye(size), atol=1e-12)
        assert np.allclose(vectors @ np.diag(values) @ vectors.T, matrix, rtol=0, atol=1e-12 * max(1, abs(matrix).max()))


def test_many_updates_and_sums_of_spectra():
    rng = np.random.default_rng(4)
    rows = rng.normal(size=(600, 12)) * np.geomspace(1, 1e-4, 12)
    parts = []
    for half in np.split(rows, 2):
        values, vectors = np.zeros(12), np.eye(12)
        for row in half:
            values, vectors = whitening.rank_one(values, vectors, row)
        parts.append((values, vectors))
    values, vectors = whitening.add_spectrum(*parts[0], *parts[1])
    assert np.allclose(values, np.linalg.eigvalsh(rows.T @ rows), rtol=1e-7, atol=1e-11)
    assert np.allclose(vectors.T @ vectors, np.eye(12), atol=1e-10)


def test_secular_roots_lie_between_poles():
    d = np.array([0.0, 1e-9, 1.0, 1.0 + 1e-12, 50.0])
    for weight in (np.ones(5), np.array([1e-18, 1.0, 1e-20, 1e3, 1e-6])):
        roots, differ = whitening.secular(d, weight)
        assert (np.diff(roots) >= 0).all() and (roots >= d).all() and (roots[:-1] <= d[1:]).all()
        assert np.allclose(roots, np.linalg.eigvalsh(np.diag(d) + np.sqrt(np.outer(weight, weight))), atol=1e-11)


@pytest.mark.parametrize("task_vectors", [7, 10_000])
def test_against_exact_covariance(spark, monkeypatch, task_vectors):
    monkeypatch.setattr(whitening, "TASK_VECTORS", task_vectors)  # many spectra, combined over three rounds
    rng = np.random.default_rng(8)
    vectors = [(i, (rng.normal(size=6) * [3, 2, 1.5, 1, 0.5, 0.2] - 1).astype("float32").tolist()) for i in range(500)]
    vectors += [(i, [0.25, 0.5, 0.0, -0.0, 1.0, -1.0]) for i in range(500, 900)]  # copies count once
    same(whitening.whiten(frame(spark, vectors)).collect(), plain(vectors))


def test_odd_rows(spark):
    vectors = [(1, [1.0, 2.0]), (2, None), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]),
               (6, [3.0, -1.0]), (6, [3.0, -1.0]), (None, [0.5, 0.5]), (7, [-1.0, 4.0]), (8, [1.0, 2.0])]
    same(whitening.whiten(frame(spark, vectors)).collect(), plain(vectors))
    lone = [(9, [1.0, 2.0, 3.0]), (10, [])]
    same(whitening.whiten(frame(spark, vectors + lone)).collect(), plain(vectors))
    line = [(i, [float(i), 2.0 * i, 3.0]) for i in range(9)]  # one direction only
    same(whitening.whiten(frame(spark, line)).collect(), plain(line))
    huge = [(i, [1e30 * i, 1.0]) for i in range(3)]
    assert [r.deviation for r in whitening.whiten(frame(spark, huge)).collect()] == [None] * 3


@pytest.mark.parametrize("vectors", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)], [(1, [])]])
def test_nothing_to_whiten(spark, vectors):
    found = whitening.whiten(frame(spark, vectors))
    assert found.collect() == []
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_query_on_a_whole_table(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    same(queries.op12_whitening(spark, sf).collect(), plain(rows))
