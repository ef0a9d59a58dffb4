"""Whitening against the dense solver, and its parts against exact arithmetic."""

from fractions import Fraction

import numpy as np
import pytest

from strata.llm import whitening
from strata.llm.whitening import SCALE, SHIFT, null_space, polynomial, primes, products, roots, scatter, whiten

SCHEMA = "vec_id long, embedding array<double>"


def found(spark, vectors, **more):
    rows = [(i, None if v is None else [None if c is None else float(c) for c in v]) for i, v in enumerate(vectors)]
    return whiten(spark.createDataFrame(rows, SCHEMA).repartition(3), **more).collect()


def by_hand(vectors):
    x = np.floor(np.array(vectors, float) * SCALE).astype(np.int64) + SHIFT
    fit = np.unique(x, axis=0)
    mean = fit.mean(0)
    apart = fit - mean
    values, vectors = np.linalg.eigh(apart.T @ apart / len(fit))
    return x, fit, mean, values[::-1], vectors[:, ::-1]


def check(rows, vectors, most=16):
    x, fit, mean, values, axes = by_hand(vectors)
    k = min(most, int((values > 1e-9 * max(values[0], 1)).sum()))
    assert sorted((r.vec_id, r.component) for r in rows) == [(i, c) for i in range(len(x)) for c in range(1, k + 1)]
    whitened = np.zeros((len(x), k))
    for r in rows:
        whitened[r.vec_id, r.component - 1] = r.whitened
        assert r.n == len(fit) and r.identity_error < 1e-9
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-9)
        sums = [int(s) for s in fit.sum(0)]
        assert int(r.deviation) == sum((len(fit) * int(a) - s) ** 2 for a, s in zip(x[r.vec_id], sums, strict=True))
    distinct = [int(np.flatnonzero((x == f).all(1))[0]) for f in fit]
    w = whitened[distinct]
    assert np.abs(w.T @ w / len(fit) - np.eye(k)).max(initial=0) < 1e-9 and np.abs(w.mean(0)).max(initial=0) < 1e-9
    return whitened, (x - mean) @ axes[:, :k] / np.sqrt(values[:k])


def test_like_the_dense_solver(spark):
    rng = np.random.default_rng(3)
    vectors = rng.normal(0, 0.1, (400, 20)) * np.linspace(1, 3, 20)
    vectors = np.concatenate([vectors, vectors[:100], vectors[:1].repeat(50, 0)])
    ours, theirs = check(found(spark, vectors), vectors)
    assert np.abs(np.abs(ours) - np.abs(theirs)).max() < 1e-6
    assert all(len(set(np.sign(a[abs(a) > 1e-6] * b[abs(a) > 1e-6]))) == 1 for a, b in zip(ours.T, theirs.T, strict=True))


def test_equal_eigenvalues_and_missing_ranks(spark):
    corners = [[a, b, c, 0.5] for a in (0, 1) for b in (0, 1) for c in (0, 3)]
    check(found(spark, corners), corners)
    check(found(spark, corners, most=2), corners, 2)
    assert found(spark, [[1.0, 2.0]] * 5) == []
    assert found(spark, [[1.0], [2.0]])[0].explained == 1


def test_rows_that_take_no_part(spark):
    fine = [[0.1, 0.2], [0.3, -0.4], [0.5, 0.1]]
    rows = found(spark, [*fine, None, [], [None, 1], [float("nan"), 1], [float("inf"), 1], [1e300, 0]])
    check(rows, fine)
    assert whiten(spark.createDataFrame([], SCHEMA)).collect() == []


def test_dimensions_are_fitted_apart(spark):
    two, three = [[0.1, 0.2], [0.3, -0.4], [0.5, 0.1]], [[1, 0, 0], [0, 1, 0], [0, 0, 1], [0, 0, 0]]
    rows = found(spark, [*two, *three])
    check([r for r in rows if r.vec_id < 3], two)
    assert {r.n for r in rows if r.vec_id >= 3} == {4}


def test_null_and_repeated_keys_and_clashing_columns(spark):
    schema = "vec_id long, embedding array<float>, x int, key string, n int"
    rows = [(None, [0.5, 1.0], 1, "a", 2), (None, [0.25, 0.0], 1, "a", 2), (7, [0.5, 1.0], 1, "a", 2), (7, [0.5, 1.0], 1, "a", 2)]
    got = whiten(spark.createDataFrame(rows, schema)).collect()
    assert sorted(str(r.vec_id) for r in got) == ["7", "7", "None", "None"] and {r.n for r in got} == {2}


def test_large_entries_are_exact(spark):
    vectors = [[1e12, 1.0], [-3e12, 2.0], [2.5e12, -7.0], [1e12, 5.0]]
    x, fit, *_ = by_hand(vectors)
    got = found(spark, vectors)
    sums = [sum(int(v) for v in column) for column in fit.T]
    for r in got:
        exact = sum((4 * int(a) - s) ** 2 for a, s in zip(x[r.vec_id], sums, strict=True))
        assert int(r.deviation) == exact
    assert {r.component for r in got} == {1, 2} and max(r.identity_error for r in got) < 1e-4


def test_products_are_exact():
    rng = np.random.default_rng(5)
    for top in (3, 1 << 19, 1 << 20, 1 << 40, 1 << 61):
        x = rng.integers(-top, top, (70, 4))
        assert (products(x) == x.astype(object).T @ x.astype(object)).all()


def test_scatter_adds_up(spark):
    rng = np.random.default_rng(6)
    x = rng.integers(-(1 << 50), 1 << 50, (200, 3))
    rows = spark.createDataFrame([([int(v) for v in r],) for r in x], "x array<long>").repartition(5)
    n, sums, m = scatter(rows)[3]
    own = x.astype(object)
    total = own.sum(0)
    assert n == 200 and sums == list(total) and m == (200 * (own.T @ own) - np.outer(total, total)).tolist()


def test_polynomial_is_exact(spark):
    rng = np.random.default_rng(7)
    a = rng.integers(-5, 6, (6, 9)).astype(object)
    a[3] = 0
    m = (a @ a.T).tolist()
    got = polynomial(spark.range(1), m)

    def determinant(rows):
        rows, out = [[Fraction(v) for v in r] for r in rows], Fraction(1)
        for k in range(len(rows)):
            pivot = next((i for i in range(k, len(rows)) if rows[i][k]), None)
            if pivot is None:
                return 0
            if pivot != k:
                rows[k], rows[pivot], out = rows[pivot], rows[k], -out
            out *= rows[k][k]
            for i in range(k + 1, len(rows)):
                f = rows[i][k] / rows[k][k]
                rows[i] = [x - f * y for x, y in zip(rows[i], rows[k], strict=True)]
        return out

    for t in (-3, 0, 1, 17):
        moved = [[t * (i == j) - v for j, v in enumerate(r)] for i, r in enumerate(m)]
        assert sum(c * t**k for k, c in enumerate(got)) == determinant(moved)


def test_roots_close_repeated_and_tiny():
    def expand(*values):
        c = [1]
        for v in values:
            c = [a - v * b for a, b in zip([0, *c], [*c, 0], strict=True)]
        return c

    big = 10**40
    found = roots(expand(big, big + 1, 7, 7, 7, 2, 0, 0), 16)
    exact = [Fraction(at, 1 << bits) for at, bits, _ in found]
    assert [s for *_, s in found] == [1, 1, 3, 1]
    for got, value in zip(exact, (big + 1, big, 7, 2), strict=True):
        assert abs(got - value) <= Fraction(value, 1 << 150)
    assert sum(s for *_, s in roots(expand(5, 4, 3, 2, 1), 2)) == 2
    thirds = [-1, 3 * 10**30]
    assert abs(Fraction(*((a, 1 << b) for a, b, _ in roots(thirds, 1)).__next__()) * 3 * 10**30 - 1) < Fraction(1, 1 << 150)


def test_nearly_equal_eigenvalues_have_accurate_components():
    n = 10**30
    m = [[n, 1, 0], [1, n, 0], [0, 0, 5]]
    # n + 1 and n - 1: far closer than doubles tell apart.
    one, other = (null_space(m, v, 0, 1)[:, 0] for v in (n + 1, n - 1))
    half = 0.5**0.5
    assert np.allclose(np.abs(one), [half, half, 0], atol=1e-15) and one[0] * one[1] > 0
    assert np.allclose(np.abs(other), [half, half, 0], atol=1e-15) and other[0] * other[1] < 0


def test_primes():
    for p in primes(200):
        assert 1 << 30 < p < 1 << 31 and all(p % k for k in range(2, 46341))
    assert np.prod([float(p) for p in primes(200)]) > 2.0**200
    assert 2 * (whitening.LIMB - 1) + whitening.ROWS.bit_length() - 1 <= 53
