"""Whitening against numpy and exact arithmetic."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

import __spark_entry__  # noqa: F401  (tasks get the package by value, patched settings included)
from offerlens.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, x string, n int"
BAD = [(900, None), (901, [None] * 6), (902, [1.0, math.nan, 0.0, 0.0, 0.0, 0.0]), (903, [math.inf] * 6)]


def brute(vectors, components, scale=256):
    """Exact counts and deviations, the rest by numpy."""
    d = max(len(v) for _, v in vectors)
    rows = [(i, [math.floor(scale * c) for c in v] + [0] * (d - len(v))) for i, v in vectors]
    fit = sorted({tuple(x) for _, x in rows})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    x = np.array(fit, float) - np.array([s / n for s in sums])
    values, axes = np.linalg.eigh(x.T @ x / n)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    out = {}
    for i, row in rows:
        deviation = sum((n * a - s) ** 2 for a, s in zip(row, sums))
        apart = np.array([float(Fraction(n * a - s, n)) for a, s in zip(row, sums)])
        out.setdefault(i, []).append((deviation, apart @ axes / np.sqrt(values)))
    return n, values / np.trace(x.T @ x / n), out


def whitened(spark, vectors, **options):
    rows = [(i, v, "clash", 1) for i, v in vectors]
    return whitening.whiten(spark.createDataFrame(rows, SCHEMA).repartition(3), **options).collect()


def test_whitening(spark):
    rng = random.Random(1)
    vectors = [(i, [rng.gauss(0, 1 + j) for j in range(6)]) for i in range(80)]
    vectors += [vectors[3], (None, vectors[4][1]), (81, [1.5, -0.001]), (82, [])]
    found = whitened(spark, vectors + BAD)
    n, explained, expected = brute(vectors, 4)
    assert len(found) == 4 * len(vectors) and {r.n for r in found} == {n}
    signs = {}
    for r in found:
        options = expected[r.vec_id]
        assert r.deviation in [d for d, _ in options]
        assert math.isclose(r.explained, explained[r.component - 1], rel_tol=1e-9)
        w = next(w for d, w in options if d == r.deviation)[r.component - 1]
        assert math.isclose(abs(r.whitened), abs(w), abs_tol=1e-9)
        if abs(w) > 1e-6:
            signs.setdefault(r.component, set()).add(r.whitened * w > 0)
        assert r.identity_error < 1e-9
    assert all(len(s) == 1 for s in signs.values())


def test_equal_eigenvalues(spark):
    """Six axes of three lengths: two components share each value, and stay orthogonal."""
    vectors = []
    for j, size in enumerate((4.0, 4.0, 2.0, 2.0, 1.0, 1.0)):
        for sign in (1, -1):
            vectors.append((len(vectors), [sign * size * (j == k) for k in range(6)]))
    found = whitened(spark, vectors)
    explained = sorted({(r.component, round(r.explained, 12)) for r in found})
    assert explained == [(1, round(16 / 42, 12)), (2, round(16 / 42, 12)), (3, round(4 / 42, 12)), (4, round(4 / 42, 12))]
    assert max(r.identity_error for r in found) < 1e-9


def test_close_eigenvalues(spark):
    """Values that differ in the tenth digit; the axes are the coordinates, exactly."""
    big = 2.0**30
    vectors = [(1, [big, 0.0]), (2, [-big, 0.0]), (3, [0.0, big + 1 / 256]), (4, [0.0, -big - 1 / 256])]
    found = {(r.vec_id, r.component): r.whitened for r in whitened(spark, vectors, components=2)}
    assert math.isclose(abs(found[3, 1]), math.sqrt(2), rel_tol=1e-9) and abs(found[1, 1]) < 1e-12
    assert math.isclose(abs(found[1, 2]), math.sqrt(2), rel_tol=1e-9) and abs(found[3, 2]) < 1e-12


def test_rank_below_the_components(spark):
    found = whitened(spark, [(i, [float(i), 2.0 * i, 0.5]) for i in range(5)])
    assert {r.component for r in found} == {1, 2, 3}
    assert all((r.whitened is None) == (r.component > 1) for r in found)
    assert {r.explained for r in found} == {1.0, 0.0} and found[0].identity_error < 1e-9
    one = whitened(spark, [(1, [3.0, 4.0]), (2, [3.0, 4.0])])
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 0, None, 0.0, None)] * 4


def test_large_entries(spark):
    vectors = [(1, [1e300, 1.0]), (2, [-1e300, 2.0]), (3, [0.0, 2.0**40]), (4, [5.0, 6.0])]
    found = whitened(spark, vectors)
    assert len(found) == 8 and all(r.deviation is None for r in found if r.vec_id in (1, 2))
    assert found[0].identity_error < 1e-6


def test_nothing_usable(spark):
    assert whitened(spark, BAD[:1]) == [] and whitened(spark, [(1, []), (2, [])]) == []
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("d", [1, 2, 3, 7])
def test_characteristic_polynomial(spark, d):
    rng = random.Random(d)
    x = np.array([[rng.randrange(-(10**6), 10**6) for _ in range(d)] for _ in range(d + 2)], object)
    x[:, 0] *= rng.choice([0, 1])
    a = x.T @ x
    poly = whitening.characteristic_polynomial(spark, a)
    # Cayley and Hamilton: a matrix is a root of its polynomial
    value = np.zeros((d, d), object)
    for c in poly:
        value = value @ a + c * np.eye(d, dtype=int).astype(object)
    assert poly[0] == 1 and not value.any()
    assert poly[1] == -sum(a[i, i] for i in range(d))


def test_roots_and_multiplicities():
    def product(roots):
        out = [1]
        for r in roots:
            out = [a - r * b for a, b in zip([*out, 0], [0, *out])]
        return out

    poly = product([0, 0, 3, 7, 7, 7, 10**20, 10**20 + 1])
    assert [whitening.roots_above(poly, at) for at in (0, 3, 6, 7, 10**20)] == [6, 5, 5, 2, 1]
    assert whitening.square_free(product([2, 2, 5])) == product([2, 5])
    found = whitening.largest_roots(poly, 4)
    assert [(r.times, round(Fraction(r.low, 2**r.bits))) for r in found] == [(1, 10**20 + 1), (1, 10**20), (3, 7)]


def test_products_are_exact():
    rng = random.Random(9)
    for reach in (3, 10**6, 2**62):
        x = [[rng.randrange(-reach, reach) for _ in range(3)] for _ in range(5)]
        exact = [[sum(r[i] * r[j] for r in x) for j in range(3)] for i in range(3)]
        assert whitening.exact_products(np.array(x, np.int64)).tolist() == exact
