"""Exact polynomials, roots and components, and whitened rows against numpy."""

import itertools
import math
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from factspark.llm import whitening


def polynomial_of(roots):
    out = [1]
    for r in roots:
        out = [(out[i - 1] if i else 0) - r * (out[i] if i < len(out) else 0) for i in range(len(out) + 1)]
    return out


def by_minors(matrix):
    """The characteristic polynomial from sums of principal minors, the constant first."""
    d = len(matrix)

    def determinant(rows):
        sign = total = 0
        for order in itertools.permutations(range(len(rows))):
            sign = (-1) ** sum(a > b for a, b in itertools.combinations(order, 2))
            total += sign * math.prod(rows[i][j] for i, j in enumerate(order))
        return total

    out = []
    for k in range(d, -1, -1):
        minors = (determinant([[matrix[i][j] for j in c] for i in c]) for c in itertools.combinations(range(d), k))
        out.append((-1) ** k * sum(minors))
    return out


def gram(rng, d, rows, size):
    x = rng.integers(-size, size, (rows, d))
    return [[int(sum(int(a) * int(b) for a, b in zip(x[:, i], x[:, j], strict=True))) for j in range(d)] for i in range(d)]


@pytest.mark.parametrize(("d", "rows", "size"), [(1, 3, 9), (2, 1, 9), (4, 9, 10**9), (5, 3, 50), (5, 20, 2**40)])
def test_polynomial_is_exact(spark, d, rows, size):
    matrix = gram(np.random.default_rng(d + rows), d, rows, size)
    assert whitening.polynomial(spark, matrix) == by_minors(matrix)


def test_polynomial_of_a_reduced_matrix_needs_no_pivot():
    matrix = np.array([[2, 0, 0, 0], [0, 3, 0, 1], [0, 0, 5, 0], [0, 1, 0, 3]], np.int64)
    p = 1_000_003
    assert whitening.polynomial_modulo(matrix, p).tolist() == [x % p for x in by_minors(matrix.tolist())]


def test_primes():
    small = [n for n in range(2, 2000) if all(n % k for k in range(2, n))]
    assert [n for n in range(2, 2000) if whitening._is_prime(n)] == small
    found = whitening.primes_for(10**60)
    assert found[0] == 2**31 - 1 and math.prod(found) > 2 * 10**60 >= math.prod(found[:-1])


@pytest.mark.parametrize("roots", [[7], [3, 3, 1], [0, 0, 5, 9], [10**20, 10**20 + 1, 4], [0, 0], [1, 1, 1, 1], [10**30, 1, 1]])
def test_roots(roots):
    got = whitening.largest_roots(polynomial_of(roots), 4)
    expected = sorted((r for r in roots if r), reverse=True)[:4]
    assert len(got) == len(expected)
    assert all(abs(g - e) <= Fraction(e, 2**200) for g, e in zip(got, expected, strict=True))


def test_close_roots_are_told_apart():
    # x ** 2 - 2 x + 1 - 10 ** -40 in whole numbers: roots 10 ** 20 - 1 and 10 ** 20 + 1, and small ones.
    got = whitening.largest_roots([2, -4, 1], 4)
    assert [float(x) for x in got] == pytest.approx([2 + math.sqrt(2), 2 - math.sqrt(2)], rel=1e-15)
    a, b = whitening.largest_roots([10**40 - 1, -2 * 10**20, 1], 2)
    assert 0 < a - b and abs(a - b - 2) < Fraction(1, 10**30)


def test_components_of_equal_roots_are_orthogonal():
    matrix = [[3, 0, 0], [0, 3, 0], [0, 0, 1]]
    found = whitening.components(matrix, [Fraction(3), Fraction(3), Fraction(1)])
    assert np.allclose(found.T @ found, np.eye(3), atol=1e-15) and np.allclose(np.array(matrix) @ found, found * [3, 3, 1], atol=1e-14)


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(4)
    data = rng.normal(0.1, 0.2, (300, 6)) * [1, 1, 1, 3, 0.5, 1]
    rows = [(i, v.tolist()) for i, v in enumerate(data)]
    # A third of the rows are copies of one; the second of two near ones becomes the same whole numbers.
    rows += [(1000 + i, rows[5][1]) for i in range(150)] + [rows[6], (None, rows[7][1]), (2000, [x + 1e-9 for x in rows[8][1]])]
    rows += [(3000, None), (3001, [None] * 6), (3002, [float("nan")] + [0.1] * 5), (3003, [float("-inf")] + [0.1] * 5)]
    return rows, spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, x string, n int")


def reference(rows, count=4):
    points = [
        (i, tuple(math.floor(256 * c) for c in v)) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)
    ]
    fit = np.array(sorted({x for _, x in points}), object)
    n, sums = len(fit), fit.sum(0)
    centred = n * fit - sums
    covariance = (centred.T @ centred).astype(np.float64) / n**3
    values, columns = np.linalg.eigh(covariance)
    out = {}
    for i, x in points:
        c = n * np.array(x, object) - sums
        for k in range(count):
            e = values[-1 - k]
            out.setdefault((i, k + 1), []).append(
                (n, int((c * c).sum()), float((c / n).astype(float) @ columns[:, -1 - k]) / math.sqrt(e), e / np.trace(covariance))
            )
    return out


def check(frame, rows):
    got, expected = {}, reference(rows)
    for r in frame.collect():
        got.setdefault((r["vec_id"], r["component"]), []).append((r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]))
    assert got.keys() == expected.keys()
    sign = {}
    for key, found in got.items():
        for a, b in zip(sorted(found), sorted(expected[key]), strict=True):
            assert a[:2] == b[:2] and a[3] == pytest.approx(b[3], rel=1e-9) and a[4] <= 1e-9
            if abs(b[2]) > 1e-3:
                s = sign.setdefault(key[1], math.copysign(1, a[2] * b[2]))
                assert a[2] * s == pytest.approx(b[2], rel=1e-6)


def test_whitened_rows(vectors):
    rows, frame = vectors
    got = whitening.whiten(frame.repartition(3))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(got, rows)


def test_large_entries_are_exact(spark):
    rng = np.random.default_rng(8)
    rows = [(i, (rng.normal(0, 1, 3) * 2.0**s).tolist()) for i, s in enumerate([3, 20, 30, 30, 30, 31, 31, 8] * 4)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {r["vec_id"]: r for r in whitening.whiten(frame, count=2).collect()}
    points = np.array([[math.floor(256 * c) for c in v] for _, v in rows], object)
    n, sums = len(points), points.sum(0)
    for i, x in enumerate(points):
        exact = int(((n * x - sums) ** 2).sum())
        assert found[i]["deviation"] == (exact if exact < 1 << 63 else None)
    huge = spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 2.0])], "vec_id long, embedding array<double>")
    assert whitening.whiten(huge).count() == 6


def test_moments_of_wide_numbers():
    x = np.array([[2**62, -(2**62)], [-5, 2**17], [2**16, -(2**16) - 1]], np.int64)
    total = np.zeros((2, 3), object)
    for place, sums in whitening.moments(x).items():
        total += sums.astype(object) * 2 ** (whitening.LIMB_BITS * place)
    exact = x.astype(object)
    assert (total[:, :2] == exact.T @ exact).all() and (total[:, 2] == exact.sum(0)).all()


def test_edge_tables(spark):
    schema = "vec_id long, embedding array<float>"

    def rows(data):
        return whitening.whiten(spark.createDataFrame(data, schema)).collect()

    assert rows([]) == [] and rows([(1, None)]) == [] and rows([(1, [])]) == []
    assert rows([(1, [0.5, 1.0])]) == [] and rows([(i, [0.5, 1.0]) for i in range(3)]) == []
    # Two points: one component. Each length is a space of its own.
    got = rows([(1, [0.0, 0.0]), (2, [1.0, 1.0]), (2, [1.0, 1.0]), (3, [1.0]), (4, [2.0]), (5, [2.0, 1.0, 0.0])])
    assert Counter((r["vec_id"], r["component"], r["n"]) for r in got) == Counter([(1, 1, 2), (2, 1, 2), (2, 1, 2), (3, 1, 2), (4, 1, 2)])
    assert all(abs(abs(r["whitened"]) - 1) < 1e-12 and r["explained"] == 1 for r in got)
