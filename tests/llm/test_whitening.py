"""Whitening against numpy's eigenvalues, exact polynomials and planted spectra."""

import itertools
from fractions import Fraction

import numpy as np
import pytest

from lendmark.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, id int, x string, v int"


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, None if v is None else [None if c is None else float(c) for c in v], 1, "x", 2) for i, v in rows], SCHEMA
    )


def brute(vectors):
    """x of every row, then mean, eigenvalues and trace of the covariance of the distinct ones."""
    x = np.floor(64 * np.asarray(vectors, dtype=np.float32).astype(np.float64)) + 1_000_000
    fit_list = np.unique(x, axis=0)
    centred = fit_list - fit_list.mean(axis=0)
    values, basis = np.linalg.eigh(centred.T @ centred / len(fit_list))
    return x, fit_list, values[::-1], basis[:, ::-1].T


def test_components_equal_those_of_numpy(spark):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(500, 20)) * np.linspace(2, 0.3, 20)
    vectors[100:300] = vectors[7]  # copies count once
    x, fit_list, values, basis = brute(vectors)
    rows = whitening.whiten(frame(spark, enumerate(vectors))).collect()
    assert len(rows) == 500 * 16
    sums = [int(s) for s in fit_list.sum(axis=0)]
    n = len(fit_list)
    got = np.zeros((500, 16))
    for r in rows:
        got[r["vec_id"], r["component"] - 1] = r["whitened"]
        assert r["n"] == n and r["identity_error"] < 1e-9
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / values.sum(), rel=1e-10)
    for r in rows[:: 16 * 37]:
        assert r["deviation"] == sum((n * int(c) - s) ** 2 for c, s in zip(x[r["vec_id"]], sums))
    expected = (x - fit_list.mean(axis=0)) @ basis[:16].T / np.sqrt(values[:16])
    for k in range(16):
        sign = np.sign(got[0, k] * expected[0, k])
        assert np.abs(got[:, k] * sign - expected[:, k]).max() < 1e-7


def test_equal_eigenvalues_share_an_orthonormal_basis(spark):
    corners = np.array(list(itertools.product((-1, 1), repeat=4)), dtype=float)
    vectors = np.hstack([corners, np.zeros((16, 2))])  # covariance 64^2 on four dimensions, nothing on two
    rows = whitening.whiten(frame(spark, enumerate(vectors))).collect()
    assert len(rows) == 16 * 4  # components without variance don't exist
    got = np.zeros((16, 4))
    for r in rows:
        got[r["vec_id"], r["component"] - 1] = r["whitened"]
        assert r["explained"] == 0.25 and r["identity_error"] < 1e-12
    assert np.abs(got.T @ got / 16 - np.eye(4)).max() < 1e-12


def leverrier(m):
    """Coefficients of det(t - m) in fractions."""
    d, c, b = len(m), [Fraction(1)], [[Fraction(0)] * len(m) for _ in m]
    for k in range(1, d + 1):
        b = [[sum(m[i][q] * (b[q][j] + (c[-1] if q == j else 0)) for q in range(d)) for j in range(d)] for i in range(d)]
        c.append(-sum(b[i][i] for i in range(d)) / k)
    return [int(v) for v in c]


def test_polynomial_is_exact(spark):
    rng = np.random.default_rng(4)
    p = (1 << 31) - 1
    for d in (1, 2, 3, 7):
        for x in (rng.integers(-900, 900, (d, d)), np.diag(rng.integers(0, 3, d)), np.zeros((d, d), dtype=np.int64)):
            m = (x @ x.T).tolist()
            wanted = leverrier(m)
            assert whitening.polynomial_mod(np.array(m) % p, p) == [c % p for c in wanted]
            assert whitening.symmetric_functions(spark, m) == [abs(c) for c in wanted]


def test_roots_are_counted_and_isolated():
    e = [1]
    for root in (5, 5, 5, 7, 1000, 10**20, 10**20 + 1):  # times (t - root)
        e = [a + root * b for a, b in zip([*e, 0], [0, *e])]
    e += [0, 0]
    assert [whitening.above(e, a, 0) for a in (-1, 0, 4, 5, 7, 10**20)] == [9, 7, 7, 4, 3, 1]
    found = whitening.largest_roots(e, 9)
    assert [(round(r.value), r.many) for r in found] == [(10**20 + 1, 1), (10**20, 1), (1000, 1), (7, 1), (5, 3)]
    assert all(abs(r.value - round(r.value)) * (1 << 90) < r.value for r in found)
    assert sum(r.many for r in whitening.largest_roots(e, 5)) >= 5
    assert whitening.largest_roots([1, 0, 0], 3) == []


def test_primes_are_prime():
    found = whitening.primes_beyond(1 << 100)
    assert len(found) == len(set(found)) == 4 and np.prod([float(p) for p in found]) > 2.0**100
    assert all(all(p % q for q in range(3, 46_342, 2)) for p in found)


def test_large_entries_stay_exact(spark):
    vectors = [(0, [2.0**50, 0]), (1, [-(2.0**50), 1]), (2, [0, 3])]
    rows = whitening.whiten(frame(spark, vectors)).collect()
    x = [[int(64 * c) for c in v] for _, v in vectors]
    sums = [sum(c) for c in zip(*x)]
    assert {r["vec_id"]: int(r["deviation"]) for r in rows} == {
        i: sum((3 * c - s) ** 2 for c, s in zip(x[i], sums)) for i in range(3)
    }
    n, totals, m = whitening.scatter(whitening.usable(frame(spark, vectors)).select("x"), 2)
    assert (n, totals) == (3, sums)
    assert m == [[3 * sum(v[i] * v[j] for v in x) - sums[i] * sums[j] for j in range(2)] for i in range(2)]


def test_odd_vectors(spark):
    good = [(0, [1, 0]), (1, [0, 1]), (1, [0, 1]), (None, [2, 5]), (1, [1, 1])]
    bad = [(5, None), (6, [None, 1]), (7, [float("nan"), 1]), (8, [float("inf"), 0]), (9, [1, 2, 3]), (10, []), (11, [1e30, 0])]
    rows = whitening.whiten(frame(spark, good + bad)).collect()
    assert sorted((r["vec_id"] is None, r["vec_id"] or 0, r["component"]) for r in rows) == sorted(
        (i is None, i or 0, k) for i, _ in good for k in (1, 2)
    )
    assert {r["n"] for r in rows} == {4}
    for empty in ([], bad[:1], [(1, [1, 2])], [(1, [1, 2]), (2, [1, 2])]):
        assert whitening.whiten(frame(spark, empty)).collect() == []
