"""Whitening: exact polynomials and roots, components against numpy, brute-force rows."""

import math
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabforge.llm import charpoly as cp
from tabforge.llm import whitening as wh

SCHEMA = "vec_id long, embedding array<float>, label int, component string, n string"


def faddeev(m):
    """Characteristic polynomial by traces of powers, in fractions."""
    d = len(m)
    a = [[Fraction(x) for x in r] for r in m]
    c, b = [Fraction(1)], [[Fraction(0)] * d for _ in range(d)]
    for k in range(1, d + 1):
        b = [[sum(a[i][t] * b[t][j] for t in range(d)) + (c[-1] if i == j else 0) for j in range(d)] for i in range(d)]
        c.append(-sum(a[i][t] * b[t][i] for i in range(d) for t in range(d)) / k)
    return [int(x) for x in reversed(c)]


def poly_of(m):
    trace = sum(m[i][i] for i in range(len(m)))
    primes = cp.primes_for(trace, len(m))
    return cp.remainder(dict(zip(primes, cp.residues(m, primes))), trace)


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10**9), st.integers(1, 7), st.integers(0, 5), st.sampled_from([2, 1000, 10**12]))
def test_polynomial_is_exact(seed, d, rank, size):
    r = np.random.default_rng(seed)
    x = r.integers(-size, size + 1, (rank, d)).astype(object)
    m = [[int(v) for v in row] for row in (x.T @ x if rank else np.zeros((d, d), object))]
    assert poly_of(m) == faddeev(m)


def test_polynomial_needs_row_swaps():
    m = [[2, 0, 0, 1], [0, 3, 1, 0], [0, 1, 3, 0], [1, 0, 0, 2]]
    assert poly_of(m) == faddeev(m)
    assert poly_of(np.diag([5, 5, 0, 7]).tolist()) == faddeev(np.diag([5, 5, 0, 7]).tolist())


def test_wrong_polynomials_are_noticed():
    m = [[4, 1], [1, 3]]
    primes = cp.primes_for(7, 2)
    got = dict(zip(primes, cp.residues(m, primes)))
    with pytest.raises(ArithmeticError):
        cp.remainder(got, 8)
    with pytest.raises(ArithmeticError):
        cp.remainder({p: [c + 1 if p == primes[0] else c for c in v] for p, v in got.items()}, 7)


def test_roots_multiple_close_and_zero():
    # (x - 5)^2 (x - 3)(x - 1) x^2
    poly = [1]
    for root in (5, 5, 3, 1, 0, 0):
        poly = [a - root * b for a, b in zip([0, *poly], [*poly, 0])]
    got = cp.largest_roots(poly, 6)
    assert [(at, size) for _, at, size in got] == [(0, 2), (2, 1), (3, 1), (4, 2)]
    assert all(abs(v - w) <= Fraction(w, 2**150) for (v, *_), w in zip(got, (5, 3, 1, 0)))
    # two roots 1e-20 apart at 1e6 are told apart
    a, b = 10**26, 10**26 + 1
    close = [a * b, -(a + b), 1]
    assert [(round(v), at, n) for v, at, n in cp.largest_roots(close, 2)] == [(b, 0, 1), (a, 1, 1)]
    assert cp.roots_above(poly, Fraction(5)) == 0 and cp.roots_above(poly, Fraction(49, 10)) == 2
    # x^2 - 4x + 2: roots 2 +- sqrt(2), far beyond doubles
    two = cp.largest_roots([2, -4, 1], 2)
    assert abs((two[0][0] - 2) ** 2 - 2) < Fraction(1, 2**140)


def test_null_space_of_near_equal_roots():
    q = np.array([[1, 2, 2], [2, 1, -2], [2, -2, 1]], object)  # 3 times an orthogonal matrix
    m = (q.T @ np.diag(np.array([10**15 + 1, 10**15, 7], object)) @ q).tolist()
    poly = poly_of(m)
    roots = cp.largest_roots(poly, 3)
    assert [round(r[0] / 9) for r in roots] == [10**15 + 1, 10**15, 7]
    for (value, *_), row in zip(roots, q):
        v = cp.null_space(m, value, 1)[0]
        want = np.array([float(x) / 3 for x in row])
        want *= np.sign(want @ v)
        assert np.abs(v - want).max() < 1e-15  # plain float64 gives no digit here


def check(rows, got, k=8):
    use = [(r[0], r[1]) for r in rows if r[1] is not None and all(c is not None and math.isfinite(c) for c in r[1])]
    dims = max(len(e) for _, e in use)
    x = [[math.floor(1024 * float(np.float32(c))) + 100000 for c in [*e, *[0.0] * (dims - len(e))]] for _, e in use]
    n, s = len(x), [sum(c) for c in zip(*x)]
    c = np.array([[n * v - t for v, t in zip(r, s)] for r in x], object)
    v = (c.T @ c).astype(float) / n**3
    values = np.linalg.eigvalsh(v)[::-1]
    size = min(k, dims)
    assert len(got) == n * size
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.deviation_exact), {}).setdefault(r.component, []).append(r)
    assert sorted(by, key=str) == sorted({(i, sum(int(q) ** 2 for q in row)) for (i, _), row in zip(use, c)}, key=str)
    for j in range(size):
        w = np.array([by[i, sum(int(q) ** 2 for q in row)][j + 1][0].whitened for (i, _), row in zip(use, c)], float)
        one = got[[r.component for r in got].index(j + 1)]
        assert one.n == n and one.explained == pytest.approx(values[j] / np.trace(v), rel=1e-6)
        if one.whitened is not None:
            assert abs(w.mean()) < 1e-9 and w.var() == pytest.approx(1, abs=1e-9)
            d = np.linalg.lstsq(c.astype(float) / n, w * math.sqrt(values[j]), rcond=None)[0]
            assert np.abs(v @ d - values[j] * d).max() < 1e-7 * values[0]
            assert one.identity_error < 1e-9


def odd_rows(n=300, dims=10):
    r = np.random.default_rng(5)
    mix = r.normal(size=(dims, dims))
    rows = [(None if i % 50 == 3 else i, (r.normal(size=dims) @ mix).astype(np.float32).tolist(), 1, "x", "y") for i in range(n)]
    return rows + [rows[0], rows[0], (1000, None, 1, None, None), (1001, [None] * dims, 1, None, None),
                   (1002, [float("nan")] * dims, 1, None, None), (1003, [float("inf")], None, None, None),
                   (1004, [], 1, None, None), (1005, [2.5, -1.25], None, None, None)]


def test_odd_rows(spark):
    rows = odd_rows()
    got = wh.whiten(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    check(rows, got)
    assert all(r.deviation == int(r.deviation_exact) for r in got)


def test_small_table_and_empty(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    check([tuple(r) for r in df.collect()], wh.whiten(df).collect())
    assert wh.whiten(df.where("false")).collect() == []


def test_few_dimensions_and_equal_rows(spark):
    rows = [(i, [float(i % 7), 1.0, float(i % 7)], 0, "", "") for i in range(50)]  # rank one
    got = wh.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    check(rows, got)
    assert {(r.component, r.whitened is None) for r in got} == {(1, False), (2, True), (3, True)}
    same = wh.whiten(spark.createDataFrame([(i, [1.0, 2.0], 0, "", "") for i in range(4)], SCHEMA)).collect()
    assert {(r.deviation, r.whitened, r.explained, r.identity_error) for r in same} == {(0, None, None, None)}
    assert wh.whiten(spark.createDataFrame([(1, [], 0, "", "")], SCHEMA)).collect() == []


def test_equal_eigenvalues_and_wide_numbers(spark):
    # corners of a cube, each once: three equal eigenvalues; large entries need more than 64 bits
    rows = [(i, [float(2**30 * (i >> k & 1)) for k in range(3)], 0, "", "") for i in range(8)]
    got = wh.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    check(rows, got)
    assert all(r.deviation is None and int(r.deviation_exact) == 3 * (8 * 2**39) ** 2 for r in got)
    assert {round(r.explained, 12) for r in got} == {round(1 / 3, 12)}
