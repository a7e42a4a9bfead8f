"""Exact eigenvalues of a symmetric integer matrix by its characteristic polynomial.

The polynomial is computed modulo many primes (Hessenberg reduction) and put
together by Chinese remaindering. Its real roots are isolated with exact
integer arithmetic and narrowed as far as asked for; eigenvectors come from
inverse iteration near a root in decimal arithmetic of high precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from decimal import Decimal, localcontext
from fractions import Fraction

import numpy as np

# Roots are narrowed to this many bits below their size; closer roots count as one.
ROOT_BITS = 160


# ------------------------------------------------------- modular polynomial
def _is_prime(n: int) -> bool:
    """Miller-Rabin with bases that decide every n below 3.4e14."""
    if n < 2 or any(n % q == 0 for q in (2, 3, 5, 7, 11, 13, 17)):
        return n in (2, 3, 5, 7, 11, 13, 17)
    d, s = n - 1, 0
    while d % 2 == 0:
        d, s = d // 2, s + 1
    for a in (2, 3, 5, 7, 11, 13, 17):
        x = pow(a, d, n)
        if x in (1, n - 1):
            continue
        for _ in range(s - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes_below(top: int = 1 << 31) -> Iterator[int]:
    n = top - 1
    while n > 1:
        if _is_prime(n):
            yield n
        n -= 1


def coefficient_bound(trace: int, d: int) -> int:
    """No coefficient of a positive semidefinite d x d matrix's polynomial is larger.

    The k-th is the k-th elementary symmetric sum of the roots, at most
    C(d, k) (trace / d)^k by Maclaurin's inequality.
    """
    return max(math.comb(d, k) * trace**k // d**k + 1 for k in range(d + 1))


def primes_for(trace: int, d: int) -> list[int]:
    """Enough primes to tell the coefficients apart, and one to check the result."""
    need, product, out = 2 * coefficient_bound(trace, d) + 1, 1, []
    for p in primes_below():
        out.append(p)
        if product > need:
            return out
        product *= p
    raise ValueError("not enough primes")


def _power(x: np.ndarray, e: np.ndarray, p: np.ndarray) -> np.ndarray:
    out = np.ones_like(x)
    for bit in range(31):
        out = np.where(e >> bit & 1, out * x % p, out)
        x = x * x % p
    return out


def hessenberg(a: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Similar Hessenberg matrices of a (k, d, d) stack, each modulo its own prime."""
    a, n, d = a.copy(), np.arange(len(a)), a.shape[1]
    q1, q2 = p[:, None], p[:, None, None]
    for j in range(d - 2):
        i = j + 1 + (a[:, j + 1:, j] != 0).argmax(axis=1)
        rows = a[n, i, :].copy()
        a[n, i, :] = a[:, j + 1, :]
        a[:, j + 1, :] = rows
        cols = a[n, :, i].copy()
        a[n, :, i] = a[:, :, j + 1]
        a[:, :, j + 1] = cols
        # a column without a pivot has zeros below already: its factors are zero
        m = a[:, j + 2:, j] * _power(a[:, j + 1, j], p - 2, p)[:, None] % q1
        a[:, j + 2:, :] = (a[:, j + 2:, :] - m[:, :, None] * a[:, j + 1, None, :]) % q2
        a[:, :, j + 1] = (a[:, :, j + 1] + (a[:, :, j + 2:] * m[:, None, :] % q2).sum(axis=2)) % q1
    return a


def polynomial_mod(a: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Coefficients (k, d + 1), lowest first, of det(x I - a) modulo each prime."""
    h, d, k = hessenberg(a, p), a.shape[1], len(a)
    q1, q2 = p[:, None], p[:, None, None]
    poly = np.zeros((k, d + 1, d + 1), np.int64)
    poly[:, 0, 0] = 1
    below = np.zeros((k, 0), np.int64)  # products of subdiagonals up to row i
    for i in range(d):
        if i:
            below = np.concatenate([below, np.ones((k, 1), np.int64)], axis=1) * h[:, i, i - 1, None] % q1
        new = np.zeros((k, d + 1), np.int64)
        new[:, 1:] = poly[:, i, :-1]
        new -= h[:, i, i, None] * poly[:, i, :] % q1
        if i:
            factor = h[:, :i, i] * below % q1
            new -= (factor[:, :, None] * poly[:, :i, :] % q2).sum(axis=1)
        poly[:, i + 1, :] = new % q1
    return poly[:, d, :]


def residues(matrix: Sequence[Sequence[int]], primes: Sequence[int]) -> np.ndarray:
    """The polynomial of an integer matrix modulo each of ``primes``."""
    m, p = np.array(matrix, object), np.array(primes, np.int64)
    stack = np.stack([(m % int(q)).astype(np.int64) for q in p])
    return polynomial_mod(stack, p)


def remainder(parts: dict[int, Sequence[int]], trace: int) -> list[int]:
    """Integer coefficients from their residues; the smallest prime only checks."""
    primes = sorted(parts, reverse=True)
    primes, check = primes[:-1], primes[-1]
    product = math.prod(primes)
    weights = [(product // p) * pow(product // p, -1, p) for p in primes]
    out = []
    for k in range(len(parts[check])):
        c = sum(w * int(parts[p][k]) for w, p in zip(weights, primes)) % product
        c = c - product if 2 * c > product else c
        if c % check != int(parts[check][k]):
            raise ArithmeticError("too few primes for the coefficients")
        out.append(c)
    if out[-1] != 1 or (len(out) > 1 and out[-2] != -trace):
        raise ArithmeticError("the polynomial does not fit its matrix")
    return out


# -------------------------------------------------------------------- roots
def roots_above(poly: Sequence[int], t: Fraction) -> int:
    """Number of roots greater than ``t``, exactly, if all roots are real.

    Sign changes of the coefficients of f(x + t): Descartes' rule counts
    without excess when every root is real.
    """
    a, s, d = t.numerator, t.denominator, len(poly) - 1
    c = [x * s ** (d - k) for k, x in enumerate(poly)]
    for i in range(d):
        for k in range(d - 1, i - 1, -1):
            c[k] += a * c[k + 1]
    signs = [x > 0 for x in c if x]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def sign_at(poly: Sequence[int], t: Fraction) -> int:
    a, s, acc, scale = t.numerator, t.denominator, 0, 1
    for c in reversed(poly):
        acc = acc * a + c * scale
        scale *= s
    return (acc > 0) - (acc < 0)


def largest_roots(poly: Sequence[int], k: int, guesses: Sequence[float] = (),
                  bits: int = ROOT_BITS) -> list[tuple[Fraction, int, int]]:
    """(value, first, multiplicity) of the ``k`` largest roots, all of them real and >= 0.

    Values are within 2**-bits of themselves; ``first`` counts from 0, and
    equal roots are one entry (its multiplicity may reach beyond ``k``).
    ``guesses`` only choose where to look first; every count is exact.
    """
    d = len(poly) - 1
    zeros = next(i for i, c in enumerate(poly) if c)  # exact multiplicity of the root 0
    top = Fraction(-poly[-2] + 1 if d else 1)
    known = {Fraction(0): d - zeros, top: 0}
    cuts = sorted({Fraction(int(g)) for g in guesses if g > 0})
    out, at = [], 0
    while at < min(k, d):
        if at >= d - zeros:
            out.append((Fraction(0), at, zeros))
            break
        while True:  # the interval (lo, hi] around the root after the first ``at`` ones
            lo = max(t for t, n in known.items() if n > at)
            hi = min(t for t, n in known.items() if n <= at)
            here = known[lo] - known[hi]
            if here == 1 or hi - lo <= hi / 2**bits:
                break
            inside = [t for t in cuts if lo < t < hi]
            t = inside[len(inside) // 2] if inside else _between(lo, hi)
            known[t] = roots_above(poly, t)
        if here == 1:
            left = sign_at(poly, lo)
            while hi - lo > hi / 2**bits:
                t = _between(lo, hi)
                s = sign_at(poly, t)
                if s == 0:
                    lo = hi = t
                elif s == left or left == 0:
                    lo, left = t, s
                else:
                    hi = t
        out.append(((lo + hi) / 2, at, here))
        at += here
    return out


def _between(lo: Fraction, hi: Fraction) -> Fraction:
    """A point near the middle with few digits: a multiple of a power of two."""
    width = (hi - lo) / 4
    bits = max(0, width.denominator.bit_length() - width.numerator.bit_length() + 1)
    scale = 1 << bits
    t = Fraction(math.floor((lo + hi) / 2 * scale), scale)
    return t if lo < t < hi else (lo + hi) / 2


# -------------------------------------------------------------- null spaces
def null_space(matrix: Sequence[Sequence[int]], root: Fraction, size: int, digits: int | None = None) -> np.ndarray:
    """``size`` orthonormal eigenvectors (rows) for one root, to double precision.

    Inverse iteration with the LU factors of ``matrix - root``, all in decimal
    arithmetic. The first of the largest entries of each vector is positive. Raises
    ``ArithmeticError`` where the residual is not that of an eigenvector.
    """
    d = len(matrix)
    with localcontext() as ctx:
        ctx.prec = digits or 60 + ROOT_BITS // 2
        num, den = Decimal(root.numerator), Decimal(root.denominator)
        m = np.array([[Decimal(int(x)) for x in row] for row in matrix], object)
        lu, order = m.copy(), list(range(d))
        for i in range(d):
            lu[i, i] -= num / den
        norm = max([abs(x) for x in m.flat] + [Decimal(1)])
        tiny = norm * Decimal(10) ** (8 - ctx.prec)
        for j in range(d):
            i = max(range(j, d), key=lambda r: abs(lu[r, j]))
            if i != j:
                lu[[i, j]] = lu[[j, i]]
                order[i], order[j] = order[j], order[i]
            if abs(lu[j, j]) < tiny:
                lu[j, j] = tiny
            if j + 1 < d:
                lu[j + 1:, j] = lu[j + 1:, j] / lu[j, j]
                lu[j + 1:, j + 1:] -= np.multiply.outer(lu[j + 1:, j], lu[j, j + 1:])

        def solve(b: np.ndarray) -> np.ndarray:
            x = b[order].copy()
            for i in range(1, d):
                x[i] -= (lu[i, :i] * x[:i]).sum()
            for i in range(d - 1, -1, -1):
                if i + 1 < d:
                    x[i] -= (lu[i, i + 1:] * x[i + 1:]).sum()
                x[i] /= lu[i, i]
            return x

        def orthonormal(vs: list[np.ndarray]) -> list[np.ndarray]:
            out: list[np.ndarray] = []
            for v in vs:
                v = v / max(abs(x) for x in v)
                for _ in range(2):
                    for u in out:
                        v = v - u * (u * v).sum()
                out.append(v / (v * v).sum().sqrt())
            return out

        # fixed start vectors, the same in every attempt
        vs = [np.array([Decimal(((i + 3) * (s + 2) * 2654435761 + i * i) % 1000003 + 1) for i in range(d)], object)
              for s in range(size)]
        for _ in range(4):
            vs = orthonormal([solve(v) for v in vs])
        rows = []
        for v in vs:
            rest = (m * v[None, :]).sum(axis=1) - v * (num / den)
            if max(abs(x) for x in rest) > norm * d * Decimal(10) ** -30:
                raise ArithmeticError("inverse iteration has not reached the null space")
            most = max(abs(x) for x in v) * (1 - Decimal(10) ** -12)
            peak = next(i for i in range(d) if abs(v[i]) >= most)
            rows.append([float(x if v[peak] > 0 else -x) for x in v])
    return np.array(rows).reshape(size, d)
