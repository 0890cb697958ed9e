"""Eigenvalues and vectors of an integer scatter matrix by its exact characteristic polynomial.

Residues of the polynomial modulo 31-bit primes come from Hessenberg forms; the
Chinese remainder theorem joins them. Because all roots are real, the sign
changes of the polynomial moved to a point count the roots beyond it exactly,
which isolates roots with their multiplicity. Vectors of the null space of
(A - root) come from inverse iteration in decimal arithmetic.
"""

from __future__ import annotations

import decimal
import math
from dataclasses import dataclass
from fractions import Fraction

import numpy as np

# Relative bits to which roots are isolated; closer ones count as one multiple root.
ROOT_BITS = 100


def primes_below(limit: int, product: int) -> list[int]:
    """Falling primes below ``limit`` (at most 2**31) whose product exceeds ``product``."""
    found, reached, n = [], 1, limit - 1
    while reached <= product:
        if _is_prime(n):
            found.append(n)
            reached *= n
        n -= 1
    return found


def _is_prime(n: int) -> bool:
    """Miller-Rabin with bases that decide every number below 3,215,031,751."""
    if n < 11:
        return n in (2, 3, 5, 7)
    if any(n % p == 0 for p in (2, 3, 5, 7)):
        return False
    d, s = n - 1, 0
    while d % 2 == 0:
        d, s = d // 2, s + 1
    for base in (2, 3, 5, 7):
        x = pow(base, d, n)
        if x in (1, n - 1):
            continue
        for _ in range(s - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def residues(matrix: np.ndarray, primes: list[int]) -> np.ndarray:
    """Coefficients of det(x - A) modulo each prime, rising powers: primes x (d + 1)."""
    d = len(matrix)
    p = np.array(primes, np.int64)
    h = np.array([[[int(v) % q for v in row] for row in matrix] for q in primes], np.int64).reshape(len(primes), d, d)
    each = np.arange(len(primes))
    p2, p3 = p[:, None], p[:, None, None]
    for k in range(d - 2):
        # A row with an entry in this column moves up; where there is none, the column is done.
        pivot = (h[:, k + 1 :, k] != 0).argmax(axis=1) + k + 1
        held = h[each, pivot].copy()
        h[each, pivot], h[:, k + 1] = h[:, k + 1].copy(), held
        held = h[each, :, pivot].copy()
        h[each, :, pivot], h[:, :, k + 1] = h[:, :, k + 1].copy(), held
        inverse = np.array([pow(int(v), -1, q) if v else 0 for v, q in zip(h[:, k + 1, k], primes)], np.int64)
        factor = h[:, k + 2 :, k] * inverse[:, None] % p2
        h[:, k + 2 :, :] = (h[:, k + 2 :, :] - factor[:, :, None] * h[:, k + 1, None, :] % p3) % p3
        h[:, :, k + 1] = (h[:, :, k + 1] + (h[:, :, k + 2 :] * factor[:, None, :] % p3).sum(axis=2)) % p2
    # Leading minors of a Hessenberg form follow from the smaller ones.
    minors = np.zeros((d + 1, len(primes), d + 1), np.int64)
    minors[0, :, 0] = 1
    for k in range(1, d + 1):
        new = np.zeros_like(minors[0])
        new[:, 1:] = minors[k - 1][:, :-1]
        new = (new - h[:, k - 1, k - 1, None] * minors[k - 1]) % p2
        below = np.ones(len(primes), np.int64)
        for i in range(1, k):
            below = below * h[:, k - i, k - i - 1] % p
            new = (new - (h[:, k - i - 1, k - 1] * below % p)[:, None] * minors[k - i - 1]) % p2
        minors[k] = new
    return minors[d]


def coefficient_bound(matrix: np.ndarray) -> int:
    """No coefficient of a positive semidefinite matrix' polynomial exceeds (1 + trace/d) ** d."""
    d = len(matrix)
    return (1 + -(-int(sum(matrix[i][i] for i in range(d))) // d)) ** d


def joined(rests: dict[int, list[int]]) -> list[int]:
    """Coefficients e_0 .. e_d (elementary symmetric functions of the roots) by Chinese remaindering.

    det(x - A) = sum of (-1)**k e_k x**(d-k); all e_k of a positive semidefinite
    matrix are at least zero, so their residues decide them.
    """
    product = math.prod(rests)
    weights = {q: (product // q) * pow(product // q, -1, q) for q in rests}
    d = len(next(iter(rests.values()))) - 1
    return [sum(weights[q] * (rest[d - k] * (-1) ** k % q) for q, rest in rests.items()) % product for k in range(d + 1)]


@dataclass(frozen=True)
class Root:
    """A root between low and high (in units of 2**-bits) with its multiplicity."""

    low: int
    high: int
    bits: int
    times: int

    @property
    def value(self) -> Fraction:
        return Fraction(self.low + self.high, 2 << self.bits)


def top_roots(symmetric: list[int], count: int) -> list[Root]:
    """The largest positive roots, falling, until their multiplicities reach ``count``."""
    positive = max(k for k, e in enumerate(symmetric) if e)
    count = min(count, positive)
    bits = 64
    while True:
        found = _isolated(symmetric, count, bits)
        if all(r.low >> ROOT_BITS for r in found):
            return found
        bits *= 2


def _isolated(symmetric: list[int], count: int, bits: int) -> list[Root]:
    # Falling powers of the polynomial whose roots are 2**bits times larger.
    poly = [(-1) ** k * e << (bits * k) for k, e in enumerate(symmetric)]

    def beyond(a: int) -> int:
        """Roots greater than a: sign changes of the polynomial moved by a."""
        c = list(poly)
        for end in range(len(c), 1, -1):
            for j in range(1, end):
                c[j] += a * c[j - 1]
        signs = [x > 0 for x in c if x]
        return sum(x != y for x, y in zip(signs, signs[1:]))

    def sign(a: int) -> int:
        y = 0
        for c in poly:
            y = y * a + c
        return (y > 0) - (y < 0)

    found: list[Root] = []
    top = symmetric[1] + 1 << bits if len(symmetric) > 1 else 1
    waiting = [(0, top, beyond(0), 0)] if count else []
    while waiting and sum(r.times for r in found) < count:
        low, high, more, fewer = waiting.pop()
        if more == fewer:
            continue
        if high - low <= max(1, low >> ROOT_BITS):
            found.append(Root(low, high, bits, more - fewer))
            continue
        if more - fewer == 1:
            # One simple root is left in (low, high]: its side shows in the sign.
            while high - low > max(1, low >> ROOT_BITS):
                middle = (low + high) // 2
                at = sign(middle)
                if at == 0:
                    low = high = middle
                elif at == (-1) ** fewer:
                    high = middle
                else:
                    low = middle
            found.append(Root(low, high, bits, 1))
            continue
        middle = (low + high) // 2
        between = beyond(middle)
        waiting.append((low, middle, more, between))
        waiting.append((middle, high, between, fewer))
    return found


def null_vectors(matrix: np.ndarray, root: Root, take: int) -> list[list[decimal.Decimal]]:
    """``take`` orthonormal vectors for one root by inverse iteration."""
    d = len(matrix)
    size = max(1, max(abs(int(v)) for v in matrix.ravel()))
    digits = len(str(size)) + int(ROOT_BITS * 0.302) * 2 + 40
    with decimal.localcontext(decimal.Context(prec=digits, Emax=decimal.MAX_EMAX, Emin=decimal.MIN_EMIN)):
        value = root.value
        shift = decimal.Decimal(value.numerator) / decimal.Decimal(value.denominator)
        a = np.array([[decimal.Decimal(int(v)) for v in row] for row in matrix], object).reshape(d, d)
        for i in range(d):
            a[i, i] -= shift
        # A pivot that cancels entirely stands for one of the size of the rounding.
        tiny = decimal.Decimal(size).scaleb(-digits)
        order = np.arange(d)
        for k in range(d):
            best = k + int(np.abs(a[k:, k]).argmax())
            if best != k:
                a[[k, best]], order[[k, best]] = a[[best, k]], order[[best, k]]
            if a[k, k] == 0:
                a[k, k] = tiny
            if k + 1 < d:
                a[k + 1 :, k] = a[k + 1 :, k] / a[k, k]
                a[k + 1 :, k + 1 :] -= a[k + 1 :, k, None] * a[k, None, k + 1 :]

        def solved(b: np.ndarray) -> np.ndarray:
            x = b[order].copy()
            for k in range(1, d):
                x[k] -= a[k, :k] @ x[:k]
            for k in range(d - 1, -1, -1):
                if k + 1 < d:
                    x[k] -= a[k, k + 1 :] @ x[k + 1 :]
                x[k] = x[k] / a[k, k]
            return x

        held: list[np.ndarray] = []
        draw = np.random.Generator(np.random.PCG64(17))
        for _ in range(take):
            x = np.array([decimal.Decimal(int(v)) for v in draw.integers(1, 1 << 20, d)], object)
            for _ in range(3):
                for y in held:
                    x = x - (x @ y) * y
                x = solved(x)
                # Twice, so that what rounding leaves of the others goes too.
                for y in held + held:
                    x = x - (x @ y) * y
                x = x / (x @ x).sqrt()
            # A fixed sign: the entry of largest size is positive.
            if x[int(np.abs(x).argmax())] < 0:
                x = -x
            held.append(x)
        return [list(x) for x in held]
