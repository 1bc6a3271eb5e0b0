"""The largest eigenvalues of a symmetric matrix by contour integration (numpy).

The wanted eigenvalues are cut into intervals by inertia counts (the signs of a
pivoted LDL' factorisation of V - s*I say how many eigenvalues exceed s). For
each interval a circle through its ends is integrated with Gauss-Legendre nodes:
solves with the complex shifted matrix project a random block onto the
interval's eigenvectors, and Rayleigh-Ritz extracts them. An interval is done
when as many Ritz pairs converge inside it as the inertia counts say it holds.
"""

from __future__ import annotations

import numpy as np

PIVOT = (1 + 17 ** 0.5) / 8   # a diagonal pivot of at least this share of the largest other entry is taken
NODES = 12                    # quadrature nodes of the upper half circle
CHUNK = 6                     # eigenvalues of one interval, where gaps allow it
ROUNDS = 40
RANGE = 8.0                   # an interval's upper end over its lower end, where it can be cut
NARROW = 1e-9                 # eigenvalues closer than this share of the norm are one cluster
SEED = 20240613


def count_above(v: np.ndarray, shift: float) -> int:
    """Number of eigenvalues of v above the shift (with multiplicity)."""
    m = v - shift * np.eye(len(v))
    above = 0
    while len(m):
        size = np.abs(m)
        r = int(np.argmax(np.diagonal(size)))
        off = size - np.diag(np.diagonal(size))
        p, q = np.unravel_index(int(np.argmax(off)), off.shape)
        if size[r, r] == 0 and off[p, q] == 0:
            break
        if size[r, r] >= PIVOT * off[p, q]:
            rest = np.delete(np.arange(len(m)), r)
            above += m[r, r] > 0
            c = m[rest, r]
            m = m[np.ix_(rest, rest)] - np.outer(c, c / m[r, r])
        else:  # a block of two with one positive and one negative eigenvalue
            rest = np.delete(np.arange(len(m)), [p, q])
            above += 1
            c = m[np.ix_(rest, [p, q])]
            m = m[np.ix_(rest, rest)] - c @ np.linalg.solve(m[np.ix_([p, q], [p, q])], c.T)
        m = (m + m.T) / 2
    return int(above)


def _cut(v: np.ndarray, k: int, lo: float, hi: float) -> float:
    """A shift in the middle of a gap with k or more eigenvalues above it: more
    where the k-th one is in a cluster. lo has at least k above, hi fewer."""
    def last(least, a, b):  # just below the ``least``-th eigenvalue, which lies in (a, b]
        while b - a > NARROW / 8:
            mid = (a + b) / 2
            a, b = (mid, b) if count_above(v, mid) >= least else (a, mid)
        return a

    above = last(k, lo, hi)
    while True:
        k = count_above(v, above)
        if count_above(v, lo) == k:
            return (lo + above) / 2 if above - lo > NARROW else lo
        below = last(k + 1, lo, above)
        if above - below > NARROW:
            return (above + below) / 2
        above = below


def _interval(v: np.ndarray, lo: float, hi: float, n: int, rng) -> tuple[np.ndarray, np.ndarray]:
    """The n eigenpairs with lo < e <= hi."""
    dims, size = len(v), min(len(v), n + max(4, n))
    centre, radius = (lo + hi) / 2, (hi - lo) / 2
    x, w = np.polynomial.legendre.leggauss(NODES)
    turn = np.exp(1j * np.pi * (1 - x) / 2)
    scale = np.abs(v).sum(axis=1).max()
    y = rng.standard_normal((dims, size))
    for _ in range(ROUNDS):
        q = np.zeros((dims, size))
        for t, weight in zip(turn, w):
            q += weight / 2 * np.real(radius * t * np.linalg.solve((centre + radius * t) * np.eye(dims) - v, y))
        u, s, _ = np.linalg.svd(q, full_matrices=False)
        u = u[:, s > s[0] * 1e-14]
        e, c = np.linalg.eigh(u.T @ v @ u)  # Rayleigh-Ritz
        y = u @ c
        inside = (e > lo) & (e <= hi)
        wrong = np.linalg.norm(v @ y - y * e, axis=0)
        if inside.sum() == n and (wrong[inside] <= 1e-13 * scale * dims ** 0.5).all():
            return e[inside], y[:, inside]
        if y.shape[1] < size:
            y = np.hstack([y, rng.standard_normal((dims, size - y.shape[1]))])
    raise ArithmeticError(f"{n} eigenvalues in ({lo}, {hi}], {int(inside.sum())} found")


def largest_eigenpairs(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues, falling, and their unit eigenvectors (columns)
    of a positive semidefinite matrix; fewer where the rest is zero up to
    rounding."""
    v = (v + v.T) / 2
    scale = np.abs(v).sum(axis=1).max(initial=0.0)
    if not scale > 0:
        return np.zeros(0), np.zeros((len(v), 0))
    unit = v / scale  # eigenvalues in [0, 1]
    zero = 1e-10
    k = min(k, count_above(unit, zero))
    rng = np.random.default_rng(SEED)
    cuts = [1.0 + 1e-6]
    while (have := count_above(unit, cuts[-1])) < k:
        hi = cuts[-1]
        lo = _cut(unit, min(k, have + CHUNK), zero, hi)
        if lo < hi / RANGE:  # too wide for one circle: what lies in its upper part first, if anything does
            upper = count_above(unit, hi / RANGE)
            lo = _cut(unit, min(k, upper), zero, hi) if upper > have else hi / RANGE
        cuts.append(lo)
    found = []
    for hi, lo in zip(cuts, cuts[1:]):
        n = count_above(unit, lo) - count_above(unit, hi)  # inertia: none may be missed
        if n:
            found.append(_interval(unit, lo, hi, n, rng))
    e = np.concatenate([f[0] for f in found])
    u = np.hstack([f[1] for f in found])
    order = np.argsort(-e, kind="stable")[:k]
    u = np.linalg.qr(u[:, order])[0]  # intervals are orthogonal up to rounding
    return e[order] * scale, u
