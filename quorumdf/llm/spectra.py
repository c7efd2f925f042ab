"""Rank-one updates of symmetric eigendecompositions, in numpy."""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
ROUNDS = 80


def secular_roots(d: np.ndarray, z2: np.ndarray, rho: float) -> np.ndarray:
    """``d[j] - root[i]`` for all roots of 1 / rho + sum(z2 / (d - x)) = 0, at [i, j].

    ``d`` rises strictly, ``z2`` and ``rho`` are positive.  Each root lies between two
    poles; it is sought from the nearer one, so its distance to the poles is exact to
    rounding.  Steps solve the interpolation with both poles; where one would leave
    the bracket, the bracket is halved.  All roots are sought at once.
    """
    k = len(d)
    top = rho * z2.sum()
    gap = np.append(np.diff(d), top)
    at = np.arange(k)
    middle = 1 / rho + (z2 / (d[None, :] - (d + gap / 2)[:, None])).sum(axis=1)
    right = (middle < 0) & (at < k - 1)
    apart = d[None, :] - d[at + right][:, None]
    low = np.where(right, -gap / 2, np.where((at == k - 1) & (middle < 0), gap / 2, 0.0))
    high = np.where(right, 0.0, np.where((at == k - 1) & (middle < 0), gap, gap / 2))
    x = np.where(low * high == 0, (low + high) / 2, low)
    below = (at[None, :] <= at[:, None]).astype(float)
    after = np.minimum(at + 1, k - 1)
    last = at == k - 1
    w, t = np.empty_like(apart), np.empty_like(apart)
    for _ in range(ROUNDS):
        np.subtract(apart, x[:, None], out=w)
        np.divide(z2, w, out=t)
        sum_below, total = np.einsum("ij,ij->i", t, below), t.sum(axis=1)
        f = 1 / rho + total  # terms below a root are negative, those above it positive
        done = (np.abs(f) <= 4 * k * EPS * (1 / rho + total - 2 * sum_below)) | (high - low <= 4 * EPS * np.abs(x))
        if done.all():
            break
        low, high = np.where(f < 0, x, low), np.where(f >= 0, x, high)
        t /= w
        psi, both = np.einsum("ij,ij->i", t, below), t.sum(axis=1)
        d1, d2 = w[at, at], w[at, after]
        a, b = (d1 + d2) * f - d1 * d2 * both, d1 * d2 * f
        c = f - d1 * psi - d2 * (both - psi)
        with np.errstate(all="ignore"):
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0.0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            step = np.where(last, d1 + d1 * d1 * both / (f - d1 * both), step)
            new = x + step
        inside = (new > low) & (new < high)
        x = np.where(done, x, np.where(inside, new, (low + high) / 2))
    return apart - x[:, None]


def _merge_equal(values, vectors, z, kept, tol):
    """Turn the plane of each two neighbouring poles that are equal to ``tol`` until one of them has no share in z."""
    p, out = kept[0], []
    for j in kept[1:]:
        s, c = z[p], z[j]
        tau = np.hypot(c, s)
        c, s = c / tau, -s / tau
        if abs((values[j] - values[p]) * c * s) <= tol:
            z[j], z[p] = tau, 0.0
            one, two = vectors[:, p].copy(), vectors[:, j].copy()
            vectors[:, p], vectors[:, j] = c * one + s * two, c * two - s * one
            d1, d2 = values[p], values[j]
            values[p], values[j] = d1 * c * c + d2 * s * s, d1 * s * s + d2 * c * c
        else:
            out.append(p)
        p = j
    return np.array([*out, p])


def add_rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """The decomposition of ``vectors @ diag(values) @ vectors.T + rho * outer(v, v)``; values rise, rho > 0.

    Poles without a share in ``v`` and poles that coincide are deflated: their pairs
    stay.  The eigenvectors of the rest come from the share that has exactly the roots
    found (Gu and Eisenstat), so they are orthogonal however close the roots are.
    """
    z = vectors.T @ v
    size = float(z @ z)
    rho = rho * size
    if not rho > EPS * EPS * max(values[-1], 0.0) or size == 0:
        return values, vectors
    values, vectors, z = values.copy(), vectors.copy(), z / np.sqrt(size)
    tol = 8 * EPS * max(values[-1], rho)
    kept = np.flatnonzero(rho * np.abs(z) > tol)
    if len(kept) > 1:
        d, y = values[kept], z[kept]
        if (np.diff(d) * np.abs(y[1:] * y[:-1]) / (y[1:] ** 2 + y[:-1] ** 2) <= tol).any():
            kept = _merge_equal(values, vectors, z, kept, tol)
            kept = kept[np.argsort(values[kept], kind="stable")]
    d, y = values[kept], z[kept]
    w = secular_roots(d, y * y, rho)
    ratio = d[None, :] - d[:, None]
    np.fill_diagonal(ratio, -1.0)
    share = np.sqrt(np.abs(np.prod(w / ratio, axis=0))) * np.where(y < 0, -1.0, 1.0)
    turn = share[None, :] / w
    turn /= np.sqrt((turn * turn).sum(axis=1))[:, None]
    values[kept] = d - w[np.arange(len(kept)), np.arange(len(kept))]
    vectors[:, kept] = vectors[:, kept] @ turn.T
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]
