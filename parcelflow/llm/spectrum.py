"""Eigendecompositions kept up to date by rank-one updates: secular equations with deflation."""

from __future__ import annotations

import numpy as np

EPS = np.finfo(np.float64).eps
#: Steps of the root search; each at least halves the bracket, and most roots need under ten.
STEPS = 80
#: A root is found when it moves by less, or when the terms cancel to less, relatively.
CLOSE = 16 * EPS


def _roots(d: np.ndarray, z2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pole, mu) of the roots of 1 + sum(z2 / (d - x)) = 0 for ascending d: x = d[pole] + mu.

    Root i lies between d[i] and d[i + 1], the last one at most sum(z2) beyond d[-1]. Each is told
    from its nearer pole, so small distances keep their digits. That pole's term is kept as it is,
    the others are taken as a line, which gives a quadratic equation per step; a bracket guards it.
    """
    k = len(d)
    gap = np.r_[np.diff(d), z2.sum()]
    middle = d + gap / 2
    at_middle = 1 + (z2 / (d[None, :] - middle[:, None])).sum(axis=1)
    right = at_middle < 0
    last = np.arange(k) == k - 1
    pole = np.arange(k) + (right & ~last)
    delta = d[None, :] - d[pole][:, None]
    low = np.where(right, np.where(last, gap / 2, -gap / 2), 0.0)
    high = np.where(right, np.where(last, gap, 0.0), gap / 2)
    mu = (low + high) / 2
    own = np.zeros((k, k), bool)
    own[np.arange(k), pole] = True
    weight = np.where(own, 0.0, z2)
    for _ in range(STEPS):
        away = delta - mu[:, None]
        away[own] = 1.0
        share = weight / away
        rest, slope = 1 + share.sum(axis=1), (share / away).sum(axis=1)
        value = rest - z2[pole] / mu
        low, high = np.where(value < 0, mu, low), np.where(value < 0, high, mu)
        b = rest - slope * mu
        root = np.sqrt(b * b + 4 * slope * z2[pole])
        # The two solutions have opposite signs; the bracket says which is meant, none is a difference of like numbers.
        far, near = np.where(b > 0, -(b + root), root - b), np.where(b > 0, b + root, b - root)
        with np.errstate(divide="ignore", invalid="ignore"):
            one, two = far / (2 * slope), 2 * z2[pole] / near
        up = low + high > 0
        new = np.where((one > 0) == up, one, two)
        new = np.where((new >= low) & (new <= high) & (new != 0) & np.isfinite(new), new, (low + high) / 2)
        near_zero = np.abs(value) <= CLOSE * (1 + np.abs(share).sum(axis=1) + z2[pole] / np.abs(mu))
        done = near_zero | (np.abs(new - mu) <= CLOSE * np.abs(new))
        mu = np.where(near_zero, mu, new)
        if done.all():
            break
    return pole, mu


def _deflated(d: np.ndarray, z: np.ndarray, u: np.ndarray, small: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Turn pairs of equal eigenvalues so that one of the two takes no part (z = 0)."""
    kept = -1
    for i in range(len(d)):
        if abs(z[i]) <= small:
            z[i] = 0.0
            continue
        if kept >= 0 and (d[i] - d[kept]) * abs(z[i] * z[kept]) <= 8 * EPS * d[-1] * (z[i] ** 2 + z[kept] ** 2):
            length = np.hypot(z[i], z[kept])
            c, s = z[i] / length, z[kept] / length
            first, second = u[:, kept].copy(), u[:, i].copy()
            u[:, kept], u[:, i] = c * first - s * second, s * first + c * second
            d[kept], d[i] = c * c * d[kept] + s * s * d[i], s * s * d[kept] + c * c * d[i]
            z[kept], z[i] = 0.0, length
        kept = i
    return d, z, u


def updated(d: np.ndarray, u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (ascending) and eigenvectors of u diag(d) u' + v v'."""
    z, d, u = u.T @ v, d.copy(), u.copy()
    total = z @ z
    if total == 0:
        return d, u
    small = 8 * EPS * np.sqrt(max(d[-1], total))
    d, z, u = _deflated(d, z, u, small)
    part = np.flatnonzero(z)
    if len(part):
        order = part[np.argsort(d[part], kind="stable")]
        poles, z_in = d[order], z[order]
        pole, mu = _roots(poles, z_in * z_in)
        # Distances of the new eigenvalues (rows) to the old ones (columns), from their poles.
        away = (poles[pole][:, None] - poles[None, :]) + mu[:, None]
        # The z for which these very roots are exact: then the eigenvectors are orthogonal.
        k = len(order)
        below = poles[:, None] - poles[None, :]
        np.fill_diagonal(below, 1.0)
        ratio = np.where(np.eye(k, dtype=bool), away, away / below.T)
        exact = np.sqrt(np.abs(np.prod(ratio, axis=0))) * np.sign(z_in)
        vectors = exact[:, None] / away.T
        vectors /= np.linalg.norm(vectors, axis=0)
        u[:, order] = u[:, order] @ vectors
        d[order] = poles[pole] + mu
    rank = np.argsort(d, kind="stable")
    return d[rank], u[:, rank]


def empty(dim: int) -> tuple[np.ndarray, np.ndarray]:
    return np.zeros(dim), np.eye(dim)


def with_rows(d: np.ndarray, u: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spectrum of the scatter with that of centred rows added, one rank-one update each.

    More rows than dimensions are first put into as many rows of the same scatter (their
    triangular factor), so a block of rows costs one update per dimension.
    """
    if len(rows) > rows.shape[1]:
        rows = np.linalg.qr(rows, mode="r")
    for v in rows:
        d, u = updated(d, u, v)
    return d, u


def combined(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The spectrum of the sum of two scatters: an update by each scaled eigenvector of the second."""
    d, u = one
    for value, vector in zip(two[0], two[1].T, strict=True):
        if value > 0:
            d, u = updated(d, u, np.sqrt(value) * vector)
    return d, u
