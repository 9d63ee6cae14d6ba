"""Eigendecomposition of a matrix after a rank-one change, by its secular equation with deflation.

A spectrum is (values, vectors): ascending eigenvalues and the orthonormal eigenvectors in columns.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(np.float64).eps
ROUNDS = 60  # bisection alone would end within these


def _merged(values: np.ndarray, vectors: np.ndarray, z: np.ndarray, tolerance: float) -> tuple[np.ndarray, np.ndarray]:
    """Within each group of equal eigenvalues the basis is reflected so that only its last vector meets ``z``."""
    first = np.flatnonzero(np.concatenate(([True], np.diff(values) > tolerance)))
    last = np.append(first[1:], len(values))
    groups = [(a, b) for a, b in zip(first.tolist(), last.tolist(), strict=True) if b - a > 1 and np.any(z[a : b - 1])]
    if not groups:
        return vectors, z
    vectors, z = vectors.copy(), z.copy()
    for a, b in groups:
        w = z[a:b].copy()
        norm = np.sqrt(w @ w)
        sign = 1.0 if w[-1] >= 0 else -1.0
        w[-1] += sign * norm
        vectors[:, a:b] -= np.outer(vectors[:, a:b] @ w, w * (2 / (w @ w)))
        z[a:b] = 0
        z[b - 1] = -sign * norm
    return vectors, z


def secular_roots(d: np.ndarray, z2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum(z2 / (d - x)), one after each of the ascending ``d``, as (nearest pole, distance from it).

    Each root is bracketed by its poles; a step that fits a rational function to the poles on either side is
    taken where it stays inside the bracket, a bisection where it does not.
    """
    m = len(d)
    at = np.arange(m)
    right = np.append(d[1:], d[-1] + z2.sum() * 1.01)  # the last root is no further than the sum
    middle = (d + right) / 2
    f = 1 + (z2[:, None] / (d[:, None] - middle[None, :])).sum(axis=0)
    pole = np.where((f >= 0) | (at == m - 1), at, np.minimum(at + 1, m - 1))
    gap = d[:, None] - d[pole][None, :]  # [pole i, root j]
    left_edge, right_edge = d - d[pole], right - d[pole]
    half = (right - d) / 2
    low = np.where(pole == at, 0.0, left_edge + half)
    high = np.where(pole == at, np.where((f >= 0), half, right_edge), 0.0)
    low = np.where((at == m - 1) & (f < 0), half, low)
    x = (low + high) / 2
    below = at[:, None] <= at[None, :]
    open_ = at
    for _ in range(ROUNDS):
        xs = x[open_]
        term = z2[:, None] / (gap[:, open_] - xs)
        size = np.abs(term).sum(axis=0) + 1
        f = 1 + term.sum(axis=0)
        more = np.abs(f) > EPS * m * size
        if not more.any():
            break
        if not more.all():
            open_, xs, f, term = open_[more], xs[more], f[more], term[:, more]
        slope = term / (gap[:, open_] - xs)
        up = np.where(below[:, open_], slope, 0.0).sum(axis=0)
        down = slope.sum(axis=0) - up
        low[open_], high[open_] = np.where(f < 0, xs, low[open_]), np.where(f >= 0, xs, high[open_])
        p, q = left_edge[open_] - xs, right_edge[open_] - xs
        a = (p + q) * f - p * q * (up + down)
        b = p * q * f
        c = f - p * up - q * down
        with np.errstate(all="ignore"):
            s = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            new = xs + np.where(a <= 0, (a - s) / (2 * c), 2 * b / (a + s))
            if open_[-1] == m - 1:  # no pole on its right
                new[-1] = xs[-1] + p[-1] + up[-1] * p[-1] ** 2 / (f[-1] - p[-1] * up[-1])
        inside = np.isfinite(new) & (new > low[open_]) & (new < high[open_])
        x[open_] = np.where(inside, new, (low[open_] + high[open_]) / 2)
    return pole, x


def updated(values: np.ndarray, vectors: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spectrum of A + v v' from that of A."""
    z = vectors.T @ v
    largest = max(abs(values[-1]), abs(values[0]), float(z @ z))
    if largest == 0:
        return values, vectors
    tolerance = 8 * EPS * largest
    vectors, z = _merged(values, vectors, z, tolerance)
    # Coordinates that change no eigenvalue by more than rounding are left out.
    live = np.abs(z) * np.sqrt(float(z @ z)) > tolerance
    if not live.any():
        return values, vectors
    d, z = values[live], z[live]
    pole, x = secular_roots(d, z * z)
    from_pole = (d[:, None] - d[pole][None, :]) - x[None, :]  # d_i - root_j
    # The vector for which the computed roots are exact, so that eigenvectors come out orthogonal.
    ratio = -from_pole
    between = d[None, :] - d[:, None]
    np.fill_diagonal(between, 1.0)
    share = ratio / np.where(np.eye(len(d), dtype=bool), 1.0, between)
    exact = np.sqrt(np.abs(np.prod(share, axis=1)))
    exact = np.where(z < 0, -exact, exact)
    turn = exact[:, None] / from_pole
    turn /= np.sqrt((turn * turn).sum(axis=0))[None, :]
    values, vectors = values.copy(), vectors.copy()
    values[live] = d[pole] + x
    vectors[:, live] = vectors[:, live] @ turn
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


class Spectrum:
    """Scatter matrix of the vectors seen so far, around their own mean, as its eigendecomposition."""

    def __init__(self, size: int) -> None:
        self.n, self.mean = 0, np.zeros(size)
        self.values, self.vectors = np.zeros(size), np.eye(size)

    def add(self, v: np.ndarray) -> None:
        """One vector more: the centred vector is a rank-one update."""
        away = v - self.mean
        self.n += 1
        self.mean = self.mean + away / self.n
        if self.n > 1:
            self.values, self.vectors = updated(self.values, self.vectors, away * np.sqrt((self.n - 1) / self.n))

    def join(self, other: Spectrum) -> None:
        """All vectors of another: its eigenvectors one after another, and the means apart, are rank-one updates."""
        if not other.n:
            return
        if self.n:
            away = other.mean - self.mean
            changes = [np.sqrt(value) * other.vectors[:, k] for k, value in enumerate(other.values) if value > 0]
            for change in [*changes, away * np.sqrt(self.n * other.n / (self.n + other.n))]:
                self.values, self.vectors = updated(self.values, self.vectors, change)
            self.mean = self.mean + away * (other.n / (self.n + other.n))
            self.n += other.n
        else:
            self.n, self.mean, self.values, self.vectors = other.n, other.mean, other.values, other.vectors

    def tobytes(self) -> bytes:
        return np.concatenate(([float(self.n)], self.mean, self.values, self.vectors.ravel())).tobytes()

    @classmethod
    def frombytes(cls, raw: bytes, size: int) -> Spectrum:
        flat, out = np.frombuffer(raw), cls(size)
        out.n, out.mean, out.values = int(flat[0]), flat[1 : size + 1], flat[size + 1 : 2 * size + 1]
        out.vectors = flat[2 * size + 1 :].reshape(size, size)
        return out
