"""The eigenvalues and eigenvectors of a scatter matrix, kept up to date row by row.

A new row changes the scatter matrix by one outer product. In the basis of the eigenvectors
the matrix is then a diagonal and an outer product, whose eigenvalues are the roots of a
secular equation, one between each two old eigenvalues.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
STEPS = 60


def _secular_roots(poles: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum(weights / (poles - x)), as ``poles[origin] + offset`` for each.

    Poles rise strictly and weights are positive, so there is one root behind each pole. Each
    root is sought as an offset from the nearer of its two poles, by interpolating the poles
    on both sides of it with one each; what leaves its bracket is bisected.
    """
    n = len(poles)
    ends = np.append(poles[1:], poles[-1] + weights.sum())
    middle = (poles + ends) / 2
    at_middle = 1 + (weights / (poles - middle[:, None])).sum(axis=1)
    origin = np.arange(n) + ((at_middle < 0) & (np.arange(n) < n - 1))
    poles_off = poles - poles[origin][:, None]
    near, far = poles - poles[origin], ends - poles[origin]
    half = middle - poles[origin]
    low, high = np.where(at_middle < 0, half, near), np.where(at_middle < 0, far, half)
    below = np.tri(n, dtype=bool)
    x = (low + high) / 2
    active = np.arange(n)
    for _ in range(STEPS):
        apart = poles_off[active] - x[active, None]
        terms = weights / apart
        slopes = terms / apart
        left = below[active]
        psi, dpsi = np.where(left, terms, 0).sum(axis=1), np.where(left, slopes, 0).sum(axis=1)
        phi, dphi = terms.sum(axis=1) - psi, slopes.sum(axis=1) - dpsi
        value = 1 + psi + phi
        size = 1 + np.abs(psi) + np.abs(phi)
        rising = value < 0  # the function rises between its poles: the root is further right
        low[active] = np.where(rising, x[active], low[active])
        high[active] = np.where(rising, high[active], x[active])
        done = np.abs(value) <= 4 * n * EPS * size
        done |= high[active] - low[active] <= 2 * EPS * np.abs(x[active])
        if done.all():
            break
        keep = ~done
        active = active[keep]
        value, dpsi, dphi = value[keep], dpsi[keep], dphi[keep]
        here = x[active]
        # psi ~ r + s / (left pole - x), phi ~ t + u / (right pole - x), same value and slope
        left_gap, right_gap = near[active] - here, far[active] - here
        s, u = dpsi * left_gap**2, dphi * right_gap**2
        const = value - dpsi * left_gap - dphi * right_gap
        # const * (l - e)(r - e) + s (r - e) + u (l - e) = 0 for the step e
        a = const
        b = -(const * (left_gap + right_gap) + s + u)
        c = const * left_gap * right_gap + s * right_gap + u * left_gap
        with np.errstate(all="ignore"):
            root = np.sqrt(np.maximum(b * b - 4 * a * c, 0))
            big = -(b + np.copysign(root, b)) / 2
            one, two = big / a, c / big
            step = np.where((one > left_gap) & (one < right_gap), one, two)
            new = here + step
        outside = ~((new > low[active]) & (new < high[active]))
        x[active] = np.where(outside, (low[active] + high[active]) / 2, new)
    return origin, x


class Spectrum:
    """Number, mean, and eigenvalues (rising) with eigenvectors (columns) of the centred scatter
    matrix of rows of ``size`` numbers."""

    def __init__(self, size: int):
        self.n = 0
        self.mean = np.zeros(size)
        self.values = np.zeros(size)
        self.vectors = np.eye(size)

    def add(self, row: np.ndarray) -> None:
        """One row more."""
        off = row - self.mean
        self.n += 1
        self.mean = self.mean + off / self.n
        if self.n > 1:
            self._update(off, 1 - 1 / self.n)

    def merge(self, other: Spectrum) -> None:
        """All rows of ``other``: an update for each of its eigenvectors and one for the means."""
        if not other.n:
            return
        off, n = other.mean - self.mean, self.n + other.n
        share = other.n / n
        if self.n:
            for value, vector in zip(other.values, other.vectors.T, strict=True):
                if value > 0:
                    self._update(vector, value)
            self._update(off, self.n * share)
        else:
            self.values, self.vectors = other.values.copy(), other.vectors.copy()
        self.mean, self.n = self.mean + off * share, n

    def _update(self, vector: np.ndarray, weight: float) -> None:
        """The spectrum of the matrix plus ``weight`` times the outer product of ``vector``."""
        z = vector @ self.vectors
        norm = np.sqrt(z @ z)
        if not norm > 0 or not weight > 0:
            return
        rho = weight * norm * norm
        z = z / norm
        scale = max(abs(self.values[-1]), abs(self.values[0]), rho)
        tolerance = 8 * EPS * scale
        self._deflate_equal(z, tolerance)
        moved = np.flatnonzero(rho * np.abs(z) > tolerance)
        if not len(moved):
            return
        poles, part = self.values[moved], z[moved]
        if len(moved) > 1 and (np.diff(poles) <= 0).any():
            poles = np.maximum.accumulate(poles + np.arange(len(poles)) * EPS * scale)
        origin, offset = _secular_roots(poles, rho * part * part)
        # gaps[i, j] is pole j minus root i, without cancellation
        gaps = poles - poles[origin][:, None] - offset[:, None]
        part = np.copysign(self._consistent(poles, gaps, rho), part)
        rotation = part / gaps
        rotation /= np.sqrt((rotation * rotation).sum(axis=1))[:, None]
        self.values[moved] = poles[origin] + offset
        self.vectors[:, moved] = self.vectors[:, moved] @ rotation.T
        order = np.argsort(self.values, kind="stable")
        if (order[1:] < order[:-1]).any():
            self.values, self.vectors = self.values[order], self.vectors[:, order]

    def _deflate_equal(self, z: np.ndarray, tolerance: float) -> None:
        """Turns the eigenvectors of equal eigenvalues so that one alone meets ``z``."""
        equal = np.diff(self.values) <= tolerance
        if not equal.any():
            return
        start = 0
        for end in [*(np.flatnonzero(~equal) + 1).tolist(), len(z)]:
            if end - start > 1:
                some = slice(start, end)
                part = z[some].copy()
                size = np.sqrt(part @ part)
                if size > 0:
                    mirror = part
                    mirror[-1] += np.copysign(size, mirror[-1])
                    length = mirror @ mirror
                    last = -np.copysign(size, mirror[-1])
                    own = self.vectors[:, some]
                    self.vectors[:, some] = own - np.outer(own @ mirror, 2 * mirror / length)
                    z[some] = 0
                    z[end - 1] = last
                self.values[some] = self.values[some].mean()
            start = end

    @staticmethod
    def _consistent(poles: np.ndarray, gaps: np.ndarray, rho: float) -> np.ndarray:
        """The lengths of the vector for which the computed roots are exact, which keeps the
        eigenvectors at right angles."""
        between = poles - poles[:, None]
        np.fill_diagonal(between, 1)
        ratio = gaps / between
        diagonal = np.diagonal(gaps).copy()
        np.fill_diagonal(ratio, 1)
        # product over roots of (root - pole j) / product over other poles of (pole - pole j)
        return np.sqrt(np.abs(np.prod(ratio, axis=0) * diagonal / rho))

    def to_bytes(self) -> bytes:
        head = np.array([self.n], np.int64).tobytes()
        return head + self.mean.tobytes() + self.values.tobytes() + self.vectors.tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes, size: int) -> Spectrum:
        out = cls(size)
        out.n = int(np.frombuffer(raw, np.int64, 1)[0])
        numbers = np.frombuffer(raw, float, offset=8)
        out.mean, out.values = numbers[:size].copy(), numbers[size : 2 * size].copy()
        out.vectors = numbers[2 * size :].reshape(size, size).copy()
        return out
