"""Leading eigenpairs of a symmetric matrix that one machine holds (dimensions squared, not rows).

Householder reflections bring it to tridiagonal form; Sturm counts, the signs of its pivots, say how many
eigenvalues lie below a number, so bisection brackets each wanted one; inverse iteration gives its vector,
and vectors of close eigenvalues are made orthogonal to each other again in every step.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
#: Eigenvalues closer than this share of the norm form a cluster.
CLOSE = 1e-3


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and unit reflection vectors (of the last rows) of Q' a Q."""
    a = np.array(a, float)
    n = len(a)
    off, reflections = np.zeros(max(0, n - 1)), []
    for k in range(n - 2):
        column = a[k + 1 :, k]
        length = np.linalg.norm(column)
        v = column.copy()
        off[k] = -length if v[0] > 0 else length
        v[0] -= off[k]
        size = np.linalg.norm(v)
        reflections.append(v / size if size > 0 else np.zeros(len(v)))
        v, rest = reflections[-1], a[k + 1 :, k + 1 :]
        p = rest @ v
        q = p - (v @ p) * v
        rest -= 2 * (np.outer(v, q) + np.outer(q, v))
    if n > 1:
        off[n - 2] = a[n - 1, n - 2]
    return np.diag(a).copy(), off, reflections


def count_below(diagonal: np.ndarray, squares: np.ndarray, x: np.ndarray, least: float) -> np.ndarray:
    """Eigenvalues below each of ``x``; ``least`` stands for a pivot of zero."""
    pivot = diagonal[0] - x
    below = (pivot < 0).astype(int)
    for d, s in zip(diagonal[1:], squares):
        pivot = np.where(np.abs(pivot) < least, -least, pivot)
        pivot = d - x - s / pivot
        below += pivot < 0
    return below


def bisect(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling."""
    n = len(diagonal)
    radius = np.abs(np.concatenate([off, [0]])) + np.abs(np.concatenate([[0], off]))
    bottom, top = (diagonal - radius).min(), (diagonal + radius).max()
    scale = max(abs(bottom), abs(top))
    if scale == 0:
        return np.zeros(k)
    least = np.finfo(float).tiny * max(1.0, (off**2).max(initial=0))
    low, high = np.full(k, bottom - 2 * EPS * scale), np.full(k, top + 2 * EPS * scale)
    wanted = n - 1 - np.arange(k)  # so many eigenvalues are smaller
    for _ in range(200):
        middle = (low + high) / 2
        below = count_below(diagonal, off**2, middle, least) > wanted
        low, high = np.where(below, low, middle), np.where(below, middle, high)
        if (high - low <= 2 * EPS * np.maximum(np.maximum(abs(low), abs(high)), EPS * scale)).all():
            break
    return (low + high) / 2


class Shifted:
    """T - x I in triangular factors with row exchanges."""

    def __init__(self, diagonal: np.ndarray, off: np.ndarray, x: float, least: float):
        n = len(diagonal)
        main, upper, second = (diagonal - x).tolist(), [*off.tolist(), 0.0], [0.0] * n
        lower = off.tolist()
        self.swap, self.factor = [False] * (n - 1), [0.0] * (n - 1)
        for i in range(n - 1):
            if abs(lower[i]) > abs(main[i]):
                self.swap[i] = True
                f = main[i] / lower[i]
                main[i], upper[i], main[i + 1], second[i], upper[i + 1] = (
                    lower[i], main[i + 1], upper[i] - f * main[i + 1], upper[i + 1], -f * upper[i + 1])
            else:
                f = lower[i] / main[i] if main[i] else 0.0
                main[i + 1] -= f * upper[i]
            self.factor[i] = f
        self.main = [m if abs(m) > least else least for m in main]
        self.upper, self.second = upper, second

    def solve(self, b: np.ndarray) -> np.ndarray:
        x = b.tolist()
        n = len(x)
        for i in range(n - 1):
            if self.swap[i]:
                x[i], x[i + 1] = x[i + 1], x[i] - self.factor[i] * x[i + 1]
            else:
                x[i + 1] -= self.factor[i] * x[i]
        for i in range(n - 1, -1, -1):
            t = x[i]
            if i + 1 < n:
                t -= self.upper[i] * x[i + 1]
            if i + 2 < n:
                t -= self.second[i] * x[i + 2]
            x[i] = t / self.main[i]
        return np.array(x)


def inverse_iteration(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray, steps: int = 5) -> np.ndarray:
    """Unit vectors, as columns, of the tridiagonal matrix for its falling ``values``."""
    n = len(diagonal)
    norm = max(np.abs(diagonal).max(initial=0), np.abs(off).max(initial=0)) or 1.0
    out, first = np.zeros((n, len(values))), 0
    for j, value in enumerate(values):
        if j and values[j - 1] - value > CLOSE * norm:
            first = j
        near, solver = out[:, first:j], Shifted(diagonal, off, value, EPS * norm)
        x = np.random.default_rng(j).standard_normal(n)
        for _ in range(steps):
            for _ in range(2):
                x = x - near @ (near.T @ x)
            x = solver.solve(x / np.linalg.norm(x))
        for _ in range(2):
            x = x / np.linalg.norm(x)
            x = x - near @ (near.T @ x)
        out[:, j] = x / np.linalg.norm(x)
    return out


def leading(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of symmetric ``a``, falling, and their unit vectors as columns."""
    diagonal, off, reflections = tridiagonal(a)
    k = min(k, len(diagonal))
    values = bisect(diagonal, off, k)
    vectors = inverse_iteration(diagonal, off, values)
    for i in range(len(reflections) - 1, -1, -1):
        v = reflections[i]
        vectors[i + 1 :] -= 2 * np.outer(v, v @ vectors[i + 1 :])
    return values, vectors
