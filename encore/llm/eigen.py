"""Leading eigenpairs of a symmetric matrix.

Householder reflections make the matrix tridiagonal, Sturm counts bisect for
the largest eigenvalues, and inverse iteration on the tridiagonal matrix
gives their vectors; vectors of eigenvalues close to each other are made
orthogonal again in each step. The matrix has the size of the vectors'
dimension squared, whatever the number of rows it was made from.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(np.float64).eps


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, float]]]:
    """``diagonal, off-diagonal, reflections``: Q^T a Q, with Q the product of
    the reflections 1 - b v v^T (v without its leading zeros), in order."""
    a = a.astype(np.float64, copy=True)
    n = len(a)
    reflections: list[tuple[np.ndarray, float]] = []
    for k in range(n - 2):
        v = a[k + 1 :, k].copy()
        norm = float(np.linalg.norm(v))
        if norm == 0.0 or not np.any(v[1:]):
            reflections.append((v, 0.0))
            continue
        v[0] += norm if v[0] >= 0 else -norm
        b = 2.0 / float(v @ v)
        rest = a[k + 1 :, k + 1 :]
        p = b * (rest @ v)
        p -= (b / 2.0 * float(p @ v)) * v
        rest -= np.outer(v, p) + np.outer(p, v)
        column = a[k + 1 :, k] - b * float(v @ a[k + 1 :, k]) * v
        a[k + 1 :, k] = column
        reflections.append((v, b))
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflections


def restored(y: np.ndarray, reflections: list[tuple[np.ndarray, float]]) -> np.ndarray:
    """Q y: a vector of the tridiagonal matrix as one of the first matrix."""
    y = y.copy()
    for k in range(len(reflections) - 1, -1, -1):
        v, b = reflections[k]
        y[k + 1 :] -= b * float(v @ y[k + 1 :]) * v
    return y


def counts_below(d: np.ndarray, e: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Sturm counts: how many eigenvalues lie below each of ``x``."""
    tiny = EPS * max(1e-300, float(np.max(np.abs(e), initial=0.0))) + 1e-300
    q = d[0] - x
    below = (q < 0).astype(np.int64)
    for i in range(1, len(d)):
        q = np.where(np.abs(q) < tiny, -tiny, q)
        q = d[i] - x - e[i - 1] ** 2 / q
        below += q < 0
    return below


def largest(d: np.ndarray, e: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, each bisected until its bracket
    holds no number between its ends."""
    n = len(d)
    radius = np.concatenate([[0.0], np.abs(e)]) + np.concatenate([np.abs(e), [0.0]])
    bound = float(np.max(np.abs(d) + radius)) * (1 + 4 * n * EPS) + 1e-300
    low, high = np.full(k, -bound), np.full(k, bound)
    rank = n - 1 - np.arange(k)  # eigenvalues below the one sought
    while True:
        middle = low + (high - low) / 2
        open_ = (middle > low) & (middle < high) & (high - low > EPS * EPS * bound)
        if not open_.any():
            return middle
        above = counts_below(d, e, middle) <= rank
        low, high = np.where(open_ & above, middle, low), np.where(open_ & ~above, middle, high)


def _solve(d: np.ndarray, e: np.ndarray, shift: float, b: np.ndarray) -> np.ndarray:
    """(T - shift) x = b by elimination with partial pivoting; pivots of zero become tiny."""
    n = len(d)
    tiny = EPS * max(float(np.max(np.abs(d))), float(np.max(np.abs(e), initial=0.0)), 1e-300)
    diag, upper, over = (d - shift).tolist(), [*e.tolist(), 0.0], [0.0] * n
    x = b.tolist()
    lower = e.tolist()
    for i in range(n - 1):
        if abs(diag[i]) >= abs(lower[i]):
            pivot = diag[i] if diag[i] else tiny
            diag[i] = pivot
            f = lower[i] / pivot
            diag[i + 1] -= f * upper[i]
            x[i + 1] -= f * x[i]
        else:
            f = diag[i] / lower[i]
            diag[i], below, kept = lower[i], diag[i + 1], upper[i]
            upper[i], diag[i + 1] = below, kept - f * below
            over[i] = upper[i + 1]
            upper[i + 1] = -f * over[i]
            x[i], x[i + 1] = x[i + 1], x[i] - f * x[i + 1]
    for i in range(n - 1, -1, -1):
        s = x[i]
        if i + 1 < n:
            s -= upper[i] * x[i + 1]
        if i + 2 < n:
            s -= over[i] * x[i + 2]
        pivot = diag[i] if abs(diag[i]) > tiny else (tiny if diag[i] >= 0 else -tiny)
        x[i] = s / pivot
    out = np.array(x)
    return out / np.max(np.abs(out))


def vectors(d: np.ndarray, e: np.ndarray, values: np.ndarray, steps: int = 6, close: float = 1e-3) -> np.ndarray:
    """Unit eigenvectors (rows) of the falling ``values`` by inverse iteration.

    A vector is kept orthogonal to those of earlier values within ``close``
    times the norm of the matrix, in every step.
    """
    norm = max(float(np.max(np.abs(d))) + 2 * float(np.max(np.abs(e), initial=0.0)), 1e-300)
    rng = np.random.default_rng(0)
    out = np.zeros((len(values), len(d)))
    for i, value in enumerate(values):
        near = [j for j in range(i) if values[j] - value <= close * norm]
        y = rng.standard_normal(len(d))
        for _ in range(steps):
            for _ in range(2):
                y -= out[near].T @ (out[near] @ y)
            y = _solve(d, e, float(value), y / np.linalg.norm(y))
        for _ in range(2):
            y -= out[near].T @ (out[near] @ y)
            y /= np.linalg.norm(y)
        out[i] = y
    return out


def leading(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """``values, vectors``: the ``k`` largest eigenvalues of the symmetric
    matrix ``a``, falling, and unit eigenvectors as rows."""
    k = min(k, len(a))
    scale = float(np.max(np.abs(a), initial=0.0))
    if k == 0 or scale == 0.0:
        return np.zeros(k), np.eye(len(a))[:k]
    d, e, reflections = tridiagonal(a / scale)
    values = largest(d, e, k)
    found = np.array([restored(y, reflections) for y in vectors(d, e, values)])
    return values * scale, found
