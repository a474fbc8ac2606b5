"""Leading eigenpairs of a symmetric matrix: tridiagonal form, bisection, inverse iteration."""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
#: Eigenvalues nearer than this share of the norm form a cluster, whose vectors are made orthogonal to each other.
CLUSTER = 1e-3
ITERATIONS = 5


def tridiagonalise(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, subdiagonal and the Householder vectors whose reflections lead there.

    Reflection k leaves rows 0 to k alone; its unit vector has the other entries.
    """
    a = np.array(matrix, float)
    n = len(a)
    reflections = []
    for k in range(n - 2):
        v = a[k + 1 :, k].copy()
        size = np.abs(v).max()
        if size == 0.0:
            reflections.append(v)
            continue
        length = size * np.linalg.norm(v / size)
        target = -length if v[0] >= 0 else length
        v[0] -= target
        v /= np.abs(v).max()
        v /= np.linalg.norm(v)
        rest = a[k + 1 :, k + 1 :]
        p = rest @ v
        w = p - (v @ p) * v
        rest -= 2.0 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1 :, k] = 0.0
        a[k + 1, k] = target
        reflections.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflections


def reflected(reflections: list[np.ndarray], vectors: np.ndarray) -> np.ndarray:
    """Columns of the tridiagonal form taken back to the matrix."""
    out = vectors.copy()
    for k in range(len(reflections) - 1, -1, -1):
        v = reflections[k]
        out[k + 1 :] -= 2.0 * np.outer(v, v @ out[k + 1 :])
    return out


def below(diagonal: np.ndarray, squares: np.ndarray, points: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie below each point: negative terms of the Sturm sequence."""
    least = np.finfo(float).tiny / EPS * max(1.0, squares.max(initial=0.0))
    count = np.zeros(len(points), int)
    q = np.ones(len(points))
    for i, d in enumerate(diagonal):
        q = d - points - (squares[i - 1] / q if i else 0.0)
        q = np.where(np.abs(q) < least, -least, q)
        count += q < 0
    return count


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, each bisected until its bounds are neighbours."""
    n = len(diagonal)
    reach = np.zeros(n)
    reach[:-1] += np.abs(off)
    reach[1:] += np.abs(off)
    low, high = np.full(k, (diagonal - reach).min()), np.full(k, (diagonal + reach).max())
    norm = max(np.abs(low).max(), np.abs(high).max())
    low, high = low - 2 * EPS * norm, high + 2 * EPS * norm
    rank = n - np.arange(k)  # the j-th largest has n - j - 1 eigenvalues below it
    squares = off * off
    while True:
        middle = low + (high - low) / 2
        if not ((middle > low) & (middle < high)).any():
            return middle
        up = below(diagonal, squares, middle) < rank
        low, high = np.where(up, middle, low), np.where(up, high, middle)


def solve(diagonal: np.ndarray, off: np.ndarray, shift: float, right: np.ndarray) -> np.ndarray:
    """(T - shift) x = right by elimination with row exchanges; a vanishing pivot becomes a tiny one."""
    n = len(diagonal)
    tiny = EPS * max(np.abs(diagonal).max(), np.abs(off).max(initial=0.0), np.finfo(float).tiny)
    main, first, second = (np.zeros(n) for _ in range(3))
    x = right.copy()
    a, b = diagonal[0] - shift, off[0] if n > 1 else 0.0
    for i in range(n - 1):
        under, d, e = off[i], diagonal[i + 1] - shift, off[i + 1] if i + 2 < n else 0.0
        if abs(under) > abs(a):
            main[i], first[i], second[i] = under, d, e
            x[i], x[i + 1] = x[i + 1], x[i]
            factor = a / under
            a, b = b - factor * d, -factor * e
        else:
            main[i], first[i] = a if a else tiny, b
            factor = under / main[i]
            a, b = d - factor * b, e
        x[i + 1] -= factor * x[i]
    main[n - 1] = a if a else tiny
    for i in range(n - 1, -1, -1):
        if i + 1 < n:
            x[i] -= first[i] * x[i + 1]
        if i + 2 < n:
            x[i] -= second[i] * x[i + 2]
        x[i] /= main[i] if abs(main[i]) > tiny else np.copysign(tiny, main[i])
        if abs(x[i]) > 1e150:  # only the direction counts
            x *= 1e-150
    return x


def inverse_iteration(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A unit vector of the tridiagonal form for each falling eigenvalue; clusters are kept orthogonal."""
    n = len(diagonal)
    norm = max(np.abs(diagonal).max() + 2 * np.abs(off).max(initial=0.0), np.finfo(float).tiny)
    starts = np.random.default_rng(0)
    vectors = np.zeros((n, len(values)))
    first, shift = 0, np.inf
    for j, value in enumerate(values):
        if j and values[j - 1] - value > CLUSTER * norm:
            first = j
        shift = min(value, shift - 10 * EPS * norm) if j > first else value
        mates = vectors[:, first:j]
        x = starts.standard_normal(n)
        for _ in range(ITERATIONS):
            x = solve(diagonal, off, shift, x / np.abs(x).max())
            x /= np.abs(x).max()
            for _ in range(2):
                x -= mates @ (mates.T @ x)
            x /= np.linalg.norm(x)
        vectors[:, j] = x
    return vectors


def leading_pairs(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and unit eigenvectors as columns; the largest entry of each is positive."""
    n = len(matrix)
    k = min(k, n)
    size = np.abs(matrix).max(initial=0.0)
    if not k or size == 0.0:
        return np.zeros(k), np.eye(n, k)
    diagonal, off, reflections = tridiagonalise(matrix / size)
    values = leading_values(diagonal, off, k)
    vectors = reflected(reflections, inverse_iteration(diagonal, off, values))
    vectors /= np.linalg.norm(vectors, axis=0)
    return values * size, vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(k)])
