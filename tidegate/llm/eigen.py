"""Leading eigenpairs of a symmetric matrix: tridiagonal form, Sturm counts, inverse iteration.

The matrix is as wide as a vector, never as long as a table. Everything is double precision and
deterministic.
"""

from __future__ import annotations

import numpy as np

_EPS = np.finfo(float).eps


def tridiagonalise(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and the Householder vectors that led there.

    Reflection ``i`` acts on the components after ``i``; an entry is None where none was needed.
    """
    a = np.array(matrix, float)
    size = len(a)
    mirrors: list[np.ndarray | None] = []
    for i in range(size - 2):
        x = a[i + 1 :, i].copy()
        if not np.abs(x[1:]).max() > 0:
            mirrors.append(None)
            continue
        # What the reflection leaves in the first place has the opposite sign: no cancellation.
        left = -np.copysign(np.sqrt(x @ x), x[0])
        v = x
        v[0] -= left
        v /= np.sqrt(v @ v)
        rest = a[i + 1 :, i + 1 :]
        # (1 - 2vv')A(1 - 2vv') = A - vw' - wv'
        p = rest @ v
        w = 2 * p - 2 * (v @ p) * v
        rest -= np.outer(v, w) + np.outer(w, v)
        a[i + 1 :, i] = 0
        a[i + 1, i] = left
        a[i, i + 1 :] = a[i + 1 :, i]
        mirrors.append(v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), mirrors


def count_below(diagonal: np.ndarray, off: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie below each shift: negative pivots of T - shift."""
    scale = max(np.abs(diagonal).max(), np.abs(off).max(initial=0), np.finfo(float).tiny / _EPS)
    least = _EPS * _EPS * scale
    below = np.zeros(len(shifts), int)
    pivot = np.ones(len(shifts))
    for d, e in zip(diagonal, np.append(0.0, off)):
        pivot = d - shifts - e * e / pivot
        # A pivot of 0 counts as negative, and is one for the next step too.
        pivot = np.where(np.abs(pivot) < least, -least, pivot)
        below += pivot < 0
    return below


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues of a tridiagonal matrix, falling, by bisection of all at once."""
    size = len(diagonal)
    reach = np.zeros(size)
    reach[:-1] += np.abs(off)
    reach[1:] += np.abs(off)
    low = np.full(k, (diagonal - reach).min())
    high = np.full(k, (diagonal + reach).max())
    width = max(np.abs(low).max(), np.abs(high).max(), np.finfo(float).tiny)
    low -= 2 * _EPS * width
    high += 2 * _EPS * width
    wanted = size - np.arange(k)  # eigenvalue j of the falling order has this many up to itself
    for _ in range(128):
        middle = (low + high) / 2
        if ((middle <= low) | (middle >= high)).all():
            break
        under = count_below(diagonal, off, middle) >= wanted
        high = np.where(under, middle, high)
        low = np.where(under, low, middle)
    return (low + high) / 2


def _factor(diagonal: np.ndarray, off: np.ndarray, shift: float) -> list[tuple]:
    """Rows of the triangular factor of T - shift, with partial pivoting."""
    size = len(diagonal)
    floor = _EPS * max(np.abs(diagonal).max(), np.abs(off).max(initial=0), np.finfo(float).tiny)
    steps = []
    row = (diagonal[0] - shift, off[0] if size > 1 else 0.0, 0.0)
    for i in range(size - 1):
        below = (off[i], diagonal[i + 1] - shift, off[i + 1] if i + 2 < size else 0.0)
        if abs(below[0]) > abs(row[0]):
            factor = row[0] / below[0]
            steps.append((True, factor, below))
            row = (row[1] - factor * below[1], row[2] - factor * below[2], 0.0)
        else:
            pivot = row[0] if abs(row[0]) > floor else floor
            factor = below[0] / pivot
            steps.append((False, factor, (pivot, row[1], row[2])))
            row = (below[1] - factor * row[1], below[2] - factor * row[2], 0.0)
    steps.append((False, 0.0, (row[0] if abs(row[0]) > floor else floor, 0.0, 0.0)))
    return steps


def _solve(steps: list[tuple], right: np.ndarray) -> np.ndarray:
    x = right.copy()
    size = len(x)
    for i, (swapped, factor, _) in enumerate(steps[:-1]):
        if swapped:
            x[i], x[i + 1] = x[i + 1], x[i]
        x[i + 1] -= factor * x[i]
    for i in range(size - 1, -1, -1):
        pivot, one, two = steps[i][2]
        rest = x[i]
        if i + 1 < size:
            rest -= one * x[i + 1]
        if i + 2 < size:
            rest -= two * x[i + 2]
        x[i] = rest / pivot
        if abs(x[i]) > 1e200:
            x /= abs(x[i])
    return x


def inverse_iteration(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (columns) of a tridiagonal matrix for falling eigenvalues.

    Values closer than a thousandth of the matrix's norm form a cluster: their shifts are set
    apart by a rounding error and each vector is made orthogonal to the cluster's earlier ones in
    every step.
    """
    size = len(diagonal)
    norm = max((np.abs(diagonal) + np.append(np.abs(off), 0) + np.append(0, np.abs(off))).max(), np.finfo(float).tiny)
    start = np.random.default_rng(0)
    vectors = np.zeros((size, len(values)))
    first, before = 0, None
    for j, value in enumerate(values):
        if j and values[j - 1] - value > 1e-3 * norm:
            first = j
        shift = value
        if j > first:
            shift = min(value, before - 4 * _EPS * norm)
        before = shift
        steps = _factor(diagonal, off, shift)
        x = start.standard_normal(size)
        cluster = vectors[:, first:j]
        for _ in range(5):
            x = _solve(steps, x / np.abs(x).max())
            for _ in range(2):  # once more against what rounding left
                x -= cluster @ (cluster.T @ x)
            x /= np.sqrt(x @ x)
        vectors[:, j] = x
    return vectors


def leading_eigenpairs(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and their unit eigenvectors as columns."""
    k = min(k, len(matrix))
    scale = np.abs(matrix).max(initial=0)
    if k == 0 or scale == 0:
        return np.zeros(k), np.eye(len(matrix))[:, :k]
    diagonal, off, mirrors = tridiagonalise(matrix / scale)
    values = leading_eigenvalues(diagonal, off, k)
    vectors = inverse_iteration(diagonal, off, values)
    for i in range(len(mirrors) - 1, -1, -1):
        if mirrors[i] is not None:
            v = mirrors[i]
            vectors[i + 1 :] -= 2 * np.outer(v, v @ vectors[i + 1 :])
    return values * scale, vectors
