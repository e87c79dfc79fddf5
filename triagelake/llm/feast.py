"""Eigenpairs of a symmetric matrix inside intervals by contour integration, with inertia counts as proof.

The matrix is model-sized (columns x columns): the rows it was made of stay in Spark.
"""

from __future__ import annotations

import numpy as np

#: Nodes of the Gauss-Legendre rule on the upper half of a contour.
NODES = 12
#: An interval with more eigenvalues than this is split first.
PER_INTERVAL = 8
#: Bunch-Parlett: a diagonal pivot is taken if it reaches this part of the largest entry beside the diagonal.
PIVOT = (1 + 17**0.5) / 8


def above(matrix: np.ndarray, at: float) -> int:
    """How many eigenvalues exceed ``at``: positive pivots of the LDL^T form of the shifted matrix (Sylvester).

    Bunch-Parlett pivoting; a two by two pivot has one eigenvalue of each sign.
    """
    a = np.array(matrix, float) - at * np.eye(len(matrix))
    positive = 0
    while len(a):
        n, diagonal = len(a), np.abs(np.diagonal(a))
        r = int(diagonal.argmax())
        beside = np.abs(a)
        np.fill_diagonal(beside, 0.0)
        p, q = divmod(int(beside.argmax()), n)
        if diagonal[r] >= PIVOT * beside[p, q]:
            if not a[r, r]:
                break  # all that is left is zero
            positive += int(a[r, r] > 0)
            own = [r]
        else:
            positive += 1
            own = [p, q]
        rest = np.setdiff1d(np.arange(n), own)
        side = a[np.ix_(rest, own)]
        a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(a[np.ix_(own, own)], side.T)
        a = (a + a.T) / 2
    return positive


def _cut(matrix: np.ndarray, at: float, width: float) -> tuple[float, int]:
    """A point near ``at`` that no eigenvalue touches, and the number of eigenvalues above it.

    If eigenvalues lie so densely that every try touches one, the last try is taken; the intervals on both
    sides are checked by their counts anyway.
    """
    for step in (0.0, 0.11, -0.13, 0.23, -0.29, 0.37, -0.41):
        point = at + step * width
        high, low = above(matrix, point * (1 + 1e-9) + 1e-300), above(matrix, point * (1 - 1e-9) - 1e-300)
        if high == low:
            return point, high
    return point, above(matrix, point)


def intervals(matrix: np.ndarray, low: float, high: float, wanted: int) -> list[tuple[float, float, int]]:
    """Intervals (low, high, eigenvalues inside), highest first, that hold the ``wanted`` largest above ``low``.

    A crowded interval is halved until it holds PER_INTERVAL or is too narrow to halve (a multiple eigenvalue).
    """
    done: list[tuple[float, float, int]] = []
    open_ = [(low, high, above(matrix, low))]
    found = 0
    while open_ and found < wanted:
        a, b, n = open_.pop()
        if n <= PER_INTERVAL or b - a <= 1e-7 * high:
            if n:
                done.append((a, b, n))
                found += n
            continue
        middle, over = _cut(matrix, (a + b) / 2, (b - a) / 4)
        over -= found
        open_ += [(a, middle, n - over), (middle, b, over)]
    return done


def inside(matrix: np.ndarray, low: float, high: float, count: int, *, seed: int = 11, rounds: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues in (low, high] and unit eigenvectors as columns.

    The contour is the circle over the interval. Each quadrature node solves one complex shifted system for all
    columns; the weighted sum projects them onto the wanted eigenspace. Rayleigh-Ritz and the projection
    alternate until the residuals reach rounding. A subspace with fewer Ritz values inside than the inertia
    counts say is widened.
    """
    n, scale = len(matrix), np.abs(matrix).sum(axis=1).max()
    centre, radius = (low + high) / 2, (high - low) / 2
    node, weight = np.polynomial.legendre.leggauss(NODES)
    turn = np.exp(1j * np.pi / 2 * (node + 1))
    width = min(n, count + max(4, count // 2))
    while True:
        y = np.random.default_rng(seed).standard_normal((n, width))
        last = np.inf
        for _ in range(rounds):
            q = np.zeros_like(y)
            for z, w in zip(turn, weight, strict=True):
                q += (w / 2) * (radius * z * np.linalg.solve((centre + radius * z) * np.eye(n) - matrix, y.astype(complex))).real
            basis = np.linalg.svd(q, full_matrices=False)
            keep = basis[1] > 1e-13 * basis[1][0]
            basis = basis[0][:, keep]
            values, vectors = np.linalg.eigh(basis.T @ matrix @ basis)
            y = basis @ vectors
            own = (values > low) & (values <= high)
            error = np.linalg.norm(matrix @ y[:, own] - y[:, own] * values[own], axis=0).max(initial=0.0)
            if own.sum() == count and (error <= 1e-15 * scale or error >= last / 2 and error <= 1e-11 * scale):
                return values[own], y[:, own]
            last = error
        if width == n:
            raise ArithmeticError(f"{own.sum()} eigenvalues found between {low} and {high}, but the inertia says {count}")
        width = min(n, 2 * width)


def largest(matrix: np.ndarray, wanted: int, floor: float = 1e-12) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues above ``floor`` times the largest possible one, falling, and their vectors.

    Fewer come back if fewer exist. A final Rayleigh-Ritz step over all intervals makes the vectors orthogonal
    to rounding, and the inertia below the last of them proves that none is missing.
    """
    high = float(np.abs(matrix).sum(axis=1).max(initial=0.0)) * (1 + 1e-9)
    wanted = min(wanted, len(matrix))
    if not high or not wanted:
        return np.zeros(0), np.zeros((len(matrix), 0))
    low = floor * high
    if not (rank := above(matrix, low)):
        return np.zeros(0), np.zeros((len(matrix), 0))
    while above(matrix, 4 * low) == rank:  # zeros must not lie on the contour
        low *= 4
    parts = [inside(matrix, *span) for span in intervals(matrix, low, high, wanted)]
    basis, _ = np.linalg.qr(np.concatenate([v for _, v in parts], axis=1))
    values, vectors = np.linalg.eigh(basis.T @ matrix @ basis)
    order = np.argsort(-values, kind="stable")[:wanted]
    values, vectors = values[order], basis @ vectors[:, order]
    gap = 1e-9 * high
    if above(matrix, values[-1] + gap) >= len(values) or above(matrix, values[-1] - gap) < len(values):
        raise ArithmeticError("the inertia of the matrix does not agree with the eigenvalues found")
    return values, vectors
