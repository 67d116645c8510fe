"""The largest eigenvalues of a symmetric matrix by contour integration.

The spectrum is cut into intervals by inertia counts (the signs of the pivots of
a shifted matrix).  On each interval the resolvent is integrated around a circle
by quadrature, which projects a few random vectors onto the eigenvectors inside;
Rayleigh-Ritz extracts them.  An interval is done when as many eigenvalues have
converged as the inertia counts demand.

The matrix is as wide as a vector is long; it does not grow with the rows.
"""

from __future__ import annotations

import numpy as np

POINTS = 8          # quadrature points on the upper half of a circle
IN_INTERVAL = 8     # eigenvalues in an interval, unless they cannot be told apart
ROUNDS = 40
SPREAD = 8          # an interval's end is at most so many times its start
TIGHTEN = 10        # steps by which an interval's ends move inwards
PIVOT = (1 + 17 ** 0.5) / 8


def below(a: np.ndarray, shift: float) -> int:
    """How many eigenvalues of ``a`` are smaller than ``shift``: the negative pivots of ``a - shift``."""
    a = np.array(a, dtype=np.float64)
    a[np.diag_indices(len(a))] -= shift
    count = 0
    while len(a):
        size = np.abs(a)
        diagonal = size.diagonal()
        k = int(diagonal.argmax())
        i, j = np.unravel_index(int(size.argmax()), a.shape)
        if size[i, j] == 0:
            break
        if diagonal[k] >= PIVOT * size[i, j]:
            count += a[k, k] < 0
            rest = np.delete(np.arange(len(a)), k)
            column = a[rest, k]
            a = a[np.ix_(rest, rest)] - np.outer(column, column / a[k, k])
        else:
            # A block of two has one eigenvalue of either sign.
            count += 1
            rest = np.delete(np.arange(len(a)), [i, j])
            both = a[np.ix_(rest, [i, j])]
            a = a[np.ix_(rest, rest)] - both @ np.linalg.solve(a[np.ix_([i, j], [i, j])], both.T)
        a = (a + a.T) / 2
    return int(count)


def _edge(a: np.ndarray, end: float, other: float, n: int) -> float:
    """``end`` moved towards ``other`` as long as ``n`` eigenvalues are below it."""
    for _ in range(TIGHTEN):
        middle = (end + other) / 2
        if below(a, middle) == n:
            end = middle
        else:
            other = middle
    return end


def intervals(a: np.ndarray, low: float, high: float, n_low: int, n_high: int, least: float):
    """``(low, high, count)`` with few eigenvalues of one order of size each.

    ``n_low``, ``n_high``: eigenvalues below the ends, which are positive.  A circle
    much wider than the small eigenvalues in it would not tell them from those outside.
    """
    if n_high == n_low:
        return
    if (n_high - n_low <= IN_INTERVAL and high <= SPREAD * low) or high - low <= least:
        # Closer to the eigenvalues inside, so that those outside are far from the circle.
        inner, outer = _edge(a, low, high, n_low), _edge(a, high, low, n_high)
        yield inner, outer, n_high - n_low
        return
    middle = (low * high) ** 0.5 if high > 4 * low else (low + high) / 2
    n = below(a, middle)
    yield from intervals(a, low, middle, n_low, n, least)
    yield from intervals(a, middle, high, n, n_high, least)


def projected(a: np.ndarray, block: np.ndarray, center: float, radius: float) -> np.ndarray:
    """``block`` projected onto the eigenvectors whose eigenvalues lie in the circle."""
    nodes, weights = np.polynomial.legendre.leggauss(POINTS)
    out = np.zeros_like(block)
    eye = np.eye(len(a))
    for node, weight in zip(nodes, weights, strict=True):
        turn = np.exp(0.5j * np.pi * (1 - node))
        solved = np.linalg.solve((center + radius * turn) * eye - a, block.astype(complex))
        out += 0.5 * radius * weight * (turn * solved).real
    return out


def ritz(a: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and vectors of ``a`` within the span of ``basis``."""
    u, s, _ = np.linalg.svd(basis, full_matrices=False)
    u = u[:, s > s.max(initial=0) * 1e-13]
    small = u.T @ a @ u
    e, w = np.linalg.eigh((small + small.T) / 2)
    return e, u @ w


def in_interval(a: np.ndarray, low: float, high: float, count: int, seed: int) -> np.ndarray:
    """``count`` orthonormal eigenvectors whose eigenvalues lie between ``low`` and ``high``."""
    rng = np.random.default_rng(seed)
    norm = np.abs(a).sum(axis=1).max()
    width = min(len(a), count + count // 2 + 4)
    block = rng.standard_normal((len(a), width))
    center = (low + high) / 2
    radius = max((high - low) / 2 * 1.02, 1e-12 * norm)
    best, last = None, np.inf
    for _ in range(ROUNDS):
        e, x = ritz(a, projected(a, block, center, radius))
        inside = np.abs(e - center) <= radius
        off = np.linalg.norm(a @ x - x * e, axis=0)
        # The Ritz values nearest the interval, as many as inertia says are in it.
        order = np.argsort(np.maximum(np.abs(e - center) - (high - low) / 2, 0), kind="stable")[:count]
        if inside.sum() >= count:
            worst = off[order].max()
            if worst < last:
                best, last = x[:, order], worst
            if worst <= 8 * np.finfo(float).eps * norm or (worst >= last and last <= 1e-12 * norm):
                return best
        elif width < len(a):
            width = min(len(a), 2 * width)
        block = np.column_stack([x, rng.standard_normal((len(a), max(0, width - x.shape[1])))])
    if best is None or last > 1e-10 * norm:
        raise ArithmeticError("eigenvalues that the inertia counts promise were not found")
    return best


def largest(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a covariance, falling, and their unit vectors as columns.

    Eigenvalues that are zero within rounding are left out, so there may be fewer.
    """
    d = len(a)
    norm = np.abs(a).sum(axis=1).max() if d else 0.0
    if not norm > 0:
        return np.zeros(0), np.zeros((d, 0))
    floor, top = d * np.finfo(float).eps * norm, norm * (1 + 1e-9)
    n_top = below(a, top)
    k = min(k, n_top - below(a, floor))
    if not k:
        return np.zeros(0), np.zeros((d, 0))
    # Where the k largest begin; eigenvalues that cannot be told apart come together.
    low, high, n_low = floor, top, below(a, floor)
    while high - low > 1e-13 * norm and n_top - n_low > k:
        middle = (low + high) / 2
        n = below(a, middle)
        if n_top - n >= k:
            low, n_low = middle, n
        else:
            high = middle
    found = [
        in_interval(a, lo, hi, n, seed)
        for seed, (lo, hi, n) in enumerate(intervals(a, low, top, n_low, n_top, 1e-11 * norm))
    ]
    e, x = ritz(a, np.column_stack(found))
    if len(e) != n_top - n_low:
        raise ArithmeticError("intervals share an eigenvector")
    order = np.argsort(-e, kind="stable")[:k]
    return e[order], x[:, order]
