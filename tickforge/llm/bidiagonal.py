"""Singular values and right singular vectors of a small triangular factor.

Householder reflections make the factor bidiagonal, the differential quotient-difference transform
with shifts (dqds) finds the squared singular values to high relative accuracy, and twisted
factorisations of ``B'B - value`` give their vectors without iterating on other values. The order
of the matrix is the length of the vectors, whatever the number of rows behind it.
"""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(float).eps)
TINY = float(np.finfo(float).tiny) / EPS


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, upper diagonal, right) with ``r = left @ B @ right.T``, ``right`` orthogonal."""
    a = r.astype(np.float64, copy=True)
    n = a.shape[1]
    right = np.eye(n)

    def reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
        """A unit vector whose reflection maps ``x`` to (value, 0, ...)."""
        norm = float(np.linalg.norm(x))
        if not norm:
            return np.zeros_like(x), 0.0
        v = x.copy()
        v[0] += norm if x[0] >= 0 else -norm
        return v / np.linalg.norm(v), -norm if x[0] >= 0 else norm

    for k in range(n):
        v, _ = reflector(a[k:, k])
        a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        if k < n - 2:
            v, _ = reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ v, v)
            right[:, k + 1 :] -= 2 * np.outer(right[:, k + 1 :] @ v, v)
    return np.diagonal(a)[:n].copy(), np.diagonal(a, 1)[: n - 1].copy(), right


def dqds(q: np.ndarray, e: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One transform of (q, e) by ``shift``: new q, new e and the intermediate d."""
    n = len(q)
    new_q, new_e, d = np.empty(n), np.empty(max(0, n - 1)), np.empty(n)
    x = q[0] - shift
    for i in range(n - 1):
        d[i] = x
        new_q[i] = x + e[i]
        ratio = q[i + 1] / new_q[i] if new_q[i] else np.inf
        new_e[i] = e[i] * ratio if e[i] else 0.0
        x = x * ratio - shift if x else -shift
    d[-1] = new_q[-1] = x
    return new_q, new_e, d


def squared_singular_values(diagonal: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Squares of the singular values of the bidiagonal matrix, falling, by dqds."""
    found: list[float] = []
    work = [(diagonal.astype(float) ** 2, upper.astype(float) ** 2, 0.0)]
    small = (100 * EPS) ** 2
    while work:
        q, e, moved = work.pop()
        guess, ups = 0.0, 0
        while len(q):
            if len(q) == 1:
                found.append(moved + max(q[0], 0.0))
                break
            # Entries that no longer matter part the matrix.
            part = np.flatnonzero(e <= small * (moved + np.minimum(q[:-1], q[1:])))
            if len(part):
                cut = int(part[-1]) + 1
                work.append((q[:cut].copy(), e[: cut - 1].copy(), moved))
                q, e, guess = q[cut:].copy(), e[cut:].copy(), 0.0
                continue
            if q[0] < q[-1] and not ups:  # the small values to the end: they come out there
                q, e = flipped(q, e)
            ups += 1
            if len(q) == 2:
                found += [moved + x for x in pair_values(q, e)]
                break
            new_q, new_e, d = dqds(q, e, guess)
            tries = 0
            while not (np.all(d >= 0) and np.all(np.isfinite(new_q))):
                # The shift passed the smallest value: a smaller one.
                tries += 1
                guess = guess / 4 if tries < 4 else 0.0
                new_q, new_e, d = dqds(q, e, guess)
            moved += guess
            q, e = new_q, new_e
            guess = 0.0 if ups > 30 * len(q) + 300 else next_shift(q, e, d)
    return np.sort(np.array(found))[::-1]


def flipped(q: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(q, e) of the same values, read from the other end (the transposed matrix, reversed)."""
    return q[::-1].copy(), e[::-1].copy()


def pair_values(q: np.ndarray, e: np.ndarray) -> list[float]:
    """Both values of two by two: of trace q0 + q1 + e and product q0 * q1."""
    half = (q[0] + q[1] + e[0]) / 2
    gap = np.sqrt(max(((q[0] - q[1] + e[0]) / 2) ** 2 + e[0] * q[1], 0.0))
    large = half + gap
    return [large, q[0] * (q[1] / large) if large else 0.0]


def next_shift(q: np.ndarray, e: np.ndarray, d: np.ndarray) -> float:
    """A shift below the smallest value, mostly: the smaller value of the last two rows, held
    back by what lies above them, and never over the smallest d (an upper bound of it)."""
    low = pair_values(q[-2:], e[-1:])[1]
    above = e[-2] * (q[-2] / (q[-2] + e[-2])) if len(e) > 1 and e[-2] else 0.0
    return float(max(0.0, min(low, d.min()) - 2 * above if above < 0.25 * low else 0.25 * min(low, d.min())))


def twisted_vector(diagonal: np.ndarray, upper: np.ndarray, value: float) -> tuple[np.ndarray, float]:
    """The eigenvector of ``B'B`` next to ``value``, and the value corrected by it.

    The factorisation from above and the one from below meet at the row where the residual is
    smallest; the vector grows from there by products alone."""
    n = len(diagonal)
    d, low = diagonal**2, upper / diagonal[:-1]
    for _ in range(3):
        s, p, down, up = np.empty(n), np.empty(n), np.empty(n - 1), np.empty(n - 1)
        s[0] = -value
        for i in range(n - 1):
            pivot = d[i] + s[i]
            pivot = pivot if abs(pivot) > TINY else -TINY
            down[i] = d[i] * low[i] / pivot
            s[i + 1] = down[i] * low[i] * s[i] - value
        p[-1] = d[-1] - value
        for i in range(n - 2, -1, -1):
            pivot = d[i] * low[i] ** 2 + p[i + 1]
            pivot = pivot if abs(pivot) > TINY else -TINY
            up[i] = low[i] * d[i] / pivot
            p[i] = p[i + 1] * (d[i] / pivot) - value
        gamma = s + p + value
        at = int(np.nanargmin(np.abs(gamma)))
        z = np.zeros(n)
        z[at] = 1.0
        for i in range(at - 1, -1, -1):
            z[i] = -down[i] * z[i + 1]
        for i in range(at, n - 1):
            z[i + 1] = -up[i] * z[i]
        length = float(z @ z)
        step = gamma[at] / length
        if not np.isfinite(length) or abs(step) <= 4 * EPS * abs(value):
            break
        value += step
    return z / np.sqrt(length), value


def right_directions(r: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest squared singular values of ``r`` and, as columns, their unit right
    singular vectors. Values that are close to each other relative to their size share a space in
    which single vectors are not determined to working accuracy: there the vectors are made
    orthogonal by inverse steps against those already found."""
    scale = float(np.abs(r).max()) if r.size else 0.0
    n = r.shape[1]
    if not scale or not np.isfinite(scale):
        return np.zeros(0), np.zeros((n, 0))
    diagonal, upper, right = bidiagonalise(r / scale)
    size = max(np.abs(diagonal).max(), np.abs(upper).max() if len(upper) else 0.0)
    diagonal = np.where(np.abs(diagonal) < EPS * EPS * size, EPS * EPS * size, diagonal)
    values = squared_singular_values(diagonal, upper)[:count]
    dense = np.zeros((n, n))
    dense[np.arange(n), np.arange(n)], dense[np.arange(n - 1), np.arange(1, n)] = diagonal, upper
    normal = dense.T @ dense
    # Blocks that do not touch have vectors of their own, which are zero elsewhere.
    edges = [0, *(np.flatnonzero(np.abs(upper) <= EPS * size) + 1).tolist(), n]
    own = [(a, b, squared_singular_values(diagonal[a:b], upper[a : b - 1])) for a, b in zip(edges, edges[1:])]
    ranked = sorted(((v, a, b) for a, b, vs in own for v in vs), key=lambda x: -x[0])[: len(values)]
    out = np.zeros((n, len(ranked)))
    for k, (value, a, b) in enumerate(ranked):
        z, _ = twisted_vector(diagonal[a:b], upper[a : b - 1], value) if b - a > 1 else (np.ones(1), value)
        x = np.zeros(n)
        x[a:b] = z
        near = [j for j in range(k) if ranked[j][0] - value <= 1e-3 * ranked[j][0] and ranked[j][1:] == (a, b)]
        if near and np.abs(x @ out[:, near]).max() > 8 * EPS:
            x = _apart(normal, value, x, out[:, near])
        out[:, k] = x
    return np.array([v for v, _, _ in ranked]) * scale**2, right @ out


def _apart(normal: np.ndarray, value: float, x: np.ndarray, others: np.ndarray) -> np.ndarray:
    """``x`` made orthogonal to ``others``, by steps of inverse iteration at ``value``."""
    moved = normal - value * (1 + 4 * EPS) * np.eye(len(x))
    rng = np.random.default_rng(len(x))
    for _ in range(4):
        x = x - others @ (others.T @ x)
        if np.linalg.norm(x) < 1e-6:
            x = rng.standard_normal(len(x))
            x -= others @ (others.T @ x)
        x = x / np.linalg.norm(x)
        try:
            y = np.linalg.solve(moved, x)
        except np.linalg.LinAlgError:
            y = x
        x = y / np.linalg.norm(y) if np.all(np.isfinite(y)) and np.linalg.norm(y) else x
    for _ in range(2):
        x = x - others @ (others.T @ x)
        x = x / np.linalg.norm(x)
    return x
