"""Singular values and right singular vectors of a small triangular factor by way of a bidiagonal matrix.

Householder reflections from both sides make the factor upper bidiagonal. Its qd array (squared
diagonal q, squared superdiagonal e) yields the squared singular values by dqds sweeps, to high
relative accuracy as nothing is subtracted but the shifts. A vector comes from the twisted factorisation of
BᵀB - λ: the stationary transform from the top and the progressive one from the bottom meet at
the index where the remainder is least. Only d x d values are handled here, however many rows there are.
"""

from __future__ import annotations

import numpy as np

_EPS = np.finfo(np.float64).eps
_TINY = np.finfo(np.float64).tiny
#: Eigenvalues closer than this, in proportion, have their vectors made orthogonal to each other.
_CLUSTER = 1e-3
#: A vector that leaves more than this of the largest value as residual is found anew by inverse iteration.
_ROUGH = 1e-12


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """v with x - 2 v (v·x) = (alpha, 0, ...), and alpha."""
    v = x.copy()
    scale = np.abs(x).max()
    if scale == 0.0 or not x[1:].any():
        return np.zeros_like(x), float(x[0])
    v /= scale
    alpha = -np.copysign(np.linalg.norm(v), v[0])
    v[0] -= alpha
    return v / np.linalg.norm(v), float(alpha * scale)


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and V of r = U B Vᵀ for a square r."""
    work, d = r.astype(np.float64, copy=True), len(r)
    v_all = np.eye(d)
    for k in range(d):
        v, alpha = _reflector(work[k:, k])
        work[k:, k:] -= 2.0 * np.outer(v, v @ work[k:, k:])
        work[k, k] = alpha
        if k < d - 2:
            v, alpha = _reflector(work[k, k + 1 :])
            work[k:, k + 1 :] -= 2.0 * np.outer(work[k:, k + 1 :] @ v, v)
            work[k, k + 1] = alpha
            v_all[:, k + 1 :] -= 2.0 * np.outer(v_all[:, k + 1 :] @ v, v)
    return np.diag(work).copy(), np.diag(work, 1).copy(), v_all


def _sweep(q: np.ndarray, e: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray] | None:
    """One differential qd step with a shift; None if the shift was above the least value."""
    n = len(q)
    new_q, new_e = np.empty(n), np.empty(n - 1)
    d = q[0] - shift
    for i in range(n - 1):
        if d < 0.0:
            return None
        new_q[i] = d + e[i]
        if new_q[i] == 0.0:
            new_e[i], d = 0.0, q[i + 1] - shift
            continue
        ratio = q[i + 1] / new_q[i]
        new_e[i] = e[i] * ratio
        d = d * ratio - shift
    if d < 0.0:
        return None
    new_q[n - 1] = d
    return new_q, new_e


def _shift(q: np.ndarray, e: np.ndarray) -> float:
    """Smaller eigenvalue of the last two rows of the qd array, from below."""
    trace = q[-2] + e[-1] + q[-1]
    product = q[-2] * q[-1]
    root = np.sqrt(max(0.0, trace * trace / 4 - product))
    return float(product / (trace / 2 + root)) if trace > 0 else 0.0


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squared singular values of a bidiagonal matrix, falling."""
    found: list[float] = []
    blocks = [(diagonal.astype(np.float64) ** 2, above.astype(np.float64) ** 2, 0.0)]
    while blocks:
        q, e, moved = blocks.pop()
        first = True
        while len(q):
            if len(q) == 1:
                found.append(moved + q[0])
                break
            small = e <= _EPS * _EPS * (moved + np.minimum(q[:-1] + e, q[1:] + e))
            if small.any():
                at = int(np.flatnonzero(small)[-1]) + 1
                blocks.append((q[:at], e[: at - 1], moved))
                q, e = q[at:], e[at:]
                continue
            # The first step is without a shift: it shows how small the last value may be.
            shift = 0.0 if first else _shift(q, e)
            first = False
            made = _sweep(q, e, shift)
            while made is None:
                shift = shift * 0.5 if shift > _EPS * (moved + q.min()) else 0.0
                made = _sweep(q, e, shift)
            moved += shift
            q, e = made
    return np.sort(np.array(found))[::-1]


def _twisted(q: np.ndarray, e: np.ndarray, value: float) -> tuple[np.ndarray, float]:
    """Vector of BᵀB near an eigenvalue, from the array of one unreduced block, and the correction of the eigenvalue."""
    n = len(q)
    if n == 1:
        return np.ones(1), 0.0
    low = np.sqrt(e / q[:-1])
    plus, minus = np.empty(n - 1), np.empty(n - 1)
    s, p = np.empty(n), np.empty(n)
    guard = _EPS * max(value, q.max()) * _EPS + _TINY
    s[0] = -value
    for i in range(n - 1):
        top = s[i] + q[i]
        top = guard if top == 0.0 else top
        plus[i] = q[i] * low[i] / top
        s[i + 1] = plus[i] * low[i] * s[i] - value
    p[n - 1] = q[n - 1] - value
    for i in range(n - 2, -1, -1):
        bottom = e[i] + p[i + 1]
        bottom = guard if bottom == 0.0 else bottom
        ratio = q[i] / bottom
        minus[i] = low[i] * ratio
        p[i] = p[i + 1] * ratio - value
    gamma = s + p + value
    k = int(np.argmin(np.abs(gamma)))
    z = np.zeros(n)
    z[k] = 1.0
    for i in range(k - 1, -1, -1):
        z[i] = -plus[i] * z[i + 1]
    for i in range(k, n - 1):
        z[i + 1] = -minus[i] * z[i]
    norm = z @ z
    return z / np.sqrt(norm), float(gamma[k] / norm)


def _signed(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Signs that lead from the vectors for absolute values to those of the matrix itself."""
    sign = np.ones(len(diagonal))
    for i in range(len(above)):
        sign[i + 1] = sign[i] * np.sign(diagonal[i] * above[i] or 1.0)
    return sign


def principal(r: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Falling eigenvalues of rᵀr above rounding, as many unit vectors as columns, and the trace."""
    diagonal, above, v_all = bidiagonalise(r)
    trace = float((diagonal**2).sum() + (above**2).sum())
    if trace == 0.0:
        return np.zeros(0), np.zeros((len(r), 0)), 0.0
    floor = trace * (_EPS * len(r)) ** 2
    # Blocks between vanishing entries are solved apart; a zero on the diagonal is left to its block as a tiny value.
    q, e = np.maximum(diagonal**2, floor * _EPS), above**2
    cuts = [0, *(int(i) + 1 for i in np.flatnonzero(e <= _EPS * _EPS * np.minimum(q[:-1] + e, q[1:] + e))), len(q)]
    pairs = []
    for low, high in zip(cuts, cuts[1:], strict=False):
        part_q, part_e = q[low:high], e[low : high - 1]
        values = dqds(np.sqrt(part_q), np.sqrt(part_e))
        pairs += [(value, low, high) for value in values]
    pairs.sort(key=lambda x: -x[0])
    pairs = [x for x in pairs if x[0] > trace * len(r) * _EPS][:most]
    signs = _signed(diagonal, above)
    kept_values: list[float] = []
    columns: list[np.ndarray] = []
    rnd = np.random.default_rng(0)
    for value, low, high in pairs:
        part_q, part_e = q[low:high], e[low : high - 1]
        z, change = _twisted(part_q, part_e, value)
        if abs(change) < 1e-8 * value:
            z, _ = _twisted(part_q, part_e, value + change)
        full = np.zeros(len(q))
        full[low:high] = z
        near = [c for v, c in zip(kept_values, columns, strict=True) if v - value <= _CLUSTER * v]
        full = _apart(full, near)
        if full is None or _residual(q, e, value, full) > _ROUGH * q.max():
            # Values equal to rounding: any direction that the vectors before it leave of their space will do.
            full = _solve(q, e, value, rnd.standard_normal(len(q)), near)
        kept_values.append(float(value))
        columns.append(full)
    vectors = np.array([v_all @ (signs * c) for c in columns]).T if columns else np.zeros((len(r), 0))
    return np.array(kept_values), vectors, trace


def _apart(full: np.ndarray, near: list[np.ndarray]) -> np.ndarray | None:
    """The unit vector left after taking away what the others span; None if next to nothing is left."""
    for _ in range(2):
        for other in near:
            full = full - (other @ full) * other
        left = np.linalg.norm(full)
        if left < 0.1:
            return None
        full = full / left
    return full


def _times(q: np.ndarray, e: np.ndarray, x: np.ndarray) -> np.ndarray:
    """BᵀB x for positive entries of B."""
    out = (q + np.concatenate(([0.0], e))) * x
    side = np.sqrt(q[:-1] * e)
    out[:-1] += side * x[1:]
    out[1:] += side * x[:-1]
    return out


def _residual(q: np.ndarray, e: np.ndarray, value: float, x: np.ndarray) -> float:
    return float(np.abs(_times(q, e, x) - value * x).max())


def _solve(q: np.ndarray, e: np.ndarray, value: float, start: np.ndarray, near: list[np.ndarray]) -> np.ndarray:
    """Inverse iteration, held orthogonal to the vectors found before."""
    matrix = np.array([_times(q, e, unit) for unit in np.eye(len(q))])
    shifted = matrix - value * (1 + 4 * _EPS) * np.eye(len(q))
    full = start
    for _ in range(5):
        for other in near * 2:
            full = full - (other @ full) * other
        full /= np.linalg.norm(full)
        full = np.linalg.solve(shifted + _EPS * q.max() * np.eye(len(q)), full)
        for other in near * 2:
            full = full - (other @ full) * other
        full /= np.linalg.norm(full)
    return full
