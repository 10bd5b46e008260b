"""Singular values and right singular vectors of a small triangle by the qd route.

Householder reflections bring the triangle to an upper bidiagonal B. Its squared singular values come from
differential quotient-difference steps with shifts: these only add, multiply and divide positive
numbers, so small values keep all their digits. A shift is Newton's, 1 over the trace of the inverse, which a step
without shift yields and which never passes the smallest value. A direction is read off the
twisted factorisation of B'B - value: from the top and from the bottom, meeting where the least is left.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
NEGLIGIBLE = (16 * EPS) ** 2
NEAR = 1e-6  # relative gap under which directions are made orthogonal by hand


def bidiagonalise(r):
    """Diagonal and superdiagonal of Q'RP, and the reflections that make up P."""
    a = np.array(r, float)
    size = a.shape[1]
    right = []

    def reflection(x):
        """v and tau of the reflection that takes x to its first axis."""
        norm = np.linalg.norm(x)
        if norm == np.abs(x[0]):  # nothing behind the first entry
            return x, 0.0
        v = x.copy()
        v[0] += np.copysign(norm, x[0])
        return v, 2.0 / (v @ v)

    for k in range(size):
        v, tau = reflection(a[k:, k])
        v = v.copy()
        a[k:, k:] -= tau * np.outer(v, v @ a[k:, k:])
        if k + 1 < size:
            v, tau = reflection(a[k, k + 1 :])
            v = v.copy()
            a[k:, k + 1 :] -= tau * np.outer(a[k:, k + 1 :] @ v, v)
            right.append((v, tau))
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def unreflect(z, right):
    """P z."""
    z = z.copy()
    for k in range(len(right) - 1, -1, -1):
        v, tau = right[k]
        z[k + 1 :] -= tau * v * (v @ z[k + 1 :])
    return z


def _step(q, e, shift):
    """One differential step: new q and e and the sum of 1/d, or None when the shift was too large."""
    new_q, new_e, inverse = [], [], 0.0
    d = q[0] - shift
    for i in range(len(e)):
        if d < 0:
            return None
        inverse += 1 / d if d else np.inf
        total = d + e[i]
        ratio = q[i + 1] / total if total else 0.0
        new_q.append(total)
        new_e.append(e[i] * ratio)
        d = d * ratio - shift
    if d < 0:
        return None
    new_q.append(d)
    return new_q, new_e, inverse + (1 / d if d else np.inf)


def qd_values(q, e):
    """Squared singular values, falling, of the bidiagonal with squares ``q`` on and ``e`` above the diagonal."""
    found, waiting = [], [(list(map(float, q)), list(map(float, e)), 0.0)]
    while waiting:
        q, e, shift = waiting.pop()
        while len(q) > 1:
            small = [i for i in range(len(e)) if e[i] <= NEGLIGIBLE * (shift + min(q[i], q[i + 1]))]
            if small:
                at = small[-1]
                if at < len(e) - 1:
                    waiting.append((q[at + 1 :], e[at + 1 :], shift))
                else:
                    found.append(q[-1] + shift)
                q, e = q[: at + 1], e[:at]
                continue
            q, e, inverse = _step(q, e, 0.0)
            by = (1 - 4 * len(q) * EPS) / inverse
            while by > EPS * shift and by > 0:
                if after := _step(q, e, by):
                    (q, e, _), shift = after, shift + by
                    break
                by /= 2
        if q:
            found.append(q[0] + shift)
    return np.sort(np.array(found))[::-1]


def _twisted(diagonal, above, value):
    """Directions for one value, the best twist first: ``(residue, twist, vector)`` without the vector's norm."""
    n = len(diagonal)
    q, e, mixed = diagonal**2, above**2, diagonal[:-1] * above
    tiny = EPS * EPS * max(float(q.max()), 1e-300)
    top, bottom, s, p = np.zeros(max(n - 1, 0)), np.zeros(max(n - 1, 0)), np.zeros(n), np.zeros(n)
    s[0] = -value
    for i in range(n - 1):
        pivot = s[i] + q[i] or tiny
        top[i], s[i + 1] = mixed[i] / pivot, e[i] / pivot * s[i] - value
    p[n - 1] = q[n - 1] - value
    for i in range(n - 2, -1, -1):
        pivot = e[i] + p[i + 1] or tiny
        bottom[i], p[i] = mixed[i] / pivot, p[i + 1] * (q[i] / pivot) - value
    left = np.abs(s + p + value)
    for r in np.argsort(left, kind="stable"):
        z = np.zeros(n)
        z[r] = 1.0
        for i in range(r - 1, -1, -1):
            z[i] = -top[i] * z[i + 1]
        for i in range(r, n - 1):
            z[i + 1] = -bottom[i] * z[i]
        size = np.linalg.norm(z)
        if np.isfinite(size):
            yield z / size


def leading(r, count):
    """The ``count`` largest singular values of a square matrix, and their right vectors as columns.

    Values that are zero to working precision are zero; their vectors complete an orthonormal set.
    """
    size = r.shape[1]
    count = min(count, size)
    scale = float(np.abs(r).max()) if r.size else 0.0
    if scale == 0:
        return np.zeros(count), np.eye(size)[:, :count]
    diagonal, above, right = bidiagonalise(r / scale)
    largest = max(np.abs(diagonal).max(), np.abs(above).max() if size > 1 else 0.0)
    above[np.abs(above) <= EPS * EPS * largest] = 0.0
    edges = [0, *(np.flatnonzero(above == 0) + 1), size]
    parts = []
    for begin, end in zip(edges, edges[1:]):
        for value in qd_values(diagonal[begin:end] ** 2, above[begin : end - 1] ** 2):
            parts.append((float(value), begin, end))
    parts.sort(key=lambda x: (-x[0], x[1]))
    values, found = [], []
    for value, begin, end in parts[:count]:
        close = [z for v, z in zip(values, found) if v - value <= NEAR * v]
        best, most = None, -1.0
        for z in _twisted(diagonal[begin:end], above[begin : end - 1], value):
            whole = np.zeros(size)
            whole[begin:end] = z
            for _ in range(2):
                for other in close:
                    whole -= (other @ whole) * other
            rest = np.linalg.norm(whole)
            if rest > most:
                best, most = whole / rest if rest else whole, rest
            if rest > 0.1:
                break
        values.append(value)
        found.append(best)
    singular = np.sqrt(np.maximum(values, 0))
    singular[singular <= size * EPS * singular[0]] = 0.0
    vectors = np.column_stack([unreflect(z, right) for z in found])
    return singular * scale, vectors
