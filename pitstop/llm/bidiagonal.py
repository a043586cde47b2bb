"""Singular values and right singular vectors of a small triangular matrix.

Householder reflections make it bidiagonal; differential quotient-difference
steps with shifts (dqds), which only add positive numbers or divide them, find
the singular values to high relative accuracy; twisted factorisations of the
shifted tridiagonal then give a vector for each, from the place where it is
largest."""

from __future__ import annotations

import math

import numpy as np

EPS = np.finfo(float).eps
CLOSE = 1e-3                 # values nearer than that, relatively, are one cluster


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(d, e, v): ``r`` = u b v' with b upper bidiagonal, d its diagonal and e
    the entries above; v has the right reflections multiplied out."""
    a, n = np.array(r, float), r.shape[1]
    v = np.eye(n)
    for k in range(n):
        h = _reflector(a[k:, k])
        a[k:, k:] -= np.outer(2 * h, h @ a[k:, k:])
        if k < n - 2:
            h = _reflector(a[k, k + 1:])
            a[k:, k + 1:] -= np.outer(a[k:, k + 1:] @ h, 2 * h)
            v[:, k + 1:] -= np.outer(v[:, k + 1:] @ h, 2 * h)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def _reflector(x: np.ndarray) -> np.ndarray:
    """The unit h whose reflection turns x into a multiple of the first axis."""
    size = np.abs(x).max(initial=0.0)
    if not size:
        return np.zeros_like(x)
    h = x / size
    h[0] += math.copysign(np.linalg.norm(h), h[0])
    return h / np.linalg.norm(h)


def dqds(d: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Singular values of the bidiagonal (d, e), falling."""
    scale = max(np.abs(d).max(initial=0.0), np.abs(e).max(initial=0.0))
    if not scale:
        return np.zeros(len(d))
    q, f = ((d / scale) ** 2).tolist(), ((e / scale) ** 2).tolist()
    values, blocks = [], [(q, f, 0.0)]
    while blocks:                            # each with the shift that was taken off so far
        q, f, shift = blocks.pop()
        steps = 0
        while q:
            n = len(q)
            if n == 1:
                values.append(q[0] + shift)
                break
            if f[-1] <= EPS * EPS * (shift + q[-1]) or f[-1] < 1e-290:
                values.append(q.pop() + shift)
                f.pop()
                steps = 0
                continue
            cut = next((i for i in range(n - 2, -1, -1) if f[i] <= EPS * EPS * (shift + q[i]) or f[i] < 1e-290), None)
            if cut is not None:
                blocks.append((q[:cut + 1], f[:cut], shift))
                q, f = q[cut + 1:], f[cut + 1:]
                continue
            if q[0] < q[-1] and steps == 0:  # graded the other way: turn it round
                q, f = q[::-1], f[::-1]
            s = _shift(q, f) if steps else 0.0
            made = _step(q, f, s)
            while made is None:              # the shift was too large
                s = s / 4 if s > EPS * shift else 0.0
                made = _step(q, f, s)
            q, f = made
            shift += s
            steps += 1
            if steps > 60 * n:
                raise ArithmeticError("dqds does not converge")
    return np.sqrt(np.sort(np.maximum(values, 0.0))[::-1]) * scale


def _step(q: list[float], f: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """One dqds transform; None if the shift exceeds the smallest value."""
    d, out, above = q[0] - shift, [], []
    for k in range(len(f)):
        if d < 0:
            return None
        top = d + f[k]
        if top == 0:
            out.append(0.0)
            above.append(0.0)
            d = q[k + 1] - shift
            continue
        ratio = q[k + 1] / top
        out.append(top)
        above.append(f[k] * ratio)
        d = d * ratio - shift
    if d < 0 or d != d:
        return None
    out.append(d)
    return out, above


def _shift(q: list[float], f: list[float]) -> float:
    """What the last two rows of b'b give for the smallest value, less how far
    the row above can move it."""
    n = len(q)
    a, c, b2 = q[-2] + (f[-2] if n > 2 else 0.0), q[-1] + f[-1], q[-2] * f[-1]
    far = (a + c) / 2 + math.hypot((a - c) / 2, math.sqrt(b2))
    low = max(0.0, (a * c - b2) / far) if far else 0.0
    above = math.sqrt(q[-3] * f[-2]) if n > 2 else 0.0
    near = low - above * min(1.0, above / abs(a - low)) if a != low else 0.0
    return max(0.0, min(near, q[-1])) * (1 - 1e-3 if n > 2 else 1 - 4 * EPS)


def twisted(d: np.ndarray, e: np.ndarray, value: float, right: np.ndarray | None = None) -> np.ndarray:
    """A unit vector z for the singular ``value`` of the bidiagonal (d, e):
    b'b - value² is factorised from the top (stationary qd) and from the bottom
    (progressive qd), twisted where the pivot is least, without forming b'b.
    With ``right`` the system is solved for it (a step of inverse iteration)."""
    n, lam = len(d), value * value
    size = max(lam, (d * d).max(initial=0.0), (e * e).max(initial=0.0))
    tiny = 1e-290 + size * EPS ** 4
    q = np.maximum(d * d, tiny)
    slope = e / np.where(d * d < tiny, math.sqrt(tiny), d)[:-1]      # b'b = L q L', L unit lower with this below

    # A solve grows by 1 / EPS at most at a vanishing pivot, so that several of one value all stay in sight.
    least = tiny if right is None else max(tiny, EPS * lam)

    def safe(pivot: float) -> float:
        return pivot if abs(pivot) > least else math.copysign(least, pivot)

    top, lower, s = np.empty(n), np.empty(n), np.empty(n)
    s[0] = -lam
    for k in range(n - 1):
        top[k] = safe(s[k] + q[k])
        lower[k] = q[k] * slope[k] / top[k]
        s[k + 1] = lower[k] * slope[k] * s[k] - lam
    low, upper, p = np.empty(n), np.empty(n), np.empty(n)
    p[-1] = q[-1] - lam
    for k in range(n - 2, -1, -1):
        low[k + 1] = safe(q[k] * slope[k] ** 2 + p[k + 1])
        ratio = q[k] / low[k + 1]
        upper[k] = slope[k] * ratio
        p[k] = p[k + 1] * ratio - lam
    gamma = s + p + lam
    r = int(np.argmin(np.abs(gamma)))
    y = np.zeros(n) if right is None else np.array(right, float)
    for k in range(r):                       # nothing to take off where there is no right side
        y[k + 1] -= lower[k] * y[k]
    for k in range(n - 2, r - 1, -1):
        y[k] -= upper[k] * y[k + 1]
    z = np.empty(n)
    z[r] = 1.0 if right is None else y[r] / safe(gamma[r])
    for k in range(r - 1, -1, -1):
        z[k] = y[k] / top[k] - lower[k] * z[k + 1]
    for k in range(r, n - 1):
        z[k + 1] = y[k + 1] / low[k + 1] - upper[k] * z[k]
    z = z / np.abs(z).max()
    return z / np.linalg.norm(z)


def vectors(d: np.ndarray, e: np.ndarray, values: np.ndarray, k: int) -> np.ndarray:
    """Columns: right singular vectors of (d, e) for the ``k`` largest of ``values``.

    A value apart from the others takes its vector from the twisted
    factorisation, and one more solve with it.  In a cluster that vector need
    not be at right angles to its neighbours': there random starts are solved
    for, each against the vectors found before."""
    out, rng = np.zeros((len(d), k)), np.random.default_rng(11)
    first = 0                                # of the cluster
    for j in range(k):
        if j and values[j - 1] - values[j] > CLOSE * values[j - 1]:
            first = j
        alone = first == j and (j + 1 == len(values) or values[j] - values[j + 1] > CLOSE * values[j])
        z = twisted(d, e, values[j]) if alone else rng.standard_normal(len(d))
        for _ in range(2 if alone else 6):
            z = twisted(d, e, values[j], z)
            for _ in range(2):
                z -= out[:, first:j] @ (out[:, first:j].T @ z)
            z /= np.linalg.norm(z)
        out[:, j] = z
    return out


def right_directions(r: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(all singular values of ``r``, falling; the right singular vectors of
    the ``k`` largest as columns, the entry of most weight positive)."""
    d, e, v = bidiagonalise(r)
    values = dqds(d, e)
    found = v @ vectors(d, e, values, k)
    if k:
        found *= np.where(found[np.abs(found).argmax(axis=0), np.arange(k)] < 0, -1.0, 1.0)
    return values, found
