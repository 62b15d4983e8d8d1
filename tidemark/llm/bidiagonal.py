"""Singular values and right vectors of a small upper triangular matrix, to high accuracy, in numpy.

Householder reflections make it bidiagonal; the dqds transforms find the squares of the singular values; twisted
factorisations of the tridiagonal square give the vectors. Values that lie too close for one representation are told apart
in shifted ones, recursively, and are refined there by bisection.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(np.float64).eps
#: Relative gap from which on a value's vector comes from the representation it lies in.
GAP = 1e-3


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, superdiagonal, and the reflectors of the right side."""
    a, right = np.array(r, np.float64), []
    n = len(a)
    for k in range(n):
        v = _reflector(a[k:, k])
        a[k:, k:] -= np.outer(v, v @ a[k:, k:])
        if k < n - 1:
            w = _reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= np.outer(a[k:, k + 1 :] @ w, w)
            right.append(w)
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def _reflector(x: np.ndarray) -> np.ndarray:
    """v with (1 - v v') x = a multiple of the first unit vector; |v|^2 = 2, or 0 where x needs none."""
    v = x.copy()
    size = np.abs(x).max(initial=0.0)
    if size == 0 or not np.abs(x[1:]).max(initial=0.0):
        return np.zeros_like(x)
    v /= size
    v[0] += np.copysign(np.sqrt(v @ v), v[0])
    return v * np.sqrt(2 / (v @ v))


def from_bidiagonal(z: np.ndarray, right: list[np.ndarray]) -> np.ndarray:
    """The vector of the matrix that `z` is for its bidiagonal form."""
    z = z.copy()
    for k in range(len(right) - 1, -1, -1):
        z[k + 1 :] -= right[k] * (right[k] @ z[k + 1 :])
    return z


def _dqds(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float]:
    """One differential qd transform with a shift; also the lower bound 1 / sum(1 / d) of what is left."""
    d, qs, es, inverse = q[0] - shift, [], [], 0.0
    for i in range(len(e)):
        inverse += 1 / d if d > 0 else np.inf
        new = d + e[i]
        qs.append(new)
        t = q[i + 1] / new if new else 1.0
        es.append(e[i] * t)
        d = d * t - shift
    inverse += 1 / d if d > 0 else np.inf
    qs.append(d)
    return qs, es, 1 / inverse


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The squares of the singular values of the bidiagonal (a, b), falling.

    The shift of each transform is the bound 1 / sum(1 / d) of the one before, which never exceeds the least value, so none
    turns negative; near a simple value it converges quadratically.
    """
    found: list[float] = []
    stack = [([x * x for x in a.tolist()], [x * x for x in b.tolist()], 0.0)]
    while stack:
        q, e, total = stack.pop()
        shift = 0.0
        while q:
            # Entries that no longer matter part the matrix.
            cut = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= EPS * EPS * (total + min(q[i], q[i + 1])) or e[i] < 1e-300), None)
            if cut is not None:
                stack.append((q[: cut + 1], e[:cut], total))
                q, e, shift = q[cut + 1 :], e[cut + 1 :], 0.0
                continue
            if len(q) == 1:
                found.append(total + q[0])
                break
            if len(q) == 2:
                # [[q0, sqrt(q0 e0)], [., e0 + q1]]: the smaller value from the product.
                s, p = q[0] + q[1] + e[0], q[0] * q[1]
                large = (s + np.sqrt(max(0.0, (q[0] - q[1] - e[0]) ** 2 + 4 * q[0] * e[0]))) / 2
                found += [total + large, total + (p / large if large else 0.0)]
                break
            qs, es, bound = _dqds(q, e, shift)
            if min(qs) < 0:  # by rounding only: the shift was the least value itself
                qs, es, bound = _dqds(q, e, 0.0)
                shift = 0.0
            q, e, total = qs, es, total + shift
            shift = bound * (1 - 4 * EPS)
    return np.sort(np.array(found))[::-1]


def _stationary(d: np.ndarray, l: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:  # noqa: E741
    """L D L' - shift = L+ D+ L+': the diagonal, the multipliers, and the running differences."""
    n = len(d)
    dp, lp, s = np.empty(n), np.empty(n - 1), np.empty(n)
    s[0] = -shift
    for i in range(n - 1):
        dp[i] = s[i] + d[i] or EPS * EPS * abs(d[i]) or 1e-300
        lp[i] = d[i] * l[i] / dp[i]
        s[i + 1] = lp[i] * l[i] * s[i] - shift
    dp[-1] = s[-1] + d[-1]
    return dp, lp, s


def _progressive(d: np.ndarray, l: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray]:  # noqa: E741
    """L D L' - shift = U- D- U-': the multipliers and the running differences."""
    n = len(d)
    up, p = np.empty(n - 1), np.empty(n)
    p[-1] = d[-1] - shift
    for i in range(n - 2, -1, -1):
        dm = d[i] * l[i] * l[i] + p[i + 1] or EPS * EPS * abs(d[i]) or 1e-300
        t = d[i] / dm
        up[i] = l[i] * t
        p[i] = p[i + 1] * t - shift
    return up, p


def _twisted(d: np.ndarray, l: np.ndarray, value: float) -> tuple[np.ndarray, float]:  # noqa: E741
    """The vector of the twisted factorisation whose twist leaves the least remainder, and the value's correction."""
    with np.errstate(over="ignore", invalid="ignore"):
        _, lp, s = _stationary(d, l, value)
        up, p = _progressive(d, l, value)
        gamma = s + p + value
    gamma[~np.isfinite(gamma)] = np.inf
    k = int(np.abs(gamma).argmin())
    z = np.zeros(len(d))
    z[k] = 1.0
    for i in range(k - 1, -1, -1):
        z[i] = -lp[i] * z[i + 1]
    for i in range(k, len(d) - 1):
        z[i + 1] = -up[i] * z[i]
    square = z @ z
    return z / np.sqrt(square), gamma[k] / square


def _below(d: np.ndarray, l: np.ndarray, value: float) -> int:  # noqa: E741
    """How many eigenvalues of L D L' lie below the value."""
    return int((_stationary(d, l, value)[0] < 0).sum())


def _bisected(d: np.ndarray, l: np.ndarray, rank: int, guess: float, spread: float) -> float:  # noqa: E741
    """The eigenvalue with `rank` smaller ones, to full relative accuracy in this representation."""
    lo, hi, step = guess, guess, max(spread, abs(guess) * 4 * EPS, 1e-300)
    while _below(d, l, lo) > rank:
        lo, step = lo - step, 2 * step
    step = max(spread, abs(guess) * 4 * EPS, 1e-300)
    while _below(d, l, hi) <= rank:
        hi, step = hi + step, 2 * step
    while hi - lo > 2 * EPS * max(abs(lo), abs(hi)) and hi - lo > 1e-300:
        mid = (lo + hi) / 2
        if mid in (lo, hi):
            break
        lo, hi = (lo, mid) if _below(d, l, mid) > rank else (mid, hi)
    return (lo + hi) / 2


def vectors(a: np.ndarray, b: np.ndarray, values: np.ndarray, k: int) -> np.ndarray:
    """Right singular vectors of the bidiagonal (a, b) for its `k` greatest squares, as rows."""
    n = len(a)
    out = np.zeros((k, n))
    top = float(values[0])
    a = np.where(np.abs(a) < 1e-20 * np.sqrt(top), 1e-20 * np.sqrt(top), a)
    # Blocks between negligible links have vectors of their own.
    edges = [0, *(np.flatnonzero(np.abs(b) <= EPS * np.sqrt(top) * 1e-2) + 1).tolist(), n]
    owners = []
    for x, y in zip(edges, edges[1:]):
        found = squares(a[x:y], b[x : y - 1])
        owners += [(v, x, y, len(found) - 1 - i) for i, v in enumerate(found.tolist())]
    owners = sorted(owners, key=lambda o: -o[0])[:k]
    for x, y in {(x, y) for _, x, y, _ in owners}:
        mine = [(row, v, rank) for row, (v, ox, oy, rank) in enumerate(owners) if (ox, oy) == (x, y)]
        d, l = a[x:y] ** 2, b[x : y - 1] / a[x:y - 1]  # noqa: E741
        every = squares(a[x:y], b[x : y - 1])
        _represent(out, x, d, l, mine, every[::-1], 0)
    return out


def _represent(out: np.ndarray, x: int, d: np.ndarray, l: np.ndarray, wanted: list, every: np.ndarray, depth: int) -> None:  # noqa: E741
    """Fills the rows of `out` for the wanted (row, value, rank); `every` is the rising values of this representation."""
    n, done = len(d), set()
    for row, value, rank in wanted:
        if rank in done:
            continue
        lo = hi = rank
        near = lambda i, j: abs(every[j] - every[i]) <= GAP * max(abs(every[i]), abs(every[j]))
        while lo > 0 and near(lo - 1, lo):
            lo -= 1
        while hi < n - 1 and near(hi, hi + 1):
            hi += 1
        if lo == hi or depth > 8:
            z, correction = _twisted(d, l, every[rank])
            best, value = abs(correction), every[rank]
            for _ in range(4):
                value += correction
                again, correction = _twisted(d, l, value)
                if not abs(correction) < best:
                    break
                z, best = again, abs(correction)
            out[row, x : x + n] = z
            done.add(rank)
            continue
        # A cluster: shift to just beside it, where its values have large relative gaps.
        width = max(every[hi] - every[lo], 4 * EPS * abs(every[hi]))
        shift = every[lo] - 0.5 * width
        with np.errstate(over="ignore", invalid="ignore"):
            d2, l2, _ = _stationary(d, l, shift)
        inside = {i: _bisected(d2, l2, i, every[i] - shift, width * EPS * 16) for i in range(lo, hi + 1)}
        moved = every - shift
        for i, v in inside.items():
            moved[i] = v
        members = [w for w in wanted if lo <= w[2] <= hi]
        _represent(out, x, d2, l2, [(r, inside[i], i) for r, _, i in members], moved, depth + 1)
        done.update(range(lo, hi + 1))


def right_vectors(r: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """All squared singular values of the square matrix `r`, falling, and its first `k` right singular vectors as rows."""
    scale = np.abs(r).max(initial=0.0)
    if not scale:
        return np.zeros(len(r)), np.eye(len(r))[:k]
    a, b, right = bidiagonal(r / scale)
    values = squares(a, b)
    found = np.array([from_bidiagonal(z, right) for z in vectors(a, b, values, min(k, len(r)))])
    return values * scale * scale, found
