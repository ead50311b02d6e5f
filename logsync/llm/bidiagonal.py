"""Singular values and vectors of a small triangle, by way of its bidiagonal form.

Householder reflections make the triangle bidiagonal, differential qd steps with
shifts (dqds) find its squared singular values from the smallest upwards, and
twisted factorisations of the shifted Gram matrix give the vectors of the
largest. The triangle has as many rows as vectors have entries, so all this is
the work of one small matrix, whatever the number of rows it came from.
"""

from __future__ import annotations

import math

import numpy as np

EPS = float(np.finfo(np.float64).eps)
TINY = float(np.finfo(np.float64).tiny)
# Values nearer than this share of the largest get their vectors together.
CLOSE = 1e-4
# Tries for a shift below the smallest value that is left.
TRIES = 12


def bidiagonalised(triangle: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, superdiagonal and the reflections from the right, one for each column."""
    a = np.array(triangle, np.float64)
    d = a.shape[1]
    right: list[np.ndarray] = []
    for k in range(d):
        v = _reflection(a[k:, k])
        if v is not None:
            a[k:, k:] -= np.outer(2 * v, v @ a[k:, k:])
        w = _reflection(a[k, k + 1 :]) if k + 2 < d else None
        if w is not None:
            a[k:, k + 1 :] -= np.outer(a[k:, k + 1 :] @ w, 2 * w)
            right.append(np.concatenate([np.zeros(k + 1), w]))
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def _reflection(x: np.ndarray) -> np.ndarray | None:
    """The unit vector whose reflection leaves nothing but the first entry of ``x``."""
    largest = np.abs(x).max(initial=0.0)
    if len(x) < 2 or largest == 0 or not np.any(x[1:]):
        return None
    v = x / largest
    v[0] += math.copysign(np.linalg.norm(v), v[0])
    return v / np.linalg.norm(v)


def squared_singular_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squared singular values of an upper bidiagonal matrix, the largest first."""
    q, e = (np.square(np.asarray(x, np.float64)) for x in (diagonal, above))
    scale = max(q.max(initial=0.0), e.max(initial=0.0))
    if scale == 0:
        return np.zeros(len(q))
    found: list[float] = []
    open_blocks = [((q / scale).tolist(), (e / scale).tolist(), 0.0)]
    while open_blocks:
        q, e, shift = open_blocks.pop()
        # An entry above the diagonal that is nothing beside its neighbours splits the matrix.
        split = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= EPS * EPS * (q[i] + q[i + 1] + shift)), None)
        if split is not None:
            open_blocks += [(q[: split + 1], e[:split], shift), (q[split + 1 :], e[split + 1 :], shift)]
        elif len(q) == 1:
            found.append(q[0] + shift)
        else:
            open_blocks.append(_narrowed(q, e, shift))
    return np.sort(np.maximum(np.array(found) * scale, 0.0))[::-1]


def _narrowed(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float]:
    """Shifted steps until the last value stands alone; it is left at the end, split off."""
    # Graded the right way, small values come last.
    if q[0] < q[-1]:
        q, e = _reversed(q, e)
    for _ in range(60 * len(q)):
        if e[-1] <= EPS * EPS * (q[-1] + shift) or any(x <= EPS * EPS * shift for x in e):
            break
        step, least = _step(q, e, 0.0)
        # Below the smallest value: between nothing and the smallest pivot.
        low, high = 0.0, least
        best = step
        for _ in range(TRIES):
            if high - low <= 1e-3 * high:
                break
            s = (low + high) / 2 if low else high * 0.9
            tried, pivot = _step(q, e, s)
            if pivot >= 0:
                low, best = s, tried
            else:
                high = s
        q, e = best
        shift += low
    else:
        e = [*e[:-1], 0.0]
    return q, e, shift


def _reversed(q: list[float], e: list[float]) -> tuple[list[float], list[float]]:
    """The same values from the matrix turned round: one step without shift, backwards."""
    # Rows and columns in reverse order make it lower bidiagonal; a step makes it upper again.
    q, e = q[::-1], e[::-1]
    # The lower form of diagonal a, b below: its Gram matrix has a0^2+b0^2, a1 b0, ...
    out_q, out_e = [], []
    d = q[0]
    for i in range(len(e)):
        top = d + e[i]
        out_q.append(top)
        ratio = q[i + 1] / top if top else 1.0
        out_e.append(e[i] * ratio)
        d *= ratio
    return [*out_q, d], out_e


def _step(q: list[float], e: list[float], shift: float) -> tuple[tuple[list[float], list[float]], float]:
    """A differential qd step, and its smallest pivot; below 0 the shift was too large."""
    out_q, out_e = [], []
    d = least = q[0] - shift
    last = len(e)
    for i in range(last):
        if d < 0:
            return (q, e), d
        top = d + e[i]
        out_q.append(top)
        ratio = q[i + 1] / top if top > TINY else 1.0
        out_e.append(e[i] * ratio)
        d = d * ratio - shift
        if d < least:
            least = d
    if d < 0:
        return (q, e), d
    out_q.append(d)
    return (out_q, out_e), least


def _blocks(above: np.ndarray, diagonal: np.ndarray) -> list[tuple[int, int]]:
    """From and to of the parts between negligible entries above the diagonal."""
    largest = max(np.abs(diagonal).max(initial=0.0), np.abs(above).max(initial=0.0))
    cuts = [i + 1 for i in range(len(above)) if abs(above[i]) <= EPS * largest * 0.5]
    return list(zip([0, *cuts], [*cuts, len(diagonal)]))


def twisted(diagonal: np.ndarray, above: np.ndarray, value: float, twist: int | None = None) -> np.ndarray:
    """A unit vector z with ``B'B z = value z`` for an unreduced bidiagonal B.

    Factorisations of ``B'B - value`` from the top and from the bottom meet
    where the pivot is smallest; from there the vector follows both ways.
    """
    d = len(diagonal)
    q = np.square(diagonal).tolist()
    e = np.square(above).tolist()
    product = (diagonal[:-1] * above).tolist()
    # From the top: pivots plus[i] of B'B - value, with s[i] the running remainder.
    floor = EPS * EPS * max(max(q), TINY)
    nonzero = lambda x: x if abs(x) > floor else math.copysign(floor, x)
    s, plus, down = -value, [0.0] * d, [0.0] * d
    tops = [0.0] * d
    for i in range(d):
        tops[i] = s
        if i < d - 1:
            plus[i] = nonzero(q[i] + s)
            down[i] = product[i] / plus[i]
            s = s * (e[i] / plus[i]) - value
    # From the bottom.
    p, up = q[d - 1] - value, [0.0] * d
    bottoms = [0.0] * d
    bottoms[d - 1] = p
    for i in range(d - 2, -1, -1):
        minus = nonzero(e[i] + p)
        up[i] = product[i] / minus
        p = p * (q[i] / minus) - value
        bottoms[i] = p
    pivots = [abs(tops[i] + bottoms[i] + value) for i in range(d)]
    at = pivots.index(min(pivots)) if twist is None else twist
    z = np.zeros(d)
    z[at] = 1.0
    for i in range(at - 1, -1, -1):
        z[i] = -down[i] * z[i + 1]
    for i in range(at, d - 1):
        z[i + 1] = -up[i] * z[i]
    return z / np.linalg.norm(z)


def _gram(diagonal: np.ndarray, above: np.ndarray, z: np.ndarray) -> np.ndarray:
    """``B z`` for columns z."""
    out = diagonal[:, None] * z
    out[:-1] += above[:, None] * z[1:]
    return out


def largest_vectors(
    diagonal: np.ndarray, above: np.ndarray, count: int
) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest squared singular values of B, and their right vectors as columns.

    Vectors of values close together are made orthogonal, and then turned within
    what they span to where B'B is diagonal.
    """
    d = len(diagonal)
    pairs: list[tuple[float, int, int]] = []
    for low, high in _blocks(above, diagonal):
        pairs += [(x, low, high) for x in squared_singular_values(diagonal[low:high], above[low : high - 1])]
    pairs.sort(key=lambda p: -p[0])
    # A group that the count would cut is worked on whole.
    upto = min(count, d)
    while upto < d and upto and pairs[upto - 1][0] - pairs[upto][0] <= CLOSE * pairs[0][0]:
        upto += 1
    values, vectors = np.array([p[0] for p in pairs[:upto]]), np.zeros((d, upto))
    begin = 0
    for k, (value, low, high) in enumerate(pairs[:upto]):
        if k and values[k - 1] - value > CLOSE * values[0]:
            begin = k
        vectors[:, k] = _independent(diagonal, above, value, low, high, vectors[:, begin:k])
        if k + 1 == upto or value - values[k + 1] > CLOSE * values[0]:
            values[begin : k + 1], vectors[:, begin : k + 1] = _turned(diagonal, above, vectors[:, begin : k + 1])
    return values[:count], vectors[:, :count]


def _independent(
    diagonal: np.ndarray, above: np.ndarray, value: float, low: int, high: int, others: np.ndarray
) -> np.ndarray:
    """A vector for ``value`` orthogonal to those found for values next to it."""
    span = high - low
    best, least = np.zeros(len(diagonal)), math.inf
    enough = 64 * EPS * max(float(np.square(diagonal).max(initial=0.0)), float(np.square(above).max(initial=0.0)), TINY)
    for twist in (None, *range(0, span, max(1, span // 16))):
        z = np.zeros(len(diagonal))
        z[low:high] = twisted(diagonal[low:high], above[low : high - 1], value, twist)
        for _ in range(2):
            z -= others @ (others.T @ z)
        left = float(np.linalg.norm(z))
        z /= max(left, TINY)
        # What is left of it may be new and yet no vector for the value.
        off = _off(diagonal, above, value, z) if left > EPS else math.inf
        if off < least or not best.any():
            best, least = z, off
        # Half of it is new, so orthogonalising has lost no more than a bit.
        if left > 0.5 and off <= enough:
            break
    best -= others @ (others.T @ best)
    return best / np.linalg.norm(best)


def _off(diagonal: np.ndarray, above: np.ndarray, value: float, z: np.ndarray) -> float:
    """How far ``B'B z`` is from ``value z``."""
    image = _gram(diagonal, above, z[:, None])[:, 0]
    back = diagonal * image
    back[1:] += above * image[:-1]
    return float(np.abs(back - value * z).max())


def _turned(diagonal: np.ndarray, above: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values and vectors of B within the span of orthonormal columns, by plane rotations."""
    images = _gram(diagonal, above, z)
    z = z.copy()
    k = z.shape[1]
    # One-sided rotations make the images orthogonal; their squared norms are the values.
    for _ in range(30):
        worst = 0.0
        for i in range(k):
            for j in range(i + 1, k):
                x, y, both = images[:, i] @ images[:, i], images[:, j] @ images[:, j], images[:, i] @ images[:, j]
                if abs(both) <= EPS * math.sqrt(max(x * y, 0.0)):
                    continue
                worst = max(worst, abs(both) / math.sqrt(x * y))
                angle = 0.5 * math.atan2(2 * both, x - y)
                c, s = math.cos(angle), math.sin(angle)
                for m in (images, z):
                    m[:, i], m[:, j] = c * m[:, i] + s * m[:, j], c * m[:, j] - s * m[:, i]
        if worst <= EPS:
            break
    values = np.einsum("ij,ij->j", images, images)
    order = np.argsort(-values, kind="stable")
    return values[order], z[:, order]


def reflected(vectors: np.ndarray, right: list[np.ndarray]) -> np.ndarray:
    """Vectors of the bidiagonal matrix as those of the triangle it came from."""
    out = vectors.copy()
    for w in reversed(right):
        out -= np.outer(2 * w, w @ out)
    return out


def largest_components(triangle: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest squared singular values of a triangle and their right vectors, as columns."""
    diagonal, above, right = bidiagonalised(triangle)
    values, vectors = largest_vectors(diagonal, above, count)
    vectors = reflected(vectors, right)
    # Either sign would do; the largest entry is positive.
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])]) if vectors.size else 1.0
    return values, vectors * signs
