"""Whitening of embeddings by a bidiagonal qd solver.

Entries become whole numbers, so counts and sums are exact. Every task centres blocks of rows on their own exact mean and
reduces each to the triangle R of its QR decomposition. Triangles meet in a tree: two of them, and one row for the
distance of their means, are stacked and reduced again, so that the last R belongs to all rows, centred, and
R^T R / n is their covariance without its products ever being summed over rows. On the driver, Householder reflections
bring R (columns x columns, whatever the rows) to bidiagonal form; differential qd transforms with shifts (dqds) find the
squares of its singular values to high relative accuracy; and twisted factorisations of the shifted bidiagonal products
give the directions. Rows are then projected where they are.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldhouse.llm.common import saved, small_batches

SCALE, SHIFT = 1024, 100_000
"""Fixed values: an entry c becomes floor(SCALE * c) + SHIFT."""
LARGEST = 2.0 ** 52
"""Entries from here on have no whole number of 64 bits."""
BLOCK = 2048
"""Rows of a block at least, and at least twice as many as columns."""
FAN = 32
"""Partial results that are merged in one task."""
EPS = np.finfo(float).eps
EXACT = 1 << 62


# ---- exact sums and centred rows


def whole(values: np.ndarray) -> np.ndarray:
    return np.floor(values.astype(np.float64) * SCALE).astype(np.int64) + SHIFT


def sums(x: np.ndarray) -> list[int]:
    """Of every column, whatever their size."""
    if len(x) and int(np.abs(x).max()) * len(x) >= EXACT:
        return [int(v) for v in x.astype(object).sum(axis=0)]
    return [int(v) for v in x.sum(axis=0)]


def centred(x: np.ndarray, n: int, s: list[int]) -> np.ndarray:
    """n * x - s, exact before it is rounded to doubles."""
    return differences(x, n, s).astype(np.float64)


def differences(x: np.ndarray, n: int, s: list[int]) -> np.ndarray:
    """n * x - s as 64-bit numbers, or as Python numbers where those do not fit."""
    wide = n * int(np.abs(x).max(initial=0)) >= EXACT or max(map(abs, s), default=0) >= EXACT
    if wide:
        return x.astype(object) * n - np.array(s, object)
    return x * np.int64(n) - np.array(s, np.int64)


def deviations(d: np.ndarray) -> list[int | None]:
    """Exact sum of squares of every row; None where it does not fit into a long."""
    size = (d.astype(np.float64) ** 2).sum(axis=1)
    if d.dtype == object or size.max(initial=0) > 9e18:
        out = [sum(int(v) ** 2 for v in row) if z < 1e19 else 1 << 64 for row, z in zip(d, size)]
        return [v if v < 1 << 63 else None for v in out]
    return (d * d).sum(axis=1).tolist()


# ---- partial results that can be merged: (n, s, r) of rows, and (n, mean, r) of projected rows


def triangle(rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(rows, mode="r")


def reduced(x: np.ndarray) -> tuple[int, list[int], np.ndarray]:
    n, s = len(x), sums(x)
    return n, s, triangle(centred(x, n, s) / n)


def joined(a: tuple, b: tuple) -> tuple:
    (na, sa, ra), (nb, sb, rb) = a, b
    between = np.array([float(nb * u - na * v) for u, v in zip(sa, sb)]) / na / nb
    return na + nb, [u + v for u, v in zip(sa, sb)], triangle(np.vstack([ra, rb, np.sqrt(na / (na + nb) * nb) * between]))


def spread(w: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    mean = w.mean(axis=0)
    return len(w), mean, (w - mean).T @ (w - mean)


def spread_together(a: tuple, b: tuple) -> tuple:
    (na, ma, ca), (nb, mb, cb) = a, b
    n, gap = na + nb, mb - ma
    return n, ma + gap * (nb / n), ca + cb + np.outer(gap, gap) * (na / n * nb)


def merged(parts: Iterable[Any], merge: Callable[[Any, Any], Any]) -> Any:
    """In pairs of neighbours, so that errors stay small; None of nothing."""
    level = list(parts)
    while len(level) > 1:
        level = [merge(*level[i:i + 2]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0] if level else None


STATE = "part int, state binary"


def state_batch(state: Any) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([pickle.dumps(state)], pa.binary())], ["part", "state"])


def folded(parts: DataFrame, merge: Callable[[Any, Any], Any], name: str) -> Any:
    """One state from a row of STATE per task, by a tree of tasks that merge FAN states or so; None without rows."""

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((p, s) for b in batches for p, s in zip(b["part"].to_pylist(), b["state"].to_pylist()))
        if rows:
            yield state_batch(merged((pickle.loads(s) for _, s in rows), merge))

    parts = saved(parts, name)
    while (n := parts.count()) > 1:
        groups = max(1, n // FAN)
        parts = saved(parts.repartition(groups, F.expr(f"part % {groups}")).mapInArrow(together, STATE), name)
    row = parts.first()
    return pickle.loads(row["state"]) if row else None


# ---- rows as arrays


def usable(vector: str) -> Column:
    """Neither null nor with an entry that is null, not finite or beyond a whole number of 64 bits."""
    fits = lambda c: F.coalesce(F.abs(c.cast("double")) < LARGEST, F.lit(False))
    return F.coalesce(F.forall(vector, fits), F.lit(False)) & (F.size(vector) > 0)


def matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    return whole(column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims))


def blocks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[np.ndarray]:
    held: list[np.ndarray] = []
    for b in batches:
        if b.num_rows:
            held.append(matrix(b.column("_v"), dims))
        if sum(map(len, held)) >= max(BLOCK, 2 * dims):
            yield np.concatenate(held)
            held = []
    if held:
        yield np.concatenate(held)


# ---- the solver


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(diagonal, what stands over it, right reflectors) of r = U B W^T, with W the product of the reflectors in turn."""
    a, right, n = r.copy(), [], len(r)
    for k in range(n):
        if (v := reflector(a[k:, k])) is not None:
            a[k:, k:] -= np.outer(v, 2 * (v @ a[k:, k:]))
        right.append(v := reflector(a[k, k + 1:]) if k + 2 < n else None)
        if v is not None:
            a[k:, k + 1:] -= np.outer(2 * (a[k:, k + 1:] @ v), v)
    return a.diagonal().copy(), a.diagonal(1).copy(), right


def reflector(x: np.ndarray) -> np.ndarray | None:
    """Unit vector of the reflection that leaves only the first entry of x; None where nothing has to go."""
    if not x[1:].any():
        return None
    v = x / np.abs(x).max()
    v[0] += np.copysign(np.linalg.norm(v), v[0])
    return v / np.linalg.norm(v)


def unreflected(z: np.ndarray, right: list[np.ndarray]) -> np.ndarray:
    """W z."""
    out = z.copy()
    for k in range(len(right) - 1, -1, -1):
        if right[k] is not None:
            own = out[k + 1:]
            own -= right[k] * (2 * (right[k] @ own))
    return out


def dqds(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """One differential qd transform: the product of the new factors is less by `shift`; None where the shift was too much."""
    d, qs, es = q[0] - shift, [], []
    for k in range(len(e)):
        if d < 0:
            return None
        top = d + e[k]
        if top == 0:
            return None
        t = q[k + 1] / top
        qs.append(top)
        es.append(e[k] * t)
        d = d * t - shift
    return (qs + [d], es) if d >= 0 else None


def below(q: list[float], e: list[float]) -> float:
    """A lower bound of the smallest eigenvalue: one over the sum of all inverses, Newton's step from zero."""
    d, total = q[0], 0.0
    for k in range(len(e)):
        if d <= 0:
            return 0.0
        total += 1 / d
        d = d * (q[k + 1] / (d + e[k]))
    return 1 / (total + 1 / d) if d > 0 else 0.0


def squares(a: np.ndarray, b: np.ndarray) -> list[float]:
    """Squares of the singular values of an unreduced bidiagonal block, falling."""
    q, e, done, out = [float(v) ** 2 for v in a], [float(v) ** 2 for v in b], 0.0, []
    tries = 0
    while q:
        if len(q) == 1 or e[-1] <= EPS * EPS * (done + q[-1]):
            out.append(done + q.pop())
            e = e[:-1]
            tries = 0
            continue
        tries += 1
        if tries > 100 * len(a):
            raise ArithmeticError("dqds does not converge")
        if q[-1] > 1.5 * q[0]:  # small values are found at the end
            q, e = q[::-1], e[::-1]
        shift = below(q, e) * (1 - 8 * EPS * len(q))
        while (step := dqds(q, e, shift)) is None:
            shift = shift / 2 if shift > EPS * EPS * q[-1] else 0.0
        (q, e), done = step, done + shift
    return sorted(out, reverse=True)


def twisted(a: np.ndarray, b: np.ndarray, value: float, others: list[np.ndarray]) -> np.ndarray:
    """Unit eigenvector of B^T B at `value`, orthogonal to `others` (those of values close by).

    The products that stand for B^T B - value are factored from the top and from the bottom; where the two meet with the
    smallest remainder, the vector is largest, and it follows outwards from there by multiplications alone.
    """
    n = len(a)
    if n == 1:
        return np.ones(1)
    tiny = EPS * EPS * max(value, 1e-300)
    big, low = a * a, b / a[:-1]
    down, up = np.empty(n), np.empty(n)
    s, lows = np.empty(n), np.empty(n - 1)
    for _ in range(3):
        s[0] = -value
        for k in range(n - 1):
            down[k] = s[k] + big[k] or tiny
            lows[k] = big[k] * low[k] / down[k]
            s[k + 1] = lows[k] * low[k] * s[k] - value
        p, ups = big[-1] - value, np.empty(n - 1)
        left = np.empty(n)
        left[-1] = p
        for k in range(n - 2, -1, -1):
            up[k + 1] = big[k] * low[k] ** 2 + left[k + 1] or tiny
            t = big[k] / up[k + 1]
            ups[k] = low[k] * t
            left[k] = left[k + 1] * t - value
        rest = s + left + value
        best, gain = None, np.inf
        for r in np.argsort(np.abs(rest))[:1 + 2 * len(others)]:
            z = np.zeros(n)
            z[r] = 1
            for k in range(r - 1, -1, -1):
                z[k] = -lows[k] * z[k + 1]
            for k in range(r, n - 1):
                z[k + 1] = -ups[k] * z[k]
            whole_length = np.linalg.norm(z)
            step = rest[r] / whole_length ** 2
            z /= whole_length
            for _ in range(2):
                for o in others:
                    z -= o * (o @ z)
            kept = np.linalg.norm(z)
            if best is None or kept > gain:
                best, gain = (z / kept if kept else z, step), kept
            if kept > 0.5:
                break
        if others or abs(best[1]) <= 4 * EPS * value:
            break
        value += best[1]  # Rayleigh's correction
    return best[0]


def leading(r: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """(singular values, right directions as columns) of r, the largest `components` that are not zero to rounding."""
    dims = r.shape[1]
    size = np.abs(r).max(initial=0)
    if not size:
        return np.zeros(0), np.zeros((dims, 0))
    full = np.zeros((dims, dims))
    full[:len(r)] = r / size
    a, b, right = bidiagonal(full)
    a = np.where(np.abs(a) < 1e-60, 1e-60, a)  # far below rounding, so that nothing is divided by zero
    cut = [0, *(np.flatnonzero(np.abs(b) <= EPS / 16 * np.abs(full).max()) + 1), dims]
    found = [(v, lo, hi) for lo, hi in zip(cut, cut[1:]) for v in squares(a[lo:hi], b[lo:hi - 1])]
    found.sort(reverse=True)
    floor = (16 * dims * EPS) ** 2 * found[0][0]
    kept: list[tuple[float, int, np.ndarray]] = []
    for value, lo, hi in found[:components]:
        if value <= floor:
            break
        near = [z for v, at, z in kept if at == lo and v - value < 1e-6 * v]
        kept.append((value, lo, twisted(a[lo:hi], b[lo:hi - 1], value, near)))
    out = np.zeros((dims, len(kept)))
    for k, (_, lo, z) in enumerate(kept):
        wide = np.zeros(dims)
        wide[lo:lo + len(z)] = z
        v = unreflected(wide, right)
        out[:, k] = v * np.sign(v[np.abs(v).argmax()]) / np.linalg.norm(v)
    return np.sqrt([v for v, _, _ in kept]) * size, out


# ---- the operator


@dataclass
class Whitening:
    """What rows are whitened by; `explained` are shares of the total variance."""

    dims: int
    n: int
    sums: list[int]
    directions: np.ndarray
    scales: np.ndarray
    explained: list[float]

    def apply(self, x: np.ndarray) -> tuple[np.ndarray, list[int | None]]:
        d = differences(x, self.n, self.sums)
        return (d.astype(np.float64) / self.n) @ (self.directions / self.scales), deviations(d)


def usual_length(df: DataFrame, vector: str) -> int:
    """The commonest length of usable vectors, of equally common ones the largest; 0 without vectors."""
    row = df.where(usable(vector)).groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return row["d"] if row else 0


def fit(df: DataFrame, vector: str = "embedding", components: int = 8) -> Whitening | None:
    """Fitted to all usable vectors of the commonest length; None without any."""
    small_batches(df.sparkSession)
    dims = usual_length(df, vector)
    if not dims:
        return None

    def triangles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for x in blocks(batches, dims):
            one = reduced(x)
            state = joined(state, one) if state else one
        if state:
            yield state_batch(state)

    rows = df.where(usable(vector) & (F.size(vector) == dims)).select(F.col(vector).alias("_v"))
    n, s, r = folded(rows.mapInArrow(triangles, STATE), joined, "whitening-r")
    size, directions = leading(r, components)
    total = float((r / max(np.abs(r).max(initial=0), 1e-300)).ravel() @ (r / max(np.abs(r).max(initial=0), 1e-300)).ravel())
    share = (size / max(np.abs(r).max(initial=0), 1e-300)) ** 2 / total if total else size
    return Whitening(dims, n, s, directions, size / np.sqrt(n), [float(v) for v in share])


def whitened(df: DataFrame, vector: str = "embedding", components: int = 8) -> DataFrame:
    """Per usable row of `df`: row (all its columns, as a struct), n, deviation, whitened, explained and identity_error.

    A row takes part if its vector is not null and has no entry that is null, not finite or of 2^52 or more, and has the
    commonest length (of equally common lengths the largest); others are left out, as are empty vectors. Components whose
    variance is zero to rounding are left out, so there can be fewer than asked for, and none where all rows are equal.
    Repeated rows all count and get equal results. `deviation` is null where it exceeds a long. Directions point where
    their largest entry is positive. `identity_error` is measured on the projected rows. An empty table gives an empty
    result. Other columns are carried unread, whatever their names.
    """
    schema = f"row {df.select(F.struct(*df.columns).alias('row')).schema['row'].dataType.simpleString()}, n long, deviation long, whitened array<double>"
    model = fit(df, vector, components)
    dims, width = (model.dims, len(model.explained)) if model else (0, 0)
    rows = df.where(usable(vector) & (F.size(vector) == dims)).select(F.col(vector).alias("_v"), F.struct(*df.columns).alias("row"))

    def spreads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for x in blocks(batches, dims):
            one = spread(model.apply(x)[0])
            state = spread_together(state, one) if state else one
        if state:
            yield state_batch(state)

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                w, deviation = model.apply(matrix(b.column("_v"), dims))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, w.size + 1, width) if width else np.zeros(len(w) + 1), pa.int32()), pa.array(w.ravel(), pa.float64()))
                yield pa.RecordBatch.from_arrays(
                    [b.column("row"), pa.array(np.full(len(w), model.n), pa.int64()), pa.array(deviation, pa.int64()), lists],
                    ["row", "n", "deviation", "whitened"])

    error = 0.0
    if width:
        n, _, c = folded(rows.select("_v").mapInArrow(spreads, STATE), spread_together, "whitening-error")
        error = float(np.abs(c / n - np.eye(width)).max())
    out = rows.mapInArrow(projected, schema) if model else df.sparkSession.createDataFrame([], schema)
    return out.withColumns({"explained": F.array(*map(F.lit, model.explained if model else [])).cast("array<double>"), "identity_error": F.lit(error)})
