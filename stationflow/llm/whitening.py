"""Whitening of embeddings by contour integration.

Components are scaled and shifted to whole numbers x, as the caller says. All that
is summed over the vectors is summed in whole numbers, so the covariance is exact
before it is rounded once, whatever the order of the tasks:

1. n and the sums S of x.
2. With m, the mean rounded to whole numbers, the products of x - m; with
   s = S - n m they give n (x-m)'(x-m) - s's, n squared times the covariance V.
   A task gives one row for each pair of dimensions, added up before the shuffle.
3. Principal components of V, on the driver: V has the square of the vectors' length
   as its size, however many vectors there are (see ``principal``).
4. The covariance of the whitened vectors, for ``identity_error``.
5. The rows, computed where the vectors are read: no vector is shuffled or kept.

``principal`` is the FEAST method. V is made tridiagonal once, by reflections; the
signs of the pivots of T - t then count the eigenvalues over any t (inertia). Such
counts cut the upper end of the spectrum into intervals of few eigenvalues. For each
one a circle around it is integrated by Gauss-Legendre quadrature: solves with the
complex shifted V turn a block of random vectors into their projection on the
interval's eigenvectors, Rayleigh-Ritz extracts these, and the step is repeated until
nothing is left of the residual. An interval is accepted with as many eigenvalues as
its inertia counts say; until then its block grows. The parts are joined by a last
Rayleigh-Ritz step, whose number of values over the lowest cut is held against the
inertia too.

A vector that is null or has null or non-finite components takes no part and gets
no rows; so does one whose length is not that of most vectors. Repeated rows and
ids each count and are returned, a null id as null. Equal eigenvalues have any
basis of their space, the same for all rows. Components whose eigenvalue is zero to
rounding have no whitened coordinate and give no rows; so one vector, or equal ones,
give none. An empty table gives an empty result. Columns of other names, clashing or
not, aren't read. Whole numbers beyond 64 bits are an error, in ``deviation`` as well.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stationflow.llm.vectors import matrix, usable

#: Quadrature nodes on half a circle, eigenvalues in an interval, steps with one block.
NODES, SLICE, STEPS = 12, 8, 12
_EPS = np.finfo(float).eps
_CELLS = "cell int, high long, low long"


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = 32, scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error), a row for each vector and component."""
    kind = vectors.schema[id_col].dataType.simpleString()
    schema = f"_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows, dim = usable(vectors, vector_col, F.col(id_col).alias("_id"))
    as_numbers = functools.partial(_numbers, dim=dim, scale=scale, shift=shift)
    *sums, n = _added(rows, lambda batches: _sums(batches, as_numbers, dim), dim + 1) if dim else [0]
    middle = [round_half(a, n) for a in sums] if n else []
    rest = [a - n * m for a, m in zip(sums, middle, strict=True)] if n else []
    values, axes, total = np.zeros(0), np.zeros((dim, 0)), 0.0
    if n:
        upper = [(i, j) for i in range(dim) for j in range(i, dim)]
        products = _added(rows, lambda batches: _products(batches, as_numbers, middle), len(upper))
        v = np.empty((dim, dim))
        for (i, j), p in zip(upper, products, strict=True):
            v[i, j] = v[j, i] = (n * p - rest[i] * rest[j]) / (n * n)
        values, axes = principal(v, most)
        total = sum(n * products[k] - rest[i] * rest[i] for k, (i, j) in enumerate(upper) if i == j) / (n * n)
    if not len(values):
        return vectors.sparkSession.createDataFrame([], schema).withColumnRenamed("_id", id_col)
    project = functools.partial(_whitened, dim=dim, n=n, rest=rest, axes=axes / np.sqrt(values))
    residue = _identity_error(rows, as_numbers, middle, project, n, len(values))
    explained = values / total

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = as_numbers(batch["_v"], minus=middle)
            k = len(values)
            yield pa.RecordBatch.from_arrays([
                batch["_id"].take(pa.array(np.repeat(np.arange(len(z)), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(z))),
                pa.array(np.full(len(z) * k, n)), pa.array(_deviation(z, n, rest)).take(pa.array(np.repeat(np.arange(len(z)), k))),
                pa.array(project(z).ravel()), pa.array(np.tile(explained, len(z))), pa.array(np.full(len(z) * k, residue)),
            ], names=["_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(out, schema).withColumnRenamed("_id", id_col)


def round_half(a: int, n: int) -> int:
    """a / n rounded to a whole number, exactly."""
    return (2 * a + n) // (2 * n)


def _numbers(column: pa.Array, dim: int, scale: int, shift: int, minus: list[int] | None = None) -> np.ndarray:
    """The whole numbers of a batch's vectors, less ``minus``."""
    x = np.floor(scale * matrix(column, dim))
    if len(x) and np.abs(x).max() >= 2.0**62:
        raise OverflowError("a component is beyond 64 bits")
    x = x.astype(np.int64)
    return x + shift if minus is None else x - (np.array(minus) - shift)


def _added(rows: DataFrame, task: Callable, cells: int) -> list[int]:
    """Sums of whole numbers of any size, as each task gives them in two parts."""
    found = rows.mapInArrow(lambda batches: _parts(task(batches)), _CELLS).groupBy("cell").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
    out = [0] * cells
    for cell, high, low in found.collect():
        out[cell] = (high << 32) + low
    return out


def _parts(values: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    if values is not None:
        high, low = [int(x) >> 32 for x in values], [int(x) & 0xFFFFFFFF for x in values]
        yield pa.RecordBatch.from_pydict({"cell": pa.array(range(len(values)), pa.int32()), "high": pa.array(high, pa.int64()), "low": pa.array(low, pa.int64())})


def _sums(batches: Iterator[pa.RecordBatch], as_numbers: Callable, dim: int) -> np.ndarray | None:
    total = None
    for batch in batches:
        x = as_numbers(batch["_v"])
        if len(x):
            total = np.zeros(dim + 1, object) if total is None else total
            small = float(np.abs(x).max()) * len(x) < 2.0**62
            total[:dim] += (x.sum(0) if small else x.astype(object).sum(0)).astype(object)
            total[dim] += len(x)
    return total


def _products(batches: Iterator[pa.RecordBatch], as_numbers: Callable, middle: list[int]) -> np.ndarray | None:
    """Sums of the products of two dimensions, in doubles as far as these are exact."""
    total = None
    upper = np.triu_indices(len(middle))
    for batch in batches:
        z = as_numbers(batch["_v"], minus=middle)
        if not len(z):
            continue
        total = np.zeros(len(upper[0]), object) if total is None else total
        most = max(1, int(np.abs(z).max()))
        block = 2**53 // most**2
        if not block:
            total += (z.astype(object).T @ z.astype(object))[upper]
            continue
        for at in range(0, len(z), block):
            part = z[at : at + block].astype(float)
            total += (part.T @ part)[upper].astype(np.int64).astype(object)
    return total


def _deviation(z: np.ndarray, n: int, rest: list[int]) -> np.ndarray:
    """The sum of (n x - S) squared of each row."""
    most = n * int(np.abs(z).max(initial=0)) + max(abs(r) for r in rest)
    if len(rest) * most**2 < 2**63:
        return ((n * z - np.array(rest)) ** 2).sum(1)
    exact = ((n * z.astype(object) - np.array(rest, object)) ** 2).sum(1)
    if max(exact, default=0) >= 2**63:
        raise OverflowError("a deviation is beyond 64 bits")
    return exact.astype(np.int64)


def _whitened(z: np.ndarray, dim: int, n: int, rest: list[int], axes: np.ndarray) -> np.ndarray:
    return (z - np.array([r / n for r in rest])) @ axes


def _identity_error(rows: DataFrame, as_numbers: Callable, middle: list[int], project: Callable, n: int, k: int) -> float:
    """The largest entry of the whitened vectors' covariance less the identity."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            w = project(as_numbers(batch["_v"], minus=middle))
            total += np.concatenate([w.T @ w, w.sum(0)[None]])
        yield pa.RecordBatch.from_pydict({"cell": np.arange(total.size, dtype=np.int32), "value": total.ravel()})

    found = rows.mapInArrow(task, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value")).toArrow()
    total = np.empty((k + 1) * k)
    total[found["cell"].to_numpy()] = found["value"].to_numpy()
    total = total.reshape(k + 1, k) / n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())


def principal(v: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest eigenvalues over zero, falling, and their unit eigenvectors, of a symmetric matrix.

    An eigenvector's largest component is positive.
    """
    size = float(np.abs(v).sum(1).max(initial=0.0))
    floor = 16 * len(v) * _EPS * size
    if not size:
        return np.zeros(0), np.zeros((len(v), 0))
    above = _inertia(v)
    want = min(most, above(floor))
    if not want:
        return np.zeros(0), np.zeros((len(v), 0))
    cuts = _cuts(above, want, floor, size * (1 + 1e-9))
    found = [_feast(v, low, high, above(low) - above(high), size) for high, low in zip(cuts[:-1], cuts[1:], strict=True)]
    values, axes = _ritz(v, np.concatenate(found, axis=1))
    if np.count_nonzero(values > cuts[-1]) != above(cuts[-1]):
        raise ArithmeticError("the number of eigenvalues found differs from the inertia")
    values, axes = values[:want], axes[:, :want]
    return values, axes * np.where(axes[np.abs(axes).argmax(0), np.arange(want)] < 0, -1.0, 1.0)


def _inertia(v: np.ndarray) -> Callable[[float], int]:
    """How many eigenvalues lie over a value: the signs of the pivots of the shifted tridiagonal form."""
    a = np.array(v)
    for k in range(len(a) - 2):
        x = a[k + 1 :, k].copy()
        x[0] += math.copysign(float(np.linalg.norm(x)), x[0])
        length = float(np.linalg.norm(x))
        if not length:
            continue
        u = x / length
        part = a[k + 1 :, k + 1 :]
        p = part @ u
        q = 2 * (p - u * (u @ p))
        part -= np.outer(u, q) + np.outer(q, u)
        a[k + 1 :, k] -= 2 * u * (u @ a[k + 1 :, k])
        a[k, k + 1 :] = a[k + 1 :, k]
    diagonal, squares = np.diag(a).tolist(), (np.diag(a, -1) ** 2).tolist()
    tiny = _EPS * max(_EPS, max(map(abs, diagonal)) + math.sqrt(max(squares, default=0.0)))

    def above(at: float) -> int:
        count, pivot = 0, 1.0
        for d, s in zip(diagonal, [0.0, *squares], strict=True):
            pivot = d - at - s / pivot
            if abs(pivot) < tiny:
                pivot = -tiny
            count += pivot > 0
        return count

    return above


def _cuts(above: Callable[[float], int], want: int, floor: float, top: float) -> list[float]:
    """Values from ``top`` down, with about SLICE eigenvalues between two of them and ``want`` or more over the last.

    Each cut halves what is known to hold the place where it must lie. Eigenvalues
    too close to be parted stay in one interval, however many they are.
    """
    cuts, done = [top], 0
    while done < want:
        goal = min(done + SLICE, want)
        low, high = floor, cuts[-1]
        while above(low) > goal and high - low > 1e-9 * top:
            middle = (low + high) / 2
            low, high = (low, middle) if above(middle) < min(done + max(1, SLICE // 2), goal) else (middle, high)
            if done + max(1, SLICE // 2) <= above(low) <= goal and (goal < want or above(low) == goal):
                break
        cuts.append(low)
        done = above(low)
    return cuts


def _ritz(v: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues and vectors of ``v`` on the space of ``block``."""
    u, scales, _ = np.linalg.svd(block, full_matrices=False)
    q = u[:, scales > scales[0] * len(v) * _EPS]
    q = np.linalg.qr(q)[0]
    small = q.T @ v @ q
    values, inner = np.linalg.eigh((small + small.T) / 2)
    return values[::-1], (q @ inner)[:, ::-1]


def _feast(v: np.ndarray, low: float, high: float, count: int, size: float) -> np.ndarray:
    """The eigenvectors whose values lie between ``low`` and ``high``, ``count`` by their inertia."""
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    turns = np.exp(0.5j * math.pi * (nodes + 1))
    centre, radius = (low + high) / 2, (high - low) / 2
    identity = np.eye(len(v))
    width = min(len(v), count + max(8, count // 2))
    dealt = np.random.default_rng(12)
    block = dealt.standard_normal((len(v), width))
    while True:
        for _ in range(STEPS):
            projected = np.zeros((len(v), block.shape[1]))
            for turn, weight in zip(turns, weights, strict=True):
                solved = np.linalg.solve((centre + radius * turn) * identity - v, block.astype(complex))
                projected += weight / 2 * (radius * turn * solved).real
            values, axes = _ritz(v, projected)
            inside = (values > low) & (values <= high)
            chosen = axes[:, inside]
            residual = np.abs(v @ chosen - chosen * values[inside]).max(initial=0.0)
            if inside.sum() == count and residual <= 64 * _EPS * size:
                return chosen
            block = axes
        if block.shape[1] >= len(v):
            raise ArithmeticError(f"{count} eigenvalues by inertia, {int(inside.sum())} found, residual {residual}")
        block = np.concatenate([block, dealt.standard_normal((len(v), min(len(v), 2 * width) - block.shape[1]))], axis=1)
        width = block.shape[1]
