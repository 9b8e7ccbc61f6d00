"""Whitening of integer vectors by eigenvectors found with contour integrals.

The covariance is summed exactly, in integers around the floored mean, by tasks whose partial sums
have the size of one matrix. The matrix itself, as large as the vectors are wide whatever their
number, is cut into intervals of its spectrum by inertia counts. In each interval a quadrature over
a circle of complex shifted solves filters a random block down to the wanted eigenvectors, and
Rayleigh-Ritz takes them out of it. The counts say how many there must be, so none is missed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.llm.vectors import BLOCKS, BLOCKS_DDL, halves, magnitude, matrix, totals, usable

FACTOR = 64
SHIFT = 1_000_000
COMPONENTS = 32
#: Eigenvalues an interval may hold unless they are too close to be told apart.
TOGETHER = 8
#: Points of the quadrature on the upper half of the circle; the lower half is its mirror image.
POINTS = 8
TURNS = 20
#: Rows of one batch: bounds memory, never results.
ROWS = 16_384
LONGS = (1 << 63) - 1


@dataclass(frozen=True)
class Moments:
    """Number of vectors, exact sums per dimension and exact n^2 * covariance, as Python integers."""

    n: int
    sums: list[int]
    scatter: list[list[int]]

    @property
    def covariance(self) -> np.ndarray:
        return np.array([[float(Fraction(c, self.n * self.n)) for c in row] for row in self.scatter]).reshape(2 * (len(self.sums),))


def _blocks(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for whole in parts:
        for start in range(0, whole.num_rows, ROWS):
            part = whole.slice(start, ROWS)
            yield part, matrix(part, FACTOR) + SHIFT


def _summed(rows: DataFrame, numbers: int, start, add) -> list[int]:
    """Exact sums over all vectors: ``add`` counts a block into what ``start`` made, ``numbers`` Python integers."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = start()
        for _, x in _blocks(parts):
            held = held + add(x)
        cells = list(halves(held.tolist(), numbers))
        yield pa.RecordBatch.from_arrays([pa.array([c[0] for c in cells], pa.int64()), pa.array([c[1] for c in cells], pa.binary())], schema=BLOCKS)

    return totals(rows.select("v").mapInArrow(run, BLOCKS_DDL), numbers)


def moments(rows: DataFrame, width: int) -> Moments:
    """Two passes: the sums, then the products of what is left of each vector after the floored mean."""
    def start(numbers):
        return lambda: np.zeros(numbers, dtype=object)

    def plain(x: np.ndarray) -> np.ndarray:
        x = x if magnitude(x) * len(x) < 1 << 62 else x.astype(object)
        return np.array([len(x), *x.sum(axis=0).tolist()], dtype=object)

    n, *sums = _summed(rows, width + 1, start(width + 1), plain)
    if not n:
        return Moments(0, sums, [[0] * width for _ in range(width)])
    middle = [s // n for s in sums]

    def products(x: np.ndarray) -> np.ndarray:
        x = _minus(x, middle)
        # Every sum of products below 2^53 is exact in doubles, in any order.
        if x.dtype != object and magnitude(x) ** 2 * len(x) < 1 << 53:
            wide = x.astype(np.float64)
            found = (wide.T @ wide).astype(np.int64)
        else:
            wide = x.astype(object)
            found = wide.T @ wide
        return found.astype(object).ravel()

    found = _summed(rows, width * width, start(width * width), products)
    rest = [s - n * m for s, m in zip(sums, middle)]
    return Moments(n, sums, [[n * found[i * width + j] - rest[i] * rest[j] for j in range(width)] for i in range(width)])


def _minus(x: np.ndarray, middle: list[int]) -> np.ndarray:
    """x - middle, both of at most 2^62 and a little: as Python integers where a long might overflow."""
    large = magnitude(x) + max(map(abs, middle), default=0) >= 1 << 62
    return x.astype(object) - np.array(middle, dtype=object) if large else x - np.array(middle, dtype=np.int64).reshape(1, -1)


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a tridiagonal matrix of the same inertia for every shift (Householder)."""
    a = a.copy()
    size = len(a)
    for k in range(size - 2):
        x = a[k + 1:, k].copy()
        length = np.sqrt((x * x).sum())
        if not length or not np.any(x[1:]):
            continue
        x[0] += np.copysign(length, x[0])
        x /= np.sqrt((x * x).sum())
        own = a[k:, k + 1:] @ x
        a[k:, k + 1:] -= 2 * np.outer(own, x)
        own = x @ a[k + 1:, k:]
        a[k + 1:, k:] -= 2 * np.outer(x, own)
    return np.diag(a).copy(), np.diag(a, 1).copy()


def above(diagonal: np.ndarray, off: np.ndarray, shift: float) -> int:
    """Eigenvalues above ``shift``: the positive pivots of the shifted matrix (Sylvester's law of inertia)."""
    count, pivot = 0, 1.0
    tiny = np.finfo(float).tiny ** 0.5 + np.finfo(float).eps * (np.abs(off).max(initial=0.0) + abs(shift)) * 1e-3
    for k, d in enumerate(diagonal):
        pivot = d - shift - (off[k - 1] ** 2 / pivot if k else 0.0)
        if abs(pivot) < tiny:
            pivot = -tiny
        count += pivot > 0
    return count


def intervals(matrix: np.ndarray, wanted: int) -> list[tuple[float, float, int]]:
    """Intervals from the largest eigenvalue down, with their counts, that hold the ``wanted`` largest at least.

    An interval is halved until it holds ``TOGETHER`` or is too narrow to part its eigenvalues.
    """
    diagonal, off = tridiagonal(matrix)
    reach = float(np.abs(matrix).sum(axis=1).max())
    narrow = 1e-9 * reach
    waiting, out, held = [(-0.01 * reach, 1.01 * reach, len(matrix))], [], 0
    while waiting and held < wanted:
        low, high, count = waiting.pop()
        if not count:
            continue
        if count <= TOGETHER or high - low <= narrow:
            out.append((low, high, count))
            held += count
            continue
        cuts = [low + f * (high - low) for f in (0.5, 0.46, 0.54, 0.42, 0.58)]
        # A cut that runs close by an eigenvalue would make both neighbours hard to part: take the clearest.
        middle = min(cuts, key=lambda c: above(diagonal, off, c - 1e-4 * (high - low)) - above(diagonal, off, c + 1e-4 * (high - low)))
        upper = above(diagonal, off, middle) - above(diagonal, off, high)
        waiting += [(low, middle, count - upper), (middle, high, upper)]
    return out


def eigenvectors(matrix: np.ndarray, low: float, high: float, count: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues in an interval and their unit vectors, as columns.

    Each turn filters the block by the contour integral of the resolvent and takes the Ritz pairs in
    the interval; the turns end when all of them are there with residuals of rounding size.
    """
    size = len(matrix)
    scale = float(np.abs(matrix).sum(axis=1).max())
    centre, radius = (low + high) / 2, (high - low) / 2
    nodes, weights = np.polynomial.legendre.leggauss(POINTS)
    turn = np.exp(1j * np.pi / 2 * (nodes + 1))
    block = np.random.default_rng(seed).normal(size=(size, min(size, 2 * count + 4)))
    best, stalled = np.inf, 0
    for _ in range(TURNS):
        filtered = np.zeros_like(block)
        for point, weight in zip(turn, weights):
            solved = np.linalg.solve((centre + radius * point) * np.eye(size) - matrix, block.astype(complex))
            filtered += weight / 2 * (radius * point * solved).real
        basis = np.linalg.qr(filtered)[0]
        values, inner = np.linalg.eigh(basis.T @ matrix @ basis)
        block = basis @ inner
        inside = np.flatnonzero((values > low) & (values <= high))
        if len(inside) > count:  # spurious pairs have large residuals
            left = np.abs(matrix @ block[:, inside] - block[:, inside] * values[inside]).max(axis=0)
            inside = inside[np.argsort(left, kind="stable")[:count]]
        found = values[inside], block[:, inside]
        left = float(np.abs(matrix @ found[1] - found[1] * found[0]).max(initial=0.0)) if len(inside) == count else np.inf
        stalled = 0 if left < best / 2 else stalled + 1
        best = min(best, left)
        if left <= 1e-15 * scale or (stalled > 1 and left <= 1e-10 * scale):
            return found
    if best > 1e-8 * scale:
        raise ArithmeticError(f"{count} eigenvalues between {low} and {high}, {len(inside)} found")
    return found


def principal(matrix: np.ndarray, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit vectors as columns; zero ones, up to rounding, are left out."""
    size = len(matrix)
    scale = float(np.abs(matrix).sum(axis=1).max(initial=0.0))
    if not scale:
        return np.empty(0), np.empty((size, 0))
    unit = matrix / scale
    found = [eigenvectors(unit, low, high, count, seed) for seed, (low, high, count) in enumerate(intervals(unit, wanted))]
    # One more Rayleigh-Ritz over all intervals makes vectors of neighbouring ones orthogonal to rounding.
    basis = np.linalg.qr(np.hstack([f[1] for f in found]))[0]
    values, inner = np.linalg.eigh(basis.T @ unit @ basis)
    order = [k for k in np.argsort(-values, kind="stable")[:wanted] if values[k] > 1e-13 * size]
    vectors = basis @ inner[:, order]
    vectors /= np.sqrt((vectors * vectors).sum(axis=0))
    return values[order] * scale, vectors


def whiten(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained`` and ``identity_error``.

    One row per usable row (``vectors.usable``) and component with a variance above rounding, at
    most 32: no rows where all vectors are equal, or none. Repeated rows and null ids give their
    rows each. Components of equal eigenvalue are some orthonormal basis of their space, the same
    for all rows. A deviation beyond the range of longs is null.
    """
    empty = "vec_id long, component int, n long, deviation long, whitened double, explained double"
    rows = usable(vectors, FACTOR, id, vector)
    first = rows.select(F.size("v").alias("width")).first()
    if first is None or not first.width:
        return vectors.sparkSession.createDataFrame([], empty + ", identity_error double")
    found = moments(rows, first.width)
    values, axes = principal(found.covariance)
    held = rows.sparkSession.sparkContext.broadcast((found.n, found.sums, axes / np.sqrt(values)))
    kept = len(values)
    if not kept:
        return vectors.sparkSession.createDataFrame([], empty + ", identity_error double")
    share = (values / (sum(found.scatter[i][i] for i in range(first.width)) / found.n ** 2)).tolist()
    fields = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()),
                        ("whitened", pa.float64()), ("explained", pa.float64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = held.value[0]
        for part, x in _blocks(parts):
            white, deviation = project(x, *held.value)
            count = len(x)
            yield pa.RecordBatch.from_arrays([
                part.column("vec_id").take(pa.array(np.repeat(np.arange(count), kept))),
                pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), count)), pa.array(np.full(count * kept, n)),
                pa.array(deviation, pa.int64()).take(pa.array(np.repeat(np.arange(count), kept))),
                pa.array(white.ravel()), pa.array(np.tile(np.array(share), count))], schema=fields)

    return rows.mapInArrow(run, empty).withColumn("identity_error", F.lit(_identity_error(rows, held, kept, found.n)))


def project(x: np.ndarray, n: int, sums: list[int], axes: np.ndarray) -> tuple[np.ndarray, list[int | None]]:
    """Whitened coordinates of integer vectors, and their exact deviations (null beyond longs)."""
    middle = [s // n for s in sums]
    rest = [s - n * m for s, m in zip(sums, middle)]
    x = _minus(x, middle)
    largest = (magnitude(x) + 1) * n
    far = x * n - np.array(rest, dtype=np.int64) if x.dtype != object and largest ** 2 * x.shape[1] <= LONGS else \
        x.astype(object) * n - np.array(rest, dtype=object)
    deviation = [d if d <= LONGS else None for d in (far * far).sum(axis=1).tolist()]
    return (far / n).astype(np.float64) @ axes, deviation


def _identity_error(rows: DataFrame, held, kept: int, n: int) -> float:
    """Largest entry of the covariance of the whitened rows minus the identity, from one more pass."""
    out = pa.schema([("cell", pa.int32()), ("value", pa.float64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, products = np.zeros(kept), np.zeros((kept, kept))
        for _, x in _blocks(parts):
            white = project(x, *held.value)[0]
            sums += white.sum(axis=0)
            products += white.T @ white
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(kept * (kept + 1), dtype=np.int32)), pa.array(np.concatenate([sums, products.ravel()]))], schema=out)

    cells = rows.mapInArrow(run, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value")).collect()
    total = np.zeros(kept * (kept + 1))
    total[[c.cell for c in cells]] = [c.value for c in cells]
    mean = total[:kept] / n
    return float(np.abs(total[kept:].reshape(kept, kept) / n - np.outer(mean, mean) - np.eye(kept)).max())
