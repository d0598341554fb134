"""Whitening of embeddings: principal components by contour integration (FEAST).

*Entries.*  An entry c becomes the integer ``floor(SCALE * c) + OFFSET``, so counts
and sums are exact and don't depend on the order of the rows.  The covariance is
summed over entries less the rounded mean (integers again), one matrix a task,
added up per cell; only the d x d result reaches the driver.

*Slices.*  Householder reflections bring the covariance to tridiagonal form once.
The signs of the pivots of its shifted LDL^T factors (Sylvester's law of inertia)
count the eigenvalues above any shift; bisection on these counts finds shifts that
part the wanted eigenvalues into slices of at most ``SLICE_VALUES``.

*Contours.*  Each slice is a task: a circle through its two shifts, Gauss-Legendre
quadrature of the solves ``(z I - V) X = Y`` at complex shifts ``z`` projects a block
``Y`` onto the slice's eigenvectors; Rayleigh-Ritz on the projected block gives
eigenpairs, and the block is projected again until residuals are at rounding error.
A slice must return as many eigenvalues as its inertia count, else it is done
again with a wider block, and at last it is an error: none can be missed.

*Whitening.*  The centred rows times components over the roots of their eigenvalues.
``identity_error`` is measured on the whitened rows of the whole table.

No part take: rows whose vector is null, empty or holds null or non-finite entries
(or entries beyond 2**56, whose integers no long can hold), and vectors whose
length isn't that of most (ties: the smaller length).  Rows without an id stay, with
a null id; repeated rows count each.  Components whose eigenvalue is zero to rounding
error (constant or dependent dimensions, fewer rows than dimensions) don't exist: a
table of equal rows has none, and like an empty table gives an empty result.  Equal
eigenvalues take any orthonormal basis of their space.  Extra columns are not read.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The integers of entries.
SCALE, OFFSET = 64, 1_000_000

COMPONENTS = 32
SLICE_VALUES = 8            # eigenvalues wanted per contour
SLICE_SPAN = 4              # largest over smallest eigenvalue of a contour
NODES = 8                   # quadrature nodes on a half circle
ROUNDS = 40
ROWS = 1024                 # rows whitened at a time


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vec) of the rows that take part, all of one length."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vec")) \
        .where(F.col("vec").isNotNull() & (F.size("vec") > 0)
               & F.forall("vec", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float(1 << 56))))
    sizes = rows.groupBy(F.size("vec").alias("size")).count().orderBy(F.desc("count"), "size").first()
    return rows.where(F.size("vec") == sizes["size"]) if sizes else rows.where("false")


def entries(column: pa.Array) -> np.ndarray:
    """The integers of a batch of vectors."""
    c = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    return np.floor(c * SCALE).astype(np.int64) + OFFSET


def _batches(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def _sums(batches):
    """(i, count, sum) per dimension, one set a task; sums as digits."""
    n, total = 0, None
    for part in _batches(batches):
        x = entries(part.column(1))
        fits = int(np.abs(x).max()) < (1 << 62) // ROWS
        sums = x.sum(axis=0).tolist() if fits else x.astype(object).sum(axis=0).tolist()
        total = sums if total is None else [a + b for a, b in zip(total, sums, strict=True)]
        n += part.num_rows
    if n:
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array([n] * len(total), pa.int64()),
                                          pa.array([str(t) for t in total])], ["i", "n", "sum"])


class Moments:
    """Count, exact sums and covariance of the entries."""

    def __init__(self, rows: DataFrame):
        found = rows.select("vec_id", "vec").mapInArrow(_sums, "i int, n long, sum string") \
            .groupBy("i").agg(F.sum("n").alias("n"), F.sum(F.col("sum").cast("decimal(38,0)")).alias("sum")) \
            .orderBy("i").collect()
        self.n = found[0]["n"] if found else 0
        if not self.n:
            return
        self.sums = [int(r["sum"]) for r in found]
        self.near = np.array([round(Fraction(s, self.n)) for s in self.sums], np.int64)
        # what the rounded means leave: sums less n times them, exactly
        self.rest = [s - self.n * int(m) for s, m in zip(self.sums, self.near, strict=True)]
        self.shift = np.array([float(Fraction(r, self.n)) for r in self.rest])
        around = second_moment(rows, self.centred, len(self.sums)) / self.n
        self.covariance = around - np.outer(self.shift, self.shift)

    def centred(self, column: pa.Array) -> np.ndarray:
        return (entries(column) - self.near).astype(float)

    def deviations(self, column: pa.Array) -> list[int]:
        """Exact sums over the dimensions of (n x - S)^2."""
        y = entries(column) - self.near
        most, rest = int(np.abs(y).max()), max(abs(r) for r in self.rest)
        if most * max(most, rest) * len(self.rest) < 1 << 62:
            squares = (y * y).sum(axis=1).tolist()
            mixed = (y * np.array(self.rest, np.int64)).sum(axis=1).tolist()
        else:
            y = y.astype(object)
            squares, mixed = (y * y).sum(axis=1).tolist(), (y * np.array(self.rest, object)).sum(axis=1).tolist()
        alone = sum(r * r for r in self.rest)
        return [self.n * self.n * s - 2 * self.n * m + alone for s, m in zip(squares, mixed, strict=True)]


def second_moment(rows: DataFrame, of, size: int) -> np.ndarray:
    """Sum over the rows of the outer product of ``of(vectors)``, a matrix per task
    added up per cell; ``size`` x ``size`` numbers come to the driver."""
    def per_task(batches):
        total = None
        for part in _batches(batches):
            y = of(part.column(1))
            total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])],
                                             ["i", "j", "v"])
    cells = rows.select("vec_id", "vec").mapInArrow(per_task, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = np.zeros((size, size))
    for r in cells.collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["v"]
    return out


def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of an orthogonally similar tridiagonal matrix."""
    a = v.copy()
    for k in range(len(a) - 2):
        x = a[k + 1:, k].copy()
        length = np.linalg.norm(x)
        if length == 0 or np.linalg.norm(x[1:]) == 0:
            continue
        x[0] += np.copysign(length, x[0])
        x /= np.linalg.norm(x)
        a[k + 1:, k:] -= 2 * np.outer(x, x @ a[k + 1:, k:])
        a[k:, k + 1:] -= 2 * np.outer(a[k:, k + 1:] @ x, x)
    return np.diag(a).copy(), np.diag(a, -1).copy()


class Inertia:
    """How many eigenvalues lie above a shift."""

    def __init__(self, v: np.ndarray):
        self.diagonal, self.off = tridiagonal(v)
        reach = np.abs(np.append(self.off, 0)) + np.abs(np.append(0, self.off))
        self.top = float((self.diagonal + reach).max()) * (1 + 1e-12) + 1e-300
        self.tiny = np.finfo(float).eps * max(self.top, 1e-290)

    def above(self, shift: float) -> int:
        count, pivot = 0, 1.0
        for i, d in enumerate(self.diagonal):
            pivot = d - shift - (self.off[i - 1] ** 2 / pivot if i else 0.0)
            if abs(pivot) < self.tiny * 1e-3:
                pivot = -self.tiny * 1e-3
            count += pivot > 0
        return int(count)

    def gap(self, k: int, low: float, high: float) -> tuple[float, float]:
        """(a, b) near the ends of the gap below the k-th eigenvalue, each with k
        eigenvalues above it; where the k-th equals the next one to rounding error,
        the gap below all that equal it."""
        floor = low
        while True:
            middle = (low + high) / 2
            found = self.above(middle)
            if found == k:
                break
            low, high = (middle, high) if found > k else (low, middle)
            if high - low <= 64 * self.tiny:
                width = high - low
                while low > floor and self.above(low) != self.above(low - width):
                    low, width = low - width, 2 * width
                middle, low, high, k = low - width / 2, low - width, low, self.above(low)
                if middle <= floor:
                    return floor, floor
                low = floor
                break
        a = b = middle
        step = 0
        while step < 10 or a > 1.1 * low or high > 1.1 * b:     # widen to both sides
            step, down, up = step + 1, (low * a) ** 0.5, (b * high) ** 0.5
            a, low = (down, low) if self.above(down) == k else (a, down)
            b, high = (up, high) if self.above(up) == k else (b, up)
        return a, b


def slices(v: np.ndarray, k: int) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues between) of contours that hold the k largest.  A
    slice spans at most a factor of ``SLICE_SPAN``, so that its circle parts small
    eigenvalues from each other too."""
    inertia = Inertia(v)
    floor = len(v) * 8 * inertia.tiny
    rank = inertia.above(floor)
    out, done = [], 0
    a, b = inertia.gap(0, floor, 2 * inertia.top) if rank else (0.0, 0.0)
    while done < min(k, rank):
        high = min((a + b) / 2, 1.25 * a)
        want = min(k, rank, done + SLICE_VALUES, max(done + 1, inertia.above(high / SLICE_SPAN)))
        a, b = inertia.gap(want, floor / 2, high) if want < rank else (floor / 2, floor)
        low = max((a + b) / 2, b / 1.25)
        found = inertia.above(low)
        out.append((float(low), float(high), found - done))
        done = found
    return out


def contour(v: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in (low, high), largest first, and their unit eigenvectors as
    columns; ``count`` of them are known to be there."""
    size = len(v)
    scale = np.abs(v).sum(axis=1).max()
    x, weight = np.polynomial.legendre.leggauss(NODES)
    turn = np.exp(1j * np.pi / 2 * (1 + x))
    centre, radius = (low + high) / 2, (high - low) / 2
    shifted = [(centre + radius * t) * np.eye(size) - v for t in turn]
    for wider in range(1, 5):
        block = min(size, (1 + wider) * count + 4 * wider)
        y = np.random.Generator(np.random.PCG64(size * 1000 + block)).standard_normal((size, block))
        before = np.inf
        for _ in range(ROUNDS):
            projected = sum(w / 2 * np.real(radius * t * np.linalg.solve(z, y))
                            for w, t, z in zip(weight, turn, shifted, strict=True))
            q, _ = np.linalg.qr(projected)
            values, small = np.linalg.eigh(q.T @ v @ q)
            y = q @ small
            inside = np.flatnonzero((values > low) & (values < high))
            if len(inside) < count:
                continue
            left = np.linalg.norm(v @ y[:, inside] - y[:, inside] * values[inside], axis=0)
            worst = np.sort(left)[:count].max()
            # spurious values inside have large residuals; go on until rounding error stops the progress
            if worst <= 1e-13 * scale and (worst >= before / 2 or worst <= 1e-15 * scale):
                best = np.sort(inside[np.argsort(left)[:count]])[::-1]
                return values[best], y[:, best]
            before = min(before, worst)
    raise ArithmeticError(f"fewer than the {count} eigenvalues between {low} and {high} that inertia counts")


def components(spark: SparkSession, v: np.ndarray, k: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues and unit eigenvectors (columns; the largest entry
    of each is positive), a contour per task."""
    parts = slices(v, k)
    if not parts:
        return np.zeros(0), np.zeros((len(v), 0))
    shared = spark.sparkContext.broadcast(v)

    def solve(frames):
        for frame in frames:
            for low, high, count in frame.itertuples(index=False):
                values, vectors = contour(shared.value, low, high, int(count))
                yield pd.DataFrame({"value": values, "vector": list(vectors.T)})

    found = spark.createDataFrame(parts, "low double, high double, count int").repartition(len(parts)) \
        .mapInPandas(solve, "value double, vector array<double>").orderBy(F.desc("value")).limit(k).collect()
    values = np.array([r["value"] for r in found])
    vectors = np.array([r["vector"] for r in found]).T
    return values, vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))])


WHITENED = "vec_id long, component int, n long, deviation long, whitened double, explained double, " \
           "identity_error double, deviation_digits string"


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = COMPONENTS) -> DataFrame:
    """One row per vector and component (``WHITENED``).  ``deviation`` is null where a
    long can't hold it; ``deviation_digits`` then has its digits."""
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col)
    moments = Moments(rows)
    values, basis = components(spark, moments.covariance, k) if moments.n else (np.zeros(0), None)
    if not len(values):
        return spark.createDataFrame([], WHITENED)
    explained = values / np.trace(moments.covariance)
    number = len(values)

    def white(column):
        return (moments.centred(column) - moments.shift) @ basis / np.sqrt(values)

    identity = second_moment(rows, white, number) / moments.n
    error = float(np.abs(identity - np.eye(number)).max())

    def run(batches):
        for part in _batches(batches):
            if not part.num_rows:
                continue
            exact = moments.deviations(part.column(1))
            fits = [d if d < 1 << 63 else None for d in exact]
            digits = [None if d < 1 << 63 else str(d) for d in exact]
            each = pa.array(np.repeat(np.arange(part.num_rows), number))
            size = part.num_rows * number
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(each), pa.array(np.tile(np.arange(1, number + 1, dtype=np.int32), part.num_rows)),
                 pa.array(np.full(size, moments.n)), pa.array(fits, pa.int64()).take(each),
                 pa.array(white(part.column(1)).ravel()), pa.array(np.tile(explained, part.num_rows)),
                 pa.array(np.full(size, error)), pa.array(digits, pa.string()).take(each)],
                [f.split()[0] for f in WHITENED.split(", ")])

    return rows.select("vec_id", "vec").mapInArrow(run, WHITENED)
