"""Embedding whitening with FEAST: contour integration, Rayleigh-Ritz, inertia counts.

Entries become whole numbers, whose sums are exact, and the covariance is summed from rows centred first, as partial sums per task. Its
eigenvectors come from contour integrals: a circle around an interval of eigenvalues, Gauss-Legendre points on it, and at each a complex solve with
the shifted covariance; their weighted sum projects a block of vectors onto the eigenvectors inside. Rayleigh-Ritz on the projected
block extracts them, and the block goes round again until residuals vanish. How many eigenvalues an interval holds is known beforehand from
the inertia of the shifted covariance (negative pivots, counted on its tridiagonal form), which also chooses the intervals; an interval is
done only when it has found as many. A last Rayleigh-Ritz over all intervals makes their vectors orthogonal to each other.

Spark does what grows with the rows (sums, covariance, projection, the check of the result); the solves are on a matrix of the vectors' dimension
and run on the driver. Nothing else reaches it.

Defined cases: vectors that are NULL, empty, or hold NULL or non-finite entries are dropped, and so are those with an entry beyond
`LARGEST`, whose whole numbers would not be exact. Vectors of each length are a fit list of their own. Components whose eigenvalue is zero to
working precision are left out, so there may be fewer than asked for, and none for one vector or equal ones. A deviation that no long can
hold is NULL. Eigenvalues that agree have any basis, the same for all rows; signs are such that a component's largest entry is positive.
Repeated rows and NULL ids are rows like any other. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetloom.llm.common import staged

COMPONENTS = 32
SCALE = 64
OFFSET = 1_000_000
LARGEST = float(1 << 40)
#: Points on half a circle, eigenvalues wanted in an interval, rounds before an interval counts as failed.
POINTS = 8
PER_INTERVAL = 8
ROUNDS = 40


# --- Eigenvectors of a symmetric matrix -------------------------------------------------------------------------------------------


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and side diagonal of a tridiagonal matrix with the same inertia for every shift, by Householder reflections."""
    a = np.array(matrix, dtype=np.float64)
    for k in range(len(a) - 2):
        v = a[k + 1 :, k].copy()
        norm = np.linalg.norm(v)
        if norm == 0:
            continue
        v[0] += np.copysign(norm, v[0])
        v /= np.linalg.norm(v)
        a[k + 1 :] -= 2 * np.outer(v, v @ a[k + 1 :])
        a[:, k + 1 :] -= 2 * np.outer(a[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, -1).copy()


def count_below(diagonal: np.ndarray, side: np.ndarray, shift: float) -> int:
    """Eigenvalues below `shift`: negative pivots of the shifted matrix."""
    tiny = np.finfo(float).tiny ** 0.5
    pivot, found = 1.0, 0
    for i, d in enumerate(diagonal.tolist()):
        pivot = d - shift - (float(side[i - 1]) ** 2 / pivot if i else 0.0)
        if abs(pivot) < tiny:
            pivot = -tiny
        found += pivot < 0
    return found


class Spectrum:
    """Inertia counts of a symmetric matrix, and intervals chosen by them."""

    def __init__(self, matrix: np.ndarray):
        self.form = tridiagonal(matrix)
        diagonal, side = self.form
        reach = np.abs(np.concatenate([side, [0.0]])) + np.abs(np.concatenate([[0.0], side]))
        self.scale = float(np.max(np.abs(diagonal) + reach))
        self.top = float(np.max(diagonal + reach)) + 1e-3 * self.scale
        self.bottom = float(np.min(diagonal - reach)) - 1e-3 * self.scale

    def above(self, shift: float) -> int:
        return len(self.form[0]) - count_below(*self.form, shift)

    def cut(self, low: float, high: float) -> float | None:
        """A point between that is clear of eigenvalues, near the middle if possible."""
        clear = 1e-9 * self.scale
        for part in (0.5, 0.4, 0.6, 0.3, 0.7, 0.2, 0.8, 0.1, 0.9):
            at = low + part * (high - low)
            if at - low > 2 * clear and high - at > 2 * clear and self.above(at - clear) == self.above(at + clear):
                return at
        return None

    def floor_of(self, wanted: int) -> float:
        """A bound with at least `wanted` eigenvalues above it, few more if it can be."""
        low, high = self.bottom, self.top
        while self.above(low) > wanted:
            at = self.cut(low, high)
            if at is None:
                break
            low, high = (at, high) if self.above(at) >= wanted else (low, at)
        return low

    def intervals(self, low: float, high: float, most: int) -> list[tuple[float, float, int]]:
        """(low, high, eigenvalues) with at most `most` eigenvalues each, more only where they lie too close to be parted."""
        done, left = [], [(low, high)]
        while left:
            low, high = left.pop()
            inside = self.above(low) - self.above(high)
            at = self.cut(low, high) if inside > most else None
            if at is not None:
                left += [(low, at), (at, high)]
            elif inside:
                done.append((low, high, inside))
        return done


def project(matrix: np.ndarray, block: np.ndarray, low: float, high: float, points: int = POINTS) -> np.ndarray:
    """`block` projected on the eigenvectors of `matrix` with eigenvalues between, by the integral over a circle."""
    places, weights = np.polynomial.legendre.leggauss(points)
    radius, centre, whole = (high - low) / 2, (low + high) / 2, np.eye(len(matrix))
    total = np.zeros_like(block)
    for place, weight in zip(places, weights):
        turn = radius * np.exp(0.5j * np.pi * (1 - place))
        total += weight / 2 * (turn * np.linalg.solve((centre + turn) * whole - matrix, block.astype(complex))).real
    return total


def extract(matrix: np.ndarray, low: float, high: float, inside: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """All eigenvalues between and their vectors; an error if fewer or more are found than the inertia says."""
    size = min(len(matrix), max(inside + 4, 3 * inside // 2))
    block = np.random.default_rng(len(matrix)).normal(size=(len(matrix), size))
    for _ in range(ROUNDS):
        base, _ = np.linalg.qr(project(matrix, block, low, high))
        values, turn = np.linalg.eigh(base.T @ matrix @ base)
        block = base @ turn
        within = (values > low) & (values < high)
        left = np.abs(matrix @ block - block * values).max(axis=0)
        if within.sum() == inside and left[within].max() <= 1e-13 * scale:
            return values[within], block[:, within]
    raise ArithmeticError(f"{inside} eigenvalues between {low} and {high}, found {int(within.sum())}")


def principal(matrix: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a covariance, falling, and their unit vectors as columns; at most `most`, none that is zero."""
    none = np.zeros(0), np.zeros((len(matrix), 0))
    if not len(matrix) or not np.abs(matrix).max():
        return none
    spectrum = Spectrum(matrix)
    zero = len(matrix) * np.finfo(float).eps * spectrum.scale
    wanted = min(most, spectrum.above(zero))
    if not wanted:
        return none
    found = [
        extract(matrix, low, high, inside, spectrum.scale)
        for low, high, inside in spectrum.intervals(spectrum.floor_of(wanted), spectrum.top, PER_INTERVAL)
    ]
    base, _ = np.linalg.qr(np.concatenate([vectors for _, vectors in found], axis=1))
    values, turn = np.linalg.eigh(base.T @ matrix @ base)
    order = np.argsort(-values, kind="stable")[:wanted]
    vectors = (base @ turn)[:, order]
    largest = vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))]
    return values[order], vectors * np.where(largest < 0, -1.0, 1.0)


# --- Rows -------------------------------------------------------------------------------------------------------------------------


def usable(vector: Column) -> Column:
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * SCALE) < LARGEST))
    return F.coalesce((F.size(vector) > 0) & whole, F.lit(False))


def whole_numbers(vectors: DataFrame) -> DataFrame:
    """`vec_id, dim, x` for the usable rows of `vectors` (vec_id, embedding)."""
    x = F.transform("embedding", lambda c: F.floor(c.cast("double") * SCALE).cast("long") + OFFSET)
    return vectors.filter(usable(F.col("embedding"))).select("vec_id", F.size("embedding").alias("dim"), x.alias("x"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, dim)


def task_sums(rows: DataFrame, make, length: int) -> list[float]:
    """Sums over all rows of the `length` numbers that `make` gives per batch: added up per task, then by Spark, exactly for whole numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = sum((make(b) for b in batches if b.num_rows), start=0)
        if np.ndim(total):
            yield pa.RecordBatch.from_arrays([pa.array(range(length), pa.int32()), pa.array(total)], ["at", "v"])

    whole = make(pa.RecordBatch.from_pylist([], schema=_arrow(rows))).dtype.kind == "i"
    kind = "long" if whole else "double"
    value = F.col("v").cast("decimal(38,0)") if whole else F.col("v")
    sums = rows.mapInArrow(run, f"at int, v {kind}").groupBy("at").agg(F.sum(value).alias("v")).collect()
    return [r.v for r in sorted(sums)]


def _arrow(rows: DataFrame) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(rows.schema)


class Fit:
    """Count, sums, covariance and components of one fit list (rows `vec_id, dim, x` of one length)."""

    def __init__(self, rows: DataFrame, dim: int, n: int, most: int):
        self.dim, self.n = dim, n
        self.sums = [int(s) for s in task_sums(rows.select("x"), lambda b: _matrix(b.column("x"), dim).sum(axis=0), dim)]
        # A mean as a whole part and a fraction, so that centring loses no digits.
        self.whole = np.array([s // n for s in self.sums], dtype=np.int64)
        self.rest = np.array([s % n for s in self.sums], dtype=np.int64)
        row, col = np.triu_indices(dim)

        def products(batch: pa.RecordBatch) -> np.ndarray:
            c = self.centred(batch)
            return (c.T @ c)[row, col]

        self.covariance = np.zeros((dim, dim))
        self.covariance[row, col] = self.covariance[col, row] = np.array(task_sums(rows.select("x"), products, len(row))) / n
        self.values, self.vectors = principal(self.covariance, most)
        self.error = self.identity_error(rows) if len(self.values) else None

    def centred(self, batch: pa.RecordBatch) -> np.ndarray:
        return (_matrix(batch.column("x"), self.dim) - self.whole) - self.rest / self.n

    def whitened(self, batch: pa.RecordBatch) -> np.ndarray:
        return self.centred(batch) @ (self.vectors / np.sqrt(self.values))

    def identity_error(self, rows: DataFrame) -> float:
        """Largest entry of the covariance of the whitened rows, as measured over them all, less the identity."""
        row, col = np.triu_indices(len(self.values))

        def products(batch: pa.RecordBatch) -> np.ndarray:
            w = self.whitened(batch)  # its mean is zero, as the rows were centred
            return (w.T @ w)[row, col]

        measured = np.array(task_sums(rows.select("x"), products, len(row))) / self.n
        return float(np.abs(measured - (row == col)).max())

    def deviation(self, batch: pa.RecordBatch) -> pa.Array:
        """Per row the sum of (n*x - sum)^2, exact; NULL if no long holds it."""
        off = _matrix(batch.column("x"), self.dim) - self.whole
        if self.dim * float(np.abs(off).max(initial=0) + 1) ** 2 * float(self.n) ** 2 < 2.0**62:
            return pa.array(((off * self.n - self.rest) ** 2).sum(axis=1))
        exact = ((off.astype(object) * self.n - self.rest.astype(object)) ** 2).sum(axis=1)
        return pa.array([v if v < 1 << 63 else None for v in exact.tolist()], pa.int64())

    def project(self, rows: DataFrame) -> DataFrame:
        """A row per row of `rows` and component."""
        k = len(self.values)
        explained = self.values / np.trace(self.covariance)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n = batch.num_rows
                at = pa.array(np.repeat(np.arange(n), k))
                cols = {
                    "vec_id": batch.column("vec_id").take(at), "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
                    "n": pa.array(np.full(n * k, self.n)), "deviation": self.deviation(batch).take(at),
                    "whitened": pa.array(self.whitened(batch).reshape(-1)), "explained": pa.array(np.tile(explained, n)),
                    "identity_error": pa.array(np.full(n * k, self.error)),
                }
                yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))

        return rows.select("vec_id", "x").mapInArrow(run, result_type(rows))


def result_type(rows: DataFrame) -> str:
    kind = rows.schema["vec_id"].dataType.simpleString()
    return f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """`vec_id, component, n, deviation, whitened, explained, identity_error`: a row per usable vector of `vectors` (vec_id, embedding) and
    component, up to `most`, by falling eigenvalue."""
    rows = staged(whole_numbers(vectors), "whole-vectors")
    done = vectors.sparkSession.createDataFrame([], result_type(rows))
    for length in sorted(rows.groupBy("dim").count().collect()):
        own = rows.filter(F.col("dim") == length["dim"])
        fit = Fit(own, length["dim"], length["count"], most)
        if len(fit.values):
            done = done.unionByName(fit.project(own))
    return done
