"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi on the factor.

An entry c counts as the whole number x = floor(64 c) + 1,000,000, so sums are exact. The fit list holds each
distinct vector once. Executors add up n, the sums and the centred scatter of its parts; the driver gets d numbers
and a d x d matrix, whatever the number of vectors. The scatter V is cut as P' L L' P (pivots from the greatest
remaining diagonal, so rank shows as pivots that vanish); Jacobi rotations make the columns of P' L orthogonal:
their squared norms are V's eigenvalues, the normalised columns its eigenvectors. No product of the factor with
itself is formed, so small eigenvalues keep their digits.

Nulls: rows whose vector is null or holds a null, NaN or infinite entry are left out; a null id stays an id.
Repeated rows each give their rows and count once in the fit. Vectors shorter than the longest one are filled with
zeros, empty ones wholly. Entries beyond 2^52 count as 2^52. Components without spread (e is 0 to double precision)
have no rows: one distinct vector gives none, and an empty table an empty one. Equal eigenvalues come in the order
the rotations leave them. ``deviation`` beyond a long is null. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskloom.llm import store

SCALE, SHIFT = 64, 1_000_000
#: Greatest size of an entry after scaling: whole numbers up to it are exact as doubles.
GREATEST = float(1 << 52)
#: Most components returned.
COMPONENTS = 16
#: Rows of a step inside a task.
STEP = 4096
_BASE = 1 << 24


@dataclass(frozen=True)
class Fit:
    """What the fit list gives: count, exact sums, components (rows, by falling eigenvalue) and what they explain."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray
    identity_error: float


def _whole(embedding: Column) -> Column:
    """floor(64 c) of each entry."""
    return F.transform(embedding, lambda c: F.floor(
        F.greatest(F.least(c.cast("double") * F.lit(float(SCALE)), F.lit(GREATEST)), F.lit(-GREATEST))
    ))


def quantised(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, x) of the rows that count; ``x`` holds floor(64 c), the constant left out."""
    entry = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
    fine = F.col(embedding).isNotNull() & ~F.exists(embedding, entry)
    return vectors.where(fine).select(F.col(vec_id).alias("vec_id"), _whole(F.col(embedding)).alias("x"))


def _matrices(column: pa.ListArray, width: int) -> Iterator[np.ndarray]:
    """The vectors of a batch as matrices of at most ``STEP`` rows, short ones filled with zeros."""
    for start in range(0, len(column), STEP):
        part = column[start : start + STEP]
        offsets = part.offsets.to_numpy()
        sizes = np.diff(offsets)
        flat = part.flatten().to_numpy(zero_copy_only=False)
        if (sizes == width).all():
            yield flat.reshape(len(part), width)
            continue
        out = np.zeros((len(part), width), np.int64)
        out[np.repeat(np.arange(len(part)), sizes), np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], sizes)] = flat
        yield out


def _added(parts: DataFrame, size: int) -> np.ndarray | None:
    """The sum of the arrays of ``parts`` (one row a task) over about as many tasks as each of them then reads."""
    shape = f"v array<{parts.schema['v'].dataType.elementType.simpleString()}>"

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                some = batch.column(0).flatten().to_numpy().reshape(-1, size).sum(axis=0)
                total = some if total is None else total + some
        if total is not None:
            yield pa.RecordBatch.from_pydict({"v": [total]})

    rows = parts.repartition(16).mapInArrow(add, shape).collect()
    return np.sum([np.array(r["v"]) for r in rows], axis=0) if rows else None


def _sums(fit: DataFrame, width: int) -> tuple[int, list[int]]:
    """Count and exact sums. Entries are split into two digits, so that no sum leaves a long."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * width + 1, np.int64)
        for batch in batches:
            for x in _matrices(batch.column(0), width):
                high = x // _BASE
                total += np.concatenate([[len(x)], high.sum(axis=0), (x - high * _BASE).sum(axis=0)])
        if total[0]:
            yield pa.RecordBatch.from_pydict({"v": [total]})

    total = _added(fit.mapInArrow(work, "v array<bigint>"), 2 * width + 1)
    if total is None:
        return 0, []
    n, high, low = int(total[0]), total[1 : width + 1], total[width + 1 :]
    return n, [int(h) * _BASE + int(s) + SHIFT * n for h, s in zip(high, low)]


def _scatter(fit: DataFrame, width: int, rows: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """Sum of the outer products of ``rows(x)`` with themselves, and of the rows (last row)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size + 1, size))
        for batch in batches:
            for x in _matrices(batch.column(0), width):
                centred = rows(x)
                total[:size] += centred.T @ centred
                total[size] += centred.sum(axis=0)
        yield pa.RecordBatch.from_pydict({"v": [total.ravel()]})

    return _added(fit.mapInArrow(work, "v array<double>"), (size + 1) * size).reshape(size + 1, size)


def _centre(n: int, sums: list[int]) -> Callable[[np.ndarray], np.ndarray]:
    """x - S/n of floor(64 c) rows: whole part and rest of the mean apart, so that nothing large is subtracted."""
    means = [divmod(s - SHIFT * n, n) for s in sums]
    whole, rest = np.array([w for w, _ in means], np.int64), np.array([r / n for _, r in means])
    return lambda x: (x - whole) - rest


def pivoted_cholesky(v: np.ndarray) -> np.ndarray:
    """G with G G' = v (rows in v's order, one column a pivot); columns end where only rounding is left."""
    left, size = v.astype(float).copy(), len(v)
    columns = []
    floor = size * np.finfo(float).eps * max(float(np.diag(left).max(initial=0.0)), 0.0)
    for _ in range(size):
        pivot = int(np.argmax(np.diag(left)))
        if left[pivot, pivot] <= floor:
            break
        column = left[:, pivot] / math.sqrt(left[pivot, pivot])
        columns.append(column)
        left -= np.outer(column, column)
        left[pivot, :] = left[:, pivot] = 0.0
    return np.array(columns).T if columns else np.zeros((size, 0))


def one_sided_jacobi(g: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Squared norms and directions (rows) of g's columns rotated until all are orthogonal, from the greatest down."""
    columns = g.T.copy()
    count = len(columns)
    tolerance = 4 * np.finfo(float).eps
    for _ in range(sweeps):
        turned = False
        for p in range(count - 1):
            for q in range(p + 1, count):
                a, b = columns[p], columns[q]
                alpha, beta, gamma = float(a @ a), float(b @ b), float(a @ b)
                if abs(gamma) <= tolerance * math.sqrt(alpha * beta):
                    continue
                turned = True
                zeta = (beta - alpha) / (2.0 * gamma)
                t = math.copysign(1.0, zeta) / (abs(zeta) + math.hypot(1.0, zeta))
                c = 1.0 / math.hypot(1.0, t)
                columns[p], columns[q] = c * a - c * t * b, c * t * a + c * b
        if not turned:
            break
    norms = np.einsum("ij,ij->i", columns, columns)
    order = np.argsort(-norms, kind="stable")
    return norms[order], columns[order] / np.sqrt(norms[order])[:, None] if count else columns


def fit_whitening(quantised_vectors: DataFrame, components: int = COMPONENTS) -> Fit | None:
    """The fit of ``quantised`` rows; None without rows. Reads the distinct vectors three times, from the shared folder."""
    width = quantised_vectors.agg(F.max(F.size("x"))).first()[0]
    if not width:
        return None
    # Filled before they are told apart: a short vector and its filled form are one.
    filled = F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("x")))
    fit = store.stored(quantised_vectors.select(filled.alias("x")).distinct(), "fit-list")
    n, sums = _sums(fit, width)
    centre = _centre(n, sums)
    v = _scatter(fit, width, centre, width)[:width] / n
    values, directions = one_sided_jacobi(pivoted_cholesky(v))
    found = min(components, int((values > 0).sum()))
    values, directions = values[:found], directions[:found]
    if not found:
        return Fit(n, sums, directions, values, values, 0.0)
    project = (directions / np.sqrt(values)[:, None]).T
    # The whitened rows are centred already; what rounding left of their mean is taken off as well.
    total = _scatter(fit, width, lambda x: centre(x) @ project, found) / n
    error = float(np.abs(total[:found] - np.outer(total[found], total[found]) - np.eye(found)).max())
    return Fit(n, sums, directions, values, values / np.trace(v), error)


OUTPUT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n x - S)^2, exact."""
    bases = [s - SHIFT * n for s in sums]
    reach = int(np.abs(x).max(initial=0)) * n + max(map(abs, bases), default=0)
    if reach * reach * max(len(bases), 1) < 1 << 63:
        far = n * x - np.array(bases, np.int64)
        return (far * far).sum(axis=1).tolist()
    exact = [sum((n * e - b) ** 2 for e, b in zip(row, bases)) for row in x.tolist()]
    return [e if e < 1 << 63 else None for e in exact]


def whiten(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row per vector and component."""
    rows = quantised(vectors, vec_id, embedding)
    fit = fit_whitening(rows, components)
    schema = f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, {OUTPUT}"
    if fit is None or not len(fit.components):
        return vectors.sparkSession.createDataFrame([], schema)
    width, count = len(fit.sums), len(fit.components)
    centre = _centre(fit.n, fit.sums)
    project, numbers = (fit.components / np.sqrt(fit.eigenvalues)[:, None]).T, np.arange(1, count + 1, dtype=np.int32)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for x in _matrices(batch.column(1), width):
                ids = batch.column(0).slice(at, len(x))
                at += len(x)
                times = np.repeat(np.arange(len(x)), count)
                yield pa.RecordBatch.from_arrays([
                    ids.take(pa.array(times)), pa.array(np.tile(numbers, len(x))), pa.array(np.full(len(times), fit.n)),
                    pa.array(_deviations(x, fit.n, fit.sums), pa.int64()).take(pa.array(times)),
                    pa.array((centre(x) @ project).ravel()), pa.array(np.tile(fit.explained, len(x))),
                    pa.array(np.full(len(times), fit.identity_error)),
                ], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(work, schema)
