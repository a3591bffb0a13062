"""Whitening of embeddings by shifted Cholesky QR over the distinct vectors."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import pick
from tabloom.llm.topk import whole_numbers
from tabloom.session import materialise, shuffle_width

#: Most dimensions: a Gram matrix of doubles is then 128 MB on the driver.
MOST_DIMS = 4096
#: Rows that a task turns into doubles at once.
ROWS_AT_ONCE = 4096
UNIT = 2.0**-53
#: Passes until the rows' Gram matrix is the identity; three are the rule.
MOST_PASSES = 8
#: A pivot below this share of an orthogonalised column is rounding.
LEAST_PIVOT = 1e-13


class Whitening(NamedTuple):
    """A fitted whitening: what a row is centred by, and its components.

    ``axes`` has a unit eigenvector of the covariance in each row, by falling
    eigenvalue in ``variances``; ``total`` is the trace.
    """

    n: int
    sums: list[int]
    largest: int
    axes: np.ndarray
    variances: np.ndarray
    total: float


def deviations(x: np.ndarray, n: int, sums: list[int], largest: int) -> np.ndarray:
    """n * x - S, exactly: as 64-bit numbers, or as Python's where those do not reach."""
    if 2 * n * largest < 2**63:
        return x * np.int64(n) - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def squared_sizes(v: np.ndarray) -> list[int]:
    """The exact sum of squares of each row of whole numbers."""
    if v.dtype == object:
        return [int(sum(c * c for c in row)) for row in v]
    # v = high * 2^31 + low, so that no sum of products leaves 64 bits.
    high, low = v >> 31, v & (2**31 - 1)
    squares = [(high * high), (high * low), (low * low)]
    parts = [(s >> 31).sum(1).tolist() for s in squares], [(s & (2**31 - 1)).sum(1).tolist() for s in squares]
    return [
        ((a1 << 31) + a0 << 62) + ((b1 << 31) + b0 << 32) + (c1 << 31) + c0
        for a1, b1, c1, a0, b0, c0 in zip(*parts[0], *parts[1])
    ]


def matrix_of(column: pa.ListArray, dims: int) -> np.ndarray:
    """Rows of whole numbers; shorter ones are filled with zeros."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    sizes = np.diff(column.offsets.to_numpy())
    if (sizes == dims).all():
        return flat.reshape(-1, dims)
    x = np.zeros((len(sizes), dims), np.int64)
    x[np.arange(dims) < sizes[:, None]] = flat
    return x


def solved(x: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """x R1^-1 R2^-1 ..., by one triangular solve for each factor.

    A zero on a diagonal marks a column that depends on those before it; it
    becomes zero.
    """
    for r in factors:
        y = np.zeros_like(x)
        for j in range(len(r)):
            if r[j, j]:
                y[:, j] = (x[:, j] - y[:, :j] @ r[:j, j]) / r[j, j]
        x = y
    return x


def cholesky(gram: np.ndarray, least: float) -> np.ndarray:
    """Upper triangular R with R^T R = gram; a pivot up to ``least`` makes its row zero."""
    d = len(gram)
    r = np.zeros((d, d))
    for j in range(d):
        row = gram[j, j:] - r[:j, j] @ r[:j, j:]
        if row[0] > least:
            r[j, j:] = row / math.sqrt(row[0])
    return r


def added(partial: DataFrame, dims: int) -> np.ndarray:
    """The sum of all tasks' matrices, given as rows (i, values).

    Row i of every task goes to one task, which adds them as they come; the
    driver gets one matrix.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            values = batch.column("values").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            for i, row in zip(batch.column("i").to_pylist(), values):
                found[i] = found[i] + row if i in found else row
        if found:
            yield pa.RecordBatch.from_pydict(
                {"i": pa.array(list(found), pa.int32()), "values": pa.array([list(v) for v in found.values()])}
            )

    width = min(dims, shuffle_width(partial.sparkSession))
    rows = partial.repartition(width, "i").mapInArrow(add, "i int, values array<double>").collect()
    total = np.zeros((max(dims, 1), dims))
    for i, values in rows:
        total[i] = values
    return total


def gram_of(fit: DataFrame, dims: int, rows_of: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """y^T y over all rows y = rows_of(x), which have ``width`` columns."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = np.zeros((width, width))
        for batch in batches:
            x = matrix_of(batch.column("x"), dims)
            for begin in range(0, len(x), ROWS_AT_ONCE):
                y = rows_of(x[begin : begin + ROWS_AT_ONCE])
                gram += y.T @ y
        yield pa.RecordBatch.from_pydict(
            {"i": pa.array(np.arange(width), pa.int32()), "values": pa.array(list(gram), pa.list_(pa.float64()))}
        )

    return added(fit.select("x").mapInArrow(partial, "i int, values array<double>"), width)


def fit_whitening(fit: DataFrame, components: int) -> Whitening | None:
    """Fit on a table of distinct rows ``x`` (arrays of whole numbers).

    The Gram matrix of the centred rows X, shifted so that its Cholesky factor
    exists whatever the condition, gives R1; rows X R1^-1 are much better
    conditioned, and their Gram matrix gives R2; this goes on until the rows
    are orthonormal to rounding. Each pass reads the table once and solves
    with the factors so far, so no squared condition number enters R =
    ... R2 R1, and X^T X = R^T R. The singular values of R are those of X.
    """
    sizes = fit.select(F.size("x").alias("d"), F.array_max("x").alias("hi"), F.array_min("x").alias("lo"))
    n, dims, high, low = sizes.agg(F.count(F.lit(1)), F.max("d"), F.max("hi"), F.min("lo")).first()
    if not n or not dims:
        return None
    if dims > MOST_DIMS:
        raise ValueError(f"vectors of {dims} components, at most {MOST_DIMS}")
    largest = max(abs(high), abs(low), 1)

    def partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * dims
        for batch in batches:
            x = matrix_of(batch.column("x"), dims)
            high, low = (x >> 31).sum(0).tolist(), (x & (2**31 - 1)).sum(0).tolist()
            total = [t + (h << 31) + l for t, h, l in zip(total, high, low)]
        yield pa.RecordBatch.from_pydict(
            {"i": pa.array(range(dims), pa.int32()), "s": [str(t) for t in total]}
        )

    parts = fit.select("x").mapInArrow(partial_sums, "i int, s string")
    found = parts.groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)"))).collect()
    sums = [int(s) for _, s in sorted(found)]

    def centred(x: np.ndarray) -> np.ndarray:
        return deviations(x, n, sums, largest).astype(np.float64) / n

    gram = gram_of(fit, dims, centred, dims)
    total = float(np.trace(gram))
    if total == 0:
        return Whitening(n, sums, largest, np.zeros((0, dims)), np.zeros(0), 0.0)
    shift = 11 * (n * dims + dims * (dims + 1)) * UNIT * total
    factors = [cholesky(gram + min(shift, 1e-3 * total) * np.eye(dims), 0.0)]
    for _ in range(MOST_PASSES):
        gram = gram_of(fit, dims, lambda x: solved(centred(x), factors), dims)
        kept = np.diag(gram) > LEAST_PIVOT
        off = np.abs(gram - np.diag(kept.astype(float))).max()
        if off < 64 * dims * UNIT:
            break
        factors.append(cholesky(gram, LEAST_PIVOT))
    r = factors[0]
    for factor in factors[1:]:
        r = factor @ r
    _, singular, axes = np.linalg.svd(r)
    # Below this a singular value is what rounding leaves of a zero.
    rank = int((singular > singular[0] * dims * UNIT).sum())
    k = min(components, rank)
    return Whitening(n, sums, largest, axes[:k], singular[:k] ** 2 / n, float((singular**2).sum() / n))


def whitened_rows(x: np.ndarray, fitted: Whitening) -> np.ndarray:
    """(x - S/n) on each component, over its standard deviation."""
    v = deviations(x, fitted.n, fitted.sums, fitted.largest).astype(np.float64) / fitted.n
    return v @ (fitted.axes / np.sqrt(fitted.variances)[:, None]).T


def whiten(
    vectors: DataFrame,
    components: int = 4,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Per row and component (from 1): its place on the leading principal axes, scaled to variance 1.

    Returns vec_id, component int, n long, deviation decimal(38,0), whitened,
    explained and identity_error double. A component of a vector becomes
    x = floor(scale * c). Mean and covariance (divisor n) are those of the n
    distinct vectors, so copies weigh nothing. ``deviation`` is the exact sum
    over dimensions of (n*x - S)^2; ``explained`` the axis's share of the
    total variance; ``identity_error`` the largest absolute entry of the
    covariance of ``whitened`` minus the identity, measured over the fit list
    in a pass of its own.

    Vectors that are NULL or hold a NULL or non-finite component take no part,
    nor do rows without an id. A shorter vector counts as filled with zeros.
    Repeated rows are returned as often as they occur. Axes along which
    nothing varies (a single distinct vector has no others) have no rows, as
    nothing scales them to variance 1. Equal variances may give their axes in
    any rotation. An empty table gives an empty one; further columns are left
    out. A component beyond 64 bits counts as the largest such number.
    """
    rows = whole_numbers(vectors, id_col, vector_col, scale).withColumnRenamed("v", "x")
    dims = rows.agg(F.max(F.size("x"))).first()[0] or 0
    # Filled before they are compared: a vector and the same with zeros after it are one.
    filled = F.when(F.size("x") == dims, F.col("x")).otherwise(
        F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size("x")))
    )
    rows = rows.withColumn("x", filled)
    fit = materialise(rows.select("x").distinct())
    fitted = fit_whitening(fit, components)
    schema = (
        "vec_id long, component int, n long, deviation decimal(38,0), "
        "whitened double, explained double, identity_error double"
    )
    if fitted is None or not len(fitted.axes):
        return rows.sparkSession.createDataFrame([], schema)
    k = len(fitted.axes)

    def with_one(x: np.ndarray) -> np.ndarray:
        return np.c_[whitened_rows(x, fitted), np.ones(len(x))]

    # The last row holds the sums, which centre the products.
    gram = gram_of(fit, dims, with_one, k + 1) / fitted.n
    covariance = gram[:k, :k] - np.outer(gram[k, :k], gram[k, :k])
    error = float(np.abs(covariance - np.eye(k)).max())
    explained = fitted.variances / fitted.total

    def applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(begin, ROWS_AT_ONCE)
                x = matrix_of(part.column("x"), dims)
                y = whitened_rows(x, fitted)
                sizes = squared_sizes(deviations(x, fitted.n, fitted.sums, fitted.largest))
                yield pa.RecordBatch.from_pydict(
                    {
                        "vec_id": pa.array(np.repeat(part.column("vec_id").to_numpy(), k)),
                        "component": pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                        "deviation": pa.array([str(s) for s in sizes for _ in range(k)]),
                        "whitened": pa.array(y.ravel()),
                        "explained": pa.array(np.tile(explained, len(x))),
                    }
                )

    found = rows.mapInArrow(applied, "vec_id long, component int, deviation string, whitened double, explained double")
    return found.select(
        "vec_id",
        "component",
        F.lit(fitted.n).cast("long").alias("n"),
        F.expr("try_cast(deviation AS decimal(38,0))").alias("deviation"),
        "whitened",
        "explained",
        F.lit(error).alias("identity_error"),
    )
