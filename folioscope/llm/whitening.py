"""Embedding whitening by a compensated covariance.

Vectors become integers, whose sums are exact.  Each task centres its vectors in
double-double arithmetic, forms their outer products with error-free
transformations and adds them up, high and low parts apart; the sums of the
tasks are merged in the same way, in two levels.  The covariance, a matrix as
wide as the vectors, is solved by LAPACK's divide and conquer for symmetric
matrices, which first makes it tridiagonal.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, releasing

#: Steps of a component in its integer, and what is added to all.
STEPS, SHIFT = 64, 1_000_000
#: Integers from here on are not exact as doubles.
LARGE = 1 << 53
#: Components that are returned.
COMPONENTS = 32
#: Outer products of so many rows are formed at once.
ROWS = 64
#: Rows of a task that are whitened at once.
CHUNK = 2048
#: Eigenvalues under this part of the greatest, a dimension, are taken for zero.
FLAT = 2.0**-52

_SPLIT = 134217729.0  # 2**27 + 1 cuts a double into halves whose products are exact


def two_sum(a, b):
    """``a + b`` and its rounding error."""
    s = a + b
    t = s - a
    return s, (a - (s - t)) + (b - t)


def _halves(a):
    t = _SPLIT * a
    high = t - (t - a)
    return high, a - high


def add(a, b):
    """Sum of two double-doubles ``(high, low)``."""
    s, e = two_sum(a[0], b[0])
    t, f = two_sum(a[1], b[1])
    e = e + t
    s, e = s + e, e - ((s + e) - s)
    e = e + f
    return s + e, e - ((s + e) - s)


def outer_sum(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the outer products of the rows ``high + low``, as a double-double matrix."""
    dim = high.shape[1]
    total = np.zeros((dim, dim)), np.zeros((dim, dim))
    for at in range(0, len(high), ROWS):
        h, w = high[at : at + ROWS], low[at : at + ROWS]
        upper, lower = _halves(h)
        a, b = h[:, :, None], h[:, None, :]
        p = a * b
        a1, a2, b1, b2 = upper[:, :, None], lower[:, :, None], upper[:, None, :], lower[:, None, :]
        e = ((a1 * b1 - p) + a1 * b2 + a2 * b1) + a2 * b2
        e += a * w[:, None, :] + w[:, :, None] * b
        while len(p) > 1:  # pairs of products, then pairs of sums
            half = len(p) // 2
            s, f = add((p[:half], e[:half]), (p[half : 2 * half], e[half : 2 * half]))
            p, e = np.concatenate([s, p[2 * half :]]), np.concatenate([f, e[2 * half :]])
        total = add(total, (p[0], e[0]))
    return total


def centred(x: np.ndarray, sums: list[int], n: int) -> tuple[np.ndarray, np.ndarray]:
    """``x - sums / n`` as double-doubles; ``x`` holds integers."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = [s % n for s in sums]
    high = np.array([r / n for r in rest])
    low = np.array([_remainder(r, h, n) for r, h in zip(rest, high.tolist())])
    s, e = two_sum((x - whole).astype(np.float64), -high)
    return two_sum(s, e - low)


def _remainder(r: int, quotient: float, n: int) -> float:
    """``r / n - quotient``, rounded once."""
    a, b = quotient.as_integer_ratio()
    return (r * b - a * n) / (n * b)


def _usable(vectors: DataFrame, column: str) -> DataFrame:
    """``vec_id, x``: the integers of vectors without null or non-finite components."""
    odd = F.exists(column, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) * STEPS >= float(LARGE)))
    x = F.transform(column, lambda c: F.floor(c.cast("double") * STEPS) + SHIFT)
    return vectors.where(F.col(column).isNotNull() & ~odd).select("vec_id", x.alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column as a matrix; the lists have one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _sums(rows: DataFrame) -> tuple[int, list[int]]:
    """The number of vectors and the exact sum of each dimension, over the vectors of the most frequent length."""
    schema = pa.schema([("dim", pa.int32()), ("at", pa.int32()), ("n", pa.int64()), ("s", pa.int64())])

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.array([len(x) for x in batch.column("x")])
            for dim in set(size.tolist()):
                x = _matrix(batch.column("x").filter(pa.array(size == dim)))
                s = x.sum(0).tolist() or [0]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(([dim] * len(s), range(len(s)), [len(x)] * len(s), s), schema)], schema=schema)

    parts = rows.select("x").mapInArrow(run, "dim int, at int, n long, s long")
    found = materialize(parts.groupBy("dim", "at").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")), "sums")
    most = found.where("at = 0 and dim > 0").orderBy(F.desc("n"), F.desc("dim")).first()
    if most is None:
        return 0, []
    return most["n"], [int(r["s"]) for r in found.where(F.col("dim") == most["dim"]).orderBy("at").collect()]


def _merged(rows: DataFrame, dim: int, make) -> tuple[np.ndarray, np.ndarray]:
    """``sum of make(x)`` over all tasks, as a double-double matrix.

    One row of two matrices a task is merged in about the square root of their
    number of tasks, and then in one; neither ever holds more than one sum.
    """

    @releasing
    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = make(_matrix(batch.column("x").slice(at, CHUNK)))
                total = add(total, part) if total else part
        if total:
            yield pa.RecordBatch.from_pydict({"high": [total[0].ravel()], "low": [total[1].ravel()]})

    @releasing
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for i in range(batch.num_rows):
                part = tuple(batch.column(c)[i].values.to_numpy() for c in ("high", "low"))
                total = add(total, part) if total else part
        if total:
            yield pa.RecordBatch.from_pydict({"high": [total[0]], "low": [total[1]]})

    schema = "high array<double>, low array<double>"
    parts = rows.select("x").mapInArrow(first, schema)
    middle = max(1, math.isqrt(rows.rdd.getNumPartitions()))
    out = parts.repartition(middle).mapInArrow(merge, schema).repartition(1).mapInArrow(merge, schema).first()
    return tuple(np.array(out[c]).reshape(dim, dim) for c in ("high", "low"))


def components(high: np.ndarray, low: np.ndarray, n: int, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvalues, falling, unit eigenvectors as columns, and the trace, of a sum of outer products over ``n``."""
    covariance = (high + low) / n
    value, vector = np.linalg.eigh(covariance)  # tridiagonal form, then divide and conquer
    value, vector = value[::-1], vector[:, ::-1]
    sign = np.where(vector[np.abs(vector).argmax(0), np.arange(len(value))] < 0, -1.0, 1.0)
    keep = min(most, int((value > max(value[0], 0.0) * len(value) * FLAT).sum()))
    return value[:keep], (vector * sign)[:, :keep], math.fsum(np.diag(high).tolist() + np.diag(low).tolist()) / n


def _deviation(x: np.ndarray, sums: list[int], n: int) -> list[int]:
    """``sum((n * x - sums) ** 2)`` of each row, exactly."""
    whole, rest = np.array([s // n for s in sums]), np.array([s % n for s in sums])
    near = x - whole
    if len(near) == 0 or (int(np.abs(near).max()) + 1) * n < 2**31 // max(1, math.isqrt(len(sums)) + 1):
        return ((n * near - rest) ** 2).sum(1).tolist()
    return ((near.astype(object) * n - rest.astype(object)) ** 2).sum(1).tolist()


def whiten(vectors: DataFrame, column: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for each usable vector and component.

    A component ``c`` of a vector counts as ``floor(STEPS * c) + SHIFT``.
    Covariances are over all usable vectors, centred before multiplying, with
    the number of vectors as divisor.  Components are numbered from 1 by falling
    eigenvalue; their sign makes the greatest entry positive.  ``deviation`` is
    decimal and exact, ``identity_error`` how far the covariance of the results
    is from the identity, at most.

    Vectors that are null or hold null or non-finite components (or such that
    ``STEPS`` of them are no exact integer, from ``LARGE`` on) take no part, nor
    do those that are not as long as most (the longer, if as many); repeated
    rows count each, null ids are kept.  Components without variance are left
    out, so equal vectors, a single one and an empty table give no rows.  Other
    columns are not read.
    """
    out = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    rows = _usable(vectors, column)
    n, sums = _sums(rows)
    dim = len(sums)
    empty = vectors.sparkSession.createDataFrame([], out)
    if not n:
        return empty
    rows = rows.where(F.size("x") == dim)
    high, low = _merged(rows, dim, lambda x: outer_sum(*centred(x, sums, n)))
    value, vector, trace = components(high, low, n, most)
    k = len(value)
    if not k:
        return empty
    scaled = vector / np.sqrt(value)

    def project(x):
        h, w = centred(x, sums, n)
        return h @ scaled + w @ scaled

    again = _merged(rows, k, lambda x: outer_sum(y := project(x), np.zeros_like(y)))
    error = float(np.abs((again[0] + again[1]) / n - np.eye(k)).max())
    names = [c.split()[0] for c in out.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.decimal128(38, 0), pa.float64(), pa.float64(), pa.float64()]
    schema = pa.schema(list(zip(names, kinds)))

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK)
                x = _matrix(part.column("x"))
                own = pa.array(np.repeat(np.arange(len(x)), k))
                deviation = pa.array(_deviation(x, sums, n), pa.decimal128(38, 0)).take(own)
                columns = [part.column("vec_id").take(own), np.tile(np.arange(1, k + 1, dtype="i4"), len(x)), np.full(len(own), n), deviation, project(x).ravel(), np.tile(value / trace, len(x)), np.full(len(own), error)]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], schema=schema)

    return rows.mapInArrow(run, out)
