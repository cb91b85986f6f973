"""Embedding whitening: principal components of a distributed covariance, refined beyond single precision.

1. One pass sums the integer vectors by length; the sums are exact.
2. A second pass multiplies the centred vectors, a block at a time, and adds
   the d x d products of the tasks row by row as they arrive.
3. The driver, which holds d x d numbers whatever the table, takes single
   precision eigenvectors and corrects them by Ogita-Aishima iterations in
   extended precision. Eigenvalues too close to be told apart at the current
   error are solved again in the space they span (``refined``).
4. A last pass projects every vector; what its covariance misses of the
   identity is measured on the rows themselves.

Defined results: rows whose vector is null, or holds a null, NaN or infinite
entry, are left out, as are vectors whose length is not the table's most
frequent one (of equally frequent ones the longer); null and repeated ids and
repeated rows count and are returned like any other. Components without
variance have no whitened value and are left out, so a table of equal vectors,
or an empty one, gives no rows. Entries that do not fit a long are an error.
Other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.llm.scratch import stored
from keelson.llm.textbytes import task

SCALE, SHIFT = 1024, 100_000
HIGH = np.longdouble
ROUNDS = 40
BLOCK_ROWS = 4096


def _finite(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows whose vector is whole, and for all rows the offsets into the flat entries (as doubles)."""
    offs = column.offsets.to_numpy().astype(np.int64)
    values = column.values.cast(pa.float64())
    whole = np.asarray(column.is_valid())
    flat = values.fill_null(np.nan).to_numpy(zero_copy_only=False)
    bad = np.append(0, np.cumsum(~np.isfinite(flat)))
    return np.flatnonzero(whole & (bad[offs[1:]] == bad[offs[:-1]])), offs, flat


def _integers(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length: the rows that have a whole vector of it, and those as integers."""
    rows, offs, flat = _finite(column)
    lengths = offs[rows + 1] - offs[rows]
    for length in np.unique(lengths).tolist():
        same = rows[lengths == length]
        for lo in range(0, len(same), BLOCK_ROWS):
            part = same[lo : lo + BLOCK_ROWS]
            x = np.floor(SCALE * flat[offs[part][:, None] + np.arange(length)])
            if x.size and np.abs(x).max() >= 2.0**53:
                raise OverflowError("a vector's entry is too large for whitening")
            yield part, x.astype(np.int64) + SHIFT


def _rows(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    return vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))


def _sums(rows: DataFrame) -> tuple[int, np.ndarray]:
    """How many vectors have the most frequent length, and their exact sum."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            for part, x in _integers(batch.column("vector")):
                n, s = total.get(x.shape[1], (0, 0))
                total[x.shape[1]] = (n + len(part), s + x.sum(axis=0))
        for length, (n, s) in total.items():
            where = pa.array(np.arange(length), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array([length] * length, pa.int32()), where, pa.array([n] * length, pa.int64()), pa.array(s)],
                ["length", "at", "n", "total"],
            )

    parts = rows.select("vector").mapInArrow(task(add), "length int, at int, n long, total long")
    sums = stored(parts.groupBy("length", "at").agg(F.sum("n").alias("n"), F.sum("total").alias("total")), "sums")
    best = sums.filter("at = 0").orderBy(F.desc("n"), F.desc("length")).limit(1).collect()
    if not best:
        return 0, np.zeros(0, np.int64)
    found = sums.filter(F.col("length") == best[0]["length"]).orderBy("at").collect()  # one row for each dimension
    return best[0]["n"], np.array([r["total"] for r in found], np.int64)


def _covariance(rows: DataFrame, n: int, sums: np.ndarray) -> np.ndarray:
    """The covariance of the integer vectors, divisor ``n``, centred before multiplying."""
    d = len(sums)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in batches:
            for _, x in _integers(batch.column("vector")):
                if x.shape[1] == d:
                    y = (n * x - sums) / n
                    total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d), pa.int32()), _lists(total)], ["at", "products"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}  # as many as dimensions
        for batch in batches:
            values = batch.column("products").flatten().to_numpy().reshape(-1, d)
            for at, row in zip(batch.column("at").to_pylist(), values):
                total[at] = total[at] + row if at in total else row.copy()
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), _lists(np.stack(list(total.values())))], ["at", "products"])

    schema = "at int, products array<double>"
    parts = rows.select("vector").mapInArrow(task(multiply), schema).withColumn("part", F.spark_partition_id())
    # Sorted by task, so the sums of a layout are the same each time.
    dealt = parts.repartition("at").sortWithinPartitions("at", "part").select("at", "products")
    found = {r["at"]: r["products"] for r in dealt.mapInArrow(add, schema).collect()}  # d x d numbers
    cov = np.array([found[i] for i in range(d)]) / n
    return (cov + cov.T) / 2


def _lists(matrix: np.ndarray) -> pa.Array:
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(matrix).ravel()))


def _symmetric(m: np.ndarray) -> np.ndarray:
    return (m + m.T) / 2


def _clusters(values: np.ndarray, apart: float) -> list[np.ndarray]:
    """Groups of two or more eigenvalues that follow each other at most ``apart``."""
    order = np.argsort(values, kind="stable")
    cuts = np.flatnonzero(np.diff(values[order]) > apart) + 1
    return [c for c in np.split(order, cuts) if len(c) > 1]


def refined(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix, to double precision.

    The start is a single precision solution X. Each round measures in extended
    precision how far X is from orthogonal (R = I - X'X) and from diagonalising
    (S = X'AX), and adds the correction X E with
    E_ij = (S_ij + l_j R_ij) / (l_j - l_i), which is quadratically convergent.
    For pairs closer than the error bound that quotient is meaningless: they are
    only made orthogonal (E_ij = R_ij / 2), and each such cluster is then
    diagonalised in its own span with its mean taken off, at its own scale.
    """
    d = len(matrix)
    scale = float(np.abs(matrix).max()) if d else 0.0
    if not scale:
        return np.zeros(d), np.eye(d)
    a = matrix.astype(HIGH) / HIGH(scale)
    x = np.linalg.eigh((matrix / scale).astype(np.float32))[1].astype(HIGH)
    size = np.sqrt((a * a).sum())
    eye = np.eye(d, dtype=HIGH)
    best, left = np.inf, 4
    for _ in range(ROUNDS):
        r = _symmetric(eye - x.T @ x)
        s = _symmetric(x.T @ (a @ x))
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(values)
        apart = 2 * (np.sqrt((off * off).sum()) + size * np.sqrt((r * r).sum()))
        # Below this gap rounding alone makes a correction whose square is more than rounding.
        apart = max(apart, np.sqrt(d * np.finfo(HIGH).eps) * size)
        gap = values[None, :] - values[:, None]
        far = np.abs(gap) > apart
        # l_j is the pair's mean plus half its gap: written so, the quotient is exactly antisymmetric.
        mean = (values[None, :] + values[:, None]) / 2
        e = np.where(far, (off + mean * r) / np.where(far, gap, 1), 0) + r / 2
        x = x + x @ e
        clusters = _clusters(values, apart)
        error = float(np.abs(e).max())
        for c in clusters:
            span = x[:, c]
            inner = _symmetric(span.T @ (a @ span)) - np.mean(values[c]) * eye[: len(c), : len(c)]
            tip = np.abs(inner).max()
            if tip > 0:
                turned = np.linalg.eigh((inner / tip).astype(np.float64))[1].astype(HIGH)
                turned = turned + turned @ (eye[: len(c), : len(c)] - turned.T @ turned) / 2
                x[:, c] = span @ turned
        if error >= best / 2:  # no longer falling
            left -= 1
        best = min(best, error)
        if error < 1e-17 or not left:
            break
    values = (x * (a @ x)).sum(axis=0) / (x * x).sum(axis=0)
    x = x / np.sqrt((x * x).sum(axis=0))
    order = np.argsort(-values, kind="stable")
    x, values = x[:, order], values[order]
    x = x * np.where(x[np.abs(x).argmax(axis=0), np.arange(d)] < 0, -1, 1)
    return (values * scale).astype(np.float64), x.astype(np.float64)


def whiten(vectors: DataFrame, components: int = 8, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, n, deviation, whitened (array), explained (array), identity_error`` for each vector that remains.

    An entry c counts as the integer floor(1024 c) + 100000. ``deviation`` is
    the exact sum over dimensions of (n x - S)^2, a decimal of 38 digits.
    """
    rows = _rows(vectors, id_col, vector_col)
    id_field = rows.schema["vec_id"]
    n, sums = _sums(rows)
    d = len(sums)
    values, axes = refined(_covariance(rows, n, sums)) if d else (np.zeros(0), np.zeros((0, 0)))
    total = float(values.sum())
    kept = int((values[:components] > 8 * np.finfo(float).eps * d * total).sum())
    turn = axes[:, :kept] / np.sqrt(values[:kept])

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, x in _integers(batch.column("vector")):
                if x.shape[1] == d:
                    y = n * x - sums
                    ids = batch.column("vec_id").take(pa.array(part))
                    yield pa.RecordBatch.from_arrays([ids, _squares(y), _lists((y / n) @ turn)], ["vec_id", "deviation", "whitened"])

    schema = T.StructType([id_field, T.StructField("deviation", T.DecimalType(38, 0)), T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    if not kept:
        done, error = vectors.sparkSession.createDataFrame([], schema), 0.0
    else:
        done = stored(rows.mapInArrow(task(project), schema), "whitened")
        error = _identity_error(done, kept)
    return done.select(
        "vec_id", F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.lit([float(v) / total for v in values[:kept]]).cast("array<double>").alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def _squares(y: np.ndarray) -> pa.Array:
    """The exact sum of squares of each row."""
    if not y.size or (y.astype(float) ** 2).sum(axis=1).max() < 2.0**62:
        exact = (y * y).sum(axis=1).tolist()
    else:
        exact = [sum(v * v for v in row) for row in y.tolist()]
    return pa.array([Decimal(v) for v in exact], pa.decimal128(38, 0))


def _identity_error(done: DataFrame, k: int) -> float:
    """The largest absolute entry of the whitened rows' covariance minus the identity."""
    at = [(i, j) for i in range(k) for j in range(i, k)]
    found = done.agg(*[F.covar_pop(F.col("whitened")[i], F.col("whitened")[j]).alias(f"c{i}_{j}") for i, j in at]).first()
    return max(abs(v - (i == j)) for v, (i, j) in zip(found, at))
