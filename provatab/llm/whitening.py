"""Embedding whitening by pivoted Cholesky and one-sided Jacobi rotations (operator 11).

Entries become integers, so sums are exact. Spark adds up one vector of sums, then the scatter of the centred vectors,
one row of it per key; what reaches the driver is a matrix of dimension by dimension, whatever the number of vectors.
There the scatter is factored with pivoting into a lower triangle whose columns end where the scatter's rank ends, and
Jacobi rotations make the columns of that triangle orthogonal. The norms of the rotated columns are the square roots
of the eigenvalues and the normalised columns, with the pivoting undone, are the components.

Vectors of each length make a space of their own, with its own count, sums and components.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provatab.llm.common import free_name, written

# Vectors handled at once; sweeps after which Jacobi rotations are taken to have failed.
ROWS, SWEEPS = 4_096, 60
LONG = np.iinfo(np.int64)


def pivoted_cholesky(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(factor, order)``: ``scatter[order][:, order] = factor @ factor.T``, with as many columns as the rank."""
    a = np.array(scatter, np.float64)
    size = len(a)
    order, factor = np.arange(size), np.zeros((size, size))
    left = a.diagonal().copy()
    least = size * np.finfo(np.float64).eps * max(left.max(initial=0.0), 0.0)
    for k in range(size):
        p = k + int(np.argmax(left[k:]))
        if left[p] <= least:
            return factor[:, :k], order
        for x in (order, left, factor):
            x[[k, p]] = x[[p, k]]
        root = np.sqrt(left[k])
        factor[k, k] = root
        rest = order[k + 1 :]
        factor[k + 1 :, k] = (a[rest, order[k]] - factor[k + 1 :, :k] @ factor[k, :k]) / root
        left[k + 1 :] -= factor[k + 1 :, k] ** 2
    return factor, order


def rotated(factor: np.ndarray) -> np.ndarray:
    """``factor`` times an orthogonal matrix, with columns orthogonal to each other to double precision.

    Columns are dealt into pairs as in a round-robin, so the pairs of a round are disjoint and turn together.
    """
    columns = np.array(factor.T, np.float64)  # one column per row, so that pairs are gathered contiguously
    n = len(columns)
    seats = np.arange(n + n % 2)  # an odd one sits out against the seat beyond the last column
    tolerance = np.finfo(np.float64).eps * np.sqrt(max(factor.shape[0], 1))
    for _ in range(SWEEPS):
        turned = False
        for _ in range(len(seats) - 1):
            half = len(seats) // 2
            i, j = seats[:half], seats[half:][::-1]
            real = (i < n) & (j < n)
            i, j = i[real], j[real]
            x, y = columns[i], columns[j]
            alpha, beta, gamma = (x * x).sum(axis=1), (y * y).sum(axis=1), (x * y).sum(axis=1)
            act = np.abs(gamma) > tolerance * np.sqrt(alpha * beta)
            if act.any():
                turned = True
                i, j, x, y = i[act], j[act], x[act], y[act]
                zeta = (beta[act] - alpha[act]) / (2 * gamma[act])
                t = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
                c = 1 / np.hypot(1.0, t)
                s = (c * t)[:, None]
                c = c[:, None]
                columns[i], columns[j] = c * x - s * y, s * x + c * y
            seats = np.concatenate([seats[:1], seats[-1:], seats[1:-1]])
        if not turned:
            return columns.T
    raise ArithmeticError("Jacobi rotations did not converge")


def principal_axes(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positive eigenvalues of ``scatter``, falling, and their unit eigenvectors as columns."""
    factor, order = pivoted_cholesky(scatter)
    turned = rotated(factor)
    norms = np.sqrt((turned**2).sum(axis=0))
    fall = np.argsort(-norms, kind="stable")
    axes = np.empty_like(turned)
    axes[order] = turned / norms
    return norms[fall] ** 2, axes[:, fall]


# --- vectors -----------------------------------------------------------------------------------


def as_long(c: np.ndarray) -> np.ndarray:
    """``floor(1024 * c) + 100000``; where a long can't hold it, the nearest end of the longs."""
    with np.errstate(over="ignore"):
        x = np.floor(c * 1024.0)
    out = np.clip(x, -(2.0**63), np.nextafter(2.0**63, 0)).astype(np.int64)
    return np.minimum(out, LONG.max - 100_000) + 100_000


def spaces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, np.ndarray]]:
    """Rows, length and entries as longs of the usable vectors of each batch, by length."""
    for whole in batches:
        for at in range(0, whole.num_rows, ROWS):
            batch = whole.slice(at, ROWS)
            vectors = batch.column(batch.schema.get_field_index("_v"))
            lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
            flat = np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), np.float64)
            ends = np.cumsum(lengths)
            for size in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == size)
                yield batch.take(pa.array(rows)), size, as_long(flat[(ends[rows] - size)[:, None] + np.arange(size)])


def usable(vectors: DataFrame, column: str) -> DataFrame:
    """Rows whose vector is neither null nor empty and holds finite entries alone, as doubles in ``_v``."""
    vector = F.col(column).cast("array<double>")
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vectors.where(F.col(column).isNotNull() & (F.size(column) > 0) & ~F.coalesce(bad, F.lit(True))).withColumn("_v", vector)


def summed(parts: DataFrame) -> list:
    """Rows ``size, i, values`` added up by size and i, in tasks that each hold the sums of the keys dealt to them."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for size, i, values in zip(*(batch.column(c).to_pylist() for c in ("size", "i")), batch.column("values"), strict=True):
                values = np.asarray(values.values)
                sums[size, i] = sums[size, i] + values if (size, i) in sums else values
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in sums], pa.int32()), pa.array([k[1] for k in sums], pa.int32()), pa.array(list(sums.values()))],
                names=["size", "i", "values"],
            )

    return parts.repartition("size", "i").mapInArrow(add, parts.schema).collect()


def _totals(rows: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Count and exact sums per dimension, by length. Sums go in two halves of 32 bits, so none can overflow."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for _, size, x in spaces(batches):
            own = np.stack([(x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0), np.full(size, len(x))])
            found[size] = found.get(size, 0) + own
        for size, own in found.items():
            yield pa.RecordBatch.from_arrays([pa.array([size] * 3, pa.int32()), pa.array(range(3), pa.int32()), pa.array(list(own))], names=["size", "i", "values"])

    halves: dict[int, dict[int, list[int]]] = {}
    for r in summed(rows.select("_v").mapInArrow(work, "size int, i int, values array<long>")):
        halves.setdefault(r["size"], {})[r["i"]] = r["values"]
    return {size: (h[2][0], [(a << 32) + b for a, b in zip(h[0], h[1])]) for size, h in halves.items()}


def _scatters(rows: DataFrame, means: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """Sum of the outer products of the centred vectors with themselves, by length."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for _, size, x in spaces(batches):
            y = x - means[size]
            found[size] = found.get(size, 0.0) + y.T @ y
        for size, own in found.items():
            yield pa.RecordBatch.from_arrays([pa.array([size] * size, pa.int32()), pa.array(range(size), pa.int32()), pa.array(list(own))], names=["size", "i", "values"])

    out = {size: np.zeros((size, size)) for size in means}
    for r in summed(rows.select("_v").mapInArrow(work, "size int, i int, values array<double>")):
        out[r["size"]][r["i"]] = r["values"]
    return {size: (a + a.T) / 2 for size, a in out.items()}


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over the dimensions of ``(n * x - S)**2``, exact; null beyond a long."""
    far = max((max(abs(n * int(lo) - s), abs(n * int(hi) - s)) for lo, hi, s in zip(x.min(axis=0), x.max(axis=0), sums)), default=0)
    if far < 1 << 31 and far * far * x.shape[1] <= LONG.max and n * int(np.abs(x).max()) <= LONG.max:
        return ((n * x - np.array(sums, np.int64)) ** 2).sum(axis=1).tolist()
    exact = ((n * x.astype(object) - np.array(sums, object)) ** 2).sum(axis=1)
    return [v if v <= LONG.max else None for v in exact]


def whitened_rows(vectors: DataFrame, *, id_column: str = "vec_id", column: str = "embedding", components: int = 8) -> DataFrame:
    """One row per usable vector: its id, ``n``, ``deviation``, ``size`` (its length), ``whitened`` and ``explained``
    (arrays of a value per component, largest eigenvalue first).

    A vector that is null, empty or holds a null or non-finite entry is dropped. There are no more components than the
    rank of the covariance, so vectors that are all equal have none (empty arrays). Repeated rows count each; a null
    id is an id like any other; other columns are not read.
    """
    rows = usable(vectors.select(F.col(id_column), F.col(column)), column).select(F.col(id_column).alias("_id"), "_v")
    totals = _totals(rows)
    means = {size: np.array([s / n for s in sums]) for size, (n, sums) in totals.items()}
    bases = {}
    for size, scatter in _scatters(rows, means).items():
        values, axes = principal_axes(scatter / totals[size][0])
        k = min(components, len(values))
        bases[size] = (axes[:, :k] / np.sqrt(values[:k]), (values[:k] / np.trace(scatter) * totals[size][0]).tolist())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, size, x in spaces(batches):
            n, sums = totals[size]
            axes, explained = bases[size]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([n] * len(x)), pa.array(deviations(x, n, sums), pa.int64()), pa.array([size] * len(x), pa.int32()),
                 pa.array(list((x - means[size]) @ axes), pa.list_(pa.float64())), pa.array([explained] * len(x), pa.list_(pa.float64()))],
                names=["_id", "n", "deviation", "size", "whitened", "explained"],
            )

    kind = dict(vectors.dtypes)[id_column]
    found = rows.mapInArrow(work, f"_id {kind}, n long, deviation long, size int, whitened array<double>, explained array<double>")
    return written(found, "whitened").withColumnRenamed("_id", id_column)


def identity_errors(whitened: DataFrame, components: int) -> DataFrame:
    """``size`` and ``identity_error``: largest absolute entry of the covariance of ``whitened`` minus the identity.

    Covariances are Spark's, which centre before they multiply. Null where a size has no component.
    """
    cells = []
    for i, j in combinations_with_replacement(range(components), 2):
        found = F.covar_pop(F.get("whitened", F.lit(i)), F.get("whitened", F.lit(j)))
        cells.append(F.abs(found - F.lit(float(i == j))))
    return whitened.groupBy("size").agg(F.greatest(*cells, F.lit(None)).alias("identity_error"))


def component_rows(vectors: DataFrame, *, id_column: str = "vec_id", column: str = "embedding", components: int = 8) -> DataFrame:
    """Per usable vector and component (numbered from 1 by falling eigenvalue): the id, ``component``, ``n``,
    ``deviation``, ``whitened``, ``explained``, ``identity_error`` (one value per length of vectors).

    See :func:`whitened_rows` for nulls, empty vectors, repeated rows and ranks below ``components``; an empty table
    gives no rows.
    """
    found = whitened_rows(vectors, id_column=id_column, column=column, components=components)
    errors = {r["size"]: r["identity_error"] for r in identity_errors(found, components).collect()}
    error = F.create_map(*[F.lit(x) for kv in errors.items() for x in kv])[F.col("size")] if errors else F.lit(None)
    each = found.select(F.col(id_column), "n", "deviation", error.cast("double").alias("identity_error"), F.posexplode(F.arrays_zip("whitened", "explained")))
    return each.select(id_column, (F.col("pos") + 1).cast("int").alias("component"), "n", "deviation", "col.whitened", "col.explained", "identity_error")
