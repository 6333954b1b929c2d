"""Whitening of integer vectors: pivoted Cholesky of the centred scatter, then one-sided Jacobi on its factor.

The scatter is summed in whole numbers around a whole centre, so it is exact and depends on no order of rows; only the
``d`` x ``d`` matrix, whose size the dimension alone bounds, comes to the driver. With ``A = L L'``, rotations from the
right make the columns of ``L`` orthogonal: their squared norms are the eigenvalues of ``A``, the normalised columns its
eigenvectors, and ``A`` is never multiplied out again.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from sendero.session import table_path

SCALE = 256
EPSILON = float(np.finfo(float).eps)
#: Up to this distance from the centre, sums of products stay exact in doubles for at least 8,192 rows.
EXACT_REACH = 2**20
BLOCK_ROWS = 65_536
SWEEPS = 60


class Whitening(NamedTuple):
    """``sums`` and ``n`` of the fit list; ``components`` (d x k) with falling ``values``; ``trace`` of the covariance."""
    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    trace: float


def pivoted_cholesky(matrix: np.ndarray) -> np.ndarray:
    """``L`` (d x rank) with ``L @ L.T`` equal to the matrix: the largest remaining diagonal entry is the next pivot.

    Rows stay in the matrix's order, so ``L`` is triangular up to the order of its rows.
    """
    rest = np.diag(matrix).astype(float).copy()
    least = EPSILON * len(rest) * (rest.max() if len(rest) else 0.0)
    columns: list[np.ndarray] = []
    open_ = np.ones(len(rest), bool)
    while open_.any():
        pivot = int(np.where(open_, rest, -np.inf).argmax())
        if rest[pivot] <= least:
            break
        column = matrix[:, pivot].astype(float)
        for known in columns:
            column = column - known[pivot] * known
        column = np.where(open_, column / np.sqrt(rest[pivot]), 0.0)
        column[pivot] = np.sqrt(rest[pivot])
        open_[pivot] = False
        rest = rest - column * column
        columns.append(column)
    return np.array(columns).T.reshape(len(rest), len(columns))


def one_sided_jacobi(factor: np.ndarray, sweeps: int = SWEEPS) -> np.ndarray:
    """The factor's columns rotated pairwise until they are orthogonal, by falling norm.

    Pairs are dealt as in a round-robin tournament, so each round rotates disjoint pairs together.
    """
    work = np.array(factor, float)
    seats = work.shape[1] + work.shape[1] % 2
    if work.shape[1] > 1:
        order = np.arange(seats)
        for _ in range(sweeps):
            worst = 0.0
            for _ in range(seats - 1):
                left, right = order[:seats // 2], order[seats // 2:][::-1]
                real = (left < work.shape[1]) & (right < work.shape[1])
                worst = max(worst, _rotate(work, left[real], right[real]))
                order = np.concatenate([order[:1], order[-1:], order[1:-1]])
            if worst <= EPSILON * len(work):
                break
    return work[:, np.argsort(-(work * work).sum(axis=0), kind="stable")]


def _rotate(work: np.ndarray, i: np.ndarray, j: np.ndarray) -> float:
    """Make columns ``i`` and ``j`` orthogonal in place; the largest cosine seen before."""
    a, b = work[:, i], work[:, j]
    aa, bb, ab = (a * a).sum(axis=0), (b * b).sum(axis=0), (a * b).sum(axis=0)
    size = np.sqrt(aa * bb)
    turned = np.abs(ab) > EPSILON * size
    zeta = (bb - aa) / np.where(turned, 2 * ab, 1.0)
    t = np.where(turned, np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta)), 0.0)
    c = 1 / np.sqrt(1 + t * t)
    work[:, i], work[:, j] = c * a - c * t * b, c * t * a + c * b
    return float((np.abs(ab) / np.where(size > 0, size, 1.0)).max(initial=0.0))


def whole_vectors(vectors: DataFrame, key: str, vector: str, scale: int = SCALE) -> DataFrame:
    """``(key, x)``: ``floor(scale * c)`` of each entry, for the vectors that take part.

    Null vectors, those with a null or non-finite entry, and empty ones take no part; neither do vectors of another
    length than the most frequent one (of equally frequent lengths the smallest). An entry beyond the range of a long
    becomes the range's end.
    """
    inf = float("inf")
    rows = vectors.select(vectors[key].cast("bigint").alias("key"), vectors[vector].cast("array<double>").alias("v"))
    rows = rows.where((F.size("v") > 0) & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < inf)))
    lengths = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    dim = lengths["dim"] if lengths else 0
    top = float(2**63)

    def whole(c):
        x = F.floor(c * float(scale))
        return F.when(c * float(scale) >= top, 2**63 - 1).when(c * float(scale) <= -top, -2**63).otherwise(x)
    return rows.where(F.size("v") == dim).select("key", F.transform("v", whole).alias("x"))


def matrix_of(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def first_moments(fit: DataFrame, dim: int) -> tuple[int, list[int], int]:
    """Row count, exact sums per dimension, and the largest absolute entry."""
    size = F.array_max(F.transform("x", lambda c: F.abs(c.cast("decimal(20,0)"))))
    sums = [F.sum(F.col("x")[i].cast("decimal(20,0)")) for i in range(dim)]
    n, largest, *sums = fit.agg(F.count("*"), F.max(size), *sums).first()
    return n, [int(s or 0) for s in sums], int(largest or 0)


def centred_scatter(fit: DataFrame, n: int, sums: list[int], largest: int) -> np.ndarray:
    """Sum over the fit list of ``(x - mean)(x - mean)'``, from products of whole distances to a whole centre."""
    dim = len(sums)
    centre = [(2 * s + n) // (2 * n) for s in sums]
    reach = largest + max(map(abs, centre))
    exact = reach <= EXACT_REACH
    block = min(BLOCK_ROWS, 2**53 // max(reach * reach, 1)) if exact else BLOCK_ROWS
    kind = pa.decimal128(38, 0) if exact else pa.float64()
    schema = pa.schema([("i", pa.int32()), ("products", pa.list_(kind))])
    away = np.array([float(c) for c in centre])

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: np.ndarray | None = None
        for batch in batches:
            rows = matrix_of(batch.column("x"), dim)
            for at in range(0, len(rows), block):
                part = rows[at:at + block].astype(float) - away
                square = part.T @ part
                if exact:
                    square = square.astype(np.int64).astype(object)  # whole numbers below 2**53, summed without bound
                total = square if total is None else total + square
        if total is not None:
            lists = [[Decimal(int(v)) for v in row] for row in total] if exact else total.tolist()
            yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array(lists, schema.field(1).type)], schema=schema)
    parts = fit.mapInArrow(products, f"i int, products array<{'decimal(38,0)' if exact else 'double'}>")
    rows = parts.groupBy("i").agg(*[F.sum(F.col("products")[j]).alias(f"p{j}") for j in range(dim)]).collect()
    scatter = np.zeros((dim, dim))
    for row in rows:
        i = row["i"]
        for j in range(dim):
            if exact:  # n * sum(zz') - sum(z)sum(z)', whole numbers until the last division
                z_i, z_j = sums[i] - n * centre[i], sums[j] - n * centre[j]
                scatter[i, j] = (n * int(row[f"p{j}"]) - z_i * z_j) / n
            else:
                scatter[i, j] = row[f"p{j}"] - (sums[i] / n - centre[i]) * (sums[j] / n - centre[j]) * n
    return (scatter + scatter.T) / 2


def fit_whitening(fit: DataFrame, components: int) -> Whitening | None:
    """Whitening fitted on every row of ``fit`` ``(x)``; None without rows or without variance."""
    first = fit.first()
    if first is None:
        return None
    n, sums, largest = first_moments(fit, len(first["x"]))
    scatter = centred_scatter(fit, n, sums, largest)
    turned = one_sided_jacobi(pivoted_cholesky(scatter / n))
    values = (turned * turned).sum(axis=0)
    kept = min(components, len(values))
    if not kept:
        return None
    units = turned[:, :kept] / np.sqrt(values[:kept])
    largest_at = np.abs(units).argmax(axis=0)
    units = units * np.sign(units[largest_at, np.arange(kept)])  # of either sign, the one whose largest entry is positive
    return Whitening(n, sums, units, values[:kept], float(np.trace(scatter) / n))


def centred(x: np.ndarray, model: Whitening) -> np.ndarray:
    """``x - S/n``: the whole part of the mean is taken off first, so that no digit is lost where x and mean are large."""
    whole = np.array([s // model.n for s in model.sums], np.int64)
    part = np.array([(s % model.n) / model.n for s in model.sums])
    near = (np.abs(x) < 2**62).all() and (np.abs(whole) < 2**62).all()
    apart = (x - whole).astype(float) if near else x.astype(float) - whole.astype(float)
    return apart - part


def whitened(x: np.ndarray, model: Whitening) -> np.ndarray:
    return centred(x, model) @ model.components / np.sqrt(model.values)


def deviations(x: np.ndarray, model: Whitening) -> list[int]:
    """Sum over dimensions of ``(n * x - S) ** 2``, in long where it fits, else in Python's integers."""
    reach = model.n * int(max(abs(int(x.max())), abs(int(x.min())))) + max(map(abs, model.sums))
    if reach * reach * x.shape[1] < 2**63:
        apart = x * model.n - np.array(model.sums, np.int64)
        return (apart * apart).sum(axis=1).tolist()
    return [sum((model.n * v - s) ** 2 for v, s in zip(row, model.sums)) for row in x.tolist()]


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """The largest entry, without sign, of the whitened fit list's covariance minus the identity."""
    k = model.components.shape[1]
    told = fit.sparkSession.sparkContext.broadcast(model)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                w = whitened(matrix_of(batch.column("x"), len(told.value.sums)), told.value)
                square = w.T @ w
                yield pa.RecordBatch.from_arrays([pa.array([v], pa.float64()) for v in [*w.sum(axis=0), *square.ravel()]],
                                                 [f"c{i}" for i in range(k + k * k)])
    names = [f"c{i}" for i in range(k + k * k)]
    parts = fit.mapInArrow(products, ", ".join(f"{c} double" for c in names))
    sums = np.array(parts.agg(*[F.sum(c) for c in names]).first(), float) / model.n
    covariance = sums[k:].reshape(k, k) - np.outer(sums[:k], sums[:k])  # the means are rounding alone
    return float(np.abs(covariance - np.eye(k)).max())


def whiten(vectors: DataFrame, components: int = 4, key: str = "vec_id", vector: str = "embedding",
           scale: int = SCALE) -> DataFrame:
    """``(key, component, n, deviation, deviation_exact, whitened, explained, identity_error)``, a row per component.

    Every row that ``whole_vectors`` keeps gets its rows, repeated rows and null keys too; other columns are not read.
    The fit list is each distinct vector once. There are as many components as the covariance has rank, at most
    ``components``; equal vectors only, or none, give no rows. ``deviation`` is null where the exact number, of up to
    38 digits in ``deviation_exact``, does not fit a long; beyond 38 digits both are null. The fit list is written to the shared folder
    and read for each pass; the rest is one pass over the vectors without a shuffle.
    """
    spark: SparkSession = vectors.sparkSession
    rows = whole_vectors(vectors, key, vector, scale)
    path = table_path(spark, "fit-list")
    rows.select("x").distinct().write.parquet(path)
    fit = spark.read.parquet(path)
    model = fit_whitening(fit, components)
    out = (f"{key} bigint, component int, n bigint, deviation bigint, deviation_exact decimal(38,0), whitened double, "
           "explained double, identity_error double")
    if model is None:
        return spark.createDataFrame([], out)
    error = identity_error(fit, model)
    told = spark.sparkContext.broadcast(model)

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = told.value
        k = len(known.values)
        explained = known.values / known.trace
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix_of(batch.column("x"), len(known.sums))
            deviation = deviations(x, known)
            each = np.repeat(np.arange(len(x)), k)
            exact = [Decimal(d) if d < 10**38 else None for d in deviation]
            short = [d if d < 2**63 else None for d in deviation]
            count = len(each)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                 pa.array(np.full(count, known.n)), pa.array(short, pa.int64()).take(pa.array(each)),
                 pa.array(exact, pa.decimal128(38, 0)).take(pa.array(each)), pa.array(whitened(x, known).ravel()),
                 pa.array(np.tile(explained, len(x))), pa.array(np.full(count, error))],
                [key, "component", "n", "deviation", "deviation_exact", "whitened", "explained", "identity_error"])
    return rows.mapInArrow(transform, out)
