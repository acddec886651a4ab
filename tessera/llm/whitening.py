"""Embedding whitening: principal components by contour integration (FEAST), held complete by inertia counts.

    vectors   embeddings -> integer vectors floor(scale * c)
    fit list  each distinct vector once
    moments   partial sums per task -> n, S, then the covariance of the fit list, exact
    FEAST     an interval of the spectrum -> its eigenvectors
    whitened  (x - S/n) . u / sqrt(e) for every vector

The covariance is exact: vectors are shifted by the rounded mean before they are multiplied, products are summed as integers,
and each entry is rounded once.  It is the only thing that passes the driver: D (D + 1) / 2 numbers, whatever the number of rows.

Components: inertia counts of shifted covariances (the signs of the pivots of a symmetric elimination say how many
eigenvalues lie above the shift) bracket the eigenvalues around the last one wanted and choose a cut in the widest gap
behind it.  On the circle through that cut and the top of the spectrum, Gauss-Legendre quadrature of the
solves ``(z - V)^-1 Y`` projects a random block ``Y`` onto the eigenvectors inside; each node's solve is a
Spark task.  Rayleigh-Ritz in the projected block gives Ritz pairs, which are the next block, until the residuals
stop falling.  The number of Ritz values inside must equal the inertia count of the interval, or the block grows.

Defined cases: null vectors and those with null or non-finite entries are dropped; an entry beyond a long fails;
vectors of each length are whitened among themselves, an empty one has no components; repeated rows and null ids are kept;
the fit list counts a vector once; a component without variance has a null ``whitened`` and ``explained`` 0 (null if nothing varies);
extra columns are ignored.

Scale: three passes over the fit list and one over the rows.  The fit list needs one shuffle, which first drops repeats
in each task, so a vector that a third of all rows repeat is one row per task.
"""

from __future__ import annotations

import functools
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import prepared, staged

_NUMBER = pa.decimal128(38, 0)
#: Eigenvalues below this share of the largest one count as zero.
NO_VARIANCE = 1e-13


# -- vectors ---------------------------------------------------------------------

def integer_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 256) -> DataFrame:
    """(id, x: array<long>) of the rows whose vector is whole and finite."""
    v = F.col("v")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    scaled = F.transform(v, lambda c: F.when(F.abs(c * scale) < 2.0 ** 63, F.floor(c * scale)).otherwise(
        F.raise_error(F.lit("a vector's entry is no long after scaling")).cast("long")))
    rows = df.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v")).filter(v.isNotNull()).filter(finite)
    return rows.select("id", scaled.alias("x"))


def _matrices(batch: pa.RecordBatch, column: int):
    """(row numbers, matrix) for each vector length in the batch."""
    lists = batch.column(column)
    offsets = lists.offsets.to_numpy()
    values = lists.values.to_numpy(zero_copy_only=False)
    lengths = np.diff(offsets)
    for dim in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == dim)
        yield rows, values[offsets[:-1][rows][:, None] + np.arange(dim)]


def _whole(values: np.ndarray, most: int) -> np.ndarray:
    """Integers that stay exact in sums below ``most``: as they are, or as Python's."""
    return values if most < 1 << 62 else values.astype(object)


def _numbers(values) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], _NUMBER)


# -- moments ---------------------------------------------------------------------

def _sums(batches):
    """Partial (dim, i, value): the number of vectors (i = -1) and the sum of each entry."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for rows, x in _matrices(batch, 0):
            dim, top = x.shape[1], int(np.abs(x.astype(float)).max(initial=0)) + 1
            part = np.concatenate(([len(rows)], _whole(x, top * len(rows)).sum(0))).astype(object)
            total[dim] = total[dim] + part if dim in total else part
    for dim, part in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([dim] * (dim + 1), pa.int32()), pa.array(range(-1, dim), pa.int32()), _numbers(part)],
                                         names=["dim", "i", "value"])


def _products(batches, shifts: dict[int, list[int]]):
    """Partial (dim, i, j, value), i <= j: sums of products of the shifted entries."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for rows, x in _matrices(batch, 0):
            dim = x.shape[1]
            top = (int(np.abs(x.astype(float)).max(initial=0)) + 1 + max(map(abs, shifts[dim]), default=0)) ** 2 * len(rows)
            y = (x if top < 1 << 62 else x.astype(object)) - np.array(shifts[dim], np.int64 if top < 1 << 62 else object)
            if top < 1 << 53:  # every partial sum is a whole double
                y = y.astype(float)
                part = (y.T @ y).astype(np.int64).astype(object)
            else:
                part = (y.T @ y).astype(object)
            total[dim] = total[dim] + part if dim in total else part
    for dim, part in total.items():
        i, j = np.triu_indices(dim)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), dim, np.int32)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                                          _numbers(part[i, j])], names=["dim", "i", "j", "value"])


class Moments(NamedTuple):
    """Of one vector length: size of the fit list, sums, rounded means, and the covariance."""
    n: int
    sums: list[int]
    shift: list[int]
    covariance: np.ndarray


def moments(fit: DataFrame) -> dict[int, Moments]:
    """By vector length, from the distinct vectors ``x``."""
    first = fit.select("x").mapInArrow(_sums, "dim int, i int, value decimal(38,0)").groupBy("dim", "i").agg(F.sum("value").alias("value")).collect()
    at = {(r.dim, r.i): int(r.value) for r in first}
    dims = sorted({d for d, _ in at if d})
    sums = {d: [at[d, i] for i in range(d)] for d in dims}
    shifts = {d: [(2 * s + at[d, -1]) // (2 * at[d, -1]) for s in sums[d]] for d in dims}
    rows = (fit.filter("size(x) > 0").select("x").mapInArrow(functools.partial(_products, shifts=shifts), "dim int, i int, j int, value decimal(38,0)")
            .groupBy("dim", "i", "j").agg(F.sum("value").alias("value")).collect())
    out = {}
    for d in dims:
        n, rest = at[d, -1], [s - at[d, -1] * m for s, m in zip(sums[d], shifts[d])]
        v = np.zeros((d, d))
        for r in rows:
            if r.dim == d:
                v[r.i, r.j] = v[r.j, r.i] = (n * int(r.value) - rest[r.i] * rest[r.j]) / (n * n)  # of integers: rounded once
        out[d] = Moments(n, sums[d], shifts[d], v)
    return out


# -- eigenvectors ----------------------------------------------------------------

def eigenvalues_above(v: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix exceed ``shift``: the positive pivots of ``v - shift`` (complete symmetric pivoting)."""
    a = v - shift * np.eye(len(v))
    alpha, above = (1 + 17 ** 0.5) / 8, 0
    while len(a):
        diagonal = np.abs(np.diagonal(a))
        off = np.abs(a)
        np.fill_diagonal(off, 0)
        p, q = divmod(int(off.argmax()), len(a))
        r = int(diagonal.argmax())
        if max(diagonal[r], off[p, q]) == 0:
            break
        pivots = [r] if diagonal[r] >= alpha * off[p, q] else [p, q]
        above += int(a[r, r] > 0) if len(pivots) == 1 else 1  # a pivot of two rows has one eigenvalue of either sign
        rest = np.delete(np.arange(len(a)), pivots)
        side = a[np.ix_(rest, pivots)]
        a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(a[np.ix_(pivots, pivots)], side.T)
    return above


def _cut(v: np.ndarray, wanted: int, top: float, most: int, further: int = 4, steps: int = 16) -> tuple[float, int]:
    """A shift in a wide gap behind the ``wanted``-th eigenvalue, and how many eigenvalues exceed it; ``most`` are not zero."""
    counts = {0.0 + NO_VARIANCE * top: most, top: 0}

    def bracket(k: int) -> tuple[float, float]:
        """Shifts with ``k`` or more, and with fewer than ``k`` eigenvalues above."""
        for _ in range(steps):
            low = max(s for s, c in counts.items() if c >= k)
            high = min(s for s, c in counts.items() if c < k)
            counts[(low + high) / 2] = eigenvalues_above(v, (low + high) / 2)
        return max(s for s, c in counts.items() if c >= k), min(s for s, c in counts.items() if c < k)

    best = (-1.0, NO_VARIANCE * top, most)
    for k in range(wanted, min(wanted + further, most) + 1):
        above = bracket(k)[0]
        below = bracket(k + 1)[1] if k < most else NO_VARIANCE * top
        best = max(best, (above - below, (above + below) / 2, k))
    return best[1], best[2]


def _solves(batches, v: np.ndarray, block: np.ndarray):
    """(real and imaginary part of a node and of its weight) to the weighted real part of its solve."""
    for batch in batches:
        for zr, zi, wr, wi in zip(*(batch.column(i).to_pylist() for i in range(4))):
            found = (complex(wr, wi) * np.linalg.solve(complex(zr, zi) * np.eye(len(v)) - v, block.astype(complex))).real
            yield pa.RecordBatch.from_arrays([pa.array([found.tobytes()], pa.binary())], names=["found"])


def _projected(spark: SparkSession, v: np.ndarray, block: np.ndarray, low: float, high: float, nodes: int) -> np.ndarray:
    """The quadrature of ``(z - v)^-1 block`` over the circle on (low, high); the lower half mirrors the upper one."""
    x, w = np.polynomial.legendre.leggauss(nodes)
    turn = (high - low) / 2 * np.exp(0.5j * np.pi * (1 - x))
    z, w = (low + high) / 2 + turn, w / 2 * turn
    rows = [(float(a.real), float(a.imag), float(b.real), float(b.imag)) for a, b in zip(z, w)]
    found = spark.createDataFrame(rows, "zr double, zi double, wr double, wi double").repartition(nodes).mapInArrow(
        functools.partial(_solves, v=v, block=block), "found binary").collect()
    return sum(np.frombuffer(r.found).reshape(block.shape) for r in found)


def top_components(spark: SparkSession, v: np.ndarray, k: int, nodes: int = 8, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of the ``k`` largest eigenvalues, without those that are zero."""
    top = float(np.abs(v).sum(1).max(initial=0)) * (1 + 1e-9)  # no eigenvalue lies above
    most = eigenvalues_above(v, NO_VARIANCE * top) if top > 0 else 0
    if not min(k, most):
        return np.zeros(0), np.zeros((len(v), 0))
    low, inside = _cut(v, min(k, most), top, most)
    size = min(len(v), inside + inside // 2 + 4)
    while True:
        block, before = np.random.default_rng(0).standard_normal((len(v), size)), np.inf
        for _ in range(rounds):
            q = np.linalg.qr(_projected(spark, v, block, low, top, nodes))[0]
            values, turn = np.linalg.eigh(q.T @ v @ q)
            block = q @ turn
            held = np.flatnonzero(values > low)
            error = np.abs(v @ block[:, held] - block[:, held] * values[held]).max(initial=0) / top
            if len(held) == inside and (error <= 4e-16 or error >= before / 2) and error < 1e-13:
                held = held[::-1][:min(k, most)]
                u = block[:, held] / np.linalg.norm(block[:, held], axis=0)
                u = u * np.where(u[np.abs(u).argmax(0), np.arange(len(held))] < 0, -1, 1)
                return values[held], u
            before = error if len(held) == inside else np.inf
        if size == len(v):
            raise ArithmeticError(f"{len(held)} eigenvalues found where the inertia counts {inside}")
        size = min(len(v), 2 * size)


# -- whitening -------------------------------------------------------------------

class Model(NamedTuple):
    moments: Moments
    components: int
    values: np.ndarray
    vectors: np.ndarray
    explained: list


def _centred(x: np.ndarray, m: Moments) -> np.ndarray:
    rest = np.array([(s - m.n * c) / m.n for s, c in zip(m.sums, m.shift)])
    return (x - np.array(m.shift)).astype(float) - rest


def _scores(x: np.ndarray, model: Model) -> np.ndarray:
    return _centred(x, model.moments) @ (model.vectors / np.sqrt(model.values))


def _spread(batches, models: dict[int, Model]):
    """Partial (dim, i, j, value): sums of the whitened entries (j = -1) and of their products."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for _, x in _matrices(batch, 0):
            w = _scores(x, models[x.shape[1]])
            part = np.column_stack((w.sum(0), w.T @ w))
            total[x.shape[1]] = total.get(x.shape[1], 0) + part
    for dim, part in total.items():
        i, j = np.indices(part.shape)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(part.size, dim, np.int32)), pa.array(i.ravel().astype(np.int32)),
                                          pa.array(j.ravel().astype(np.int32) - 1), pa.array(part.ravel())], names=["dim", "i", "j", "value"])


def _identity_errors(fit: DataFrame, models: dict[int, Model]) -> dict[int, float]:
    """By vector length, the largest absolute entry of the whitened fit list's covariance minus the identity."""
    rows = (fit.filter("size(x) > 0").select("x").mapInArrow(functools.partial(_spread, models=models), "dim int, i int, j int, value double")
            .groupBy("dim", "i", "j").agg(F.sum("value").alias("value")).collect())
    at = {(r.dim, r.i, r.j): r.value for r in rows}
    out: dict[int, float] = {}
    for (d, i, j), value in at.items():
        if j >= 0:
            n = models[d].moments.n
            out[d] = max(out.get(d, 0.0), abs(value / n - at[d, i, -1] / n * at[d, j, -1] / n - (i == j)))
    return out


def _whiten(batches, models: dict[int, Model], errors: dict[int, float]):
    for batch in batches:
        for rows, x in _matrices(batch, 1):
            if x.shape[1] == 0:
                continue
            model = models[x.shape[1]]
            m, k = model.moments, model.components
            most = m.n * (int(np.abs(x.astype(float)).max(initial=0)) + 1) + max(map(abs, m.sums))
            kind = np.int64 if most ** 2 * x.shape[1] < 1 << 62 else object
            away = ((m.n * x.astype(kind) - np.array(m.sums, kind)) ** 2).sum(1)
            away = pa.array(away).cast(_NUMBER) if kind is np.int64 else _numbers(away)
            w = np.full((len(rows), k), np.nan)
            w[:, :len(model.values)] = _scores(x, model)
            take = pa.array(np.repeat(rows, k))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))), pa.array([m.n] * (k * len(rows)), pa.int64()),
                 away.take(pa.array(np.repeat(np.arange(len(rows)), k))), pa.array(w.ravel(), from_pandas=True),
                 pa.array(model.explained * len(rows), pa.float64()), pa.array([errors.get(x.shape[1])] * (k * len(rows)), pa.float64())],
                names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = 4, scale: int = 256) -> DataFrame:
    """One row per whole, finite vector and component (numbered from 1, by falling eigenvalue): id, component, n, deviation
    (decimal: sum of ``(n x - S)^2``), whitened, explained, identity_error."""
    spark = df.sparkSession
    prepared(spark)
    rows = integer_vectors(df, id_col, vec_col, scale)
    fit = staged(rows.select("x").distinct(), "whitening-fit")
    models = {}
    for d, m in moments(fit).items():
        values, vectors = top_components(spark, m.covariance, components)
        trace, k = float(np.trace(m.covariance)), min(components, d)
        explained = [e / trace for e in values.tolist()] + [0.0 if trace else None] * (k - len(values))
        models[d] = Model(m, k, values, vectors, explained)
    errors = _identity_errors(fit, models)
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType)]).add("component", T.IntegerType()).add("n", T.LongType()) \
        .add("deviation", T.DecimalType(38, 0)) \
        .add("whitened", T.DoubleType()).add("explained", T.DoubleType()).add("identity_error", T.DoubleType())
    out = rows.select("id", "x").mapInArrow(functools.partial(_whiten, models=models, errors=errors), schema)
    return out.select(F.col("id").alias(id_col), *out.columns[1:])
