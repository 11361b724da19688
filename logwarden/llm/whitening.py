"""Embedding whitening: eigenpairs by rank-one updates, refined over all data by Rayleigh-Ritz.

Every partition of the fit list keeps the spectrum of its scatter matrix about the common mean and
updates it vector by vector: the new eigenvalues are the roots of a secular equation, after parts
that the update does not touch are deflated. Spectra of partitions are combined a few at a time,
each eigenpair of one being a rank-one update of the other. The basis found is then refined by one
pass over the data: the covariance projected on it is all but diagonal, and its eigenvectors turn
the basis into the final one.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden.operators.durable import durable

COMPONENTS = 4

#: Entries are counted in steps of 1 / SCALE.
SCALE = 256

#: Partial results that one task combines at a time, and vectors whose spectrum one task makes.
FAN_IN, TASK_VECTORS = 8, 10_000

#: Eigenvalues below this share of the largest count as zero: no component can be scaled by them.
RANK_TOLERANCE = 1e-12

EPS = np.finfo(float).eps

PARTS = "part long, values array<double>, matrix array<double>"
ROWS = "vec_id long, component int, deviation long, whitened double"


# one rank-one update

def secular(d: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum_j weight_j / (d_j - root) = 0 for ascending, different d and positive weights.

    Root i lies between d_i and d_i+1, the last one up to sum(weight) above the last d. All roots
    advance together; each is kept as its distance from the nearer pole, so the differences
    d_j - root_i, returned as the second result by [i, j], are accurate to the last digits. Each step fits
    a pole on either side to value and slope; a step that leaves the bracket is replaced by halving it.
    """
    k = len(d)
    gap = np.append(d[1:], d[-1] + weight.sum()) - d
    middle = gap / 2
    below = np.tri(k, dtype=bool)
    own = np.arange(k)
    beside = np.minimum(own + 1, k - 1)
    last = own == k - 1
    value = 1 + (weight / (d - (d + middle)[:, None])).sum(1)
    right = (value < 0) & ~last
    pole = np.where(right, d + gap, d)
    pole[:-1][right[:-1]] = d[1:][right[:-1]]  # the pole itself, not d plus a rounded gap
    away = d - pole[:, None]
    low = np.where(right, -middle, 0.0)
    high = np.where(right, 0.0, np.where(last, gap, middle))
    low[-1], high[-1] = (middle[-1], gap[-1] * (1 + 4 * EPS)) if value[-1] < 0 else (0.0, middle[-1])
    mu = (low + high) / 2
    open_ = np.ones(k, bool)
    with np.errstate(all="ignore"):
        for _ in range(80):
            differ = away - mu[:, None]
            term = weight / differ
            slope = term / differ
            psi, phi = np.where(below, term, 0).sum(1), np.where(below, 0, term).sum(1)
            psi_, phi_ = np.where(below, slope, 0).sum(1), np.where(below, 0, slope).sum(1)
            f = 1 + psi + phi
            open_ &= np.abs(f) > EPS * k * (1 + np.abs(psi) + np.abs(phi))
            if not open_.any():
                break
            low, high = np.where(f < 0, mu, low), np.where(f < 0, high, mu)
            left, next_ = differ[own, own], differ[own, beside]
            a = (left + next_) * f - left * next_ * (psi_ + phi_)
            b = left * next_ * f
            c = f - left * psi_ - next_ * phi_
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            step[-1] = left[-1] + psi_[-1] * left[-1] ** 2 / (f[-1] - left[-1] * psi_[-1])
            new = mu + step
            new = np.where(np.isfinite(new) & (new > low) & (new < high), new, (low + high) / 2)
            open_ &= np.abs(new - mu) > EPS * np.abs(new) / 2
            mu = np.where(open_, new, mu)
            if not open_.any():
                break
    return pole + mu, away - mu[:, None]


def rank_one(values: np.ndarray, vectors: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spectrum of vectors diag(values) vectors' + x x'. Values ascend; vectors are orthonormal columns."""
    z = vectors.T @ x
    size = float(z @ z)
    if size == 0:
        return values, vectors
    tiny = 8 * EPS * max(abs(values[-1]), abs(values[0]), size)
    weighty = np.abs(z) * np.sqrt(size) > tiny
    kept = np.flatnonzero(weighty)
    if len(kept) == 0:
        return values, vectors
    p, q = z[kept[:-1]], z[kept[1:]]
    if (np.diff(values[kept]) * np.abs(p * q) <= tiny * (p * p + q * q)).any():
        values, vectors, z, kept = _deflate_close(values, vectors, z, kept, tiny)
    d, w = values[kept], z[kept]
    roots, differ = secular(d, w * w)
    between = d[:, None] - d
    np.fill_diagonal(between, 1.0)
    with np.errstate(all="ignore"):
        # weights for which these roots are exact, so that the vectors come out orthogonal
        exact = np.sqrt(np.abs(np.prod(differ / between, axis=0)))
        turn = np.copysign(exact, w) / differ
        turn /= np.sqrt((turn * turn).sum(1))[:, None]
    if not np.isfinite(turn).all():  # a root upon its pole: fall back to the dense problem
        roots, turned = np.linalg.eigh(np.diag(d) + np.outer(w, w))
        turn = turned.T
    values, vectors = values.copy(), vectors.copy()
    values[kept] = roots
    vectors[:, kept] = vectors[:, kept] @ turn.T
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


def _deflate_close(values, vectors, z, kept, tiny):
    """Turn pairs of (all but) equal eigenvalues so that the update touches only one of them."""
    values, vectors, z = values.copy(), vectors.copy(), z.copy()
    stay, before = [], kept[0]
    for i in kept[1:]:
        length = np.hypot(z[before], z[i])
        c, s = z[i] / length, -z[before] / length
        gap = values[i] - values[before]
        if abs(gap * c * s) <= tiny:
            z[i], z[before] = length, 0.0
            a, b = vectors[:, before].copy(), vectors[:, i].copy()
            vectors[:, before], vectors[:, i] = c * a + s * b, c * b - s * a
            values[before], values[i] = values[before] * c * c + values[i] * s * s, values[before] * s * s + values[i] * c * c
        else:
            stay.append(before)
        before = i
    return values, vectors, z, np.array([*stay, before])


def add_spectrum(values, vectors, more_values, more_vectors):
    """The spectrum of the sum of two matrices: each eigenpair of the second updates the first."""
    for value, vector in zip(more_values, more_vectors.T):
        if value > 0:
            values, vectors = rank_one(values, vectors, np.sqrt(value) * vector)
    return values, vectors


# Spark

def counted(vector: Column) -> Column:
    """floor(SCALE * entry) of each entry, as long."""
    return F.transform(vector.cast("array<double>"), lambda c: F.floor(c * SCALE).cast("long"))


def usable(vectors: DataFrame, vector: str) -> DataFrame:
    v = F.col(vector).cast("array<double>")
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vectors.where(F.col(vector).isNotNull() & F.coalesce(fine, F.lit(False)))


def blocks(batches, column: str):
    """Each batch's vectors as a matrix of longs."""
    for batch in batches:
        lists = batch.column(batch.schema.get_field_index(column))
        if batch.num_rows:
            yield batch, lists.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def in_rounds(parts: DataFrame, combine: Callable, label: str) -> tuple[np.ndarray, np.ndarray] | None:
    """Combine all rows of PARTS, FAN_IN at a time, until one is left; None if there is none."""
    def merge(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        rows = group.sort_values("part")
        values, matrix = rows["values"].iloc[0], rows["matrix"].iloc[0]
        for other in zip(rows["values"].iloc[1:], rows["matrix"].iloc[1:]):
            values, matrix = combine(values, matrix, *other)
        return pd.DataFrame({"part": [int(key[0])], "values": [values], "matrix": [matrix]})

    parts = durable(parts, label)
    while (top := parts.agg(F.max("part")).head()[0] or 0) > 0:  # parts are numbered from 0 to top, with holes
        groups = -(-(top + 1) // FAN_IN)
        parts = durable(parts.groupBy((F.col("part") % groups).alias("bundle")).applyInPandas(merge, PARTS), label)
    row = parts.select("values", "matrix").head()
    return row and (np.array(row["values"]), np.array(row["matrix"]))


def _part(values: np.ndarray, matrix: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([values.ravel()], pa.list_(pa.float64())),
         pa.array([matrix.ravel()], pa.list_(pa.float64()))], ["part", "values", "matrix"])


def column_sums(fit: DataFrame) -> list[int]:
    """Exact sum of every dimension."""
    def sums(batches):
        total = None
        for _, x in blocks(batches, "x"):
            safe = int(np.abs(x.astype(float)).max()) * len(x) < 2**62
            part = [int(v) for v in (x if safe else x.astype(object)).sum(0)]
            total = part if total is None else [a + b for a, b in zip(total, part)]
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(total)), pa.int32()), pa.array([str(t) for t in total])], ["i", "total"])

    rows = fit.mapInArrow(sums, "i int, total string").groupBy("i").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).orderBy("i").collect()
    return [int(r["total"]) for r in rows]


def spectra(fit: DataFrame, mean: np.ndarray) -> DataFrame:
    """The spectrum of each partition's scatter about the mean."""
    def updates(batches):
        values, vectors, seen = np.zeros(len(mean)), np.eye(len(mean)), False
        for _, x in blocks(batches, "x"):
            for row in x - mean:
                values, vectors = rank_one(values, vectors, row)
                seen = True
        if seen:
            yield _part(values, vectors)

    return fit.mapInArrow(updates, PARTS)


def moments(fit: DataFrame, mean: np.ndarray, basis: np.ndarray) -> DataFrame:
    """Sums and products of each partition's vectors, centred and projected on the basis."""
    def products(batches):
        total = None
        for _, x in blocks(batches, "x"):
            y = (x - mean) @ basis
            part = y.sum(0), y.T @ y
            total = part if total is None else (total[0] + part[0], total[1] + part[1])
        if total is not None:
            yield _part(*total)

    return fit.mapInArrow(products, PARTS)


def _summed(fit: DataFrame, mean: np.ndarray, basis: np.ndarray, label: str) -> tuple[np.ndarray, np.ndarray]:
    size = basis.shape[1]
    sums, products = in_rounds(moments(fit, mean, basis), lambda v, m, w, n: (v + w, m + n), label)
    return sums, products.reshape(size, size)


def eigenpairs(fit: DataFrame, mean: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """All eigenvalues of the covariance, falling, and the unit eigenvectors as columns."""
    size = len(mean)

    def combine(values, flat, more, more_flat):
        values, vectors = add_spectrum(values, flat.reshape(size, size), more, more_flat.reshape(size, size))
        return values, vectors.ravel()

    spread = fit.repartition(-(-n // TASK_VECTORS))
    _, flat = in_rounds(spectra(spread, mean), combine, "whitening-spectra")
    basis, _ = np.linalg.qr(flat.reshape(size, size)[:, ::-1])
    _, products = _summed(fit, mean, basis, "whitening-ritz")
    values, turn = np.linalg.eigh(products / n)
    vectors = basis @ turn[:, ::-1]
    return values[::-1], vectors / np.linalg.norm(vectors, axis=0)


def whiten(vectors: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """For each usable row and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Rows whose vector is null or holds null or non-finite entries are left out. The covariance is
    that of the different vectors, each counted once, so copies, however many, change nothing; they
    are dropped where they lie before anything is shuffled. Only vectors of the most common length
    (of equally common ones the longest) share a space; others are left out, as are empty ones. There are as many
    components as the data have directions: none for a single different vector or an empty table,
    which give no rows. A missing vec_id stays null, repeated rows stay rows. A deviation that no
    long can hold is null. Other columns are ignored.

    The driver holds matrices of the number of dimensions squared, never rows.
    """
    rows = usable(vectors, vector).select(F.col("vec_id").cast("long").alias("vec_id"), counted(F.col(vector)).alias("x"))
    fit = durable(rows.where(F.size("x") > 0).select("x").distinct(), "whitening-fit")
    lengths = fit.groupBy(F.size("x").alias("dims")).agg(F.count(F.lit(1)).alias("n"))
    common = lengths.orderBy(F.desc("n"), F.desc("dims")).head()
    schema = f"{ROWS}, n long, explained double, identity_error double"
    columns = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    if common is None:
        return rows.sparkSession.createDataFrame([], schema).select(*columns)
    dims, n = common["dims"], common["n"]
    fit, rows = fit.where(F.size("x") == dims), rows.where(F.size("x") == dims)
    sums = column_sums(fit)
    mean = np.array([s / n for s in sums])
    values, basis = eigenpairs(fit, mean, n)
    rank = int((values > RANK_TOLERANCE * values[0]).sum()) if values[0] > 0 else 0
    count = min(components, rank)
    if count == 0:
        return rows.sparkSession.createDataFrame([], schema).select(*columns)
    scaled = basis[:, :count] / np.sqrt(values[:count])
    first, second = _summed(fit, mean, scaled, "whitening-identity")
    identity_error = float(np.abs(second / n - np.outer(first / n, first / n) - np.eye(count)).max())
    explained = [float(v) for v in values[:count] / values.sum()]

    def project(batches):
        for batch, x in blocks(batches, "x"):
            whitened = (x - mean) @ scaled
            furthest = n * int(np.abs(x.astype(float)).max()) + max(map(abs, sums))
            if dims * furthest**2 < 2**62:
                away = n * x - np.array(sums)
                deviation = (away * away).sum(1).tolist()
            else:
                away = n * x.astype(object) - np.array(sums, object)
                deviation = [v if v < 2**63 else None for v in (away * away).sum(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("vec_id")).take(pa.array(np.repeat(np.arange(batch.num_rows), count))),
                 pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), batch.num_rows)),
                 pa.array([v for v in deviation for _ in range(count)], pa.int64()), pa.array(whitened.ravel())],
                ["vec_id", "component", "deviation", "whitened"])

    return rows.mapInArrow(project, ROWS).select(
        "vec_id", "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(F.array(*[F.lit(v) for v in explained]), F.col("component")).alias("explained"),
        F.lit(identity_error).alias("identity_error"))
