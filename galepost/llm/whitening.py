"""Whitening of vectors by the refined eigenvectors of their covariance.

Entries become whole numbers, so the covariance is exact: sums first, then products of
entries less their mean's whole part, both as integers in every task. Its eigenvectors are
found in float32 and corrected by matrix-multiplication iterations in higher precision; where
eigenvalues lie too close for such a step, the part of the matrix that belongs to them is
shifted and solved by itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galepost.session import stage

from .common import map_batches

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 32
# Scaled entries below this keep all sums of products whole; a larger one would not leave a
# row's squared deviations room in a long either.
LARGEST = 1 << 40
# A sum of products is kept as high * 2^40 + low, which are longs in every task.
LIMB = 40
LIMB_ROWS = 1 << 17
# Up to this size, products of 500 rows are exact in a double.
EXACT = 1 << 21
# Steps double the right digits, so few are needed; clusters take one or two more.
MAX_STEPS = 30
# Eigenvalues closer than so many times the error are a cluster: corrections divide by the gap.
NEAR = 64
# Steps without a gain after which rounding is all that is left.
IDLE_STEPS = 3

WIDE = np.longdouble


@dataclass
class Whitening:
    """What is known of the fit rows; as large as the square of the dimension."""

    n: int
    centre: np.ndarray  # whole part of each dimension's mean, of scaled entries
    rest: list[int]  # n times what is left of the mean
    values: np.ndarray  # eigenvalues of the components
    vectors: np.ndarray  # their unit eigenvectors, a column each
    explained: np.ndarray
    identity_error: float = 0.0


def usable_vectors(rows: DataFrame, vector: str, key: str) -> DataFrame:
    """``(id, vec)`` of the rows that can be whitened, with one dimension for all.

    Rows go whose vector is null, empty, or holds a null, non-finite or too large entry
    (``LARGEST``). Of vectors of different lengths those of the most frequent length stay,
    of equally frequent ones the shorter.
    """
    fits = F.forall(
        vector,
        lambda c: F.coalesce(
            ~F.isnan(c) & (F.abs(c.cast("double")) * SCALE < float(LARGEST)), F.lit(False)
        ),
    )
    good = rows.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vec")).where(
        F.col(vector).isNotNull() & (F.size(vector) > 0) & fits
    )
    common = (
        good.groupBy(F.size("vec").alias("length"))
        .count()
        .orderBy(F.desc("count"), "length")
        .first()
    )
    return good.where(F.size("vec") == (common["length"] if common else 0))


def _scaled(batch: pa.RecordBatch, column: str = "vec") -> np.ndarray:
    """Whole scaled entries, a row for each vector."""
    vectors = batch.column(column)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(SCALE * flat).astype(np.int64).reshape(len(vectors), -1)


def _by_dimension(rows: DataFrame) -> list:
    """(dimension, rows, sum of scaled entries), a record for each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            if batch.num_rows:
                here = _scaled(batch)
                n += len(here)
                total = here.sum(axis=0) if total is None else total + here.sum(axis=0)
            if total is not None and n >= LIMB_ROWS:
                yield pa.record_batch(
                    {"dim": np.arange(len(total)), "n": np.full(len(total), n), "total": total}
                )
                n, total = 0, None
        if total is not None:
            yield pa.record_batch(
                {"dim": np.arange(len(total)), "n": np.full(len(total), n), "total": total}
            )

    return (
        map_batches(rows.select("vec"), run, "dim long, n long, total long")
        .groupBy("dim")
        .agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
        .orderBy("dim")
        .collect()
    )


def _products(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """High and low parts of the exact sums of products of whole columns."""
    if np.abs(y).max(initial=0) < EXACT:
        wide = y.astype(np.float64)
        return _limbs((wide.T @ wide).astype(np.int64))
    # Entries below 2^41 in two parts, so each product of parts is exact in a double.
    high = (y >> 20).astype(np.float64)
    low = (y & ((1 << 20) - 1)).astype(np.float64)
    across = high.T @ low
    parts = [
        (_limbs((low.T @ low).astype(np.int64)), 0),
        (_limbs((across + across.T).astype(np.int64)), 20),
    ]
    top, rest = (high.T @ high).astype(np.int64), np.zeros(across.shape, dtype=np.int64)
    for (h, l), shift in parts:
        top += (h << shift) + (l >> (LIMB - shift))
        rest += (l & ((1 << (LIMB - shift)) - 1)) << shift
    return top + (rest >> LIMB), rest & ((1 << LIMB) - 1)


def _limbs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return values >> LIMB, values & ((1 << LIMB) - 1)


def _gram(rows: DataFrame, centre: np.ndarray) -> list:
    """(i, j, high, low): sums of products of centred entries, for i <= j."""
    d = len(centre)
    upper = np.triu_indices(d)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def record():
            return pa.record_batch(
                {"i": upper[0], "j": upper[1], "high": high[upper], "low": low[upper]}
            )

        n, high, low = 0, np.zeros((d, d), np.int64), np.zeros((d, d), np.int64)
        for batch in batches:
            if batch.num_rows:
                h, l = _products(_scaled(batch) - centre)
                n, high, low = n + batch.num_rows, high + h, low + l
            if n >= LIMB_ROWS:
                yield record()
                n, high, low = 0, np.zeros((d, d), np.int64), np.zeros((d, d), np.int64)
        if n:
            yield record()

    wide = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")]
    return (
        map_batches(rows.select("vec"), run, "i long, j long, high long, low long")
        .groupBy("i", "j")
        .agg(*wide)
        .collect()
    )


def _ratio(over: int, under: int) -> np.longdouble:
    whole, rest = divmod(over, under)
    return WIDE(whole) + WIDE(rest) / WIDE(under)


def refine_eigenvectors(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and vectors of the symmetric ``a``, from the approximate vectors ``x``.

    Each step measures how far ``x`` is from orthogonal and from diagonalising ``a`` and adds
    the correction that removes both to first order. For eigenvalues closer than what the
    step can tell apart it only orthogonalises; their vectors then span the right space, in
    which ``a`` less their mean eigenvalue is solved by itself.
    """
    a, x = a.astype(WIDE), x.astype(WIDE)
    d = len(a)
    eye, size = np.eye(d, dtype=WIDE), float(np.linalg.norm(a.astype(np.float64)))
    rounding = d * float(np.finfo(WIDE).eps) * size
    best, best_error, idle = x, np.inf, 0
    for _ in range(MAX_STEPS):
        r = eye - x.T @ x
        s = x.T @ (a @ x)
        s = (s + s.T) / 2
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(values)
        error = float(np.linalg.norm(off.astype(np.float64)))
        error += size * float(np.linalg.norm(r.astype(np.float64)))
        idle = 0 if error < best_error / 2 else idle + 1
        if error < best_error:
            best, best_error = x.copy(), error
        if error <= rounding or idle == IDLE_STEPS:
            break
        gap = values[None, :] - values[:, None]
        near = np.abs(gap) <= NEAR * error
        e = np.where(near, r / 2, (s + values[None, :] * r) / np.where(near, 1, gap))
        x = x + x @ e
        order = np.argsort(values)
        cuts = np.flatnonzero(np.diff(values[order]) > NEAR * error) + 1
        for cluster in np.split(order, cuts):
            if len(cluster) > 1:
                part = x[:, cluster]
                shifted = part.T @ (a @ part - values[cluster].mean() * part)
                shifted = ((shifted + shifted.T) / 2).astype(np.float64)
                if np.abs(shifted - np.diag(np.diag(shifted))).max() > rounding:
                    x[:, cluster] = part @ np.linalg.eigh(shifted)[1].astype(WIDE)
    x = best / np.sqrt(np.sum(best * best, axis=0))
    values = np.sum(x * (a @ x), axis=0)
    order = np.argsort(-values, kind="stable")
    return values[order], x[:, order]


def fit_whitening(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of ``usable_vectors`` rows; None where there are none.

    A component without variance cannot be scaled to one and is left out, so constant or
    dependent dimensions give fewer components.
    """
    sums = _by_dimension(rows)
    if not sums:
        return None
    n = int(sums[0]["n"])
    parts = [divmod(int(row["total"]), n) for row in sums]
    centre, rest = np.array([p[0] for p in parts], np.int64), [p[1] for p in parts]
    d = len(centre)
    covariance = np.zeros((d, d), dtype=WIDE)
    for i, j, high, low in _gram(rows, centre):
        total = (int(high) << LIMB) + int(low)
        covariance[i, j] = covariance[j, i] = _ratio(n * total - rest[i] * rest[j], n * n)
    _, start = np.linalg.eigh(covariance.astype(np.float32))
    values, vectors = refine_eigenvectors(covariance, start)
    usable = int(np.sum(values > max(values[0], 0) * d * 2.0**-50))
    kept = min(components, usable)
    vectors = vectors[:, :kept].astype(np.float64)
    # The largest entry of each vector is positive, so a refit gives the same signs.
    vectors *= np.sign(vectors[np.argmax(np.abs(vectors), axis=0), np.arange(kept)])
    trace = np.trace(covariance)
    explained = (values[:kept] / trace if kept else values[:0]).astype(np.float64)
    return Whitening(n, centre, rest, values[:kept].astype(np.float64), vectors, explained)


def _project(fit: Whitening, y: np.ndarray) -> np.ndarray:
    mean = np.array([float(_ratio(t, fit.n)) for t in fit.rest])
    return ((y - mean) @ fit.vectors) / np.sqrt(fit.values)


def _deviation(fit: Whitening, y: np.ndarray) -> list[int | None]:
    """Sum over dimensions of (n x - sum)^2; None where it does not fit a long."""
    about = np.square(y.astype(np.float64) * fit.n - np.array(fit.rest, np.float64)).sum(axis=1)
    out: list[int | None] = [None] * len(y)
    small = about < 2.0**62
    if small.any():
        # Each term's root is below 2^31 here, so nothing overflows.
        terms = y[small] * np.int64(fit.n) - np.array(fit.rest, np.int64)
        for at, value in zip(np.flatnonzero(small), (terms * terms).sum(axis=1), strict=True):
            out[at] = int(value)
    for at in np.flatnonzero(~small & (about < 2.0**64)):
        value = sum((int(v) * fit.n - t) ** 2 for v, t in zip(y[at], fit.rest, strict=True))
        out[at] = value if value < 1 << 63 else None
    return out


def identity_error(rows: DataFrame, fit: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    k = len(fit.values)
    if not k:
        return 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, products, n = np.zeros(k), np.zeros((k, k)), 0
        for batch in batches:
            if batch.num_rows:
                white = _project(fit, _scaled(batch) - fit.centre)
                total, products, n = total + white.sum(axis=0), products + white.T @ white, n + 1
        if n:
            i, j = np.indices((k, k + 1))
            both = np.concatenate([products, total[:, None]], axis=1)
            yield pa.record_batch({"i": i.ravel(), "j": j.ravel(), "v": both.ravel()})

    sums = np.zeros((k, k + 1))
    cells = map_batches(rows.select("vec"), run, "i long, j long, v double")
    for i, j, v in cells.groupBy("i", "j").agg(F.sum("v")).collect():
        sums[i, j] = v
    mean = sums[:, k] / fit.n
    return float(np.abs(sums[:, :k] / fit.n - np.outer(mean, mean) - np.eye(k)).max())


SCHEMA = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double,"
    " identity_error double"
)


def whiten(
    rows: DataFrame, vector: str = "embedding", key: str = "vec_id", components: int = COMPONENTS
) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)``, a row for
    each usable vector and component.

    Rows without a usable vector (``usable_vectors``) are left out; a table without any, or
    with vectors that are all the same, gives no rows. Ids may be null or repeat: every row is
    one of the fit and has its own result. Other columns of the table are not read.
    ``deviation`` is null where it does not fit a long.
    """
    good = stage(usable_vectors(rows, vector, key), "vectors")
    fit = fit_whitening(good, components)
    if fit is None:
        return rows.sparkSession.createDataFrame([], SCHEMA)
    fit.identity_error = identity_error(good, fit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(fit.values)
        for batch in batches:
            m = batch.num_rows
            if not m or not k:
                continue
            y = _scaled(batch) - fit.centre
            each = np.repeat(np.arange(m), k)
            yield pa.record_batch(
                {
                    "vec_id": batch.column("id").take(pa.array(each)),
                    "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    "n": np.full(m * k, fit.n),
                    "deviation": pa.array(_deviation(fit, y), pa.int64()).take(pa.array(each)),
                    "whitened": _project(fit, y).ravel(),
                    "explained": np.tile(fit.explained, m),
                    "identity_error": np.full(m * k, fit.identity_error),
                }
            )

    return map_batches(good, run, SCHEMA)
