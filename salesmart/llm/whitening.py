"""Whitening of embeddings on mixed-precision eigenvectors.

Entries become integers (``floor(SCALE * c) + SHIFT``). Two passes over the
vectors give the covariance without rounding: the first one the count and the
sum of every dimension, the second one the products of the vectors centred at
the whole number nearest below each mean. These products are integers, summed
per task and then by Spark, one row per pair of dimensions; what the centring
left over is less than one and is taken out exactly. Only the covariance, its
size fixed by the dimensions, reaches the driver.

There its eigenvectors are found in float32, then corrected by the iteration of
Ogita and Aishima: with the eigenvectors ``X`` so far, ``R = I - X'X`` and
``S = X'AX`` in extended precision give the correction ``X (I + E)``, matrix
multiplications only, and the error is squared by every round. Where
eigenvalues lie closer together than the error bound tells apart, ``E`` takes
only the orthogonality part, and the cluster is solved by itself: ``A`` minus
the cluster's centre, seen in the cluster's vectors, is a small matrix whose
eigenvectors turn them; the rounds go on until nothing moves.

Defined cases: rows whose vector is null or has a null, NaN or infinite entry
are left out; repeated rows count as often as they stand there; rows of equal
vectors, null or repeated ids give equal values each; vectors of different
lengths, or entries beyond ``MOST`` when scaled, fail the job with a message; a
component whose variance is 0 (a constant dimension, fewer vectors than
dimensions) cannot be whitened and gives no rows, so one vector alone, or none,
gives an empty result; a ``deviation`` beyond 64 bits is null; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
MOST = 1 << 52  # scaled entries are exact as doubles up to here
SLICE_ROWS = 4096
ROUNDS = 40
HALF = 26  # bits of the lower half of a wide entry
_SUM = 1 << 62


def usable(vector: Column) -> Column:
    """Whether a vector is there, with finite entries only."""
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & fine, F.lit(False))


def _matrices(batch: pa.RecordBatch, column: int, dims: int | None) -> Iterator[tuple[slice, np.ndarray]]:
    """Scaled vectors of a batch, some thousand rows at a time."""
    for i in range(0, len(batch), SLICE_ROWS):
        rows = slice(i, min(i + SLICE_ROWS, len(batch)))
        vectors = batch.column(column)[rows]
        length = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
        if len(length) and (length != (length[0] if dims is None else dims)).any():
            raise ValueError(f"vectors of different lengths: {sorted(set(length.tolist()) | ({dims} if dims else set()))[:5]}")
        values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        scaled = np.floor(SCALE * values)
        if len(scaled) and np.abs(scaled).max() >= MOST:
            raise ValueError(f"an entry of {np.abs(values).max()} is too large to be scaled exactly")
        yield rows, scaled.reshape(len(length), -1).astype(np.int64) + SHIFT


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per slice of rows and dimension: count, sum, least and most."""
    dims = None
    for batch in batches:
        for _, x in _matrices(batch, 0, dims):
            dims = x.shape[1]
            for k in range(0, len(x), 512):  # 512 * MOST fits
                y = x[k:k + 512]
                n = max(1, dims)
                total = y.sum(0) if dims else [0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(n), pa.int32()), pa.array(np.full(n, dims), pa.int32()), pa.array(np.full(n, len(y))),
                     pa.array(total, pa.int64()), pa.array(y.min(0) if dims else [0], pa.int64()),
                     pa.array(y.max(0) if dims else [0], pa.int64())],
                    ["dim", "dims", "n", "total", "least", "most"])


def _products(mean: np.ndarray, reach: int):
    """Sums of the products of centred vectors, one row per pair of dimensions
    and task (more where a sum might not fit). Wide entries are split in two
    halves; ``shift`` tells which halves a sum is of."""
    dims = len(mean)
    upper = np.triu_indices(dims)
    cells = upper[0].astype(np.int64) * dims + upper[1]
    wide = reach >= 1 << HALF
    half = reach >> HALF if wide else reach
    most = max((half + 1) ** 2, 1 << 2 * HALF if wide else 1) * (2 if wide else 1)  # one row adds so much to a sum

    def products(z: np.ndarray) -> list[np.ndarray]:
        if not wide:
            f = z.astype(np.float64)
            return [(f.T @ f).astype(np.int64)]
        high, low = z >> HALF, z & ((1 << HALF) - 1)
        return [low.T @ low, high.T @ low + low.T @ high, high.T @ high]

    step = max(1, min(SLICE_ROWS, (_SUM if wide else 1 << 53) // most))  # products of doubles stay exact

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, room = None, _SUM

        def out() -> Iterator[pa.RecordBatch]:
            for k, total in enumerate(totals):
                yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(np.full(len(cells), k, np.int32)), pa.array(total)],
                                                 ["cell", "shift", "total"])

        for batch in batches:
            for _, x in _matrices(batch, 0, dims):
                z = x - mean
                for k in range(0, len(z), step):
                    part = z[k:k + step]
                    if totals is None or len(part) * most > room:
                        if totals is not None:
                            yield from out()
                        totals, room = [0] * (3 if wide else 1), _SUM
                    totals = [t + p[upper] for t, p in zip(totals, products(part))]
                    room -= len(part) * most
        if totals is not None:
            yield from out()

    return run


@dataclass
class Moments:
    """Count, sums and exact covariance of the scaled vectors."""
    n: int
    sums: list[int]
    mean: np.ndarray  # whole numbers
    reach: int        # most that a centred entry is away from 0
    covariance: np.ndarray  # longdouble


def _long(value: Fraction) -> np.longdouble:
    """A fraction rounded to extended precision."""
    high = float(value)
    return np.longdouble(high) + np.longdouble(float(value - Fraction(high)))


def moments(vectors: DataFrame, column: str) -> Moments | None:
    """The moments of a column of usable vectors; None without any."""
    rows = vectors.select(F.col(column).alias("vector"))
    wide = F.col("total").cast("decimal(38,0)")
    found = sorted(rows.mapInArrow(_sums, "dim int, dims int, n long, total long, least long, most long")
                   .groupBy("dim").agg(F.min("dims").alias("dims"), F.max("dims").alias("most_dims"), F.sum("n").alias("n"),
                                       F.sum(wide).alias("total"), F.min("least").alias("least"), F.max("most").alias("most"))
                   .collect(), key=lambda r: r["dim"])  # one row per dimension
    if not found:
        return None
    if len({d for r in found for d in (r["dims"], r["most_dims"])}) > 1:
        raise ValueError("vectors of different lengths")
    n, dims = found[0]["n"], found[0]["dims"]
    if not dims:
        return None
    sums = [int(r["total"]) for r in found]
    mean = [s // n for s in sums]
    reach = max(max(r["most"] - m, m - r["least"]) for r, m in zip(found, mean))
    cells = (rows.mapInArrow(_products(np.array(mean, np.int64), reach), "cell long, shift int, total long")
             .groupBy("cell", "shift").agg(F.sum(wide).alias("total")).collect())  # three rows per pair of dimensions at most
    products: dict[int, int] = {}
    for r in cells:
        products[r["cell"]] = products.get(r["cell"], 0) + (int(r["total"]) << HALF * r["shift"])
    left = [s - n * m for s, m in zip(sums, mean)]  # sums of the centred vectors
    covariance = np.zeros((dims, dims), np.longdouble)
    for cell, total in products.items():
        i, j = divmod(cell, dims)
        covariance[i, j] = covariance[j, i] = _long(Fraction(n * total - left[i] * left[j], n * n))
    return Moments(n, sums, np.array(mean, np.int64), reach, covariance)


def _norm(a: np.ndarray) -> np.longdouble:
    return np.sqrt((a * a).sum())


def _clusters(close: np.ndarray) -> list[np.ndarray]:
    """Indices of eigenvalues that chains of ``close`` ones connect; two or more."""
    out, seen = [], np.zeros(len(close), bool)
    for i in range(len(close)):
        if seen[i]:
            continue
        member, edge = np.zeros(len(close), bool), np.array([i])
        while len(edge):
            member[edge] = True
            edge = np.flatnonzero(close[edge].any(0) & ~member)
        seen |= member
        if member.sum() > 1:
            out.append(np.flatnonzero(member))
    return out


def refined_eigen(a: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric
    longdouble matrix, as longdouble."""
    size = _norm(a)
    if not size:
        return np.zeros(len(a), np.longdouble), np.eye(len(a), dtype=np.longdouble)
    a = a / size
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    eye, eps = np.eye(len(a), dtype=np.longdouble), np.finfo(np.longdouble).eps
    noise = 8 * eps * np.sqrt(len(a))  # of the products below
    for _ in range(rounds):
        r, s = eye - x.T @ x, x.T @ (a @ x)
        r, s = (r + r.T) / 2, (s + s.T) / 2
        value = np.diag(s) / (1 - np.diag(r))
        if max(np.abs(r).max(), np.abs(s - np.diag(np.diag(s))).max()) < noise:
            break
        gap = value[None, :] - value[:, None]
        bound = 2 * (_norm(s - np.diag(np.diag(s))) + _norm(r))
        close = np.abs(gap) <= bound
        np.fill_diagonal(close, False)
        turn = s + value[None, :] * r
        only_r = close | (np.abs(turn) < noise) | np.eye(len(a), dtype=bool)  # nothing to turn, or no telling
        x = x + x @ np.where(only_r, r / 2, turn / np.where(only_r, 1, gap))
        for group in _clusters(close):
            # The cluster by itself: its centre taken off, its spread is all that is left.
            y = x[:, group]
            y = y + y @ ((np.eye(len(group)) - y.T @ y) / 2)
            t = y.T @ (a @ y - value[group].mean() * y)
            spread = np.abs(t).max()
            if spread > noise:
                y = y @ np.linalg.eigh(((t + t.T) / (2 * spread)).astype(np.float64))[1].astype(np.longdouble)
            x[:, group] = y
    x = x / np.sqrt((x * x).sum(0))
    value = np.einsum("ij,ij->j", x, a @ x) * size
    order = np.argsort(-value, kind="stable")
    return value[order], x[:, order]


@dataclass
class Whitening:
    moments: Moments
    values: np.ndarray   # eigenvalues kept, falling
    vectors: np.ndarray  # their eigenvectors, as columns
    trace: float

    def apply(self, x: np.ndarray) -> np.ndarray:
        """Whitened components of scaled vectors (rows)."""
        m = self.moments
        left = np.array([float(Fraction(s - m.n * int(k), m.n)) for s, k in zip(m.sums, m.mean)])
        return ((x - m.mean) - left) @ (self.vectors / np.sqrt(self.values)[None, :])


def fit(vectors: DataFrame, column: str, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of a column of usable vectors; None if nothing varies."""
    m = moments(vectors, column)
    if m is None:
        return None
    values, x = refined_eigen(m.covariance)
    trace = np.trace(m.covariance)
    # What rounding leaves of a variance of 0 is below this.
    kept = np.flatnonzero(values > trace * len(values) * np.finfo(np.float64).eps)[:components]
    if not len(kept):
        return None
    return Whitening(m, values[kept].astype(np.float64), x[:, kept].astype(np.float64), float(trace))


def _deviation(x: np.ndarray, m: Moments) -> list[int | None]:
    """Sum over dimensions of (n x - S)^2, exact; null beyond 64 bits."""
    left = [s - m.n * int(k) for s, k in zip(m.sums, m.mean)]
    most = m.n * (m.reach + 1)
    if most * most * x.shape[1] < 1 << 63:
        d = m.n * (x - m.mean) - np.array(left, np.int64)
        return (d * d).sum(1).tolist()
    d = m.n * (x - m.mean).astype(object) - np.array(left, object)
    return [v if v < 1 << 63 else None for v in (d * d).sum(1)]


def whitened(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
             components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component: vec_id, component (from 1),
    n, deviation, whitened, explained (share of the variance) and
    identity_error (of the covariance of all whitened vectors)."""
    rows = embeddings.where(usable(F.col(vector_col))).select(F.col(id_col).cast("long").alias("vec_id"),
                                                               F.col(vector_col).alias("vector"))
    schema = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    model = fit(rows, "vector", components)
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    shared = rows.sparkSession.sparkContext.broadcast(model)  # its size is set by the dimensions
    k = len(model.values)

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums of the whitened components and of their products, per task."""
        total, seen = np.zeros((k + 1, k)), False
        for batch in batches:
            for _, x in _matrices(batch, 0, len(model_dims)):
                w = shared.value.apply(x)
                total[:k] += w.T @ w
                total[k] += w.sum(0)
                seen = True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size), pa.int64()), pa.array(total.ravel())], ["cell", "total"])

    model_dims = model.moments.sums
    total = np.zeros((k + 1) * k)
    for r in rows.select("vector").mapInArrow(gram, "cell long, total double").groupBy("cell").agg(F.sum("total").alias("total")).collect():
        total[r["cell"]] = r["total"]
    total = total.reshape(k + 1, k) / model.moments.n
    error = float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        share = m.values / m.trace
        for batch in batches:
            for some, x in _matrices(batch, 1, len(m.moments.sums)):
                n = len(x)
                per_row = np.repeat(np.arange(n), k)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[some].take(pa.array(per_row)), pa.array(np.tile(np.arange(1, k + 1), n), pa.int32()),
                     pa.array(np.full(n * k, m.moments.n)), pa.array(_deviation(x, m.moments), pa.int64()).take(pa.array(per_row)),
                     pa.array(m.apply(x).ravel()), pa.array(np.tile(share, n)), pa.array(np.full(n * k, error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema)
