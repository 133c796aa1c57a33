"""Whitening of embeddings by spectral divide and conquer.

Tasks sum the entries, then the centred products; the covariance (dimension squared, not
rows) comes to the driver.  There its eigenvectors are found by QDWH: the polar factor of
the covariance less a shift is the matrix sign of it, which gives the projectors on the
eigenvectors above and below the shift; both subspaces are split again until every block
is one component.  The projection is then sent to all tasks.

QDWH and the divide and conquer: Nakatsukasa and Higham, Stable and Efficient Spectral
Divide and Conquer Algorithms for the Symmetric Eigenvalue Decomposition and the SVD, 2013.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EPS = np.finfo(float).eps
SCALE, OFFSET = 1024, 100_000


# --- the decomposition of a symmetric matrix --------------------------------------------

def polar(a: np.ndarray, most: int = 12) -> np.ndarray | None:
    """Orthogonal polar factor of ``a`` by the dynamically weighted Halley iteration; None
    if ``a`` is too close to singular for it to settle."""
    size = np.linalg.norm(a)
    if size == 0:
        return None
    x, low, unit = a / size, EPS, np.eye(len(a))
    for _ in range(most):
        d = np.cbrt(4 * (1 - low**2) / low**4)
        wa = math.sqrt(1 + d) + 0.5 * math.sqrt(max(8 - 4 * d + 8 * (2 - low**2) / (low**2 * math.sqrt(1 + d)), 0))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        before = x
        if wc > 100:  # ill-conditioned: by a QR factorisation
            q, _ = np.linalg.qr(np.vstack([math.sqrt(wc) * x, unit]))
            x = wb / wc * x + (wa - wb / wc) / math.sqrt(wc) * q[:len(a)] @ q[len(a):].T
        else:
            x = wb / wc * x + (wa - wb / wc) * np.linalg.solve(unit + wc * x.T @ x, x.T).T
        low = min(low * (wa + wb * low**2) / (1 + wc * low**2), 1.0)
        x = (x + x.T) / 2
        if abs(1 - low) < 10 * EPS and np.linalg.norm(x - before) < (4 * EPS) ** (1 / 3):
            return x
    return None


def _basis(projector: np.ndarray, k: int, rnd: np.random.Generator) -> np.ndarray:
    """Orthonormal columns that span the range of a projector of rank ``k``."""
    q = np.linalg.qr(projector @ rnd.standard_normal((len(projector), k)))[0]
    return np.linalg.qr(projector @ q)[0]


def _halves(a: np.ndarray, rnd: np.random.Generator) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of the eigenvectors of ``a`` above and below a shift, or None if all of its
    eigenvalues are the same to double precision."""
    n, size = len(a), np.linalg.norm(a)
    radius = np.abs(a - np.diag(np.diag(a))).sum(axis=1)
    high, low = (np.diag(a) + radius).max(), (np.diag(a) - radius).min()  # Gershgorin
    shift = float(np.median(np.diag(a)))
    for attempt in range(200):
        if high - low <= 4 * n * EPS * size:
            return None
        sign = polar(a - shift * np.eye(n))
        if sign is not None:
            above = (np.eye(n) + sign) / 2
            k = round(np.trace(above))
            if 0 < k < n and abs(np.trace(above) - k) < 0.01:
                return _basis(above, k, rnd), _basis(np.eye(n) - above, n - k, rnd)
            if k == 0:
                high = min(high, shift)
            elif k == n:
                low = max(low, shift)
            shift = (low + high) / 2
        else:  # on an eigenvalue: beside it
            shift = low + (high - low) * rnd.uniform(0.1, 0.9)
    return None


def eigenvectors(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of a symmetric matrix."""
    a = (a + a.T) / 2
    rnd = np.random.default_rng(0)
    blocks, done = [np.eye(len(a))], []
    while blocks:
        q = blocks.pop()
        halves = None
        if q.shape[1] > 1:
            inner = q.T @ a @ q
            halves = _halves((inner + inner.T) / 2, rnd)
        if halves is None:
            done.append(q)
        else:
            blocks += [q @ h for h in halves]
    q = np.linalg.qr(np.hstack(done))[0] if done else np.empty((0, 0))
    t = q.T @ a @ q
    # what rounding left off the diagonal, to first order
    gap = np.diag(t)[None, :] - np.diag(t)[:, None]
    tilt = np.where(np.abs(gap) > 1e3 * EPS * np.linalg.norm(a), t / np.where(gap == 0, 1, gap), 0)
    np.fill_diagonal(tilt, 0)
    q = q + q @ ((tilt - tilt.T) / 2)
    q /= np.linalg.norm(q, axis=0)
    values = np.einsum("ij,ij->j", q, a @ q)
    order = np.argsort(-values, kind="stable")
    return values[order], q[:, order]


# --- rows -------------------------------------------------------------------------------

def _vectors(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, x of them as a matrix), for each length of vector: of the rows whose
    entries are all there, finite, and a long after scaling."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    starts = np.asarray(column.offsets)
    n = np.diff(starts)
    entries = column.values
    there = np.asarray(entries.is_valid())
    c = entries.to_numpy(zero_copy_only=False).astype(float)
    with np.errstate(all="ignore"):
        scaled = np.floor(SCALE * c)
        good = there & (np.abs(scaled) < 2.0**62)  # false for NaN
    bad = np.concatenate([[0], np.cumsum(~good)])
    whole = np.asarray(column.is_valid()) & (n > 0) & (bad[starts[1:]] == bad[starts[:-1]])
    for length in np.unique(n[whole]):
        at = np.flatnonzero(whole & (n == length))
        yield at, scaled[starts[at][:, None] + np.arange(length)].astype(np.int64) + OFFSET


def _sum_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """By length: vectors, and sums of the entries' upper and lower 32 bits."""
    n: dict[int, int] = {}
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for at, x in _vectors(batch.column(0)):
            size = x.shape[1]
            n[size] = n.get(size, 0) + len(at)
            sums[size] = sums.get(size, 0) + np.concatenate([(x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)])
    for size in n:
        yield pa.RecordBatch.from_pydict({"size": [size] * 2 * size, "i": list(range(2 * size)), "n": [n[size]] * 2 * size, "s": sums[size]})


@dataclass
class Fit:
    """Of the fit list: its vectors, their dimension, sums by dimension (exact), mean,
    covariance; and the projection on the first components."""

    n: int
    size: int
    sums: list[int]
    mean: np.ndarray
    covariance: np.ndarray
    values: np.ndarray
    projection: np.ndarray
    explained: np.ndarray
    identity_error: float


def _centred(fit_size: int, mean: np.ndarray, make: Callable[[np.ndarray], np.ndarray]) -> Callable:
    """A function over batches: sums of the products of all pairs of columns of
    make(centred vectors), one row per column."""

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for _, x in _vectors(batch.column(0)):
                if x.shape[1] == fit_size:
                    y = make(x - mean)
                    total = y.T @ y + (0 if total is None else total)
        if total is not None:
            k = len(total)
            yield pa.RecordBatch.from_pydict({"i": np.repeat(np.arange(k), k), "j": np.tile(np.arange(k), k), "v": total.ravel()})

    return products


def _products(vectors: DataFrame, size: int, mean: np.ndarray, k: int, make: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    out = np.zeros((k, k))
    sums = vectors.mapInArrow(_centred(size, mean, make), "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    for r in sums.collect():  # dimension squared
        out[r.i, r.j] = r.v
    return out


def fit(table: DataFrame, vector: str = "embedding", components: int = 8) -> Fit | None:
    """Mean, covariance and whitening projection of all vectors; None if there are none.

    A vector takes part if it isn't null or empty and no entry is null, NaN, infinite or
    too large for ``x = floor(1024 * entry) + 100000`` to be a long.  Vectors of another
    length than the most frequent one (of equally frequent ones, the longest) can't share a
    covariance with the rest and count as null vectors.
    """
    vectors = table.select(F.col(vector).alias("v"))
    sums = (vectors.mapInArrow(_sum_entries, "size long, i long, n long, s long")
            .groupBy("size", "i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")))
    # the most frequent length; then 2 x dimension rows
    best = sums.where("i = 0").orderBy(F.desc("n"), F.desc("size")).limit(1).collect()
    if not best:
        return None
    size, n = best[0]["size"], best[0]["n"]
    parts = {r.i: int(r.s) for r in sums.where(F.col("size") == size).collect()}
    total = [(parts[i] << 32) + parts[size + i] for i in range(size)]
    mean = np.array([s / n for s in total])
    covariance = _products(vectors, size, mean, size, lambda x: x) / n
    values, q = eigenvectors(covariance)
    k = min(components, size)
    values, q, trace = values[:k], q[:, :k], np.trace(covariance)
    real = values > size * EPS * max(trace, 0.0) * 16  # others have no variance to bring to one
    projection = np.where(real, q / np.sqrt(np.where(real, values, 1.0)), 0.0)
    white = _products(vectors, size, mean, k, lambda x: x @ projection) / n
    error = float(np.abs(white - np.eye(k))[np.ix_(real, real)].max(initial=0.0))
    return Fit(n, size, total, mean, covariance, values, projection, np.where(real, values / (trace or 1.0), 0.0), error)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n * x - sum)^2, exact; None where that is no long."""
    about = np.square(n * x.astype(float) - np.array([float(s) for s in sums])).sum(axis=1)
    if about.max(initial=0) < 2.0**62 and n * float(np.abs(x).max(initial=0)) < 2.0**62:
        return np.square(n * x - np.array(sums, dtype=np.int64)).sum(axis=1).tolist()
    exact = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]
    return [v if v < 2**63 else None for v in exact]


def whiten(table: DataFrame, model: Fit | None, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """For each vector that takes part (see ``fit``) and each component of ``model``: ``key``,
    component (from 1), n, deviation, whitened, explained, identity_error.

    A null key stays null, repeated rows each give their rows, other columns are not read;
    without a model (an empty table) there are no rows.  A component without variance (its
    eigenvalue is zero to rounding) has whitened and explained 0 and is left out of
    identity_error.  A deviation past the range of a long is null.
    """
    kind = table.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = table.select(F.col(key).alias("k"), F.col(vector).alias("v"))
    if model is None:
        return table.sparkSession.createDataFrame([], schema)
    # the projection and two vectors: bounded by the dimension
    n, size, sums, mean, projection = model.n, model.size, model.sums, model.mean, model.projection
    explained, error, k = model.explained, model.identity_error, model.projection.shape[1]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in _vectors(batch.column(1)):
                if x.shape[1] != size:
                    continue
                m = len(at)
                white = (x - mean) @ projection
                # a 32-bit count goes past 2^31 rows only beyond what a batch holds
                each = np.repeat(np.arange(m), k)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(at)).take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n, np.int64)),
                    pa.array(_deviations(x, n, sums), pa.int64()).take(pa.array(each)), pa.array(white.ravel()),
                    pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                    names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(project, schema)
