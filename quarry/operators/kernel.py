"""Support-vector machines on feature maps (M10, M12, X15), all settings and folds at once.

The primal of the squared losses is solved by Newton's method (Chapelle, Training a
Support Vector Machine in the Primal, 2007): a pass over the rows sums, for every model,
the loss, its slope and the products of the features of the rows that count; a model's
step is then exact for those rows, and few passes reach the tolerance.  The RBF kernel
is met by random Fourier features (Rahimi and Recht 2007).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quarry.operators.packed import _rows, fold_moments, summed


@dataclass(frozen=True)
class Map:
    """Features of a row x: (x - mean) @ w, or with ``phase`` sqrt(2 / n) * cos(x @ w + phase)."""

    w: np.ndarray
    mean: np.ndarray | None = None
    phase: np.ndarray | None = None

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = (x if self.mean is None else x - self.mean) @ self.w
        if self.phase is not None:
            z = np.sqrt(2 / self.w.shape[1]) * np.cos(z + self.phase)
        return np.hstack([z, np.ones((len(x), 1))])


def fourier(dim: int, features: int, gamma: float, seed: int = 42) -> Map:
    """Features whose products approach exp(-gamma |x - y|^2) as their number grows."""
    rnd = np.random.default_rng(seed)
    return Map(rnd.normal(0, np.sqrt(2 * gamma), (dim, features)), phase=rnd.uniform(0, 2 * np.pi, features))


def components(moments: np.ndarray, k: int) -> Map:
    """Projection on the first ``k`` principal components of the rows behind ``moments``."""
    n = moments[-1, -1]
    mean = moments[-1, :-2] / n
    _, q = np.linalg.eigh(moments[:-2, :-2] / n - np.outer(mean, mean))
    return Map(q[:, ::-1][:, :k], mean=mean)


@dataclass(frozen=True)
class Problem:
    """|w|^2 / 2 + C * sum of squared losses over the rows outside fold ``left_out``: the
    hinge of labels 0/1, or with ``epsilon`` the part of the error beyond it."""

    map: int
    C: float = 1.0
    epsilon: float | None = None
    left_out: int = -2


def _losses(p: Problem, z: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Signed distance that each row's value has to move."""
    if p.epsilon is None:
        sign = np.where(y > 0.5, 1.0, -1.0)
        return sign * np.maximum(0, 1 - sign * z)
    r = y - z
    return np.sign(r) * np.maximum(0, np.abs(r) - p.epsilon)


def fit_newton(rows: DataFrame, dim: int, maps: Sequence[Map], problems: Sequence[Problem], tol: float = 1e-6, max_passes: int = 50) -> list[np.ndarray]:
    """Weights (the last is the intercept, without penalty) of every problem.  A problem ends
    when its slope is ``tol`` of its first or its objective no longer falls; a step that
    raises the objective is halved."""
    size = [maps[p.map].w.shape[1] + 1 for p in problems]
    now = [np.zeros(s) for s in size]
    last: list[tuple[np.ndarray, float] | None] = [None] * len(problems)
    first = [0.0] * len(problems)
    live = list(range(len(problems)))
    for _ in range(max_passes):
        spans = np.cumsum([0, *[size[i] * size[i] + size[i] + 1 for i in live]])

        def task(batches: Iterator[pa.RecordBatch], live=live, spans=spans) -> np.ndarray:
            out = np.zeros(spans[-1])
            for rb in batches:
                x, y, fold, _ = _rows(rb, dim)
                made = {m: maps[m](x) for m in {problems[i].map for i in live}}
                for i, a in zip(live, spans, strict=False):
                    p, s, phi = problems[i], size[i], made[problems[i].map]
                    move = np.where(fold == p.left_out, 0.0, _losses(p, phi @ now[i], y))
                    on = move != 0
                    part = phi[on]
                    out[a:a + s * s] += (part.T @ part).ravel()
                    out[a + s * s:a + s * s + s] += part.T @ move[on]
                    out[a + s * s + s] += move @ move
            return out

        v = summed(rows, int(spans[-1]), task)
        left = []
        for i, a in zip(live, spans, strict=False):
            p, s, w = problems[i], size[i], now[i]
            keep = np.append(np.ones(s - 1), 0.0)
            value = float(keep @ (w * w)) / 2 + p.C * v[a + s * s + s]
            if last[i] is not None and value > last[i][1] * (1 + 1e-12):
                if np.abs(w - last[i][0]).max() < 1e-12:
                    now[i] = last[i][0]
                else:
                    now[i] = (w + last[i][0]) / 2
                    left.append(i)
                continue
            slope = keep * w - 2 * p.C * v[a + s * s:a + s * s + s]
            norm = float(np.linalg.norm(slope))
            first[i] = first[i] or norm
            if norm <= tol * first[i]:
                continue
            bend = np.diag(keep) + 2 * p.C * v[a:a + s * s].reshape(s, s)
            last[i] = (w, value)
            now[i] = w - np.linalg.lstsq(bend, slope, rcond=None)[0]
            left.append(i)
        live = left
        if not live:
            break
    return now


def score(rows: DataFrame, dim: int, maps: Sequence[Map], problems: Sequence[Problem], weights: Sequence[np.ndarray], folds: int) -> list[float]:
    """Accuracy (hinge) or R2 of each problem on its own left-out fold."""
    def task(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        out = np.zeros((len(problems), 4))  # right answers or squared errors; rows, labels, their squares
        for rb in batches:
            x, y, fold, _ = _rows(rb, dim)
            for f in np.unique(fold):
                at = fold == f
                made: dict[int, np.ndarray] = {}
                for j, p in enumerate(problems):
                    if p.left_out == f:
                        phi = made.setdefault(p.map, maps[p.map](x[at]))
                        z, yf = phi @ weights[j], y[at]
                        hit = ((z > 0) == (yf > 0.5)).sum() if p.epsilon is None else np.square(yf - z).sum()
                        out[j] += [hit, len(yf), yf.sum(), np.square(yf).sum()]
        return out.ravel()

    s = summed(rows, 4 * len(problems), task).reshape(-1, 4)
    n = np.maximum(s[:, 1], 1)
    spread = s[:, 3] - s[:, 2] ** 2 / n
    return [float(1 - h / max(v, 1e-300)) if p.epsilon is not None else float(h / m)
            for p, h, v, m in zip(problems, s[:, 0], spread, n, strict=True)]


def values(rows: DataFrame, dim: int, made: Map, w: np.ndarray, key: str = "k") -> DataFrame:
    """(key, y, decision) of every row of (key, x, y): decision values of one machine."""
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            if rb.num_rows:
                x = rb.column("x").flatten().to_numpy(zero_copy_only=False).reshape(rb.num_rows, dim)
                yield pa.RecordBatch.from_arrays([rb.column(key), rb.column("y"), pa.array(made(x) @ w)], names=[key, "y", "decision"])

    return rows.select(key, "x", "y").mapInArrow(run, f"`{key}` {kind}, y double, decision double")


def kernel_search(rows: DataFrame, dim: int, features: int, gammas: Sequence[float], Cs: Sequence[float], epsilons: Sequence[float | None], folds: int,
                  seed: int = 42) -> tuple[list[tuple], Map, np.ndarray]:
    """Mean score of every (gamma, C, epsilon) over the folds, and the map and weights of the
    first best one refit on all rows."""
    maps = [fourier(dim, features, g, seed) for g in gammas]
    grid = [(g, c, e) for g in range(len(gammas)) for c in Cs for e in epsilons]
    problems = [Problem(g, c, e, f) for g, c, e in grid for f in range(folds)]
    found = score(rows, dim, maps, problems, fit_newton(rows, dim, maps, problems), folds)
    means = np.mean(np.reshape(found, (len(grid), folds)), axis=1)
    best = int(np.argmax(means))
    g, c, e = grid[best]
    w = fit_newton(rows, dim, [maps[g]], [Problem(0, c, e)])[0]
    return [(gammas[g], c, e, float(m), i == best) for i, ((g, c, e), m) in enumerate(zip(grid, means, strict=True))], maps[g], w


def pca_search(rows: DataFrame, dim: int, sizes: Sequence[int], Cs: Sequence[float], folds: int) -> tuple[list[tuple], Map, np.ndarray]:
    """Principal components and a linear machine searched as one.  Every fold's
    components come from the moments of the other folds, all summed in one pass, so no
    held-out row takes part in them.  Returns mean accuracies, and the refit of the best."""
    m = fold_moments(rows, dim, folds)
    all_ = m.sum(axis=0)
    maps = [components(all_ - m[f], k) for f in range(folds) for k in sizes]
    grid = [(i, c) for i in range(len(sizes)) for c in Cs]
    problems = [Problem(f * len(sizes) + i, c, None, f) for i, c in grid for f in range(folds)]
    found = score(rows, dim, maps, problems, fit_newton(rows, dim, maps, problems), folds)
    means = np.mean(np.reshape(found, (len(grid), folds)), axis=1)
    best = int(np.argmax(means))
    made = components(all_, sizes[grid[best][0]])
    w = fit_newton(rows, dim, [made], [Problem(0, grid[best][1])])[0]
    return [(sizes[i], c, float(v), j == best) for j, ((i, c), v) in enumerate(zip(grid, means, strict=True))], made, w
