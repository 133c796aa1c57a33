"""Linear learners.

The gradient engine: each step maps every partition's Arrow batches to ONE partial
(gradient sum, loss sum, count) with NumPy, the partials are summed per coordinate on
the executors (posexplode + grouped sum), and only the summed, model-sized vector
reaches the driver, which updates the weights and ships them in the next closure.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.sources.files import cached

GradFn = Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, float]]


def _matrix(batch: pa.RecordBatch, col: str) -> np.ndarray:
    """Rows of an array column side by side, without a Python object for each; nulls are NaN."""
    lists = batch.column(col)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    dim = len(flat) // batch.num_rows
    if lists.null_count or (np.diff(np.asarray(lists.offsets)) != dim).any():
        raise ValueError(f"{col}: arrays of one length expected")
    return flat.reshape(batch.num_rows, dim)


def _floats(df: DataFrame, features: str, label: str) -> DataFrame:
    return df.select(F.col(features).cast("array<double>").alias(features), F.col(label).cast("double").alias(label))


def sum_gradient(df: DataFrame, w: np.ndarray, fn: GradFn, features: str = "features",
                 label: str = "label") -> tuple[np.ndarray, float, int]:
    """Sum of ``fn(X, y, w) -> (grad, loss)`` over all rows, partials per partition."""
    dim = len(w)
    wl = w.tolist()

    def run(it):
        wv = np.asarray(wl)
        g = np.zeros(dim)
        loss, n = 0.0, 0
        for rb in it:
            if rb.num_rows == 0:
                continue
            X = _matrix(rb, features)
            y = rb.column(label).to_numpy(zero_copy_only=False)
            gi, li = fn(X, y, wv)
            g += gi
            loss += float(li)
            n += len(y)
        # one job: loss and count ride along as two extra coordinates of the summed vector
        yield pa.RecordBatch.from_pydict({"g": pa.array([np.append(g, [loss, n])], pa.list_(pa.float64()))})

    parts = _floats(df, features, label).mapInArrow(run, "g array<double>")
    vec = parts.select(F.posexplode("g").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v")).collect()
    g = np.zeros(dim + 2)
    for r in vec:
        g[r.i] = r.v  # dim + 2 rows: model-sized
    return g[:dim], float(g[dim]), int(round(g[dim + 1]))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return np.where(z >= 0, 1 / (1 + np.exp(-np.abs(z))), np.exp(-np.abs(z)) / (1 + np.exp(-np.abs(z))))


def logistic_grad(X, y, w):
    """Residual y - sigmoid(Xw) times X, and the summed log-loss."""
    p = _sigmoid(X @ w)
    eps = 1e-15
    loss = -np.sum(y * np.log(np.clip(p, eps, 1)) + (1 - y) * np.log(np.clip(1 - p, eps, 1)))
    return X.T @ (y - p), loss


def squared_grad(X, y, w):
    """Residual y - Xw times X, and the summed err^2 / 2."""
    r = y - X @ w
    return X.T @ r, float(np.sum(r * r) / 2)


def with_intercept(df: DataFrame, features: str = "features") -> DataFrame:
    from quarry.functions.vector import add_intercept
    return df.withColumn(features, add_intercept(F.col(features)))


def train_gd(df: DataFrame, dim: int, fn: GradFn, max_iter: int = 1000, learning_rate: float = 0.1,
             features: str = "features", label: str = "label", log_every: int = 100):
    """Batch gradient descent from zero weights, w += lr / m * sum(grad).
    Returns (weights, [(iteration, mean cost)])."""
    w = np.zeros(dim)
    costs = []
    with cached(df.select(features, label)) as data:  # re-read every step; recomputed from lineage if lost
        for it in range(max_iter):
            g, loss, n = sum_gradient(data, w, fn, features, label)
            if it % log_every == 0:
                costs.append((it, loss / max(n, 1)))
            w = w + learning_rate / max(n, 1) * g
    return w, costs


def train_logistic_gd(df, dim, max_iter=1000, learning_rate=0.1, fit_intercept=False, **kw):
    """M27 (with ``fit_intercept`` a constant 1.0 feature is prepended)."""
    d = with_intercept(df, kw.get("features", "features")) if fit_intercept else df
    return train_gd(d, dim + int(fit_intercept), logistic_grad, max_iter, learning_rate, **kw)


def train_linear_gd(df, dim, max_iter=1000, learning_rate=0.001, fit_intercept=False, features="features",
                    label="label", log_every=100):
    """M28.  The squared error's gradient is X'y - X'X w, so one pass over the rows sums X'X,
    X'y and y'y (``dim`` x ``dim`` numbers) and every step after it is exact without the rows."""
    d = with_intercept(df, features) if fit_intercept else df
    m = dim + int(fit_intercept)

    def moments(X, y, _):
        return np.concatenate([(X.T @ X).ravel(), X.T @ y]), float(y @ y)

    s, yy, n = sum_gradient(d, np.zeros(m * m + m), moments, features, label)
    xx, xy = s[:m * m].reshape(m, m), s[m * m:]
    w, costs, n = np.zeros(m), [], max(n, 1)
    for it in range(max_iter):
        if it % log_every == 0:
            costs.append((it, float(yy - 2 * w @ xy + w @ xx @ w) / 2 / n))
        w = w + learning_rate / n * (xy - xx @ w)
    return w, costs


def predict_linear(df: DataFrame, w, features: str = "features", out: str = "prediction",
                   logistic: bool = False, add_intercept: bool = False) -> DataFrame:
    """Scores with driver weights as literals (intercept added when the weights carry one)."""
    from quarry.functions.vector import add_intercept as ai, dot_const, sigmoid
    x = ai(F.col(features)) if add_intercept else F.col(features)
    z = dot_const(x, list(map(float, w)))
    return df.withColumn(out, sigmoid(z) if logistic else z)


def train_logistic_sgd(df: DataFrame, dim: int, epochs: int = 5, learning_rate: float = 0.01,
                       features: str = "features", label: str = "label", seed: int = 42,
                       w0: np.ndarray | None = None, batch: int = 8) -> np.ndarray:
    """SGD run inside every partition on shuffled mini-batches, weights averaged by rows
    after each epoch (parameter mixing, Zinkevich et al. 2010).  Sequential order exists only
    within a partition, so the result is close to, not equal to, one sequential pass.  An
    epoch is one job: the row count rides along with the weights."""
    w = np.zeros(dim) if w0 is None else np.asarray(w0, dtype=np.float64)
    for ep in range(epochs):
        wl, lr, sd = w.tolist(), learning_rate, seed + ep

        def run(it):
            from pyspark import TaskContext
            wv = np.asarray(wl)
            n = 0
            rng = np.random.default_rng([sd, TaskContext.get().partitionId()])
            for rb in it:
                if rb.num_rows == 0:
                    continue
                X = _matrix(rb, features)
                y = rb.column(label).to_numpy(zero_copy_only=False)
                order = rng.permutation(len(y))
                for i in range(0, len(y), batch):
                    rows = order[i:i + batch]
                    wv = wv + lr * X[rows].T @ (y[rows] - _sigmoid(X[rows] @ wv))
                n += len(y)
            yield pa.RecordBatch.from_pydict({"w": pa.array([np.append(wv * n, n)], pa.list_(pa.float64()))})

        parts = _floats(df, features, label).mapInArrow(run, "w array<double>")
        vec = parts.select(F.posexplode("w").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v")).collect()
        total = np.zeros(dim + 1)
        for r in vec:
            total[r.i] = r.v  # dim + 1 rows: model-sized
        w = total[:dim] / max(total[dim], 1.0)
    return w


def train_gblinear(df: DataFrame, dim: int, rounds: int = 50, eta: float = 0.3, reg_lambda: float = 0.0,
                   features: str = "features", label: str = "label") -> tuple[np.ndarray, float]:
    """Boosted linear model on logistic loss — each round one aggregate of per-feature
    gradient G_j and hessian H_j, then w_j -= eta * G_j / (H_j + lambda) (bias likewise)."""
    w = np.zeros(dim)
    b = 0.0

    def fn(X, y, wv):
        z = X @ wv[:-1] + wv[-1]
        p = _sigmoid(z)
        g = p - y
        h = p * (1 - p)
        return np.concatenate([X.T @ g, [g.sum()], (X * X).T @ h, [h.sum()]]), 0.0

    for _ in range(rounds):
        wb = np.concatenate([w, [b]])
        s, _, _ = sum_gradient(df, np.zeros(2 * dim + 2), lambda X, y, _w, wb=wb: fn(X, y, wb), features, label)
        G, H = s[:dim + 1], s[dim + 1:]
        step = -eta * G / (H + reg_lambda + 1e-12)
        w += step[:dim]
        b += step[dim]
    return w, b


def train_linear_svr(df: DataFrame, dim: int, C: float = 1.0, epsilon: float = 0.1, max_iter: int = 200,
                     learning_rate: float = 0.01, features: str = "features", label: str = "label") -> np.ndarray:
    """Epsilon-insensitive linear regression by subgradient descent on
    0.5 ||w||^2 + C * sum max(0, |y - x.w| - eps) (last weight is the unpenalised bias)."""
    w = np.zeros(dim + 1)

    def fn(X, y, wv):
        Xb = np.hstack([X, np.ones((len(y), 1))])
        r = y - Xb @ wv
        s = np.where(r > epsilon, 1.0, np.where(r < -epsilon, -1.0, 0.0))
        return Xb.T @ s, float(np.sum(np.maximum(0, np.abs(r) - epsilon)))

    data = df.select(features, label).cache()
    for it in range(max_iter):
        g, _, n = sum_gradient(data, w, fn, features, label)
        reg = np.concatenate([w[:-1], [0.0]])
        w = w - learning_rate / (1 + it) ** 0.5 * (reg - C * g) / max(n, 1)
    data.unpersist()
    return w


def spark_logistic(max_iter: int = 20, reg: float = 0.001, elastic_net: float = 0.001,
                   features: str = "features", label: str = "label"):
    """Elastic-net logistic regression (sparse features welcome)."""
    from pyspark.ml.classification import LogisticRegression
    return LogisticRegression(maxIter=max_iter, regParam=reg, elasticNetParam=elastic_net,
                              featuresCol=features, labelCol=label)


def one_vs_rest(classifier, weight_col: str | None = None):
    """M30/M9 multi-class: one binary model per class (optional per-row weights)."""
    from pyspark.ml.classification import OneVsRest
    kw = {"weightCol": weight_col} if weight_col else {}
    return OneVsRest(classifier=classifier, **kw)


def top_weights(w, names, k: int = 10) -> tuple[list, list]:
    """Bottom-k and top-k features by |weight| (model-sized)."""
    order = np.argsort(np.abs(np.asarray(w)), kind="stable")
    return [(names[i], float(w[i])) for i in order[:k]], [(names[i], float(w[i])) for i in order[-k:]]
