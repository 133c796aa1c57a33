"""Linear support-vector learners (M7-M9, M32) on Spark ML's LinearSVC, and the one-vs-one
vote (M8).  Kernel machines are in ``kernel.py``."""

from __future__ import annotations

import itertools
import json
import math

import numpy as np
from pyspark.ml.classification import LinearSVC
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class FewTasksSVC(LinearSVC):
    """Every evaluation of the loss is a job, and each of its tasks reports some 2 to 3 KB to
    the driver: a fit runs as many tasks as the cluster has cores, however many the input has."""

    def _fit(self, dataset: DataFrame):
        return super()._fit(dataset.coalesce(dataset.sparkSession.sparkContext.defaultParallelism))


def linear_svc(C: float = 1.0, n: int = 1, max_iter: int = 100, features: str = "features",
               label: str = "label", weight_col: str | None = None):
    """C-SVM -> regParam = 1 / (n C), no standardisation."""
    kw = {"weightCol": weight_col} if weight_col else {}
    return FewTasksSVC(regParam=1.0 / (n * C), maxIter=max_iter, standardization=False,
                       featuresCol=features, labelCol=label, **kw)


def one_vs_one(df: DataFrame, classes, C: float = 1.0, features: str = "features", label: str = "label",
               row: str = "row_id", max_iter: int = 200, tol: float = 1e-3) -> DataFrame:
    """M8: a linear SVM per class pair; each row gets one vote per pair; majority wins
    (lowest class on ties).  Returns (row, pred).  ``features`` is an array.

    All pairs train together: one pass over the rows gives every pair's gradient of
    ||w||^2 / 2 + C * sum of squared hinges, and Nesterov's method steps with the Lipschitz
    constant of that sum until no gradient norm exceeds ``tol`` of its start."""
    from quarry.operators.linear import sum_gradient
    order = sorted(classes)
    duos = list(itertools.combinations(range(len(order)), 2))
    data = df.select(features, F.array_position(F.array(*[F.lit(c) for c in order]), F.col(label)).cast("double").alias("__c")).where("__c > 0").cache()
    d = len(data.select(features).first()[0]) + 1
    left, right = np.array([i for i, _ in duos]), np.array([j for _, j in duos])

    def gram(X, y, _):
        Xb = np.hstack([X, np.ones((len(X), 1))])
        return (Xb.T @ Xb).ravel(), 0.0

    def hinge(X, y, w):
        Xb, c = np.hstack([X, np.ones((len(X), 1))]), y.astype(int) - 1
        sign = (c[:, None] == right).astype(float) - (c[:, None] == left)
        short = np.maximum(0, 1 - sign * (Xb @ w.reshape(-1, d).T)) * np.abs(sign)
        return ((short * sign).T @ Xb).ravel(), float((short ** 2).sum())

    step = 1 / (1 + 2 * C * float(np.linalg.eigvalsh(sum_gradient(data, np.zeros(d * d), gram, features, "__c")[0].reshape(d, d))[-1]))
    keep = np.tile([*[1.0] * (d - 1), 0.0], len(duos))  # the bias is not penalised
    w = z = np.zeros(len(duos) * d)
    first, t = None, 1.0
    for _ in range(max_iter):
        slope, _, _ = sum_gradient(data, z, hinge, features, "__c")
        g = keep * z - 2 * C * slope
        norm = float(np.linalg.norm(g.reshape(-1, d), axis=1).max())
        first = first or norm
        if norm <= tol * first:
            break
        new, after = z - step * g, (1 + math.sqrt(1 + 4 * t * t)) / 2
        z, w, t = new + (t - 1) / after * (new - w), new, after
    data.unpersist()
    pairs = [{"a": order[i], "b": order[j], "w": v[:-1].tolist(), "c": float(v[-1])} for (i, j), v in zip(duos, w.reshape(-1, d), strict=True)]
    # all pairs vote in one pass over the rows; the models are one constant
    kind = dict(df.dtypes)[label]
    models = F.from_json(F.lit(json.dumps(pairs)), f"array<struct<a:{kind},b:{kind},w:array<double>,c:double>>")

    def vote(p: Column) -> Column:
        z = F.aggregate(F.zip_with(p["w"], F.col("__x"), lambda u, v: u * v), p["c"], lambda u, v: u + v)
        return F.when(z > 0, p["b"]).otherwise(p["a"])

    votes = df.select(row, F.col(features).alias("__x")).select(row, F.transform(models, vote).alias("votes"))
    tally = F.transform(F.array(*[F.lit(c) for c in sorted(classes)]),
                        lambda c: F.struct((-F.size(F.filter("votes", lambda v: v == c))).alias("n"), c.alias("c")))
    return votes.select(row, F.array_min(tally)["c"].alias("pred"))
