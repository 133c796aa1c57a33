"""k-means (M37-M39).  Centres are model-sized literals in the assignment expression
(no join); updates are grouped means with partial aggregation; labels are
checkpointed between iterations."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.aggregate import vector_mean_by
from quarry.operators.relate import nearest_centre


def init_sample(df: DataFrame, vec: str, k: int, seed: int = 42, row: str | None = None) -> list[list[float]]:
    """k starting centres drawn with replacement (bounded fetch): draw i takes the row with
    the least hash of its id (``row``, or else the vector) and (seed, i), so the start
    doesn't depend on the partitioning and one row may be drawn twice."""
    key = F.col(row).cast("string") if row else F.array_join(F.transform(F.col(vec), lambda x: x.cast("string")), ",")
    first = df.agg(*[F.min_by(vec, F.md5(F.concat(key, F.lit(f"|{seed}|{i}")).cast("binary"))).alias(f"c{i}") for i in range(k)]).first()
    return [[float(v) for v in c] for c in first]


def kmeans_step(df: DataFrame, vec: str, centres: list[list[float]], out: str = "cluster"):
    """One assignment + update; a cluster left empty keeps its old centre."""
    assigned = df.withColumn(out, nearest_centre(F.col(vec), centres))
    means = vector_mean_by(assigned, out, vec).collect()  # k x d rows, model-sized
    new = [list(c) for c in centres]
    for r in means:
        new[r[out]][r.pos] = r.mean
    return assigned, new


def kmeans(df: DataFrame, vec: str, k: int, max_iter: int = 100, tol: float = 1e-4, seed: int = 42,
           centres: list[list[float]] | None = None, row: str | None = None):
    """Iterate until the Frobenius norm of the centre move is <= tol."""
    c = centres or init_sample(df, vec, k, seed, row)
    base = df.checkpoint(eager=True)
    for _ in range(max_iter):
        _, new = kmeans_step(base, vec, c)
        move = math.sqrt(float(np.sum((np.asarray(new) - np.asarray(c)) ** 2)))
        c = new
        if move <= tol:
            break
    return base.withColumn("cluster", nearest_centre(F.col(vec), c)), c


def spark_kmeans(df: DataFrame, features: str, k: int, seeds=(42,), max_iter: int = 20, tol: float = 1e-4):
    """K-means|| for each seed, keep the lowest training cost (inertia)."""
    from pyspark.ml.clustering import KMeans
    best = None
    for s in seeds:
        m = KMeans(k=k, seed=s, maxIter=max_iter, tol=tol, featuresCol=features).fit(df)
        if best is None or m.summary.trainingCost < best.summary.trainingCost:
            best = m
    return best


def cluster_scores(assigned: DataFrame, vec: str, centres: list[list[float]], cluster: str = "cluster") -> DataFrame:
    """Per-cluster squared distances summed; inertia = sum, and the reference's
    elbow score = sum over clusters of sqrt (the Frobenius norm of each cluster's residuals)."""
    from quarry.functions.vector import sq_dist
    cl = F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in centres])
    d = sq_dist(F.col(vec), F.element_at(cl, F.col(cluster) + 1))
    per = assigned.groupBy(cluster).agg(F.sum(d).alias("ss"))
    return per.agg(F.sum("ss").alias("inertia"), F.sum(F.sqrt("ss")).alias("sum_norm"))
