"""Scalar math and array functions (F11-F16, P19-P20) as JVM column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def sigmoid(z: Column) -> Column:
    """logistic function, written so large |z| never overflows exp()."""
    return F.when(z >= 0, 1.0 / (1.0 + F.exp(-z))).otherwise(F.exp(z) / (1.0 + F.exp(z)))


def sigmoid_derivative(z: Column) -> Column:
    """s(z) * (1 - s(z))."""
    s = sigmoid(z)
    return s * (1.0 - s)


def log_loss(y: Column, p: Column) -> Column:
    """-y ln p - (1-y) ln(1-p); infinite at p in {0, 1} (null in Spark's log)."""
    return -y * F.log(p) - (1.0 - y) * F.log(1.0 - p)


def dot(a: Column, b: Column) -> Column:
    """inner product of two equal-length numeric arrays."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0), lambda acc, v: acc + v)


def dot_const(a: Column, w: Sequence[float]) -> Column:
    """Inner product of an array column with a small driver-side weight vector."""
    return dot(a, F.array(*[F.lit(float(v)) for v in w]))


def sq_dist(a: Column, b: Column) -> Column:
    """Squared Euclidean distance of two arrays."""
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) *
                   (x.cast("double") - y.cast("double"))),
        F.lit(0.0), lambda acc, v: acc + v)


def euclid(a: Column, b: Column) -> Column:
    """||a - b||."""
    return F.sqrt(sq_dist(a, b))


def norm(a: Column) -> Column:
    """||a||."""
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def argmin(a: Column) -> Column:
    """0-based position of the first minimum."""
    return F.array_position(a, F.array_min(a)) - 1


def argmax(a: Column) -> Column:
    """0-based position of the first maximum."""
    return F.array_position(a, F.array_max(a)) - 1


def add_intercept(features: Column) -> Column:
    """Prepend a constant 1.0 feature."""
    return F.concat(F.array(F.lit(1.0)), F.transform(features, lambda x: x.cast("double")))


def flatten_grid(grid: Column) -> Column:
    """P20: image grid (array of rows) to one vector."""
    return F.flatten(grid)


def as_doubles(a: Column) -> Column:
    return F.transform(a, lambda x: x.cast("double"))
