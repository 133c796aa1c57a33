"""Small neural networks (M33-M36) trained with full-batch or mini-batch gradients
summed per partition (NumPy inside Arrow batches), updated on the driver (SGD or
Adam).  Layers are model-sized; data never leaves the executors."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def init_layers(sizes, seed: int = 42):
    rng = np.random.default_rng(seed)
    return [(rng.normal(0, np.sqrt(2.0 / a), size=(a, b)), np.zeros(b)) for a, b in zip(sizes[:-1], sizes[1:])]


def _act(z, kind):
    if kind == "relu":
        return np.maximum(z, 0)
    if kind == "sigmoid":
        return 1 / (1 + np.exp(-z))
    return z


def _dact(a, z, kind):
    if kind == "relu":
        return (z > 0).astype(float)
    if kind == "sigmoid":
        return a * (1 - a)
    return np.ones_like(z)


def forward(X, layers, hidden="relu", out="identity", drop=0.0, rng=None):
    acts, zs, masks = [X], [], []
    a = X
    for i, (W, b) in enumerate(layers):
        z = a @ W + b
        last = i == len(layers) - 1
        a = _act(z, out if last else hidden)
        if not last and drop > 0 and rng is not None:
            m = (rng.random(a.shape) >= drop) / (1 - drop)
            a = a * m
        else:
            m = None
        zs.append(z)
        acts.append(a)
        masks.append(m)
    return acts, zs, masks


def backward(y, layers, acts, zs, masks, hidden="relu", out="identity"):
    """Gradients of the summed 0.5 * (y - yhat)^2 loss."""
    grads = []
    delta = (acts[-1] - y.reshape(-1, 1)) * _dact(acts[-1], zs[-1], out)
    for i in range(len(layers) - 1, -1, -1):
        grads.append((acts[i].T @ delta, delta.sum(axis=0)))
        if i > 0:
            delta = delta @ layers[i][0].T
            if masks[i - 1] is not None:
                delta = delta * masks[i - 1]
            delta = delta * _dact(acts[i], zs[i - 1], hidden)
    return grads[::-1]


def _flat(layers):
    return np.concatenate([np.concatenate([W.ravel(), b]) for W, b in layers])


def _unflat(v, sizes):
    out, o = [], 0
    for a, b in zip(sizes[:-1], sizes[1:]):
        W = v[o:o + a * b].reshape(a, b)
        o += a * b
        out.append((W, v[o:o + b]))
        o += b
    return out


def summed_gradient(df: DataFrame, layers, sizes, hidden, out, features, label, drop=0.0, seed=0):
    flat = _flat(layers).tolist()
    dim = len(flat)

    def run(it):
        from pyspark import TaskContext
        lay = _unflat(np.asarray(flat), sizes)
        pid = TaskContext.get().partitionId() if TaskContext.get() else 0
        rng = np.random.default_rng((seed, pid))
        g = np.zeros(dim)
        loss, n = 0.0, 0
        for pdf in it:
            if len(pdf) == 0:
                continue
            X = np.stack([np.asarray(v, dtype=float) for v in pdf[features].to_numpy()])
            y = pdf[label].to_numpy(dtype=float)
            acts, zs, masks = forward(X, lay, hidden, out, drop, rng)
            gr = backward(y, lay, acts, zs, masks, hidden, out)
            g += np.concatenate([np.concatenate([gW.ravel(), gb]) for gW, gb in gr])
            loss += float(np.sum((acts[-1].ravel() - y) ** 2) / 2)
            n += len(y)
        yield pd.DataFrame({"g": [g.tolist()], "loss": [loss], "n": [n]})

    parts = df.select(features, label).mapInPandas(run, "g array<double>, loss double, n long")
    packed = parts.select(F.concat("g", F.array(F.col("loss"), F.col("n").cast("double"))).alias("g"))
    vec = packed.select(F.posexplode("g").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v")).collect()
    g = np.zeros(dim + 2)
    for r in vec:
        g[r.i] = r.v
    return g[:dim], float(g[dim]), int(round(g[dim + 1]))


def mse(df: DataFrame, layers, sizes, hidden, out, features, label) -> float:
    _, loss, n = summed_gradient(df, layers, sizes, hidden, out, features, label)
    return 2 * loss / max(n, 1)


def train(df: DataFrame, sizes, epochs: int = 100, lr: float = 1e-3, hidden: str = "relu",
          out: str = "identity", optimizer: str = "adam", dropout: float = 0.0, features: str = "features",
          label: str = "label", valid: DataFrame | None = None, patience: int | None = None, seed: int = 42):
    """M34 (``hidden='sigmoid', out='sigmoid', optimizer='sgd'``), M35 (ReLU + Adam), M36
    (dropout and early stopping on ``valid`` with best-weight restore), M33 (no hidden
    layer).  Returns (layers, history of (epoch, train_mse, valid_mse))."""
    layers = init_layers(sizes, seed)
    v = _flat(layers)
    m1, m2 = np.zeros_like(v), np.zeros_like(v)
    b1, b2, e = 0.9, 0.999, 1e-8
    hist, best, best_v, wait = [], None, float("inf"), 0
    df = df.select(features, label).cache()
    for ep in range(epochs):
        g, loss, n = summed_gradient(df, _unflat(v, sizes), sizes, hidden, out, features, label, dropout, seed + ep)
        g = g / max(n, 1)
        if optimizer == "adam":
            m1 = b1 * m1 + (1 - b1) * g
            m2 = b2 * m2 + (1 - b2) * g * g
            v = v - lr * (m1 / (1 - b1 ** (ep + 1))) / (np.sqrt(m2 / (1 - b2 ** (ep + 1))) + e)
        else:
            v = v - lr * g
        vl = mse(valid, _unflat(v, sizes), sizes, hidden, out, features, label) if valid is not None else None
        hist.append((ep, 2 * loss / max(n, 1), vl))
        if vl is not None and patience is not None:
            if vl < best_v:
                best_v, best, wait = vl, v.copy(), 0
            else:
                wait += 1
                if wait >= patience:
                    break
    df.unpersist()
    if best is not None:
        v = best
    return _unflat(v, sizes), hist


def predict(df: DataFrame, layers, hidden="relu", out="identity", features="features",
            col: str = "prediction") -> DataFrame:
    """Forward pass per Arrow batch (weights shipped in the closure)."""
    lay = [(W.tolist(), b.tolist()) for W, b in layers]

    def run(it):
        L = [(np.asarray(W), np.asarray(b)) for W, b in lay]
        for pdf in it:
            if len(pdf) == 0:
                yield pdf.assign(**{col: []})
                continue
            X = np.stack([np.asarray(x, dtype=float) for x in pdf[features].to_numpy()])
            acts, _, _ = forward(X, L, hidden, out)
            yield pdf.assign(**{col: acts[-1].ravel()})
    from pyspark.sql import types as T
    schema = T.StructType(list(df.schema.fields) + [T.StructField(col, T.DoubleType())])
    return df.mapInPandas(run, schema)
