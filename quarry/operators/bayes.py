"""Naive Bayes (M1-M6) as relational aggregates.

Features are long — ``(row, feature, value)`` — so a sparse row never becomes dense.
Fitting is one grouped aggregate per feature (class counts side by side); scoring
joins a row's features to that per-feature table and sums log-terms per row.  Only
class-sized numbers (priors, totals) reach the driver.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir


def classes_of(labels: DataFrame, label: str) -> list:
    """The classes, which are as many as the model has columns.  Rows without one don't train."""
    return [r[0] for r in labels.select(label).distinct().where(F.col(label).isNotNull()).orderBy(label).collect()]


def priors(labels: DataFrame, label: str = "label") -> DataFrame:
    """M1: (label, n, prior = n / N)."""
    total = labels.select(F.count(F.lit(1))).scalar()
    return labels.groupBy(label).agg(F.count(F.lit(1)).alias("n")).withColumn("prior", F.col("n") / total)


def _softmax(scores: Sequence[Column]) -> list[Column]:
    m = F.greatest(*scores) if len(scores) > 1 else scores[0]
    ex = [F.exp(s - m) for s in scores]
    tot = ex[0]
    for e in ex[1:]:
        tot = tot + e
    return [e / tot for e in ex]


@dataclass
class NBModel:
    classes: list
    log_prior: list[float]
    table: DataFrame          # (feature, w_0..w_{k-1}[, b_0..]) per-feature log terms
    const: list[float]        # per-class constant added to every row
    per_value: list[float]    # per-class coefficient of sum(x) (multinomial denominator)
    feature: str
    kind: str
    distinct: bool = False    # rows to score hold each (row, feature) once

    def scores(self, features: DataFrame, rows: DataFrame, row: str, value: str) -> DataFrame:
        k = len(self.classes)
        if self.kind == "bernoulli":  # a stored row means x = 1, whatever its count
            features = _once(features, row, self.feature, self.distinct).withColumn(value, F.lit(1.0))
        j = features.join(self.table, self.feature)
        sums = j.groupBy(row).agg(*[F.sum(F.col(value) * F.col(f"w_{i}")).alias(f"s_{i}") for i in range(k)],
                                  F.sum(value).alias("sx"))
        r = rows.select(row).join(sums, row, "left").fillna(0.0, [f"s_{i}" for i in range(k)] + ["sx"])
        sc = [F.lit(self.log_prior[i] + self.const[i]) + F.col(f"s_{i}") - F.col("sx") * F.lit(self.per_value[i])
              for i in range(k)]
        return r.select(row, *[s.alias(f"score_{i}") for i, s in enumerate(sc)])

    def predict_proba(self, features: DataFrame, rows: DataFrame, row: str = "row_id",
                      value: str = "value") -> DataFrame:
        """(row, probs array in class order, pred)."""
        s = self.scores(features, rows, row, value)
        k = len(self.classes)
        probs = _softmax([F.col(f"score_{i}") for i in range(k)])
        out = s.select(row, F.array(*probs).alias("probs"))
        cls = F.array(*[F.lit(c) for c in self.classes])
        best = F.array_position(F.col("probs"), F.array_max("probs")).cast("int")
        return out.withColumn("pred", F.element_at(cls, best))


def _once(features: DataFrame, row: str, feature: str, distinct: bool) -> DataFrame:
    """Each (row, feature) once; of rows said to be ``distinct`` there is nothing to drop."""
    pairs = features.select(row, feature)
    return pairs if distinct else pairs.distinct()


def _class_totals(features: DataFrame, labels: DataFrame, row: str, feature: str, value: str,
                  label: str, classes: list) -> DataFrame:
    fl = features.join(labels.select(row, label), row)
    return fl.groupBy(feature).agg(*[
        F.sum(F.when(F.col(label) == c, F.col(value)).otherwise(F.lit(0.0))).cast("double").alias(f"n_{i}")
        for i, c in enumerate(classes)])


def fit_multinomial(features: DataFrame, labels: DataFrame, alpha: float = 1.0, fit_prior: bool = True,
                    row: str = "row_id", feature: str = "feature", value: str = "value",
                    label: str = "label", n_features: int | None = None) -> NBModel:
    """M5: theta_cj = (N_cj + alpha) / (N_c + alpha * V); prior learned or uniform."""
    classes = classes_of(labels, label)
    k = len(classes)
    ensure_checkpoint_dir(features.sparkSession)
    cnt = _class_totals(features, labels, row, feature, value, label, classes).checkpoint()  # for totals and scores
    tot = cnt.agg(*[F.sum(f"n_{i}").alias(f"t_{i}") for i in range(k)], F.count(F.lit(1)).alias("v")).first()
    v = n_features or tot["v"]
    nc = {r[0]: r[1] for r in labels.where(F.col(label).isNotNull()).groupBy(label).count().collect()}
    n = sum(nc.values())
    lp = [math.log(nc[c] / n) if fit_prior else -math.log(k) for c in classes]
    table = cnt.select(feature, *[F.log(F.col(f"n_{i}") + alpha).alias(f"w_{i}") for i in range(k)])
    per_value = [math.log(tot[f"t_{i}"] + alpha * v) for i in range(k)]
    return NBModel(classes, lp, table, [0.0] * k, per_value, feature, "multinomial")


def fit_bernoulli(features: DataFrame, labels: DataFrame, alpha: float = 1.0, fit_prior: bool = True,
                  row: str = "row_id", feature: str = "feature", label: str = "label",
                  n_features: int | None = None, distinct: bool = False) -> NBModel:
    """M2-M4: binary features (stored rows mean x = 1; ``distinct``: none repeats);
    theta_cj = (sum x + alpha) / (n_c + 2 alpha); score = log prior + sum_j log(1 - theta)
    + sum_{x_j = 1} (log theta - log(1 - theta))."""
    classes = classes_of(labels, label)
    k = len(classes)
    ensure_checkpoint_dir(features.sparkSession)
    bin_f = _once(features, row, feature, distinct).withColumn("__x", F.lit(1.0))
    cnt = _class_totals(bin_f, labels, row, feature, "__x", label, classes).checkpoint()  # for constants and scores
    nc = {r[0]: r[1] for r in labels.where(F.col(label).isNotNull()).groupBy(label).count().collect()}
    n = sum(nc.values())
    th = [(F.col(f"n_{i}") + alpha) / (nc[c] + 2 * alpha) for i, c in enumerate(classes)]
    table = cnt.select(feature, *[(F.log(t) - F.log(1 - t)).alias(f"w_{i}") for i, t in enumerate(th)],
                       *[F.log(1 - t).alias(f"b_{i}") for i, t in enumerate(th)])
    agg = table.agg(*[F.sum(f"b_{i}").alias(f"B_{i}") for i in range(k)], F.count(F.lit(1)).alias("v")).first()
    v = n_features or agg["v"]
    const = []
    for i, c in enumerate(classes):  # features never seen in training: theta = alpha / (n_c + 2 alpha)
        unseen = (v - agg["v"]) * math.log(1 - alpha / (nc[c] + 2 * alpha))
        const.append(agg[f"B_{i}"] + unseen)
    lp = [math.log(nc[c] / n) if fit_prior else -math.log(k) for c in classes]
    m = NBModel(classes, lp, table.select(feature, *[f"w_{i}" for i in range(k)]), const, [0.0] * k,
                feature, "bernoulli", distinct)
    return m


def bernoulli_likelihood(features: DataFrame, labels: DataFrame, alpha: float = 1.0, row: str = "row_id",
                         feature: str = "feature", label: str = "label", distinct: bool = False) -> DataFrame:
    """M2 long form: (label, feature, theta)."""
    fl = _once(features, row, feature, distinct).join(labels.select(row, label), row)
    nc = labels.groupBy(label).agg(F.count(F.lit(1)).alias("__n"))
    s = fl.groupBy(label, feature).agg(F.count(F.lit(1)).alias("__s"))
    return s.join(nc, label).select(label, feature, ((F.col("__s") + alpha) / (F.col("__n") + 2 * alpha)).alias("theta"))


def gaussian_stats(df: DataFrame, vec: str, label: str = "label") -> tuple[dict, np.ndarray]:
    """M6: class -> (rows, means, population variances), and the variances over all rows, from
    one aggregate (rows, sums and sums of squares by class and dimension)."""
    long = df.where(F.col(label).isNotNull()).select(label, F.posexplode(vec).alias("pos", "x")).withColumn("x", F.col("x").cast("double"))
    sums = long.groupBy(label, "pos").agg(F.count("x").alias("n"), F.avg("x").alias("m"), F.var_pop("x").alias("v")).collect()
    d = 1 + max((r.pos for r in sums), default=-1)
    found: dict = {}
    for r in sums:  # classes x dimensions: model-sized
        n, mean, var = found.setdefault(r[label], (np.zeros(d), np.zeros(d), np.zeros(d)))
        n[r.pos], mean[r.pos], var[r.pos] = r.n, r.m, r.v
    n = sum(x[0] for x in found.values())
    mean = sum(x[0] * x[1] for x in found.values()) / n
    spread = sum(x[0] * (x[2] + (x[1] - mean) ** 2) for x in found.values()) / n
    return dict(sorted(found.items())), spread


def fit_gaussian(df: DataFrame, vec: str, label: str = "label", var_smoothing: float = 1e-9, stats=None):
    """M6: per-class mean and population variance per dimension, variances widened by
    ``var_smoothing`` x the largest per-dimension variance over all rows.  Returns a
    function adding ``pred`` and ``jll``, the per-class log-likelihoods.  ``stats`` of the
    same rows may be given, so that several smoothings share them."""
    found, spread = stats or gaussian_stats(df, vec, label)
    eps = var_smoothing * float(spread.max())
    n = sum(float(x[0][0]) for x in found.values())
    classes = list(found)
    model = [{"mu": mean.tolist(), "iv": (1 / (var + eps)).tolist(),
              "c": math.log(rows[0] / n) - 0.5 * float(np.log(2 * math.pi * (var + eps)).sum())} for rows, mean, var in found.values()]
    table = F.from_json(F.lit(json.dumps(model)), "array<struct<mu:array<double>,iv:array<double>,c:double>>")

    def transform(frame: DataFrame) -> DataFrame:
        x = F.transform(F.col(vec), lambda t: t.cast("double"))

        def one(m: Column) -> Column:
            far = F.zip_with(F.zip_with(x, m["mu"], lambda a, b: (a - b) * (a - b)), m["iv"], lambda q, w: q * w)
            return m["c"] - 0.5 * F.aggregate(far, F.lit(0.0), lambda a, b: a + b)

        scored = frame.withColumn("jll", F.transform(table, one))
        best = F.array_position("jll", F.array_max("jll")).cast("int")
        return scored.withColumn("pred", F.element_at(F.array(*[F.lit(c) for c in classes]), best))
    return transform


def cv_grid_auc(features: DataFrame, labels: DataFrame, folds: DataFrame, alphas: Sequence[float],
                fit_priors: Sequence[bool] = (True, False), row: str = "row_id", feature: str = "feature",
                value: str = "value", label: str = "label", fold: str = "fold", pos=1) -> DataFrame:
    """R9 for multinomial NB on two classes: every (alpha, fit_prior) setting x fold from
    ONE set of count aggregates.  Train counts of fold f = all counts - counts in f.
    Returns (alpha, fit_prior, mean_auc) averaged over folds."""
    from quarry.operators.metrics import auc
    classes = classes_of(labels, label)
    if len(classes) != 2:
        raise ValueError("cv_grid_auc scores two classes")
    neg, posc = classes if classes[1] == pos else classes[::-1]
    lab = labels.select(row, label).join(folds.select(row, fold), row)
    ensure_checkpoint_dir(features.sparkSession)
    fl = features.join(lab, row).checkpoint()  # for the counts and the scores
    ind = {c: (F.col(label) == c) for c in (neg, posc)}
    per_fold = fl.groupBy(fold, feature).agg(*[F.sum(F.when(ind[c], F.col(value)).otherwise(0.0)).alias(f"f{i}")
                                              for i, c in enumerate((neg, posc))]).checkpoint()
    allc = per_fold.groupBy(feature).agg(F.sum("f0").alias("a0"), F.sum("f1").alias("a1"))
    v = allc.count()
    tot_f = {r[fold]: (r["t0"], r["t1"]) for r in per_fold.groupBy(fold).agg(
        F.sum("f0").alias("t0"), F.sum("f1").alias("t1")).collect()}
    t_all = (sum(t[0] for t in tot_f.values()), sum(t[1] for t in tot_f.values()))
    folds_list = sorted(r[0] for r in lab.select(fold).distinct().collect())
    # per (fold, feature): training counts with the fold held out
    train = per_fold.join(allc, feature).select(fold, feature, (F.col("a0") - F.col("f0")).alias("c0"),
                                                (F.col("a1") - F.col("f1")).alias("c1"))
    rows_f = fl.select(row, fold, feature, value).join(train, [fold, feature])
    per_row = rows_f.groupBy(row, fold).agg(
        *[F.sum(F.col(value) * (F.log(F.col("c1") + float(a)) - F.log(F.col("c0") + float(a)))).alias(f"lr{i}") for i, a in enumerate(alphas)],
        F.sum(value).alias("sx"))
    # per fold constants: held-out totals, priors — a literal map keyed by fold (<= k folds)
    def lit_map(fn):
        return F.create_map(*[x for f in folds_list for x in (F.lit(f), F.lit(float(fn(f))))])
    tr0 = lit_map(lambda f: t_all[0] - tot_f.get(f, (0, 0))[0])
    tr1 = lit_map(lambda f: t_all[1] - tot_f.get(f, (0, 0))[1])
    # one row per labelled row, with or without features; the scores of all settings side by
    # side.  A learned prior adds the same number to every score of a fold, which changes no
    # AUC, so both priors of an alpha share it.
    held = lab.join(per_row, [row, fold], "left").fillna(0.0, [*(f"lr{i}" for i in range(len(alphas))), "sx"])
    f = F.col(fold)

    def ratio(i: int, a: float) -> Column:
        return F.col(f"lr{i}") - F.col("sx") * (F.log(F.element_at(tr1, f) + a * v) - F.log(F.element_at(tr0, f) + a * v))

    scores = F.array(*[F.struct(F.lit(float(a)).alias("alpha"), ratio(i, float(a)).alias("s")) for i, a in enumerate(alphas)])
    scored = (held.select(fold, (F.col(label) == posc).cast("int").alias("__y"), F.explode(scores).alias("x"))
              .select(fold, "__y", F.col("x.alpha").alias("alpha"), F.col("x.s").alias("__s")))
    per = auc(scored, "__y", "__s", 1, ["alpha", fold]).groupBy("alpha").agg(F.avg("auc").alias("mean_auc"))
    return per.select("alpha", F.explode(F.array(*[F.lit(bool(p)) for p in fit_priors])).alias("fit_prior"), "mean_auc")
