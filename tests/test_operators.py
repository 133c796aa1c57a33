"""Property tests for the non-SQL operators."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.functions import text as tx
from quarry.operators import kernel, linear, metrics, relate, split


def test_porter_and_lemma(spark):
    assert tx.porter_stem("machines") == "machin"
    assert tx.porter_stem("learning") == "learn"
    vocab = spark.createDataFrame([("machines",), ("machine",), ("learning",)], "token string")
    lem = {r.token: r.lemma for r in tx.noun_lemmas(vocab).collect()}
    assert lem["machines"] == "machine" and lem["learning"] == "learning"


def test_linear_gd_toy(spark):
    x = [6, 2, 3, 4, 1, 5, 2, 6, 4, 7]
    y = [5.5, 1.6, 2.2, 3.7, .8, 5.2, 1.5, 5.3, 4.4, 6.8]
    df = spark.createDataFrame([([float(a)], b) for a, b in zip(x, y)], "features array<double>, label double")
    w, _ = linear.train_linear_gd(df, 1, max_iter=100, learning_rate=0.01)
    assert w[0] == pytest.approx(0.940816, abs=1e-6)
    pred = linear.predict_linear(spark.createDataFrame([([1.3],), ([3.5],)], "features array<double>"), w)
    assert [round(r.prediction, 4) for r in pred.collect()] == [1.2231, 3.2929]


def test_row_index_and_folds_partition_rows(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("rid"), (F.col("id") % 3).alias("y"))
    idx = relate.global_row_index(df, ["rid"], "i").select("i").collect()
    assert sorted(r.i for r in idx) == list(range(1000))
    f = split.stratified_folds(df, "rid", "y", 5).groupBy("y", "fold").count().collect()
    assert sum(r["count"] for r in f) == 1000
    for y in range(3):
        sizes = [r["count"] for r in f if r.y == y]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_auc_invariant_under_monotone_transform(spark):
    rng = np.random.default_rng(0)
    rows = [(int(rng.integers(0, 2)), float(round(rng.random(), 2))) for _ in range(300)]
    df = spark.createDataFrame(rows, "label int, score double")
    a = metrics.auc(df, "label", "score").first().auc
    b = metrics.auc(df.withColumn("score", F.exp(F.col("score") * 3)), "label", "score").first().auc
    assert 0 <= a <= 1 and a == pytest.approx(b)


def test_fourier_features_approach_the_rbf_kernel():
    made = kernel.fourier(2, 2000, 1.0, 0)
    a, b = made(np.array([[0.0, 0.0], [0.5, 0.5]]))[:, :-1]
    assert a @ b == pytest.approx(np.exp(-0.5), abs=0.06)


def test_weighted_rows_give_the_tree_and_the_auc_of_all_rows(spark):
    """Rows alike in all columns as one row with their number: least rows of a node, and scores."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from quarry.operators import metrics, tree
    rows = [(float((i * 7) % 5 < 2), [float(i % 2), float(i % 3 == 0), float(i % 11 < 3)]) for i in range(400)] + [(1.0, [1.0, 1.0, 1.0])] * 30
    df = spark.createDataFrame(rows, "label double, x array<double>")
    few = df.groupBy("label", "x").agg(F.count(F.lit(1)).cast("double").alias("times"))
    assert few.count() < 20
    vec = lambda d: d.withColumn("features", array_to_vector("x"))
    for least in (1, 45, 216):
        one = tree.spark_tree_classifier(4, least).fit(vec(df))
        two = tree.weighted_rows(tree.spark_tree_classifier(4, least, "times"), 430.0).fit(vec(few))
        assert one.toDebugString.split("\n")[1:] == two.toDebugString.split("\n")[1:]
        p = [m.transform(vec(d)).withColumn("p1", vector_to_array("probability")[1]) for m, d in ((one, df), (two, few))]
        a, b = metrics.auc(p[0], "label", "p1").first().auc, metrics.auc(p[1], "label", "p1", times="times").first().auc
        assert a == pytest.approx(b, abs=1e-12)
