"""Hand-computed expected values for the reference's toy inputs."""

import math

import pytest
from pyspark.sql import functions as F

from quarry.operators import bayes, tree


def test_bernoulli_nb_toy(spark):
    rows = [(0, [0, 1, 1], "Y"), (1, [0, 0, 1], "N"), (2, [0, 0, 0], "Y"), (3, [1, 1, 0], "Y")]
    df = spark.createDataFrame(rows, "row_id long, x array<int>, label string")
    feats = (df.select("row_id", F.posexplode("x").alias("feature", "value"))
             .where(F.col("value") == 1).withColumn("value", F.col("value").cast("double")))
    labels = df.select("row_id", "label")
    model = bayes.fit_bernoulli(feats, labels, 1.0, True, "row_id", "feature", "label", n_features=3)
    q = spark.createDataFrame([(9, 0, 1.0), (9, 1, 1.0)], "row_id long, feature int, value double")
    qrows = spark.createDataFrame([(9,)], "row_id long")
    pr = model.predict_proba(q, qrows, "row_id", "value").first()
    probs = dict(zip(model.classes, pr.probs))
    assert probs["Y"] == pytest.approx(0.921036, abs=1e-6)
    assert probs["N"] == pytest.approx(0.078964, abs=1e-6)
    theta = {(r.label, r.feature): r.theta for r in bayes.bernoulli_likelihood(feats, labels, 1.0, "row_id",
                                                                                "feature", "label").collect()}
    assert theta[("Y", 1)] == pytest.approx(0.6)
    assert theta[("N", 2)] == pytest.approx(2 / 3)


def test_gini_entropy_toys(spark):
    df = spark.createDataFrame([(0, v) for v in [1, 1, 0, 1, 1, 0, 1]] + [(1, v) for v in [1, 1, 0, 1, 0, 0]],
                               "g int, y int")
    g = {r.g: r.gini for r in tree.impurity(df, ["g"], "y", [0, 1], "gini").collect()}
    assert g[0] == pytest.approx(0.408163, abs=1e-6)
    assert g[1] == pytest.approx(0.5)
    df2 = spark.createDataFrame([(0, v) for v in [1, 1, 0, 1, 1, 0, 1]] + [(1, v) for v in [1, 1, 0, 1, 0]] +
                                [(2, v) for v in [1, 1, 1, 1]], "g int, y int")
    e = {r.g: r.entropy for r in tree.impurity(df2, ["g"], "y", [0, 1], "entropy").collect()}
    assert e[0] == pytest.approx(0.863121, abs=1e-6)
    assert e[1] == pytest.approx(0.970951, abs=1e-6)
    assert e[2] == 0
    with pytest.raises(ValueError):
        tree.impurity(df, ["g"], "y", [0, 1], "bogus")


def test_weighted_entropy_toy(spark):
    kids = spark.createDataFrame([(0, v) for v in [1, 0, 1]] + [(1, v) for v in [0, 1]], "g int, y int")
    imp = tree.impurity(kids, ["g"], "y", [0, 1], "entropy")
    assert tree.weighted_impurity(imp, "n", "entropy").first()[0] == pytest.approx(0.950978, abs=1e-6)
    kids = spark.createDataFrame([(0, v) for v in [1, 1]] + [(1, v) for v in [0, 0, 1]], "g int, y int")
    imp = tree.impurity(kids, ["g"], "y", [0, 1], "entropy")
    assert tree.weighted_impurity(imp, "n", "entropy").first()[0] == pytest.approx(0.550978, abs=1e-6)


def test_variance_toy(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 2.0), (0, 3.0), (1, 1.0), (1, 2.0), (2, 3.0)], "g int, y double")
    v = {r.g: r.mse for r in tree.variance_by(df, ["g"], "y").collect()}
    assert v[0] == pytest.approx(0.666667, abs=1e-6)
    w = tree.weighted_impurity(tree.variance_by(df.where("g > 0"), ["g"], "y"), "n", "mse").first()[0]
    assert w == pytest.approx(1 / 6, abs=1e-6)


def test_cart_categorical_toy(spark):
    X = [["tech", "professional"], ["fashion", "student"], ["fashion", "professional"], ["sports", "student"],
         ["tech", "student"], ["tech", "retired"], ["sports", "professional"]]
    y = [1, 0, 0, 0, 1, 0, 1]
    df = spark.createDataFrame(list(zip(X, y)), "x array<string>, y int")
    t = tree.train_tree(df, "x", "y", ["cat", "cat"], 2, 2, "gini")
    root = t.nodes[1]
    assert (root.feature, root.value, root.is_leaf) == (0, "fashion", False)
    assert t.nodes[3].is_leaf and t.nodes[3].prediction == 0
    assert (t.nodes[2].feature, t.nodes[2].value) == (1, "professional")
    assert t.nodes[4].prediction == 0 and t.nodes[5].prediction == 1
    pred = df.select(t.predict(F.col("x")).alias("p"), "y").collect()
    assert sum(int(r.p == r.y) for r in pred) >= 6
    assert t.rules() == [(3, 1, 2, "feature_0 = 'fashion'", 0.0), (4, 2, 3, "feature_0 <> 'fashion' AND feature_1 <> 'professional'", 0.0),
                         (5, 2, 2, "feature_0 <> 'fashion' AND feature_1 = 'professional'", 1.0)]


def test_cart_numeric_toy(spark):
    X = [[6, 7], [2, 4], [7, 2], [3, 6], [4, 7], [5, 2], [1, 6], [2, 0], [6, 3], [4, 1]]
    y = [0, 0, 0, 0, 0, 1, 1, 1, 1, 1]
    df = spark.createDataFrame([([str(a), str(b)], c) for (a, b), c in zip(X, y)], "x array<string>, y int")
    t = tree.train_tree(df, "x", "y", ["num", "num"], 2, 2, "gini")
    assert (t.nodes[1].feature, float(t.nodes[1].value)) == (1, 4.0)
    assert (t.nodes[2].feature, float(t.nodes[2].value)) == (0, 7.0)
    assert t.nodes[4].prediction == 1 and t.nodes[5].prediction == 0
    assert (t.nodes[3].feature, float(t.nodes[3].value)) == (0, 2.0)
    assert t.nodes[6].prediction == 1 and t.nodes[7].prediction == 0


def test_regression_tree_toy(spark):
    X = [["semi", "3"], ["detached", "2"], ["detached", "3"], ["semi", "2"], ["semi", "4"]]
    y = [600.0, 700.0, 800.0, 400.0, 700.0]
    df = spark.createDataFrame(list(zip(X, y)), "x array<string>, y double")
    t = tree.train_tree(df, "x", "y", ["cat", "num"], 2, 2, "mse")
    assert (t.nodes[1].feature, t.nodes[1].value) == (0, "detached")
    assert t.nodes[3].prediction == pytest.approx(750)
    assert (t.nodes[2].feature, float(t.nodes[2].value)) == (1, 3.0)
    assert t.nodes[4].prediction == pytest.approx(400) and t.nodes[5].prediction == pytest.approx(650)


def test_sigmoid_stable(spark):
    from quarry.functions.vector import sigmoid
    r = spark.range(1).select(sigmoid(F.lit(-800.0)).alias("a"), sigmoid(F.lit(800.0)).alias("b"),
                              sigmoid(F.lit(0.0)).alias("c")).first()
    assert r.a == 0.0 and r.b == 1.0 and r.c == 0.5
    assert not math.isnan(r.a)
