"""Registered queries: learners (M7-M42, X1-X6, ST1-ST2); searches are in ``q_search``.

Model fits are iterative and seeded but not expressible in SQL, so these carry no
DuckDB twin (rows-only check); their exact parts are covered by toy tests.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from quarry.operators import bayes, cluster, encode, linear, metrics, neural, svm, topics, tree
from quarry.operators import series
from quarry.plans.catalog import register, rounded, sql_rounded
from quarry.session import FREE_SHUFFLES, kept, setting
from quarry.sources import files
from quarry.sources import fixtures as fx
from quarry.sources.tables import table

CAT = ["l_linestatus", "o_orderpriority", "p_brand", "p_type", "c_mktsegment"]


def _clicks_split(spark, sf_dir, *more):
    """Clicks (label, categories, ``more``) that train and that test.  Every fit and score reads
    them many times, so the joined rows are written once, as Parquet; the side of a row is
    drawn before the joins, which then carry no key columns that only the draw needs."""
    from quarry.operators.split import hashed_split
    li = table(spark, sf_dir, "lineitem").withColumn("__row", fx.row_id_col())
    c = fx.clicks(spark, sf_dir, "is_test", lines=hashed_split(li, "__row", 0.3, 42))
    s = c.select(F.col("label").cast("double").alias("label"), *CAT, "is_test", *more)
    path = files.new_scratch(spark, "clicks")
    with setting(spark, FREE_SHUFFLES, "true"):  # the joins' shuffles go once the rows are written
        s.select("*").write.parquet(path)
    s = spark.read.schema(s.schema).parquet(path)
    return s.where(~F.col("is_test")), s.where(F.col("is_test"))


def _auc_row(pred, name, score="p1", times=None):
    return metrics.auc(pred, "label", score, times=times).select(F.lit(name).alias("model"), "auc")


def _p1(df):
    return df.withColumn("p1", vector_to_array("probability")[1])


def _emb(spark, sf_dir, binary=True):
    e = table(spark, sf_dir, "embeddings")
    lab = (F.col("label") % 2).cast("double") if binary else F.col("label").cast("double")
    return e.select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("features"),
                    lab.alias("label"))


@register("x1_x4_m21_m22_m23_m31_click_models")
def x1_x4_m21_m22_m23_m31_click_models(spark, sf_dir):
    """One-hot pipeline fit on train rows, then tree / forest / boosted trees / elastic-net
    logistic scored by AUC on held-out rows.

    Rows that are alike in all columns are one weighted row for the learners that a weight
    serves as well (trees without resampling) and for the scores; the forest draws rows and
    the logistic one takes the deviation of rows, so these fit on all rows."""
    tr, te = _clicks_split(spark, sf_dir)
    enc = encode.fit_onehot(tr, CAT)
    trf = enc.transform(tr).select("features", "label")
    alike, held = (kept(d.groupBy("label", *CAT).agg(F.count(F.lit(1)).cast("double").alias("times"))) for d in (tr, te))
    trw, tew = (enc.transform(d).select("features", "label", "times") for d in (alike, held))
    n = alike.agg(F.sum("times")).first()[0] or 0.0
    out = None
    for name, est, rows in [("decision_tree", tree.weighted_rows(tree.spark_tree_classifier(8, 45, "times"), n), trw),
                            ("random_forest", tree.spark_forest_classifier(20, 8), trf),
                            ("boosted_trees", tree.spark_gbt_classifier(10, 4, weight_col="times"), trw),
                            ("logistic", linear.spark_logistic(20, 0.001, 0.001), trf)]:
        r = _auc_row(_p1(est.fit(rows).transform(tew)), name, times="times")
        out = r if out is None else out.unionByName(r)
    return rounded(out, {"auc": 6})


@register("x1_frequency_index", fx.with_sql(["clicks"], """
SELECT name, value, CAST(row_number() OVER (PARTITION BY name ORDER BY n DESC, value) - 1 AS INTEGER) AS index
FROM (SELECT name, value, count(*) AS n FROM (""" + " UNION ALL ".join(f"SELECT '{c}' AS name, {c} AS value FROM clicks" for c in CAT)
                                              + ") GROUP BY 1, 2)"))
def x1_frequency_index(spark, sf_dir):
    """Index of every category, most frequent first, from one multi-column indexer."""
    c = fx.clicks(spark, sf_dir)
    model = encode.fit_onehot(c, CAT).stages[0]
    rows = [(name, v, i) for name, values in zip(CAT, model.labelsArray, strict=True) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "name string, value string, index int")


def _impurity_sql(kind):
    part = {"gini": "1 - sum((n * 1.0 / t) * (n * 1.0 / t))", "entropy": "-sum((n * 1.0 / t) * log2(n * 1.0 / t))"}[kind]
    return f"SELECT p_brand, CAST(max(t) AS BIGINT) AS n, {part} AS {kind} FROM g GROUP BY 1"


_G = "g AS (SELECT *, sum(n) OVER (PARTITION BY p_brand) AS t FROM (SELECT p_brand, label, count(*) AS n FROM clicks GROUP BY 1, 2))"


@register("m13_gini", sql_rounded(fx.with_sql(["clicks"], _impurity_sql("gini"), _G), {"gini": 6}))
def m13_gini(spark, sf_dir):
    return rounded(tree.impurity(fx.clicks(spark, sf_dir), ["p_brand"], "label", [0, 1], "gini"), {"gini": 6})


@register("m13_entropy", sql_rounded(fx.with_sql(["clicks"], _impurity_sql("entropy"), _G), {"entropy": 6}))
def m13_entropy(spark, sf_dir):
    return rounded(tree.impurity(fx.clicks(spark, sf_dir), ["p_brand"], "label", [0, 1], "entropy"), {"entropy": 6})


@register("m14_weighted_gini", sql_rounded(fx.with_sql(["clicks"], f"""
SELECT sum(n * gini) / sum(n) AS weighted FROM ({_impurity_sql("gini")})""", _G), {"weighted": 6}))
def m14_weighted_gini(spark, sf_dir):
    return rounded(tree.weighted_impurity(tree.impurity(fx.clicks(spark, sf_dir), ["p_brand"], "label", [0, 1])), {"weighted": 6})


@register("m19_variance", sql_rounded(fx.with_sql(["clicks"], """
SELECT p_brand, count(*) AS n, var_pop(l_quantity) AS mse FROM clicks GROUP BY 1"""), {"mse": 6}))
def m19_variance(spark, sf_dir):
    return rounded(tree.variance_by(fx.clicks(spark, sf_dir), ["p_brand"], "l_quantity"), {"mse": 6})


@register("m16_root_split", sql_rounded(fx.with_sql(["clicks"], """
SELECT name, value, n_right, score FROM (
  SELECT name, value, r0 + r1 AS n_right,
         ((r0 + r1) * (1 - (r0 * r0 + r1 * r1) / ((r0 + r1) * (r0 + r1) * 1.0))
          + (t0 - r0 + t1 - r1) * (1 - ((t0 - r0) * (t0 - r0) + (t1 - r1) * (t1 - r1)) / ((t0 - r0 + t1 - r1) * (t0 - r0 + t1 - r1) * 1.0)))
         / (t0 + t1) AS score
  FROM (SELECT name, value, count_if(label = 0) AS r0, count_if(label = 1) AS r1 FROM ("""
    + " UNION ALL ".join(f"SELECT '{c}' AS name, {c} AS value, label FROM clicks" for c in CAT) + """) GROUP BY 1, 2),
       (SELECT count_if(label = 0) AS t0, count_if(label = 1) AS t1 FROM clicks)
  WHERE r0 + r1 < t0 + t1) ORDER BY round(score, 12), name, value LIMIT 1"""), {"score": 9}))
def m16_root_split(spark, sf_dir):
    """The best first split of a gini tree on the click categories."""
    c = fx.clicks(spark, sf_dir)
    order = sorted(CAT)  # ties go to the first feature
    df = c.select(F.array(*[F.col(x) for x in order]).alias("x"), "label")
    t = tree.train_tree(df, "x", "label", ["cat"] * len(order), 1, 1, "gini", [0, 1], order)
    root, right, left = t.nodes[1], t.nodes[3], t.nodes[2]
    sides = df.select(F.when(tree.goes_right(F.get("x", F.lit(root.feature)), F.lit(False), F.lit(root.value)), "right").otherwise("left").alias("side"), "label")
    score = tree.weighted_impurity(tree.impurity(sides, ["side"], "label", [0, 1])).select("weighted")
    return rounded(score.select(F.lit(order[root.feature]).alias("name"), F.lit(root.value).alias("value"),
                                F.lit(right.n).cast("long").alias("n_right"), F.col("weighted").alias("score")), {"score": 9})


@register("m42_j5_average_regressors", sql_rounded(fx.with_sql(["prices"], """
SELECT date, (a0 + a1 * close_1 + b0 + b1 * open) / 2 AS prediction, close FROM l,
  (SELECT regr_intercept(close, close_1) AS a0, regr_slope(close, close_1) AS a1,
          regr_intercept(close, open) AS b0, regr_slope(close, open) AS b1 FROM l)""",
    "l AS (SELECT * FROM (SELECT date, open, close, lag(close) OVER (ORDER BY date) AS close_1 FROM prices) WHERE close_1 IS NOT NULL)"),
    {"prediction": 2, "close": 2}))
def m42_j5_average_regressors(spark, sf_dir):
    """Two least-squares regressors of the daily close (on the day before's, on the open),
    fitted in one aggregate, their predictions aligned by date and averaged."""
    from quarry.operators.relate import align_mean
    p = series.lag_features(fx.prices(spark, sf_dir), ["close"], "date").where(F.col("close_1").isNotNull()).select("date", "open", "close", "close_1").checkpoint()
    fit = p.agg(*[f("close", x).alias(n) for x, y in (("close_1", "a"), ("open", "b")) for f, n in ((F.regr_intercept, y + "0"), (F.regr_slope, y + "1"))]).first()
    one = p.select("date", (F.lit(fit.a0) + F.lit(fit.a1) * F.col("close_1")).alias("z"))
    two = p.select("date", (F.lit(fit.b0) + F.lit(fit.b1) * F.col("open")).alias("z"))
    return rounded(align_mean(one, two, "date", "z", "prediction").join(p.select("date", "close"), "date"), {"prediction": 2, "close": 2})


@register("x5_x6_hashed_and_formula_features")
def x5_x6_hashed_and_formula_features(spark, sf_dir):
    """Feature hashing (10 000 dims) and an R formula with an interaction, each feeding
    a logistic regression; AUC on held-out rows."""
    tr, te = _clicks_split(spark, sf_dir)
    out = None
    for name, stage in [("hashed", encode.hashed_features(CAT, 10_000)),
                        ("formula", encode.formula_features("label ~ l_linestatus + o_orderpriority + p_brand + "
                                                            "p_type:c_mktsegment"))]:
        pipe = Pipeline(stages=[stage, linear.spark_logistic(20, 0.001, 0.001)]).fit(tr)
        r = _auc_row(_p1(pipe.transform(te)), name)
        out = r if out is None else out.unionByName(r)
    return rounded(out, {"auc": 6})


@register("m17_m18_cart_rules")
def m17_m18_cart_rules(spark, sf_dir):
    """Scratch CART (gini, depth 3, min size 45) on the click categories; a rule per leaf."""
    c = fx.clicks(spark, sf_dir)
    df = c.select(F.array(*[F.col(x) for x in CAT]).alias("x"), "label")
    t = tree.train_tree(df, "x", "label", ["cat"] * len(CAT), 3, 45, "gini", [0, 1], CAT)
    return spark.createDataFrame(t.rules(), "leaf long, depth int, n long, condition string, prediction double")


@register("m16_m20_regression_tree_nodes")
def m16_m20_regression_tree_nodes(spark, sf_dir):
    """Scratch regression tree (depth 3, min size 20) predicting the daily close from
    lagged price features; the node table."""
    p = series.price_features(fx.prices(spark, sf_dir))
    cols = series.feature_names()
    df = p.select(F.array(*[F.col(x).cast("string") for x in cols]).alias("x"), F.col("close").alias("y"))
    t = tree.train_tree(df, "x", "y", ["num"] * len(cols), 3, 20, "mse", names=cols)
    return t.to_df(spark)


def _price_xy(spark, sf_dir):
    p = series.price_features(fx.prices(spark, sf_dir)).checkpoint(eager=True)  # reused by every fit step
    names = series.feature_names()
    cut = p.select(F.percentile_approx("date", 0.9)).first()[0]
    scale = encode.standard_scaler(p.where(F.col("date") <= cut), names)
    z = scale(p).select("date", F.array(*[F.col(n) for n in names]).alias("features"), F.col("close").alias("label"))
    return z.where(F.col("date") <= cut), z.where(F.col("date") > cut), names


@register("m25_m26_t4_forest_regressor")
def m25_m26_t4_forest_regressor(spark, sf_dir):
    """Random-forest and tree regressors on the price features; test metrics, then the
    ten most important features by name."""
    tr, te, names = _price_xy(spark, sf_dir)
    trv = tr.withColumn("features", array_to_vector("features"))
    tev = te.withColumn("features", array_to_vector("features"))
    rf = tree.spark_forest_regressor(30, 8).fit(trv)
    m = metrics.regression_metrics(rf.transform(tev), "label", "prediction")
    by_weight = sorted(tree.importances(rf, names), key=lambda t: -t[1])
    imp = [(f"top_{n}", v) for n, v in by_weight[:10]] + [(f"bottom_{n}", v) for n, v in by_weight[-10:]]
    dt = tree.spark_tree_regressor(10).fit(trv)
    m2 = metrics.regression_metrics(dt.transform(tev), "label", "prediction")
    rows = [("forest_r2", float(m.first().r2)), ("tree_r2", float(m2.first().r2))] + [(f"imp_{n}", float(v))
                                                                                      for n, v in imp]
    return spark.createDataFrame(rows, "name string, value double")


@register("m27_m28_t3_gradient_descent")
def m27_m28_t3_gradient_descent(spark, sf_dir):
    """Batch GD: logistic (intercept, 30 steps) on embeddings, linear (1000 steps) on scaled
    price features; train AUC and the ten largest and smallest |weights|."""
    e = _emb(spark, sf_dir).cache()
    w, costs = linear.train_logistic_gd(e, 64, max_iter=30, learning_rate=0.5, fit_intercept=True, log_every=10)
    pr = linear.predict_linear(e, w, logistic=True, add_intercept=True, out="p1")
    auc = metrics.auc(pr, "label", "p1").first().auc
    tr, te, names = _price_xy(spark, sf_dir)
    trs = tr.withColumn("label", F.col("label") / 1e4)
    wl, _ = linear.train_linear_gd(trs, len(names), max_iter=1000, learning_rate=0.01, fit_intercept=True)
    lo, hi = linear.top_weights(wl[1:], names, 10)
    rows = [("logistic_auc", float(auc)), ("logistic_cost_first", costs[0][1])] + \
           [(f"top_{n}", v) for n, v in hi] + [(f"bottom_{n}", v) for n, v in lo]
    e.unpersist()
    return spark.createDataFrame(rows, "name string, value double")


@register("m29_m24_sgd_and_boosted_linear")
def m29_m24_sgd_and_boosted_linear(spark, sf_dir):
    """Per-partition SGD with weight averaging, and a boosted linear model; train AUC."""
    e = _emb(spark, sf_dir).cache()
    w = linear.train_logistic_sgd(e, 64, epochs=3, learning_rate=0.05)
    a1 = metrics.auc(linear.predict_linear(e, w, logistic=True, out="p1"), "label", "p1").first().auc
    wg, b = linear.train_gblinear(e, 64, rounds=10, eta=0.3, reg_lambda=1.0)
    pr = linear.predict_linear(e, list(wg), logistic=False, out="z").withColumn("p1", F.col("z") + b)
    a2 = metrics.auc(pr, "label", "p1").first().auc
    e.unpersist()
    return spark.createDataFrame([("sgd_auc", float(a1)), ("gblinear_auc", float(a2))], "name string, value double")


@register("m7_m9_m32_linear_svm")
def m7_m9_m32_linear_svm(spark, sf_dir):
    """Binary linear SVM (C=1) and one-vs-rest over ten classes with balanced weights."""
    e = _emb(spark, sf_dir).withColumn("features", array_to_vector("features"))
    n = e.count()
    b = svm.linear_svc(1.0, n).fit(e).transform(e)
    acc_b = metrics.accuracy(b, "label", "prediction").first().accuracy
    m = _emb(spark, sf_dir, binary=False).withColumn("features", array_to_vector("features"))
    mw = tree.balanced_weights(m, "label")
    ovr = linear.one_vs_rest(svm.linear_svc(1.0, n, 50, weight_col="weight"), "weight").fit(mw).transform(mw)
    acc_m = metrics.accuracy(ovr, "label", "prediction").first().accuracy
    return spark.createDataFrame([("binary_accuracy", float(acc_b)), ("ovr_accuracy", float(acc_m))],
                                 "name string, value double")


@register("m8_e2_svm_one_vs_one")
def m8_e2_svm_one_vs_one(spark, sf_dir):
    """One-vs-one linear SVM vote over all classes; confusion matrix."""
    e = _emb(spark, sf_dir, binary=False)
    classes = bayes.classes_of(e, "label")
    pred = svm.one_vs_one(e, classes, 1.0, row="vec_id")
    j = e.select("vec_id", "label").join(pred, "vec_id")
    return metrics.confusion(j, "label", "pred", classes)


@register("m11_linear_svr")
def m11_linear_svr(spark, sf_dir):
    """Linear epsilon-SVR on scaled price features; test R2."""
    tr, te, names = _price_xy(spark, sf_dir)
    sc = 1e4
    w = linear.train_linear_svr(tr.withColumn("label", F.col("label") / sc), len(names), C=10.0, epsilon=0.02,
                                max_iter=40, learning_rate=0.5)
    pr = linear.predict_linear(te, list(w[:-1]), out="z").withColumn("prediction", (F.col("z") + w[-1]) * sc)
    return rounded(metrics.regression_metrics(pr, "label", "prediction"), {"mse": 1, "rmse": 4, "mae": 4, "r2": 6})


@register("m33_m35_m36_neural_regressor")
def m33_m35_m36_neural_regressor(spark, sf_dir):
    """Two ReLU layers (16, 8) with Adam, dropout 0.1 and early stopping on held-out
    days; plus a no-hidden-layer linear model; per-epoch history."""
    tr, te, names = _price_xy(spark, sf_dir)
    trs, tes = (d.withColumn("label", F.col("label") / 1e4).checkpoint() for d in (tr, te))
    _, h = neural.train(trs, [len(names), 16, 8, 1], epochs=25, lr=0.01, dropout=0.1, valid=tes, patience=10)
    _, h0 = neural.train(trs, [len(names), 1], epochs=10, lr=0.05)
    rows = [("mlp", ep, float(a), float(b) if b is not None else None) for ep, a, b in h] + \
           [("linear", ep, float(a), None) for ep, a, _ in h0]
    return spark.createDataFrame(rows, "model string, epoch int, train_mse double, valid_mse double")


@register("m34_sigmoid_network")
def m34_sigmoid_network(spark, sf_dir):
    """One hidden sigmoid layer, squared error, plain batch back-propagation."""
    e = _emb(spark, sf_dir).cache()
    layers, h = neural.train(e, [64, 8, 1], epochs=20, lr=1.0, hidden="sigmoid", out="sigmoid", optimizer="sgd")
    pr = neural.predict(e, layers, "sigmoid", "sigmoid", col="p1")
    a = metrics.auc(pr, "label", "p1").first().auc
    return spark.createDataFrame([(ep, float(l)) for ep, l, _ in h] + [(-1, float(a))], "epoch int, value double")


@register("m37_kmeans_scratch")
def m37_kmeans_scratch(spark, sf_dir):
    """k-means from scratch (k=10) on embeddings: cluster sizes and final centres' norms."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double"))
                                                 .alias("v"))
    assigned, c = cluster.kmeans(e, "v", 10, max_iter=100, tol=1e-4, row="vec_id")
    sizes = assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))
    return sizes.withColumn("centre_norm", F.element_at(
        F.array(*[F.lit(float(np.linalg.norm(x))) for x in c]), F.col("cluster") + 1))


@register("m38_m39_kmeans_elbow")
def m38_m39_kmeans_elbow(spark, sf_dir):
    """Spark k-means|| (10 starts) for k = 1..8: inertia and the sum of per-cluster norms."""
    e = table(spark, sf_dir, "embeddings").select(F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    ev = e.withColumn("features", array_to_vector("v")).cache()
    # one cluster has the mean as its centre; Spark's learner starts at two
    mean = [float(x) for x in ev.select(Summarizer.mean(F.col("features")).alias("m")).first().m]
    sc = cluster.cluster_scores(ev.withColumn("cluster", F.lit(0)), "v", [mean]).first()
    rows = [(1, float(sc.inertia), float(sc.sum_norm))]
    for k in range(2, 9):
        m = cluster.spark_kmeans(ev, "features", k, seeds=range(1, 11), max_iter=20)
        centres = [list(map(float, c)) for c in m.clusterCenters()]
        sc = cluster.cluster_scores(m.transform(ev).withColumnRenamed("prediction", "cluster"), "v", centres).first()
        rows.append((k, float(sc.inertia), float(sc.sum_norm)))
    ev.unpersist()
    return spark.createDataFrame(rows, "k int, inertia double, sum_norm double")


@register("m40_t5_lda_topics")
def m40_t5_lda_topics(spark, sf_dir):
    """LDA with 20 topics and 10 iterations over the bag of words, whole vocabulary; ten top
    terms per topic."""
    from quarry.plans.q_text import _bow_parts
    tf, vocab, _ = _bow_parts(spark, sf_dir)
    lam, _ = topics.lda(encode.bag_of_words(tf, vocab), k=20, max_iter=10)
    mine = lam.select("index", F.posexplode("lam").alias("topic", "lam"))
    whole = mine.groupBy("topic").agg(F.sum("lam").alias("whole"))
    share = mine.join(whole, "topic").join(vocab.select("index", "term"), "index")
    return topics.top_terms(share.select("topic", "term", (F.col("lam") / F.col("whole")).alias("weight")), 10)


NMF_UPDATES = 15  # the reference allows 200; an update here is two distributed joins (see README)


@register("m41_t5_nmf_topics")
def m41_t5_nmf_topics(spark, sf_dir):
    """NMF with 20 components on TF-IDF weights of the whole vocabulary, NMF_UPDATES
    multiplicative updates unless the error settles before; top terms."""
    from quarry.plans.q_text import _bow_parts
    tf, vocab, n = _bow_parts(spark, sf_dir)
    w = encode.tfidf(tf, vocab, n).select("doc_id", "index", F.col("weight").alias("value"))
    _, H, losses = topics.nmf(w, 20, max_iter=NMF_UPDATES, tol=1e-4)
    per_topic = H.select("index", F.posexplode("h").alias("topic", "weight")).join(vocab.select("index", "term"), "index")
    return topics.top_terms(per_topic.select("topic", "term", "weight"), 10).withColumn("final_loss", F.lit(losses[-1]))


EVENTS_PER_FILE = 20_000  # a chunk of the stream


@register("st1_st2_online_logistic")
def st1_st2_online_logistic(spark, sf_dir):
    """Four fifths of the events rewritten as files of at most EVENTS_PER_FILE, streamed one
    file per trigger into an online logistic model (label: click); AUC of the final weights
    on the fifth that was held out."""
    from quarry.operators.split import hashed_split
    ev = hashed_split(table(spark, sf_dir, "events"), "event_id", 0.2, 42)
    held, ev = ev.where("is_test").drop("is_test"), ev.where("NOT is_test").drop("is_test")
    src = files.new_scratch(spark, "events_stream")
    ev.write.option("maxRecordsPerFile", EVENTS_PER_FILE).parquet(src)

    def featurize(df):
        hour = F.hour("ts")
        x = F.array(F.lit(1.0), (F.col("value") / 100.0).cast("double"),
                    *[(hour == h).cast("double") for h in range(24)])
        return df.select(x.alias("features"), (F.col("event_type") == "click").cast("double").alias("label"))
    w = __import__("quarry.streaming.online", fromlist=["run_online"]).run_online(
        spark, src, ev.schema, featurize, 26, files.new_scratch(spark, "online_state"),
        files.new_scratch(spark, "online_ckpt"), learning_rate=0.05)
    from quarry.streaming.online import score
    pr = score(featurize(held), w, out="p1")
    return rounded(metrics.auc(pr, "label", "p1"), {"auc": 6})

