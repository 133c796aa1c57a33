"""Registered queries: metrics and splits (E*, R*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import vector as vx
from quarry.operators import metrics as me
from quarry.operators import split as sp
from quarry.plans.catalog import register, rounded, sql_round, sql_rounded
from quarry.plans.q_relational import _ASSIGN_SQL, _assigned
from quarry.sources import fixtures as fx
from quarry.sources.tables import table

_SCORED_SQL = """scored AS (SELECT row_id, label, l_discount * 10 AS score,
  CAST(l_discount * 10 >= 0.5 AS INTEGER) AS pred FROM clicks)"""


def _scored(spark, sf_dir):
    """Click rows with a tie-heavy score (discount x 10) and a 0.5-threshold prediction."""
    s = fx.clicks(spark, sf_dir, "l_discount").select("row_id", "label", (F.col("l_discount") * 10).alias("score"))
    return s.withColumn("pred", (F.col("score") >= 0.5).cast("int"))


def _sql(body, *extra):
    return fx.with_sql(["clicks"], body, _SCORED_SQL, *extra)


@register("e1_accuracy", sql_rounded(_sql("SELECT avg(CAST(label = pred AS DOUBLE)) AS accuracy FROM scored"),
                                     {"accuracy": 6}))
def e1_accuracy(spark, sf_dir):
    return rounded(me.accuracy(_scored(spark, sf_dir), "label", "pred"), {"accuracy": 6})


@register("e2_confusion_matrix", _sql("""
SELECT y.v AS label, p.v AS pred, count(s.row_id) AS n
FROM (VALUES (0), (1)) y(v) CROSS JOIN (VALUES (0), (1)) p(v)
LEFT JOIN scored s ON s.label = y.v AND s.pred = p.v GROUP BY 1, 2"""))
def e2_confusion_matrix(spark, sf_dir):
    return me.confusion(_scored(spark, sf_dir), "label", "pred", [0, 1])


_PRF = {"precision": 6, "recall": 6, "f1": 6}


@register("e3_precision_recall_f1", sql_rounded(_sql("""
SELECT precision, recall, coalesce(2 * precision * recall / NULLIF(precision + recall, 0), 0.0) AS f1 FROM (
  SELECT coalesce(tp / NULLIF(tp + fp, 0), 0.0) AS precision, coalesce(tp / NULLIF(tp + fn, 0), 0.0) AS recall
  FROM (SELECT count_if(label = 1 AND pred = 1) AS tp, count_if(label <> 1 AND pred = 1) AS fp,
               count_if(label = 1 AND pred <> 1) AS fn FROM scored))"""), _PRF))
def e3_precision_recall_f1(spark, sf_dir):
    return rounded(me.precision_recall_f1(_scored(spark, sf_dir), "label", "pred"), _PRF)


@register("e4_classification_report", sql_rounded(f"""WITH {_ASSIGN_SQL},
d AS (SELECT label AS y, cluster AS p FROM assigned),
ks AS (SELECT y AS k FROM d UNION SELECT p FROM d),
per AS (SELECT CAST(k AS VARCHAR) AS class, coalesce(tp / NULLIF(npred, 0), 0.0) AS precision,
               coalesce(tp / NULLIF(support, 0), 0.0) AS recall, support FROM (
          SELECT k, (SELECT count(*) FROM d WHERE y = k) AS support, (SELECT count(*) FROM d WHERE p = k) AS npred,
                 (SELECT count(*) FROM d WHERE y = k AND p = k) AS tp FROM ks)),
per2 AS (SELECT *, coalesce(2 * precision * recall / NULLIF(precision + recall, 0), 0.0) AS f1 FROM per)
SELECT class, precision, recall, f1, support FROM per2
UNION ALL SELECT 'accuracy', a, a, a, n FROM (SELECT avg(CAST(y = p AS DOUBLE)) AS a, count(*) AS n FROM d)
UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM per2
UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                 sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM per2""", _PRF))
def e4_classification_report(spark, sf_dir):
    return rounded(me.classification_report(_assigned(spark, sf_dir), "label", "cluster"), _PRF)


_ROC = {"fpr": 6, "tpr": 6}


@register("e5_roc_points", sql_rounded(_sql("""
SELECT score AS threshold, cpos / P AS tpr, cneg / N AS fpr FROM (
  SELECT score, sum(pos) OVER w AS cpos, sum(neg) OVER w AS cneg,
         sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM (
    SELECT score, count_if(label = 1) AS pos, count_if(label <> 1) AS neg FROM scored GROUP BY 1)
  WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING))"""), _ROC))
def e5_roc_points(spark, sf_dir):
    return rounded(me.roc_points(_scored(spark, sf_dir), "label", "score"), _ROC)


_TS = ", ".join(f"(CAST({round(i * 0.05, 10)!r} AS DOUBLE))" for i in range(22))


@register("e5_roc_fixed_thresholds", sql_rounded(_sql(f"""
SELECT t AS threshold, count_if(label <> 1 AND score >= t) / count_if(label <> 1) AS fpr,
       count_if(label = 1 AND score >= t) / count_if(label = 1) AS tpr
FROM scored, (VALUES {_TS}) ts(t) GROUP BY 1"""), _ROC))
def e5_roc_fixed_thresholds(spark, sf_dir):
    return rounded(me.roc_fixed(_scored(spark, sf_dir), "label", "score"), _ROC)


_AUC_SQL_TAIL = """
SELECT sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)) AS auc FROM (
  SELECT *, sum(neg) OVER (ORDER BY score ROWS UNBOUNDED PRECEDING) - neg AS below FROM (
    SELECT score, count_if(label = 1) AS pos, count_if(label <> 1) AS neg FROM {src} GROUP BY 1))"""


@register("e6_auc", sql_rounded(_sql(_AUC_SQL_TAIL.format(src="scored")), {"auc": 6}))
def e6_auc(spark, sf_dir):
    return rounded(me.auc(_scored(spark, sf_dir), "label", "score"), {"auc": 6})


# ---- E7: one-vs-one AUC of a nearest-class-mean model's softmax scores

def _class_probs(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    from quarry.operators.aggregate import vector_mean_arrays
    means = vector_mean_arrays(e, "label", "embedding").orderBy("label").collect()
    classes = [r.label for r in means]
    ex = F.array(*[F.exp(-vx.sq_dist(F.col("embedding"), F.array(*[F.lit(float(v)) for v in r.embedding])) / 64.0)
                   for r in means])
    tot = F.aggregate(ex, F.lit(0.0), lambda a, b: a + b)
    from quarry.plans.catalog import round_half_up
    probs = F.transform(ex, lambda x: round_half_up(x / tot, 6))
    return e.select("vec_id", "label", probs.alias("probs")), classes


_E7_SQL = sql_rounded(f"""
WITH cm AS (SELECT label AS c, list(m ORDER BY pos) AS mean FROM (
              SELECT label, pos, avg(CAST(x AS DOUBLE)) AS m FROM (
                SELECT label, generate_subscripts(embedding, 1) AS pos, unnest(embedding) AS x FROM embeddings)
              GROUP BY 1, 2) GROUP BY 1),
d AS (SELECT e.vec_id, e.label, cm.c, exp(-list_reduce(list_transform(range(1, 65),
        lambda i: (CAST(e.embedding[i] AS DOUBLE) - cm.mean[i]) * (CAST(e.embedding[i] AS DOUBLE) - cm.mean[i])),
        lambda a, b: a + b) / 64.0) AS ex FROM embeddings e, cm),
p AS (SELECT vec_id, label, c, {sql_round('ex / sum(ex) OVER (PARTITION BY vec_id)', 6)} AS score FROM d),
pairs AS (SELECT a.c AS pa, b.c AS pb FROM cm a, cm b WHERE a.c <> b.c),
sc AS (SELECT pa, pb, p.score, CAST(p.label = pa AS INTEGER) AS pos
       FROM p JOIN pairs ON p.c = pairs.pa AND p.label IN (pairs.pa, pairs.pb)),
g AS (SELECT pa, pb, score, sum(pos) AS npos, sum(1 - pos) AS nneg FROM sc GROUP BY 1, 2, 3),
c AS (SELECT *, sum(nneg) OVER (PARTITION BY pa, pb ORDER BY score ROWS UNBOUNDED PRECEDING) - nneg AS below FROM g)
SELECT avg(auc) AS auc_ovo FROM (
  SELECT pa, pb, sum(npos * (below + 0.5 * nneg)) / (sum(npos) * sum(nneg)) AS auc FROM c GROUP BY 1, 2)""",
                      {"auc_ovo": 6})


@register("e7_auc_one_vs_one", _E7_SQL)
def e7_auc_one_vs_one(spark, sf_dir):
    probs, classes = _class_probs(spark, sf_dir)
    return rounded(me.auc_ovo(probs, "label", "probs", classes), {"auc_ovo": 6})


_REG = {"mse": 1, "rmse": 4, "mae": 4, "r2": 6}


@register("e8_regression_metrics", sql_rounded(fx.with_sql(["prices"], """
SELECT mse, sqrt(mse) AS rmse, mae, 1 - mse / NULLIF(v, 0) AS r2 FROM (
  SELECT avg((close - close_1) * (close - close_1)) AS mse, avg(abs(close - close_1)) AS mae, var_pop(close) AS v
  FROM (SELECT close, lag(close) OVER (ORDER BY date) AS close_1 FROM prices) WHERE close_1 IS NOT NULL)"""), _REG))
def e8_regression_metrics(spark, sf_dir):
    """Naive previous-day forecast of the daily close."""
    from quarry.operators.series import lag_features
    p = lag_features(fx.prices(spark, sf_dir), ["close"], "date").where(F.col("close_1").isNotNull())
    return rounded(me.regression_metrics(p, "close", "close_1"), _REG)


# ---- splits

@register("r2_shuffled_split", _sql("""
SELECT row_id, (row_number() OVER (ORDER BY md5(row_id || '42')) - 1) < ceil(0.25 * (SELECT count(*) FROM clicks))
       AS is_test FROM clicks"""))
def r2_shuffled_split(spark, sf_dir):
    return sp.shuffled_split(fx.clicks(spark, sf_dir).select("row_id"), "row_id", 0.25, 42)


_CHRONO = "l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity"


@register("r3_chronological_split", _sql(f"""
SELECT row_id, (row_number() OVER (ORDER BY {_CHRONO}) - 1) < CAST(floor(0.9 * (SELECT count(*) FROM clicks)) AS BIGINT)
       AS is_train FROM clicks"""))
def r3_chronological_split(spark, sf_dir):
    c = fx.clicks(spark, sf_dir).select("row_id", "l_shipdate", *fx.ROW_KEY)
    return sp.chronological_split(c, ["l_shipdate", *fx.ROW_KEY], 0.9).select("row_id", "is_train")


@register("r4_date_split", fx.with_sql(["prices"], "SELECT date, close, date < DATE '1998-01-01' AS is_train FROM prices"))
def r4_date_split(spark, sf_dir):
    return sp.date_split(fx.prices(spark, sf_dir).select("date", "close"), "date", "1998-01-01")


@register("r5_last_n_split", fx.with_sql(["prices"], """
SELECT date, (row_number() OVER (ORDER BY date) - 1) >= (SELECT count(*) FROM prices) - 30 AS is_test FROM prices"""))
def r5_last_n_split(spark, sf_dir):
    return sp.last_n_split(fx.prices(spark, sf_dir).select("date"), ["date"], 30)


@register("r6_stratified_folds", _sql("""
SELECT row_id, label, CAST((row_number() OVER (PARTITION BY label ORDER BY md5(row_id || '42')) - 1) % 10 AS INTEGER)
       AS fold FROM clicks"""))
def r6_stratified_folds(spark, sf_dir):
    return sp.stratified_folds(fx.clicks(spark, sf_dir).select("row_id", "label"), "row_id", "label", 10, 42)


@register("r7_contiguous_folds", fx.with_sql(["prices"], """
SELECT date, CAST(CASE WHEN i < (q + 1) * r THEN i // (q + 1) ELSE r + (i - (q + 1) * r) // q END AS INTEGER) AS fold
FROM (SELECT date, row_number() OVER (ORDER BY date) - 1 AS i, (SELECT count(*) FROM prices) // 5 AS q,
             (SELECT count(*) FROM prices) % 5 AS r FROM prices)"""))
def r7_contiguous_folds(spark, sf_dir):
    return sp.contiguous_folds(fx.prices(spark, sf_dir).select("date"), ["date"], 5)


@register("r7_stratified_unshuffled_folds", _sql(f"""
SELECT row_id, CAST((row_number() OVER (PARTITION BY label ORDER BY {_CHRONO}) - 1) % 3 AS INTEGER) AS fold
FROM clicks"""))
def r7_stratified_unshuffled_folds(spark, sf_dir):
    c = fx.clicks(spark, sf_dir).select("row_id", "label", "l_shipdate", *fx.ROW_KEY)
    return sp.stratified_contiguous_folds(c, ["l_shipdate", *fx.ROW_KEY], "label", 3).select("row_id", "fold")


@register("r11_random_baseline_auc", sql_rounded(_sql("""
SELECT n_selected, auc FROM (SELECT count_if(pred = 1) AS n_selected FROM r11),
(""" + _AUC_SQL_TAIL.format(src="(SELECT label, pred AS score FROM r11)") + ")",
                                               """r11 AS (SELECT row_id, label, CAST((row_number() OVER (ORDER BY md5(row_id || '42')) - 1)
  < round((SELECT count(*) FROM clicks) * (SELECT sum(label) FROM clicks) / (SELECT count(*) FROM clicks)) AS INTEGER)
  AS pred FROM clicks)"""), {"auc": 6}))
def r11_random_baseline_auc(spark, sf_dir):
    b = sp.random_baseline(fx.clicks(spark, sf_dir).select("row_id", "label"), "row_id", "label", 42)
    a = me.auc(b, "label", "pred")
    n = b.agg(F.count_if(F.col("pred") == 1).alias("n_selected"))
    return rounded(a.select(n.scalar().alias("n_selected"), "auc"), {"auc": 6})


@register("r1_random_split", _sql("""
SELECT row_id, label, CASE WHEN CAST('0x' || substr(md5(row_id || '42'), 1, 8) AS BIGINT) / 4294967296.0 < 0.7
                           THEN 'train' ELSE 'test' END AS part FROM clicks"""))
def r1_random_split(spark, sf_dir):
    """Seeded 70/30 random split."""
    tr, te = sp.random_split(fx.clicks(spark, sf_dir).select("row_id", "label"), "row_id", [0.7, 0.3], 42)
    return tr.withColumn("part", F.lit("train")).unionByName(te.withColumn("part", F.lit("test")))


@register("e9_spark_auc_evaluator", sql_rounded(_sql(_AUC_SQL_TAIL.format(src="scored")), {"auc": 6}))
def e9_spark_auc_evaluator(spark, sf_dir):
    """Spark's BinaryClassificationEvaluator on the same scores as e6."""
    from pyspark.ml.functions import array_to_vector
    s = _scored(spark, sf_dir).select(F.col("label").cast("double").alias("label"),
                                      array_to_vector(F.array(-F.col("score"), F.col("score"))).alias("rawPrediction"))
    return rounded(spark.createDataFrame([(float(me.spark_auc(s)),)], "auc double"), {"auc": 6})
