"""Registered queries: naive Bayes on document quality labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import bayes as nb
from quarry.operators import split as sp
from quarry.operators.metrics import accuracy
from quarry.plans.catalog import register, rounded, sql_rounded
from quarry.plans.q_text import _BOW_CTES, _bow_parts
from quarry.sources import fixtures as fx
from quarry.sources.tables import table

_LAB_SQL = "lab AS (SELECT doc_id, quality AS label FROM labels)"
_BOW_F = "bow AS (SELECT doc_id, term, CAST(tf AS DOUBLE) AS tf FROM tf JOIN vi USING (term))"


def _doc_features(spark, sf_dir):
    """(bag of words of the documents that have a label, each (document, term) once; labels).
    The vocabulary is that of all documents.  Fit and score both read the rows, so they are
    written once."""
    tf, vocab, _ = _bow_parts(spark, sf_dir)
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    mine = tf.join(labels.select("doc_id").distinct(), "doc_id", "left_semi")
    feats = mine.join(vocab.select("term"), "term").select("doc_id", F.col("term").alias("feature"),
                                                           F.col("tf").cast("double").alias("value")).checkpoint()
    return feats, labels


@register("m1_class_priors", sql_rounded("""
SELECT quality AS label, count(*) AS n, count(*) / (SELECT count(*) FROM labels) AS prior FROM labels GROUP BY 1""",
                                         {"prior": 6}))
def m1_class_priors(spark, sf_dir):
    lab = table(spark, sf_dir, "labels").select(F.col("quality").alias("label"))
    return rounded(nb.priors(lab, "label"), {"prior": 6})


@register("m2_bernoulli_likelihood", sql_rounded(fx.with_sql([], """
SELECT l.label, b.term AS feature, (count(*) + 1.0) / (n.n + 2.0) AS theta
FROM bow b JOIN lab l USING (doc_id) JOIN (SELECT label, count(*) AS n FROM lab GROUP BY 1) n USING (label)
GROUP BY l.label, b.term, n.n""", _BOW_CTES, _BOW_F, _LAB_SQL), {"theta": 6}))
def m2_bernoulli_likelihood(spark, sf_dir):
    feats, labels = _doc_features(spark, sf_dir)
    return rounded(nb.bernoulli_likelihood(feats, labels, 1.0, "doc_id", "feature", "label", distinct=True), {"theta": 6})


_M5_SQL = sql_rounded(fx.with_sql([], """
SELECT doc_id, exp(s1 - m) / (exp(s0 - m) + exp(s1 - m)) AS p1,
       CASE WHEN s1 > s0 THEN 1 ELSE 0 END AS pred FROM (
  SELECT doc_id, s0, s1, greatest(s0, s1) AS m FROM (
    SELECT l.doc_id,
      ln((SELECT count(*) FROM lab WHERE label = 0) / (SELECT count(*) FROM lab))
        + coalesce(sum(b.tf * ln(coalesce(c.n0, 0) + 1.0)), 0) - coalesce(sum(b.tf), 0) * ln(t.t0 + t.v) AS s0,
      ln((SELECT count(*) FROM lab WHERE label = 1) / (SELECT count(*) FROM lab))
        + coalesce(sum(b.tf * ln(coalesce(c.n1, 0) + 1.0)), 0) - coalesce(sum(b.tf), 0) * ln(t.t1 + t.v) AS s1
    FROM lab l LEFT JOIN bow b USING (doc_id) LEFT JOIN cnt c ON c.term = b.term,
         (SELECT sum(n0) AS t0, sum(n1) AS t1, count(*) AS v FROM cnt) t
    GROUP BY l.doc_id, t.t0, t.t1, t.v))""", _BOW_CTES, _BOW_F, _LAB_SQL, """cnt AS (
  SELECT term, sum(CASE WHEN label = 0 THEN tf ELSE 0 END) AS n0, sum(CASE WHEN label = 1 THEN tf ELSE 0 END) AS n1
  FROM bow JOIN lab USING (doc_id) GROUP BY 1)"""), {"p1": 6})


@register("m5_multinomial_nb", _M5_SQL)
def m5_multinomial_nb(spark, sf_dir):
    """Multinomial NB (alpha 1, learned prior) fit on labelled documents' term counts,
    posterior of the positive class for every labelled document."""
    feats, labels = _doc_features(spark, sf_dir)
    model = nb.fit_multinomial(feats, labels, 1.0, True, "doc_id", "feature", "value", "label")
    pr = model.predict_proba(feats, labels, "doc_id", "value")
    return rounded(pr.select("doc_id", F.col("probs")[1].alias("p1"), "pred"), {"p1": 6})


_M3_SQL = sql_rounded(fx.with_sql([], """
SELECT doc_id, exp(s1 - greatest(s0, s1)) / (exp(s0 - greatest(s0, s1)) + exp(s1 - greatest(s0, s1))) AS p1,
       CASE WHEN s1 > s0 THEN 1 ELSE 0 END AS pred FROM (
  SELECT l.doc_id, max(t.b0) + coalesce(sum(ln(c.t0) - ln(1 - c.t0)), 0) AS s0,
                   max(t.b1) + coalesce(sum(ln(c.t1) - ln(1 - c.t1)), 0) AS s1
  FROM lab l LEFT JOIN bow b USING (doc_id) LEFT JOIN th c ON c.term = b.term,
       (SELECT ln((SELECT n0 / (n0 + n1) FROM nn)) + sum(ln(1 - t0)) AS b0,
               ln((SELECT n1 / (n0 + n1) FROM nn)) + sum(ln(1 - t1)) AS b1 FROM th) t
  GROUP BY l.doc_id)""", _BOW_CTES, _BOW_F, _LAB_SQL, """nn AS (SELECT count_if(label = 0) AS n0, count_if(label = 1) AS n1 FROM lab)""",
    """th AS (SELECT term, (count_if(label = 0) + 1.0) / ((SELECT n0 FROM nn) + 2.0) AS t0,
                     (count_if(label = 1) + 1.0) / ((SELECT n1 FROM nn) + 2.0) AS t1
              FROM bow JOIN lab USING (doc_id) GROUP BY 1)"""), {"p1": 6})


@register("m3_m4_bernoulli_nb", _M3_SQL)
def m3_m4_bernoulli_nb(spark, sf_dir):
    """Bernoulli NB (alpha 1) on term presence: posterior and prediction per document."""
    feats, labels = _doc_features(spark, sf_dir)
    model = nb.fit_bernoulli(feats, labels, 1.0, True, "doc_id", "feature", "label", distinct=True)
    pr = model.predict_proba(feats, labels, "doc_id", "value")
    return rounded(pr.select("doc_id", F.col("probs")[1].alias("p1"), "pred"), {"p1": 6})


_M6_SQL = sql_rounded("""
WITH f AS (SELECT vec_id, label, embedding, (row_number() OVER (PARTITION BY label ORDER BY md5(vec_id::VARCHAR || '42')) - 1) % 5 AS fold FROM embeddings),
x AS (SELECT vec_id, label, fold, generate_subscripts(embedding, 1) AS pos, CAST(unnest(embedding) AS DOUBLE) AS x FROM f),
h AS (SELECT unnest(range(5)) AS held),
c AS (SELECT held, label, pos, count(*) AS n, avg(x) AS m, var_pop(x) AS v FROM x, h WHERE fold <> held GROUP BY 1, 2, 3),
e AS (SELECT held, max(v) AS spread FROM (SELECT held, pos, var_pop(x) AS v FROM x, h WHERE fold <> held GROUP BY 1, 2) GROUP BY 1),
s AS (SELECT unnest([1e-10, 1e-9, 1e-5]) AS var_smoothing),
p AS (SELECT held, label, max(n) AS n FROM c GROUP BY 1, 2),
t AS (SELECT held, sum(n) AS n FROM p GROUP BY 1),
l AS (SELECT var_smoothing, x.fold, x.vec_id, x.label, c.label AS guess,
        any_value(ln(p.n / t.n)) - 0.5 * sum(ln(2 * pi() * (v + var_smoothing * spread)) + (x - m) * (x - m) / (v + var_smoothing * spread)) AS ll
      FROM x JOIN c ON c.held = x.fold AND c.pos = x.pos JOIN e ON e.held = x.fold JOIN p ON p.held = x.fold AND p.label = c.label
        JOIN t ON t.held = x.fold, s GROUP BY 1, 2, 3, 4, 5),
g AS (SELECT var_smoothing, fold, vec_id, label, arg_max(guess, ll) AS guess FROM l GROUP BY 1, 2, 3, 4)
SELECT var_smoothing, avg(acc) AS accuracy FROM (SELECT var_smoothing, fold, avg(CAST(label = guess AS INTEGER)) AS acc FROM g GROUP BY 1, 2) GROUP BY 1""",
                      {"accuracy": 6})


@register("m6_gaussian_nb_accuracy", _M6_SQL)
def m6_gaussian_nb_accuracy(spark, sf_dir):
    """Gaussian NB on embeddings for each var_smoothing on a grid: mean accuracy on the held-out
    rows of five stratified folds, whose statistics all smoothings share."""
    e = sp.stratified_folds(table(spark, sf_dir, "embeddings"), "vec_id", "label", 5, 42).checkpoint()
    outs = []
    for fold in range(5):
        train, held = e.where(F.col("fold") != fold), e.where(F.col("fold") == fold)
        stats = nb.gaussian_stats(train, "embedding", "label")
        outs += [accuracy(nb.fit_gaussian(train, "embedding", "label", vs, stats)(held), "label", "pred").withColumn("var_smoothing", F.lit(vs))
                 for vs in (1e-10, 1e-9, 1e-5)]
    res = outs[0]
    for o in outs[1:]:
        res = res.unionByName(o)
    return rounded(res.groupBy("var_smoothing").agg(F.avg("accuracy").alias("accuracy")), {"accuracy": 6})


# A learned prior adds one number to all scores of a fold, which changes no AUC.
_R9_SQL = sql_rounded(fx.with_sql([], """
SELECT alpha, fit_prior, mean_auc FROM (SELECT alpha, avg(auc) AS mean_auc FROM auc GROUP BY 1), (SELECT unnest([true, false]) AS fit_prior)""",
    _BOW_CTES, _BOW_F, """fo AS (SELECT doc_id, quality AS label, (row_number() OVER (PARTITION BY quality ORDER BY md5(doc_id::VARCHAR || '42')) - 1) % 10 AS fold FROM labels)""",
    """pf AS (SELECT fold, term, sum(CASE WHEN label = 0 THEN tf ELSE 0 END) AS f0, sum(CASE WHEN label = 1 THEN tf ELSE 0 END) AS f1 FROM bow JOIN fo USING (doc_id) GROUP BY 1, 2)""",
    """al AS (SELECT term, sum(f0) AS a0, sum(f1) AS a1 FROM pf GROUP BY 1)""",
    """tt AS (SELECT fold, sum(f0) AS t0, sum(f1) AS t1 FROM pf GROUP BY 1)""",
    """ta AS (SELECT sum(t0) AS t0, sum(t1) AS t1 FROM tt)""",
    """ga AS (SELECT CAST(unnest([1, 2, 3, 4, 5, 6]) AS DOUBLE) AS alpha)""",
    """sc AS (SELECT alpha, fold, label, doc_id, coalesce(sum(tf * (ln(a1 - f1 + alpha) - ln(a0 - f0 + alpha))), 0)
         - coalesce(sum(tf), 0) * (ln(any_value(ta.t1 - tt.t1) + alpha * any_value(nv)) - ln(any_value(ta.t0 - tt.t0) + alpha * any_value(nv))) AS s
       FROM fo LEFT JOIN bow USING (doc_id) LEFT JOIN al USING (term) LEFT JOIN pf USING (fold, term) JOIN tt USING (fold), ta, ga, (SELECT count(*) AS nv FROM al) GROUP BY 1, 2, 3, 4)""",
    """rk AS (SELECT alpha, fold, label, round(s, 9) AS s FROM sc)""",
    """auc AS (SELECT alpha, fold, sum(CASE WHEN label = 1 THEN r ELSE 0 END) / (count_if(label = 1) * count_if(label = 0)) - (count_if(label = 1) + 1.0) / (2 * count_if(label = 0)) AS auc
       FROM (SELECT alpha, fold, label, rank() OVER (PARTITION BY alpha, fold ORDER BY s) + (count(*) OVER (PARTITION BY alpha, fold, s) - 1) / 2.0 AS r FROM rk) GROUP BY 1, 2)"""),
    {"mean_auc": 6})


@register("r9_nb_cv_grid", _R9_SQL)
def r9_nb_cv_grid(spark, sf_dir):
    """10-fold stratified CV AUC of multinomial NB over alpha x fit_prior, all settings and
    folds scored from one set of per-fold count aggregates."""
    feats, labels = _doc_features(spark, sf_dir)
    folds = sp.stratified_folds(labels, "doc_id", "label", 10, 42)
    res = nb.cv_grid_auc(feats, labels, folds, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0], (True, False),
                         "doc_id", "feature", "value", "label", "fold")
    return rounded(res, {"mean_auc": 6})
