"""Evaluation (E1-E9): every metric is a grouped aggregate over (label, prediction /
score) columns; curves and AUC use per-distinct-score counts and distributed running
sums, so ties are averaged exactly and no step pulls rows to the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.relate import running_sums
from quarry.session import ensure_checkpoint_dir


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def accuracy(df: DataFrame, y: str, p: str, group: Sequence[str] = ()) -> DataFrame:
    """E1."""
    return df.groupBy(*group).agg(F.avg((F.col(y) == F.col(p)).cast("double")).alias("accuracy"))


def confusion(df: DataFrame, y: str, p: str, labels: Sequence) -> DataFrame:
    """E2 long form (y, p, n) over the given label order, zero-filled.

    The label grid is a literal (len(labels)^2 rows); counts are one grouped aggregate.
    """
    grid = df.sparkSession.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(a).alias(y), F.lit(b).alias(p)) for a in labels for b in labels])).alias("g")
    ).select("g.*")
    counts = df.groupBy(y, p).agg(F.count(F.lit(1)).alias("n"))
    return grid.join(counts, [y, p], "left").select(y, p, F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def precision_recall_f1(df: DataFrame, y: str, p: str, pos=1) -> DataFrame:
    """E3 for the positive label; 0/0 -> 0."""
    tp = F.count_if((F.col(y) == pos) & (F.col(p) == pos))
    fp = F.count_if((F.col(y) != pos) & (F.col(p) == pos))
    fn = F.count_if((F.col(y) == pos) & (F.col(p) != pos))
    agg = df.agg(tp.alias("tp"), fp.alias("fp"), fn.alias("fn"))
    prec = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")), F.lit(0.0))
    return (agg.select(prec.alias("precision"), rec.alias("recall"))
            .withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"),
                                                      F.col("precision") + F.col("recall")), F.lit(0.0))))


def classification_report(df: DataFrame, y: str, p: str) -> DataFrame:
    """Per class (precision, recall, f1, support) plus accuracy, macro avg and
    weighted avg rows; class names are strings in column ``class``."""
    ensure_checkpoint_dir(df.sparkSession)
    # one pass over the rows: counts of (label, prediction), then everything from these
    pairs = df.groupBy(F.col(y).alias("y"), F.col(p).alias("p")).agg(F.count(F.lit(1)).alias("n")).checkpoint()
    sides = F.explode(F.array(F.struct(F.col("y").alias("k"), F.col("n").alias("support"), F.lit(0).cast("long").alias("npred")),
                              F.struct(F.col("p").alias("k"), F.lit(0).cast("long").alias("support"), F.col("n").alias("npred"))))
    hit = F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0)
    k = (pairs.select(sides.alias("s"), hit.alias("hit")).select("s.*", F.when(F.col("s.support") > 0, F.col("hit")).otherwise(0).alias("hit"))
         .groupBy("k").agg(F.sum("support").alias("support"), F.sum("npred").alias("npred"), F.sum("hit").alias("tp")))
    prec = F.coalesce(F.try_divide(F.col("tp"), F.col("npred")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp"), F.col("support")), F.lit(0.0))
    per = k.select(F.col("k").cast("string").alias("class"), prec.alias("precision"), rec.alias("recall"),
                   F.col("support").cast("long").alias("support"))
    per = per.withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"),
                                                       F.col("precision") + F.col("recall")), F.lit(0.0)))
    tot = per.agg(F.sum("support").alias("n"))
    right = F.sum(F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0))
    acc = pairs.agg((right / F.sum(F.when(F.col("y").isNotNull() & F.col("p").isNotNull(), F.col("n")))).alias("a"), F.sum("n").alias("n"))
    macro = per.agg(F.lit("macro avg").alias("class"), F.avg("precision").alias("precision"),
                    F.avg("recall").alias("recall"), F.sum("support").alias("support"), F.avg("f1").alias("f1"))
    n = tot.select("n").scalar()
    weighted = per.agg(F.lit("weighted avg").alias("class"),
                       (F.sum(F.col("precision") * F.col("support")) / n).alias("precision"),
                       (F.sum(F.col("recall") * F.col("support")) / n).alias("recall"),
                       F.sum("support").alias("support"),
                       (F.sum(F.col("f1") * F.col("support")) / n).alias("f1"))
    accuracy_row = acc.select(F.lit("accuracy").alias("class"), F.col("a").alias("precision"),
                              F.col("a").alias("recall"), F.col("n").alias("support"), F.col("a").alias("f1"))
    cols = ["class", "precision", "recall", "f1", "support"]
    return (per.select(*cols).unionByName(accuracy_row.select(*cols))
            .unionByName(macro.select(*cols)).unionByName(weighted.select(*cols)))


def score_counts(df: DataFrame, y: str | Column, score: str | Column, pos=1,
                 group: Sequence[str] = (), times: str | None = None) -> DataFrame:
    """(group..., score, pos, neg): one row per distinct score; a row counts ``times``."""
    yy = _c(y)
    if times:
        return df.groupBy(*group, _c(score).alias("score")).agg(
            *[F.coalesce(F.sum(F.when(hit, F.col(times))), F.lit(0)).cast("long").alias(name) for hit, name in ((yy == pos, "pos"), (yy != pos, "neg"))])
    return df.groupBy(*group, _c(score).alias("score")).agg(
        F.count_if(yy == pos).alias("pos"), F.count_if(yy != pos).alias("neg"))


def roc_points(df: DataFrame, y: str, score: str, pos=1, group: Sequence[str] = ()) -> DataFrame:
    """E5: (threshold, fpr, tpr) for every distinct score, from the highest down."""
    sc = score_counts(df, y, score, pos, group)
    cum = running_sums(sc, [F.desc("score")], {"cpos": F.col("pos"), "cneg": F.col("neg")}, group)
    # the totals are the largest running counts, which are at hand
    if group:
        tot = cum.groupBy(*[F.col(c).alias(f"__t_{c}") for c in group]).agg(F.max("cpos").alias("P"), F.max("cneg").alias("N"))
        same = F.lit(True)
        for c in group:
            same = same & F.col(c).eqNullSafe(F.col(f"__t_{c}"))
        j = cum.join(tot, same)
    else:
        j = cum.withColumns({"P": cum.select(F.max("cpos")).scalar(), "N": cum.select(F.max("cneg")).scalar()})
    return j.select(*group, F.col("score").alias("threshold"),
                    F.try_divide(F.col("cneg"), F.col("N")).alias("fpr"),
                    F.try_divide(F.col("cpos"), F.col("P")).alias("tpr"))


def roc_fixed(df: DataFrame, y: str, score: str, step: float = 0.05, n: int = 22, pos=1) -> DataFrame:
    """E5 on fixed thresholds 0, step, ..., (n-1)*step: one pass, 2n conditional counts."""
    ts = [round(i * step, 10) for i in range(n)]
    yy, s = F.col(y) == pos, F.col(score)
    aggs = [F.count_if(yy).alias("P"), F.count_if(~yy).alias("N")]
    for i, t in enumerate(ts):
        aggs += [F.count_if(yy & (s >= t)).alias(f"tp{i}"), F.count_if(~yy & (s >= t)).alias(f"fp{i}")]
    row = df.agg(*aggs)
    pts = F.explode(F.array(*[F.struct(F.lit(t).alias("threshold"),
                                       F.try_divide(F.col(f"fp{i}"), F.col("N")).alias("fpr"),
                                       F.try_divide(F.col(f"tp{i}"), F.col("P")).alias("tpr"))
                              for i, t in enumerate(ts)]))
    return row.select(pts.alias("p")).select("p.*")


def auc(df: DataFrame, y: str | Column, score: str | Column, pos=1, group: Sequence[str] = (), times: str | None = None) -> DataFrame:
    """ROC AUC with tied scores counted one half (Mann-Whitney); a row counts ``times``."""
    sc = score_counts(df, y, score, pos, group, times)
    cum = running_sums(sc, [F.asc("score")], {"cneg": F.col("neg")}, group)
    below = F.col("cneg") - F.col("neg")
    return cum.groupBy(*group).agg(
        F.try_divide(F.sum(F.col("pos").cast("double") * (below.cast("double") + 0.5 * F.col("neg"))),
                     F.sum("pos").cast("double") * F.sum("neg").cast("double")).alias("auc"))


def auc_ovo(df: DataFrame, y: str, probs: str, classes: Sequence[int]) -> DataFrame:
    """Macro one-vs-one AUC.  ``probs`` is an array column of class scores in
    ``classes`` order.  Each row joins the (k-1) class pairs containing its label."""
    idx = {c: i for i, c in enumerate(classes)}
    # label -> the ordered pairs (a, b) it takes part in; each unordered pair is scored
    # both ways (positive class a, score of a).  A literal map, exploded per row.
    member = {c: [(a, b) for a in classes for b in classes if a != b and c in (a, b)] for c in classes}
    lit_map = F.create_map(*[x for c, prs in member.items() for x in (
        F.lit(c), F.array(*[F.struct(F.lit(a).alias("pa"), F.lit(b).alias("pb"), F.lit(idx[a]).alias("si"))
                            for a, b in prs]))])
    lab = df.select(F.col(y).cast("int").alias("__y"), F.col(probs).alias("__p"))
    j = lab.select("__y", "__p", F.explode(F.try_element_at(lit_map, F.col("__y"))).alias("q"))
    j = j.select(F.col("q.pa").alias("pa"), F.col("q.pb").alias("pb"),
                 (F.col("__y") == F.col("q.pa")).cast("int").alias("__pos"),
                 F.element_at("__p", F.col("q.si") + 1).alias("__s"))
    per = auc(j, "__pos", "__s", 1, ["pa", "pb"])
    return per.agg(F.avg("auc").alias("auc_ovo"))


def regression_metrics(df: DataFrame, y: str, p: str) -> DataFrame:
    """Mse, rmse, mae, r2 in one aggregate."""
    e = F.col(y) - F.col(p)
    agg = df.agg(F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"),
                 F.var_pop(F.col(y)).alias("__v"))
    return agg.select("mse", F.sqrt("mse").alias("rmse"), "mae",
                      (1 - F.try_divide(F.col("mse"), F.col("__v"))).alias("r2"))


def spark_auc(predictions: DataFrame, label: str = "label", raw: str = "rawPrediction") -> float:
    """Spark's evaluator (cross-check of E6)."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    ev = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=raw, metricName="areaUnderROC")
    return ev.evaluate(predictions)
