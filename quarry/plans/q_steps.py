"""Registered queries: single steps of iterative learners, and helpers around them, each
with a DuckDB twin (S6, S8, X2, M27, M28, M37, M39)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import cluster, encode, linear
from quarry.plans.catalog import register, rounded, sql_rounded
from quarry.plans.q_models import CAT
from quarry.sources import files
from quarry.sources import fixtures as fx
from quarry.sources.tables import table

# The urgency of the order priorities.
URGENCY = [("1-URGENT", 5), ("2-HIGH", 4), ("3-MEDIUM", 3), ("4-NOT SPECIFIED", 2), ("5-LOW", 1)]


@register("s6_inline_rows", f"""
SELECT o_orderpriority, urgency, count(*) AS n, sum(urgency) AS weight
FROM orders JOIN (VALUES {", ".join(map(str, URGENCY))}) AS u(priority, urgency) ON o_orderpriority = priority GROUP BY 1, 2""")
def s6_inline_rows(spark, sf_dir):
    """Literal rows with a schema, joined to the orders."""
    inline = files.inline_rows(spark, URGENCY, "priority string, urgency long")
    o = table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return (o.join(inline, F.col("o_orderpriority") == F.col("priority"))
            .select("o_orderpriority", "urgency", "n", (F.col("n") * F.col("urgency")).alias("weight")))


@register("s8_best_saved_trial", sql_rounded("""
SELECT 'mean_of_' || m.p_brand AS trial_id, var_pop(p.p_retailprice) + (avg(p.p_retailprice) - any_value(m.c)) * (avg(p.p_retailprice) - any_value(m.c)) AS score
FROM (SELECT p_brand, avg(p_retailprice) AS c FROM part GROUP BY 1) m, part p GROUP BY m.p_brand ORDER BY round(score, 6), trial_id LIMIT 1""", {"score": 4}))
def s8_best_saved_trial(spark, sf_dir):
    """Trials (each brand's mean price as a guess at all prices) saved, reloaded, and the one
    with the least squared error taken."""
    p = table(spark, sf_dir, "part")
    spread, mean = (p.select(f("p_retailprice")).scalar() for f in (F.var_pop, F.avg))
    guess = p.groupBy("p_brand").agg(F.avg("p_retailprice").alias("c"))
    trials = guess.select(F.concat(F.lit("mean_of_"), "p_brand").alias("trial_id"), F.create_map(F.lit("guess"), F.col("c")).alias("params"),
                          (spread + (mean - F.col("c")) * (mean - F.col("c"))).alias("score"), F.lit(0).alias("best_step"), F.lit("COMPLETED").alias("status"))
    path = files.save_trials(trials, files.new_scratch(spark, "trials"))
    return rounded(files.best_trial(spark, path).select("trial_id", "score"), {"score": 4})


@register("x2_one_hot_positions", fx.with_sql(["clicks"], """
SELECT row_id, coalesce(array_to_string(list_transform(list_sort(list(index) FILTER (WHERE index IS NOT NULL)), lambda i: i::VARCHAR), ','), '') AS hot
FROM (SELECT row_id, v.index FROM st LEFT JOIN vo v USING (name, value)) GROUP BY row_id""",
    "st AS (" + " UNION ALL ".join(f"SELECT row_id, l_shipdate, '{i}' AS name, {c} AS value FROM clicks" for i, c in enumerate(CAT)) + ")",
    """vo AS (SELECT name, value, row_number() OVER (ORDER BY name, n DESC, value) - 1 AS index
  FROM (SELECT name, value, count(*) AS n FROM st WHERE l_shipdate < TIMESTAMP '1999-01-01' GROUP BY 1, 2))"""))
def x2_one_hot_positions(spark, sf_dir):
    """The hot positions of every row, most frequent category first within each column;
    fitted on the rows shipped before 1999."""
    c = fx.clicks(spark, sf_dir)
    _, positions = encode.fit_hot_positions(c.where(F.col("l_shipdate") < F.lit("1999-01-01").cast("timestamp_ntz")), CAT)
    return positions(c).select("row_id", F.array_join(F.transform(F.array_sort("hot"), lambda i: i.cast("string")), ",").alias("hot"))


def _steps_sql(link: str, cost: str, y: str, rate: float) -> str:
    """Three steps of batch gradient descent on (1, x) from zero, as one CTE each."""
    steps = [f"l AS (SELECT (l_quantity - 25) / 14.7 AS x, {y} AS y FROM lineitem)", "w0 AS (SELECT 0.0::DOUBLE AS a, 0.0::DOUBLE AS b)"]
    for i in range(3):
        p = link.format(z="(a + b * x)")
        steps.append(f"w{i + 1} AS (SELECT any_value(a) + {rate} * avg(y - {p}) AS a, any_value(b) + {rate} * avg((y - {p}) * x) AS b, avg({cost.format(p=p)}) AS cost FROM l, w{i})")
    rows = " UNION ALL ".join(f"SELECT {i} AS step, a AS w0, b AS w1, cost FROM w{i}" for i in (1, 2, 3))
    return "WITH " + ", ".join(steps) + " " + rows


def _descent(spark, sf_dir, y, train, rate):
    """Weights after one, two and three steps, and the cost before the last of them."""
    li = table(spark, sf_dir, "lineitem").select(F.array((F.col("l_quantity") - 25) / 14.7).alias("features"), y.cast("double").alias("label"))
    with files.cached(li) as data:
        found = [train(data, 1, max_iter=n, learning_rate=rate, fit_intercept=True, log_every=1) for n in (1, 2, 3)]
    rows = [(i + 1, float(w[0]), float(w[1]), float(c[-1][1])) for i, (w, c) in enumerate(found)]
    return rounded(spark.createDataFrame(rows, "step int, w0 double, w1 double, cost double"), _DESCENT)


_DESCENT = {"w0": 6, "w1": 6, "cost": 6}


@register("m27_logistic_steps", sql_rounded(_steps_sql("(1 / (1 + exp(-{z})))", "-(y * ln({p}) + (1 - y) * ln(1 - {p}))", "CAST(l_returnflag = 'R' AS DOUBLE)", 0.5), _DESCENT))
def m27_logistic_steps(spark, sf_dir):
    """Three steps of logistic gradient descent over all line items, from cached rows."""
    return _descent(spark, sf_dir, F.col("l_returnflag") == "R", linear.train_logistic_gd, 0.5)


@register("m28_linear_steps", sql_rounded(_steps_sql("{z}", "(y - {p}) * (y - {p}) / 2", "l_extendedprice / 10000", 0.1), _DESCENT))
def m28_linear_steps(spark, sf_dir):
    """Three steps of linear gradient descent over all line items, from their moments."""
    return _descent(spark, sf_dir, F.col("l_extendedprice") / 10000, linear.train_linear_gd, 0.1)


_MEANS_SQL = """x AS (SELECT vec_id, label, generate_subscripts(embedding, 1) AS pos, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings WHERE label IS NOT NULL),
c AS (SELECT label, pos, avg(x) AS m FROM x GROUP BY 1, 2)"""


def _label_means(e):
    """Mean vector of each label, in label order (as many as there are labels)."""
    rows = e.groupBy("label").agg(F.array(*[F.avg(F.get("v", F.lit(i))) for i in range(64)]).alias("m")).orderBy("label").collect()
    return [list(r.m) for r in rows], [r.label for r in rows]


def _labelled(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").where("label IS NOT NULL").select("vec_id", "label", F.transform("embedding", lambda x: x.cast("double")).alias("v"))


@register("m37_kmeans_step", sql_rounded(f"""WITH {_MEANS_SQL},
d AS (SELECT vec_id, c.label, sum((x - m) * (x - m)) AS d FROM x JOIN c USING (pos) GROUP BY 1, 2),
k AS (SELECT label AS label, row_number() OVER (ORDER BY label) - 1 AS cluster FROM (SELECT DISTINCT label FROM c)),
a AS (SELECT vec_id, arg_min(cluster, (round(d, 9), cluster)) AS cluster FROM d JOIN k USING (label) GROUP BY 1),
u AS (SELECT cluster, pos, avg(x) AS m FROM a JOIN x USING (vec_id) GROUP BY 1, 2)
SELECT CAST(k.cluster AS INTEGER) AS cluster, CAST(c.pos - 1 AS INTEGER) AS pos, coalesce(u.m, c.m) AS centre FROM k JOIN c USING (label) LEFT JOIN u USING (cluster, pos)""", {"centre": 6}))
def m37_kmeans_step(spark, sf_dir):
    """One assignment and update of k-means from the labels' means; the new centres."""
    e = _labelled(spark, sf_dir)
    centres, _ = _label_means(e)
    _, new = cluster.kmeans_step(e, "v", centres)
    rows = [(k, i, float(x)) for k, c in enumerate(new) for i, x in enumerate(c)]  # centres x dimensions
    return rounded(spark.createDataFrame(rows, "cluster int, pos int, centre double"), {"centre": 6})


@register("m39_elbow_scores", sql_rounded(f"""WITH {_MEANS_SQL}, s AS (SELECT label, sum((x - m) * (x - m)) AS ss FROM x JOIN c USING (label, pos) GROUP BY 1)
SELECT sum(ss) AS inertia, sum(sqrt(ss)) AS sum_norm FROM s""", {"inertia": 4, "sum_norm": 4}))
def m39_elbow_scores(spark, sf_dir):
    """Both elbow scores of the clusters that the labels are."""
    e = _labelled(spark, sf_dir)
    centres, labels = _label_means(e)
    at = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col("label")).cast("int") - 1
    return rounded(cluster.cluster_scores(e.withColumn("cluster", at), "v", centres), {"inertia": 4, "sum_norm": 4})
