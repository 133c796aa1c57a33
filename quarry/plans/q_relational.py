"""Registered queries: aggregates, joins, ranking, sets (A*, J*, T*, U*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import text as tx
from quarry.functions.stopwords import ENGLISH
from quarry.operators import aggregate as ag
from quarry.operators import relate as rl
from quarry.plans.catalog import register, rounded, sql_rounded
from quarry.sources import fixtures as fx
from quarry.sources.tables import table

ROW_KEY_SQL = "(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity)"


@register("a1_distinct_ids", fx.with_sql(["ratings"], """
SELECT count(DISTINCT user_id) AS n_user_id, count(DISTINCT movie_id) AS n_movie_id FROM ratings"""))
def a1_distinct_ids(spark, sf_dir):
    return ag.distinct_counts(fx.ratings(spark, sf_dir), ["user_id", "movie_id"])


@register("a2_non_null_counts", fx.with_sql(["prices", "raw_prices", "parsed_prices"], """
SELECT count(*) AS n_rows, count(date) AS nn_date, count(close) AS nn_close, count(open) AS nn_open,
       count(high) AS nn_high, count(low) AS nn_low, count(volume) AS nn_volume FROM parsed_prices"""))
def a2_non_null_counts(spark, sf_dir):
    return ag.non_null_counts(fx.parsed_prices(spark, sf_dir))


@register("a3_value_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def a3_value_counts(spark, sf_dir):
    return ag.value_counts(table(spark, sf_dir, "events"), "event_type")


@register("a4_value_share", sql_rounded("""
SELECT o_orderpriority, count(*) AS n, count(*) * 100.0 / (SELECT count(*) FROM orders) AS pct
FROM orders GROUP BY 1""", {"pct": 6}))
def a4_value_share(spark, sf_dir):
    return rounded(ag.value_share(table(spark, sf_dir, "orders"), "o_orderpriority"), {"pct": 6})


@register("a5_conditional_counts", fx.with_sql(["clicks"], """
SELECT count_if(label = 1) AS n_pos, count_if(NOT (label = 1)) AS n_neg FROM clicks"""))
def a5_conditional_counts(spark, sf_dir):
    return ag.conditional_counts(fx.clicks(spark, sf_dir), F.col("label") == 1)


@register("a6_j2_class_distribution_named", """
SELECT n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def a6_j2_class_distribution_named(spark, sf_dir):
    counts = ag.value_counts(table(spark, sf_dir, "customer"), "c_nationkey")
    nation = table(spark, sf_dir, "nation")  # 25 rows by definition of the schema
    return (rl.lookup(counts, F.broadcast(nation), counts.c_nationkey == nation.n_nationkey)
            .select("n_name", "n"))


_DESCRIBE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_DESCRIBE_SPEC = {"mean": 4, "std": 4, "min": 4, "p25": 4, "p50": 4, "p75": 4, "max": 4}


@register("a7_describe", sql_rounded(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std,
       min({c}) AS min, quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50,
       quantile_cont({c}, 0.75) AS p75, max({c}) AS max FROM lineitem""" for c in _DESCRIBE_COLS),
    _DESCRIBE_SPEC))
def a7_describe(spark, sf_dir):
    return rounded(ag.describe(table(spark, sf_dir, "lineitem"), _DESCRIBE_COLS), _DESCRIBE_SPEC)


@register("a8_p7_ratings_per_item", fx.with_sql(["ratings"], """
SELECT movie_id, count(*) AS n_ratings FROM ratings WHERE rating > 0 GROUP BY 1"""))
def a8_p7_ratings_per_item(spark, sf_dir):
    return ag.positive_counts(fx.ratings(spark, sf_dir), "movie_id", "rating")


@register("a9_rating_cells", fx.with_sql(["ratings"], "SELECT user_id, movie_id, rating FROM ratings"))
def a9_rating_cells(spark, sf_dir):
    return fx.ratings(spark, sf_dir)


@register("a10_rating_distribution", fx.with_sql(["ratings"], """
SELECT rating, count(*) AS n FROM ratings GROUP BY 1
UNION ALL
SELECT 0 AS rating, count(DISTINCT user_id) * count(DISTINCT movie_id) - count(*) AS n FROM ratings"""))
def a10_rating_distribution(spark, sf_dir):
    return ag.rating_distribution(fx.ratings(spark, sf_dir))


@register("a11_histogram", """
WITH mm AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem)
SELECT CAST(coalesce(least(floor(((l_extendedprice - lo) / NULLIF(hi - lo, 0)) * 20), 19), 0) AS INTEGER) AS bin,
       count(*) AS n, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi
FROM lineitem, mm GROUP BY 1""")
def a11_histogram(spark, sf_dir):
    return ag.histogram(table(spark, sf_dir, "lineitem"), "l_extendedprice", 20)


# ---- nearest centre (J6) and the per-cluster aggregates built on it

N_CENTRES = 10


def _centres(spark, sf_dir):
    """The first N_CENTRES embeddings by id: a bounded (k-row) driver fetch."""
    e = table(spark, sf_dir, "embeddings")
    rows = e.orderBy("vec_id").select("embedding").limit(N_CENTRES).collect()
    return [[float(v) for v in r.embedding] for r in rows]


def _assigned(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.withColumn("cluster", rl.nearest_centre(F.col("embedding"), _centres(spark, sf_dir)))


_SQDIST = ("list_reduce(list_transform(range(1, len(e.embedding) + 1), "
           "lambda i: (CAST(e.embedding[i] AS DOUBLE) - CAST(c.embedding[i] AS DOUBLE)) * "
           "(CAST(e.embedding[i] AS DOUBLE) - CAST(c.embedding[i] AS DOUBLE))), lambda a, b: a + b)")
_ASSIGN_SQL = f"""centres AS (
  SELECT CAST(row_number() OVER (ORDER BY vec_id) - 1 AS INTEGER) AS cluster, embedding
  FROM embeddings ORDER BY vec_id LIMIT {N_CENTRES}),
assigned AS (
  SELECT e.vec_id, e.label, e.embedding, arg_min(c.cluster, ({_SQDIST}, c.cluster)) AS cluster
  FROM embeddings e, centres c GROUP BY e.vec_id, e.label, e.embedding)"""


@register("j6_nearest_centre", f"WITH {_ASSIGN_SQL} SELECT vec_id, cluster FROM assigned")
def j6_nearest_centre(spark, sf_dir):
    return _assigned(spark, sf_dir).select("vec_id", "cluster")


@register("a12_cluster_composition", f"""WITH {_ASSIGN_SQL},
pair AS (SELECT cluster, label, count(*) AS n FROM assigned GROUP BY 1, 2)
SELECT cluster, label, n, sum(n) OVER (PARTITION BY cluster) AS group_size,
       row_number() OVER (PARTITION BY cluster ORDER BY n DESC, label) AS rank FROM pair""")
def a12_cluster_composition(spark, sf_dir):
    return ag.group_composition(_assigned(spark, sf_dir), "cluster", "label")


@register("a13_centroid_update", sql_rounded(f"""WITH {_ASSIGN_SQL}
SELECT cluster, CAST(pos - 1 AS INTEGER) AS pos, avg(CAST(x AS DOUBLE)) AS mean
FROM (SELECT cluster, generate_subscripts(embedding, 1) AS pos, unnest(embedding) AS x FROM assigned)
GROUP BY 1, 2""", {"mean": 6}))
def a13_centroid_update(spark, sf_dir):
    return rounded(ag.vector_mean_by(_assigned(spark, sf_dir), "cluster", "embedding"), {"mean": 6})


# ---- joins and lookups

@register("j1_first_seen_index", f"""
SELECT l_partkey, CAST(row_number() OVER (ORDER BY first_key, l_partkey) - 1 AS BIGINT) AS index
FROM (SELECT l_partkey, min({ROW_KEY_SQL}) AS first_key FROM lineitem GROUP BY 1)""")
def j1_first_seen_index(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return rl.encode_first_seen(li, "l_partkey", list(fx.ROW_KEY)).select("l_partkey", "index")


@register("j2_supplier_nation", """
SELECT s_suppkey, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def j2_supplier_nation(spark, sf_dir):
    s, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    return rl.lookup(s, F.broadcast(n), s.s_nationkey == n.n_nationkey).select("s_suppkey", "n_name")


@register("j3_u2_remove_names", fx.with_sql(["tokens", "part_words"], """
SELECT doc_id, pos, token FROM tokens WHERE token NOT IN (SELECT word FROM part_words)"""))
def j3_u2_remove_names(spark, sf_dir):
    return tx.remove_listed(fx.tokens(spark, sf_dir), fx.part_words(spark, sf_dir))


_STOP_VALUES = ", ".join(f"('{w}')" for w in ENGLISH)


@register("j4_remove_stop_words", fx.with_sql(["tokens"], f"""
SELECT doc_id, pos, token FROM tokens
WHERE token NOT IN (SELECT w FROM (VALUES {_STOP_VALUES}) AS s(w))"""))
def j4_remove_stop_words(spark, sf_dir):
    stop = spark.createDataFrame([(w,) for w in ENGLISH], "word string")
    return tx.remove_listed(fx.tokens(spark, sf_dir), stop)


@register("j5_align_mean", sql_rounded(fx.with_sql(["clicks"], """
SELECT row_id, (l_extendedprice * 0.9 + l_extendedprice * 1.1) / 2 AS mean FROM clicks"""), {"mean": 4}))
def j5_align_mean(spark, sf_dir):
    c = fx.clicks(spark, sf_dir)
    a = c.select("row_id", (F.col("l_extendedprice") * 0.9).alias("pred"))
    b = c.select("row_id", (F.col("l_extendedprice") * 1.1).alias("pred"))
    return rounded(rl.align_mean(a, b, "row_id", "pred"), {"mean": 4})


@register("j7_mesh_grid_scores", sql_rounded(f"""
WITH pts AS (SELECT CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y, label FROM embeddings),
b AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM pts),
cen AS (SELECT label, avg(x) AS cx, avg(y) AS cy FROM pts GROUP BY 1),
grid AS (SELECT id AS point_id, x0 + floor(id / 200) * ((x1 - x0) / 199) AS x,
                y0 + (id % 200) * ((y1 - y0) / 199) AS y FROM range(40000) t(id), b)
SELECT point_id, x, y, arg_min(label, ((x - cx) * (x - cx) + (y - cy) * (y - cy), label)) AS label
FROM grid, cen GROUP BY 1, 2, 3""", {"x": 6, "y": 6}))
def j7_mesh_grid_scores(spark, sf_dir):
    """Decision map of a 2-D nearest-class-mean model on a 200 x 200 grid."""
    e = table(spark, sf_dir, "embeddings")
    pts = e.select(F.col("embedding")[0].cast("double").alias("x"),
                   F.col("embedding")[1].cast("double").alias("y"), "label")
    b = pts.agg(F.min("x"), F.max("x"), F.min("y"), F.max("y")).first()
    cen = pts.groupBy("label").agg(F.avg("x").alias("cx"), F.avg("y").alias("cy")).orderBy("label").collect()
    grid = rl.mesh_grid(spark, b[0], b[1], b[2], b[3], 200)
    labels = F.array(*[F.lit(r.label) for r in cen])
    d = F.array(*[(F.col("x") - r.cx) * (F.col("x") - r.cx) + (F.col("y") - r.cy) * (F.col("y") - r.cy)
                  for r in cen])
    best = F.array_position(d, F.array_min(d)).cast("int")
    return rounded(grid.select("point_id", "x", "y", F.element_at(labels, best).alias("label")),
                   {"x": 6, "y": 6})


# ---- ranking, top-k and sets

@register("t1_top_item", f"""
SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1
ORDER BY n DESC, min({ROW_KEY_SQL}) LIMIT 1""")
def t1_top_item(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    g = li.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*fx.ROW_KEY)).alias("first"))
    return rl.top_k(g, [F.desc("n"), F.asc("first")], 1).select("l_partkey", "n")


@register("t2_prices_newest_first", fx.with_sql(["prices"], "SELECT * FROM prices ORDER BY date DESC"))
def t2_prices_newest_first(spark, sf_dir):
    return fx.prices(spark, sf_dir).orderBy(F.desc("date"))


@register("t5_top_terms_per_lang", fx.with_sql(["tokens"], """
SELECT * FROM (
  SELECT lang, token, n, row_number() OVER (PARTITION BY lang ORDER BY n DESC, token) AS rank
  FROM (SELECT lang, token, count(*) AS n FROM tokens JOIN documents USING (doc_id) GROUP BY 1, 2))
WHERE rank <= 10"""))
def t5_top_terms_per_lang(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "lang")
    counts = (fx.tokens(spark, sf_dir).join(d, "doc_id")
              .groupBy("lang", "token").agg(F.count(F.lit(1)).alias("n")))
    return rl.top_k_per_group(counts, "lang", [F.desc("n"), F.asc("token")], 10)


@register("t6_majority_lang_per_source", """
SELECT source, arg_min(lang, (-n, lang)) AS majority
FROM (SELECT source, lang, count(*) AS n FROM documents GROUP BY 1, 2) GROUP BY 1""")
def t6_majority_lang_per_source(spark, sf_dir):
    return rl.majority(table(spark, sf_dir, "documents"), "source", "lang")


@register("u1_stop_words_with_names", fx.with_sql(["part_words"], f"""
SELECT DISTINCT word FROM (SELECT w AS word FROM (VALUES {_STOP_VALUES}) AS s(w)
                           UNION ALL SELECT word FROM part_words)"""))
def u1_stop_words_with_names(spark, sf_dir):
    stop = spark.createDataFrame([(w,) for w in ENGLISH], "word string")
    return rl.union_distinct(stop, fx.part_words(spark, sf_dir))
