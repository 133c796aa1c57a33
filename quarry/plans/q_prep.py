"""Registered queries: scans, projections, predicates and cleaning (S*, P*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import clean
from quarry.functions import vector as vx
from quarry.plans.catalog import register, rounded, sql_rounded
from quarry.sources import files
from quarry.sources import fixtures as fx
from quarry.sources.tables import table


@register("s1_s3_csv_typed_scan", fx.with_sql(["prices"], "SELECT * FROM prices"))
def s1_s3_csv_typed_scan(spark, sf_dir):
    """Daily prices round-tripped through CSV, read back with a declared schema and a
    date parsed by explicit format."""
    path = files.write_csv(fx.prices(spark, sf_dir).withColumn("date", F.date_format("date", "yyyy-MM-dd")),
                           files.new_scratch(spark, "csv"))
    schema = "date string, open double, close double, high double, low double, volume double"
    return files.dated_csv_scan(spark, path, schema, "date")


@register("s4_double_colon_scan", fx.with_sql(["ratings"], "SELECT user_id, movie_id, rating FROM ratings"))
def s4_double_colon_scan(spark, sf_dir):
    """Ratings written as ``user::item::rating`` without a header and read back by name."""
    path = files.write_csv(fx.ratings(spark, sf_dir), files.new_scratch(spark, "dat"), header=False, sep="::")
    return files.csv_scan(spark, path, "user_id long, movie_id long, rating int", header=False, sep="::")


@register("s5_first_rows", """
SELECT * FROM lineitem
ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity LIMIT 1000""")
def s5_first_rows(spark, sf_dir):
    return files.first_rows(table(spark, sf_dir, "lineitem"), list(fx.ROW_KEY), 1000)


@register("p1_p2_p3_p5_click_columns", fx.with_sql(["clicks"], """
SELECT label AS click, l_linestatus AS linestatus, o_orderpriority, p_brand, p_type, c_mktsegment
FROM clicks"""))
def p1_p2_p3_p5_click_columns(spark, sf_dir):
    c = fx.clicks(spark, sf_dir)
    c = clean.drop_columns(c, "row_id", "l_shipdate", *fx.ROW_KEY)
    c = clean.rename(c, {"label": "click", "l_linestatus": "linestatus"})
    feats, label = clean.features_label(c, "click")
    return c.select(*label.columns, *feats.columns)


@register("p4_positional_slice", fx.with_sql(["clicks"], """
SELECT l_linestatus, o_orderpriority, p_brand, p_type FROM clicks"""))
def p4_positional_slice(spark, sf_dir):
    return clean.select_range(fx.clicks(spark, sf_dir), 9, -1)


@register("p6_any_contains", fx.with_sql(["prices", "raw_prices"], """
SELECT * FROM raw_prices WHERE contains(price, '-') OR contains(open, '-') OR contains(high, '-')
   OR contains(low, '-') OR contains(vol, '-')"""))
def p6_any_contains(spark, sf_dir):
    return clean.any_contains(fx.raw_prices(spark, sf_dir), "-")


@register("p8_membership", "SELECT doc_id, lang FROM documents WHERE lang IN ('en', 'de')")
def p8_membership(spark, sf_dir):
    return table(spark, sf_dir, "documents").where(F.col("lang").isin("en", "de")).select("doc_id", "lang")


@register("p9_frequent_classes", """
SELECT doc_id, lang FROM documents WHERE lang IN (SELECT lang FROM documents GROUP BY 1 HAVING count(*) >= 130)""")
def p9_frequent_classes(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return clean.keep_frequent_classes(d, "lang", 130)


@register("p10_r4_date_range", fx.with_sql(["prices"], """
SELECT * FROM prices WHERE date BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'"""))
def p10_r4_date_range(spark, sf_dir):
    import datetime as dt
    return clean.date_range(fx.prices(spark, sf_dir), "date", dt.date(1996, 1, 1), dt.date(1997, 12, 31))


_PARSED = ["prices", "raw_prices", "parsed_prices"]
_VOL_SPEC = {"volume": 3}


@register("p11_drop_null_rows", sql_rounded(fx.with_sql(_PARSED, """
SELECT * FROM parsed_prices WHERE date IS NOT NULL AND close IS NOT NULL AND open IS NOT NULL
  AND high IS NOT NULL AND low IS NOT NULL AND volume IS NOT NULL"""), _VOL_SPEC))
def p11_drop_null_rows(spark, sf_dir):
    return rounded(clean.drop_null_rows(fx.parsed_prices(spark, sf_dir)), _VOL_SPEC)


@register("p12_binarise_ratings", fx.with_sql(["ratings"], """
SELECT user_id, movie_id, CAST(rating > 3 AS INTEGER) AS liked FROM ratings"""))
def p12_binarise_ratings(spark, sf_dir):
    r = fx.ratings(spark, sf_dir)
    return r.select("user_id", "movie_id", clean.binarize(F.col("rating"), 3).alias("liked"))


# Order priorities to ordinal ranks (the ordinal-encoding example).
PRIORITY_RANK = {"5-LOW": 1, "4-NOT SPECIFIED": 2, "3-MEDIUM": 3, "2-HIGH": 4, "1-URGENT": 5}


@register("p13_ordinal_map", """
SELECT o_orderkey, CASE o_orderpriority WHEN '5-LOW' THEN 1 WHEN '4-NOT SPECIFIED' THEN 2
  WHEN '3-MEDIUM' THEN 3 WHEN '2-HIGH' THEN 4 WHEN '1-URGENT' THEN 5 END AS priority FROM orders""")
def p13_ordinal_map(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", clean.map_values(F.col("o_orderpriority"), PRIORITY_RANK,
                                                   keep_unmapped=False).alias("priority"))


@register("p14_p15_parse_prices", sql_rounded(fx.with_sql(_PARSED, "SELECT * FROM parsed_prices"), _VOL_SPEC))
def p14_p15_parse_prices(spark, sf_dir):
    return rounded(fx.parsed_prices(spark, sf_dir), _VOL_SPEC)


@register("p16_mean_impute", sql_rounded(fx.with_sql(_PARSED, """
SELECT date, close, open, high, low, coalesce(volume, (SELECT avg(volume) FROM parsed_prices)) AS volume
FROM parsed_prices"""), _VOL_SPEC))
def p16_mean_impute(spark, sf_dir):
    return rounded(clean.impute_mean(fx.parsed_prices(spark, sf_dir), ["volume"]), _VOL_SPEC)


@register("p17_cast_float", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS FLOAT) AS l_quantity,
       CAST(l_extendedprice AS FLOAT) AS l_extendedprice, CAST(l_discount AS FLOAT) AS l_discount FROM lineitem""")
def p17_cast_float(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                                 "l_quantity", "l_extendedprice", "l_discount")
    return clean.cast_all(li, ["l_quantity", "l_extendedprice", "l_discount"], "float")


@register("p18_round_half_even", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
       round_even(l_extendedprice / 7, 3) AS price_7 FROM lineitem""")
def p18_round_half_even(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                                 "l_quantity", (F.col("l_extendedprice") / 7).alias("price_7"))
    return clean.round_numeric(li.withColumn("l_quantity", F.col("l_quantity").cast("long")), 3)


@register("p19_add_intercept", """
SELECT vec_id, list_concat([1.0::DOUBLE], list_transform(embedding, lambda x: CAST(x AS DOUBLE))) AS features
FROM embeddings""")
def p19_add_intercept(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", vx.add_intercept(F.col("embedding")).alias("features"))


@register("p20_flatten_grid", """
SELECT vec_id, flatten(list_transform(range(8), lambda i: embedding[i * 8 + 1: i * 8 + 8])) AS flat
FROM embeddings""")
def p20_flatten_grid(spark, sf_dir):
    """Embeddings as 8 x 8 grids, flattened back to 64-vectors."""
    e = table(spark, sf_dir, "embeddings")
    grid = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.slice("embedding", i * 8 + 1, 8))
    return e.select("vec_id", vx.flatten_grid(grid).alias("flat"))
