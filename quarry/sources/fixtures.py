"""Derived inputs that stand in for the reference's datasets.

Each builder has a DuckDB twin (``SQL``) so oracle queries can start from the
same rows.  All of them are joins / aggregates over the shared tables, so their
cost grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import text as tx
from quarry.sources.tables import LINEITEM_ROW_KEY, table

ROW_KEY = list(LINEITEM_ROW_KEY)


def row_id_col() -> F.Column:
    """String id of a lineitem row, identical in Spark and DuckDB (integers only)."""
    return F.concat_ws(
        "-",
        F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"),
        F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"),
        F.col("l_quantity").cast("bigint").cast("string"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").cast("string"),
    )


_ROW_ID_SQL = ("concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), "
               "CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR), "
               "CAST(CAST(l_quantity AS BIGINT) AS VARCHAR), "
               "CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR))")


def clicks(spark: SparkSession, sf_dir: str, *more: str, lines: DataFrame | None = None) -> DataFrame:
    """CTR-style log: one row per lineitem with five categorical columns and a 0/1 label;
    ``more`` lineitem columns follow.  ``lines``: the lineitem rows, if columns were added."""
    li = table(spark, sf_dir, "lineitem") if lines is None else lines
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    return (
        # orders meet their customers first: the lines, which are most, are shuffled once less
        li.join(o.join(c, F.col("o_custkey") == c.c_custkey), li.l_orderkey == o.o_orderkey)
        .join(p, li.l_partkey == p.p_partkey)
        .select(
            row_id_col().alias("row_id"), "l_shipdate", *ROW_KEY,
            (F.col("l_returnflag") == "R").cast("int").alias("label"),
            "l_linestatus", "o_orderpriority", "p_brand", "p_type", "c_mktsegment", *more,
        )
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, movie_id, rating 1..5); the last write by (o_orderdate, row key) wins."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    joined = li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("movie_id"), "o_orderdate", *ROW_KEY)
    # hash aggregate for the last date; the row key is compared only among a pair's lines of it
    last = joined.groupBy("user_id", "movie_id").agg(F.max("o_orderdate").alias("__last"), F.count(F.lit(1)).alias("__n"),
                                                     F.max("l_quantity").alias("__q"))
    once = last.where("__n = 1").select("user_id", "movie_id", F.col("__q").alias("q"))
    many = last.where("__n > 1").select(F.col("user_id").alias("__u"), F.col("movie_id").alias("__m"), "__last")
    ends = joined.join(many, (F.col("user_id") == F.col("__u")) & (F.col("movie_id") == F.col("__m")) & (F.col("o_orderdate") == F.col("__last")))
    tied = ends.groupBy("user_id", "movie_id").agg(F.max_by("l_quantity", F.struct(*ROW_KEY)).alias("q"))
    return once.unionByName(tied).select("user_id", "movie_id", F.ceil(F.col("q") / 10).cast("int").alias("rating"))


DATES = 1_000_000  # rows of the per-date table that are broadcast, at most: some 2,700 years


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily OHLCV series from lineitem: open/close = first/last price in row-key order.

    Kept on hash aggregation (a struct-ordered ``min_by`` over all rows would force a
    sort-based aggregate): pass 1 aggregates high/low/volume and the first/last
    ``l_orderkey`` per date; pass 2 keeps only the lines of those two orders and breaks
    the tie on the rest of the row key there.  The per-date table is counted and broadcast
    up to DATES rows, so that no line is shuffled: Spark takes a checkpoint for as large as
    what it was made of, and AQE measures it only after the lines have been shuffled.
    """
    li = table(spark, sf_dir, "lineitem").withColumn("date", F.to_date("l_shipdate"))
    main = li.groupBy("date").agg(
        F.max("l_extendedprice").alias("high"), F.min("l_extendedprice").alias("low"),
        F.sum("l_quantity").alias("volume"),
        F.min("l_orderkey").alias("__kf"), F.max("l_orderkey").alias("__kl"))
    main = main.checkpoint(eager=True)  # one row per date; reused by both passes, never recomputed
    key = F.struct(*ROW_KEY)
    ok = F.col("l_orderkey")
    days = main.select("date", "__kf", "__kl")
    ends = (li.join(F.broadcast(days) if main.count() <= DATES else days, "date")
            .where((ok == F.col("__kf")) | (ok == F.col("__kl"))))
    oc = ends.groupBy("date").agg(  # min_by / max_by skip null orderings
        F.min_by("l_extendedprice", F.when(ok == F.col("__kf"), key)).alias("open"),
        F.max_by("l_extendedprice", F.when(ok == F.col("__kl"), key)).alias("close"))
    return main.join(oc, "date").select("date", "open", "close", "high", "low", "volume")


def raw_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``prices`` written back as text: thousands separators, an ``M`` volume suffix, and
    ``-`` for the volume of every seventh day, to exercise the text cleaners."""
    p = prices(spark, sf_dir)
    money = lambda c: F.format_number(F.col(c), 2)  # noqa: E731  "12,345.67"
    vol = F.when(F.dayofyear("date") % 7 == 0, F.lit("-")).otherwise(
        F.concat(F.format_string("%.3f", F.col("volume") / 1000), F.lit("M")))
    return p.select(
        "date", money("close").alias("price"), money("open").alias("open"),
        money("high").alias("high"), money("low").alias("low"), vol.alias("vol"),
    )


def parsed_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P14+P15: ``raw_prices`` parsed back to numbers; a ``-`` volume becomes null."""
    from quarry.functions import clean
    r = raw_prices(spark, sf_dir)
    return r.select("date", clean.parse_number(F.col("price")).alias("close"),
                    *[clean.parse_number(F.col(c)).alias(c) for c in ("open", "high", "low")],
                    clean.parse_suffixed(F.col("vol"), "M", 1000.0, "-").alias("volume"))


def part_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A names-like word list: distinct lower-case words of part names."""
    p = table(spark, sf_dir, "part")
    return p.select(F.explode(tx.split_ws(F.lower("p_name"))).alias("word")).distinct()


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, pos, token): lower-cased, whitespace-split, alphabetic tokens."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.posexplode(tx.alpha_tokens(F.col("text"))).alias("pos", "token"))


_KEY_SQL = "(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity)"

SQL: dict[str, str] = {
    "raw_prices": """raw_prices AS (
  SELECT date, format('{:,.2f}', close) AS price, format('{:,.2f}', open) AS open,
         format('{:,.2f}', high) AS high, format('{:,.2f}', low) AS low,
         CASE WHEN dayofyear(date) % 7 = 0 THEN '-' ELSE printf('%.3f', volume / 1000) || 'M' END AS vol
  FROM prices)""",
    "parsed_prices": """parsed_prices AS (
  SELECT date, TRY_CAST(replace(price, ',', '') AS DOUBLE) AS close,
         TRY_CAST(replace(open, ',', '') AS DOUBLE) AS open,
         TRY_CAST(replace(high, ',', '') AS DOUBLE) AS high,
         TRY_CAST(replace(low, ',', '') AS DOUBLE) AS low,
         CASE WHEN vol = '-' THEN NULL
              ELSE TRY_CAST(replace(replace(vol, ',', ''), 'M', '') AS DOUBLE) * 1000.0 END AS volume
  FROM raw_prices)""",
    "part_words": f"""part_words AS (
  SELECT DISTINCT unnest(list_filter(string_split_regex(lower(p_name), '{tx.WHITESPACE}'), lambda x: x <> '')) AS word
  FROM part)""",
    "clicks": f"""clicks AS (
  SELECT {_ROW_ID_SQL} AS row_id, l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey,
         l_extendedprice, l_quantity, CAST(l_returnflag = 'R' AS INTEGER) AS label,
         l_linestatus, o_orderpriority, p_brand, p_type, c_mktsegment, l_discount
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey)""",
    "ratings": f"""ratings AS (
  SELECT o_custkey AS user_id, l_partkey AS movie_id,
         arg_max(CAST(ceil(l_quantity / 10) AS INTEGER), (o_orderdate, {_KEY_SQL[1:-1]})) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)""",
    "prices": f"""prices AS (
  SELECT CAST(l_shipdate AS DATE) AS date,
         arg_min(l_extendedprice, {_KEY_SQL}) AS open, arg_max(l_extendedprice, {_KEY_SQL}) AS close,
         max(l_extendedprice) AS high, min(l_extendedprice) AS low, sum(l_quantity) AS volume
  FROM lineitem GROUP BY 1)""",
    "tokens": f"""tokens AS (
  SELECT doc_id, CAST(generate_subscripts(tok, 1) - 1 AS INTEGER) AS pos, unnest(tok) AS token
  FROM (SELECT doc_id, {tx.alpha_tokens_sql('text')} AS tok FROM documents))""",
}


def with_sql(names: list[str] | tuple[str, ...], body: str, *extra: str) -> str:
    """Prefix ``body`` with the fixture CTEs in ``names`` and any extra ``name AS (...)`` CTEs."""
    ctes = [SQL[n] for n in names] + list(extra)
    return ("WITH " + ",\n".join(ctes) + "\n" + body) if ctes else body
