"""Aggregations (A1-A13).  All are grouped aggregates with map-side partial
aggregation, so a hot key is combined inside each task before the shuffle.
Global totals are lazy scalar subqueries (one row), never cross joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.relate import running_sums


def distinct_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A1: exact number of distinct values per column (one row ``n_<col>``)."""
    return df.agg(*[F.count_distinct(c).alias(f"n_{c}") for c in cols])


def approx_distinct_counts(df: DataFrame, cols: Sequence[str], rsd: float = 0.01) -> DataFrame:
    """A1 at scale: HyperLogLog++ sketches, mergeable partials."""
    return df.agg(*[F.approx_count_distinct(c, rsd).alias(f"n_{c}") for c in cols])


def non_null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A2: one row — total rows and the non-null count of every column."""
    cols = list(cols or df.columns)
    return df.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count(c).alias(f"nn_{c}") for c in cols])


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """A3."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def value_share(df: DataFrame, col: str, scale: float = 100.0) -> DataFrame:
    """A4: count and percentage of all rows (denominator = row count, a scalar subquery)."""
    total = df.select(F.count(F.lit(1))).scalar()
    return value_counts(df, col).withColumn("pct", F.col("n") * F.lit(scale) / total)


def conditional_counts(df: DataFrame, cond: Column, name: str = "n_pos",
                       else_name: str = "n_neg") -> DataFrame:
    """A5: rows meeting / not meeting a predicate (null counts as not meeting)."""
    c = F.coalesce(cond, F.lit(False))
    return df.agg(F.count_if(c).alias(name), F.count_if(~c).alias(else_name))


def describe(df: DataFrame, cols: Sequence[str], exact: bool = True,
             accuracy: int = 100_000) -> DataFrame:
    """Long form (column, count, mean, std, min, p25, p50, p75, max).

    ``std`` is the sample std and quartiles interpolate linearly (pandas).  ``exact``
    quartiles come from the counts of each distinct value and their running sums, which are
    spread over many tasks; ``exact=False`` uses mergeable ``percentile_approx`` sketches.
    """
    long = (df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in cols])).alias("v"))
            .select("v.*").where("x IS NOT NULL"))
    stats = long.groupBy("column").agg(F.count("x").alias("count"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"),
                                       F.min("x").alias("min"), F.max("x").alias("max"),
                                       *([] if exact else [F.percentile_approx("x", [0.25, 0.5, 0.75], accuracy).alias("q")]))
    names = ["column", "count", "mean", "std", "min", "p25", "p50", "p75", "max"]
    if not exact:
        return stats.select("*", *[F.col("q")[i].alias(p) for i, p in enumerate(("p25", "p50", "p75"))]).select(*names)
    values = long.groupBy("column", "x").agg(F.count(F.lit(1)).alias("n"))
    cum = running_sums(values, ["x"], {"cum": F.col("n")}, group=["column"])
    joined = cum.join(stats, "column")  # one row per column on the right
    shares = {"p25": 0.25, "p50": 0.5, "p75": 0.75}

    def at(place: Column) -> Column:
        """The value at a 0-based place of the sorted column."""
        return F.min(F.when(F.col("cum") > place, F.col("x")))

    place = {p: (F.col("count") - 1) * q for p, q in shares.items()}
    found = joined.groupBy("column", "count", "mean", "std", "min", "max").agg(
        *[at(F.floor(v)).alias(f"{p}_lo") for p, v in place.items()], *[at(F.ceil(v)).alias(f"{p}_hi") for p, v in place.items()])
    return found.select("*", *[(F.col(f"{p}_lo") + (F.col(f"{p}_hi") - F.col(f"{p}_lo")) * (v - F.floor(v))).alias(p)
                               for p, v in place.items()]).select(*names)


def positive_counts(df: DataFrame, key: str, value: str) -> DataFrame:
    """Per key, number of rows with ``value > 0``."""
    return df.where(F.col(value) > 0).groupBy(key).agg(F.count(F.lit(1)).alias("n_ratings"))


def rating_distribution(ratings: DataFrame, user: str = "user_id", item: str = "movie_id",
                        rating: str = "rating") -> DataFrame:
    """A10: counts per rating value plus the implicit zero cells of the user x item
    matrix (users x items - stored ratings), without ever densifying the matrix."""
    counts = ratings.groupBy(rating).agg(F.count(F.lit(1)).alias("n"))
    sizes = ratings.agg(F.count_distinct(user).alias("u"), F.count_distinct(item).alias("i"),
                        F.count(F.lit(1)).alias("r"))
    zero = sizes.select(F.lit(0).cast(ratings.schema[rating].dataType).alias(rating),
                        (F.col("u") * F.col("i") - F.col("r")).alias("n"))
    return counts.unionByName(zero)


def histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """Equal-width bins over [min, max]; the max falls in the last bin."""
    x = F.col(col).cast("double")
    lo = df.select(F.min(x)).scalar()
    hi = df.select(F.max(x)).scalar()
    b = F.least(F.floor(F.try_divide(x - lo, hi - lo) * bins), F.lit(bins - 1))
    b = F.coalesce(b, F.lit(0)).cast("int")
    return (df.where(x.isNotNull()).groupBy(b.alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"), F.min(x).alias("lo"), F.max(x).alias("hi")))


def group_composition(df: DataFrame, group: str, label: str) -> DataFrame:
    """(group, label, n, group_size, rank of label within group by n desc, label)."""
    from pyspark.sql import Window
    pair = df.groupBy(group, label).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(group)  # rows per group = distinct labels, small
    return (pair.withColumn("group_size", F.sum("n").over(w))
            .withColumn("rank", F.row_number().over(w.orderBy(F.desc("n"), F.asc(label)))))


def vector_mean_by(df: DataFrame, key: str, vec: str) -> DataFrame:
    """Element-wise mean of an array column per key (long form: key, pos, mean).

    ``posexplode`` is narrow; the grouped average combines partials per task, so a
    key holding a third of the rows is reduced before the shuffle.
    """
    return (df.select(key, F.posexplode(vec).alias("pos", "x"))
            .groupBy(key, "pos").agg(F.avg(F.col("x").cast("double")).alias("mean")))


def vector_mean_arrays(df: DataFrame, key: str, vec: str) -> DataFrame:
    """A13 back to one array per key (arrays are model-sized: one per key)."""
    long = vector_mean_by(df, key, vec)
    return (long.groupBy(key)
            .agg(F.array_sort(F.collect_list(F.struct("pos", "mean"))).alias("__s"))
            .select(key, F.transform("__s", lambda s: s["mean"]).alias(vec)))
