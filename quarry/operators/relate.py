"""Joins, lookups, ranking, top-k and set operators (J1-J7, T1-T6, U1-U2), plus the
distributed row-index helper used wherever the reference leans on row position."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir, kept, setting


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` checkpointed by hash of ``keys`` and sorted by them within partitions, so that
    later joins and groups on them don't shuffle or sort it again.  Under adaptive execution
    a checkpoint doesn't tell how it is laid out, so it is off for this one write."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with setting(spark, "spark.sql.adaptive.enabled", "false"):
        return kept(df.repartition(n, *keys).sortWithinPartitions(*keys))


def running_sums(df: DataFrame, order: Sequence[Column | str], sums: dict[str, Column],
                 group: Sequence[str] = (), partitions: int | None = None) -> DataFrame:
    """Inclusive running totals of ``sums`` along ``order`` (within ``group``), with no
    window that holds a whole group in one task.

    Rows are range-partitioned on (group, order) — so even a group holding a third of
    the rows is split over many tasks — and checkpointed to the shared checkpoint
    folder, so partition ids stay stable between the two passes and survive executor
    loss.  Pass 1 totals each (partition, group) piece (a few rows per partition);
    their prefix sums are each piece's offset; pass 2 is a window inside each piece.
    ``order`` must be a total order within a group.
    """
    ensure_checkpoint_dir(df.sparkSession)
    g = list(group)
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    base = df.withColumns({f"__v_{k}": v for k, v in sums.items()})
    ranged = kept(base.repartitionByRange(n, *[F.col(c) for c in g], *cols)
                  .withColumn("__pid", F.spark_partition_id()))
    pieces = ranged.groupBy("__pid", *g).agg(*[F.sum(f"__v_{k}").alias(f"__t_{k}") for k in sums])
    wp = Window.partitionBy(*g).orderBy("__pid")  # pieces: <= partitions x groups-per-partition rows
    offs = pieces.select("__pid", *g, *[(F.sum(f"__t_{k}").over(wp) - F.col(f"__t_{k}")).alias(f"__o_{k}")
                                        for k in sums])
    w = (Window.partitionBy("__pid", *g).orderBy(*cols)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # Without groups the offsets are one row per partition: a proven bound, broadcast.
    # With groups their number follows the data, so the planner (AQE) decides.
    # Groups meet null-safe: rows with a null group are a group like any other.
    offs = offs.select(F.col("__pid").alias("__op"), *[F.col(c).alias(f"__g_{i}") for i, c in enumerate(g)],
                       *[f"__o_{k}" for k in sums])
    same = F.col("__pid") == F.col("__op")
    for i, c in enumerate(g):
        same = same & F.col(c).eqNullSafe(F.col(f"__g_{i}"))
    out = ranged.join(F.broadcast(offs) if not g else offs, same)
    out = out.withColumns({k: F.sum(f"__v_{k}").over(w) + F.col(f"__o_{k}") for k in sums})
    return out.drop("__pid", "__op", *[f"__g_{i}" for i in range(len(g))], *[f"__v_{k}" for k in sums],
                    *[f"__o_{k}" for k in sums])


def global_row_index(df: DataFrame, order: Sequence[Column | str], out: str = "idx",
                     group: Sequence[str] = (), partitions: int | None = None) -> DataFrame:
    """0-based position of every row in a total order (within ``group``), computed by
    ``running_sums`` — never a one-task window."""
    r = running_sums(df, order, {out: F.lit(1)}, group, partitions)
    return r.withColumn(out, F.col(out) - 1)


def encode_first_seen(df: DataFrame, key: str, order: Sequence[str], out: str = "index") -> DataFrame:
    """J1 dictionary: distinct ``key`` -> dense 0-based index in first-seen order.

    The least leading order column per key comes from a hash aggregate over all rows; only
    the rows that reach it are compared on the rest of the order."""
    head, rest = order[0], list(order[1:])
    least = df.groupBy(key).agg(F.min(head).alias("__head"))
    if rest:
        ties = df.join(least.withColumnRenamed(key, "__key"), F.col(key).eqNullSafe(F.col("__key")) & F.col(head).eqNullSafe(F.col("__head")))
        least = ties.groupBy(key, "__head").agg(F.min(F.struct(*rest)).alias("__rest"))
    return (global_row_index(least, ["__head", *(["__rest"] if rest else []), key], out)
            .select(key, out))


def encode_sorted(df: DataFrame, key: str, out: str = "index") -> DataFrame:
    """X10/J1 variant: distinct values -> 0..k-1 in sorted order."""
    return global_row_index(df.select(key).distinct(), [key], out)


def lookup(df: DataFrame, table: DataFrame, on: str | Column, how: str = "inner") -> DataFrame:
    """Code -> name lookup; the planner broadcasts the table when its size allows."""
    return df.join(table, on, how)


def align_mean(a: DataFrame, b: DataFrame, key: str, col: str, out: str = "mean") -> DataFrame:
    """Align two prediction sets on a row key and average them."""
    return (a.select(key, F.col(col).alias("__a")).join(b.select(key, F.col(col).alias("__b")), key)
            .select(key, ((F.col("__a") + F.col("__b")) / 2).alias(out)))


def nearest_centre(vec: Column, centres: Sequence[Sequence[float]]) -> Column:
    """Index of the closest centre (first on ties) for a model-sized centre list.

    Centres are literals in the expression, so there is no join at all.
    """
    from quarry.functions.vector import sq_dist
    lits = F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in centres])
    d = F.transform(lits, lambda c: sq_dist(vec, c))
    return F.array_position(d, F.array_min(d)).cast("int") - 1


def mesh_grid(spark, x_min: float, x_max: float, y_min: float, y_max: float, n: int = 200) -> DataFrame:
    """N x n grid of points from one ``range`` (no join)."""
    sx = (x_max - x_min) / (n - 1)
    sy = (y_max - y_min) / (n - 1)
    g = spark.range(n * n)
    return g.select(
        F.col("id").alias("point_id"),
        (F.lit(x_min) + F.floor(F.col("id") / n) * sx).alias("x"),
        (F.lit(y_min) + (F.col("id") % n) * sy).alias("y"),
    )


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows of a total order (``orderBy().limit()`` is planned as
    TakeOrderedAndProject: a per-task top-k, then a merge of k rows per task)."""
    return df.orderBy(*order).limit(k)


def top_k_per_group(df: DataFrame, group: str, order: Sequence[Column], k: int,
                    rank_col: str = "rank") -> DataFrame:
    """T5: ``row_number`` within each group, kept while <= k."""
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def majority(df: DataFrame, group: Sequence[str] | str, label: str, out: str = "majority") -> DataFrame:
    """Most frequent label per group, the lowest label on ties."""
    g = [group] if isinstance(group, str) else list(group)
    counts = df.groupBy(*g, label).agg(F.count(F.lit(1)).alias("__n"))
    return counts.groupBy(*g).agg(F.min_by(label, F.struct(-F.col("__n"), F.col(label))).alias(out))


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """U1."""
    return a.unionByName(b).distinct()


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """U2."""
    return df.select(col).distinct()
