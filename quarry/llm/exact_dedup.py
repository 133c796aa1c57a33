"""Exact duplicates with the frequent texts split off from the shuffle.

A Misra-Gries summary of the texts' digests finds every digest that more than one row in
``counters + 1`` has.  Their exact counts and winners are a table of at most ``counters``
rows, which is broadcast: rows of a frequent text are settled where they are read, however
many there are.  All other rows meet their winner in an ordinary shuffle, in which no
group is larger than that share.  Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCK_BITS = 15  # a first summary covers 2^15 rows
FAN_IN = 64  # summaries that are merged into one


def digest(text: Column) -> Column:
    """SHA-256 (lowercase hex) of the text with A-Z lowered; null counts as empty."""
    return F.sha2(F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER).cast("binary"), 256)


def _summaries(counted: DataFrame, counters: int) -> DataFrame:
    """One Misra-Gries summary (b, h, c) for each b of exact or summarised counts (b, h, c):
    the ``counters`` largest, less the next largest count, where that leaves any."""
    best = F.sort_array(F.collect_list(F.struct("c", "h")), asc=False)
    cut = F.coalesce(F.get(F.col("best"), F.lit(counters))["c"], F.lit(0))
    left = F.transform(F.slice("best", 1, counters), lambda x: F.struct((x["c"] - cut).alias("c"), x["h"].alias("h")))
    return (counted.groupBy("b").agg(best.alias("best"))
            .select("b", F.explode(F.filter(left, lambda x: x["c"] > 0)).alias("x")).select("b", "x.h", "x.c"))


def frequent(digests: DataFrame, counters: int = 256) -> DataFrame:
    """Digests (h) among ``digests`` (h, u), u a row number.  Holds every digest that more
    than one row in ``counters + 1`` has, and at most ``counters`` digests; some may be rare.

    Blocks of 2^15 rows are counted and cut to a summary; FAN_IN summaries at a time are
    added up and cut again, until one is left.  A summary's count falls short of the true
    one by at most a share of 1 / (counters + 1) of the rows that it covers.
    """
    # u has the partition in its upper bits, so a block never spans two partitions
    blocks = digests.select(F.shiftright("u", BLOCK_BITS).alias("b"), "h")
    now = _summaries(blocks.groupBy("b", "h").agg(F.count(F.lit(1)).alias("c")), counters).checkpoint()
    n = now.select("b").distinct().count()
    while n > 1:
        n = -(-n // FAN_IN)
        merged = now.withColumn("b", F.pmod(F.xxhash64("b"), F.lit(n)))
        now = _summaries(merged.groupBy("b", "h").agg(F.sum("c").alias("c")), counters)
    return now.select("h")


def _winners(rows: DataFrame) -> DataFrame:
    """For each digest: how many rows, the largest key, and the row that stays (one of
    those with that key; where no row has a key, any)."""
    return rows.groupBy("h").agg(
        F.count(F.lit(1)).alias("n"), F.max("k").alias("top"),
        F.coalesce(F.max_by("u", "k"), F.max("u")).alias("stays"))


def mark(docs: DataFrame, key: str = "doc_id", text: str = "text", counters: int = 256) -> DataFrame:
    """One row per input row: ``key``, keep_id, group_size, kept, text_sha256.

    Rows are equal if their texts are after lowering A-Z alone (null: empty).  Of equal
    rows the one with the largest key stays; a null key is the least.  Of several rows with
    the same text and the same largest key exactly one stays, and where all keys of a
    group are null keep_id is null and one row stays.  An empty table gives no rows;
    other columns are not read.

    Winners of the frequent digests are verified: their counts and keys come from a second,
    exact pass, and a digest that the summary overrated is only settled early.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    # narrow rows, read three times below; the checkpoint fixes the row numbers
    rows = docs.select(F.col(key).alias("k"), digest(F.col(text)).alias("h"),
                       F.monotonically_increasing_id().alias("u")).checkpoint()
    often = F.broadcast(frequent(rows, counters))  # at most ``counters`` rows
    head = F.broadcast(_winners(rows.join(often, "h", "left_semi")).checkpoint())  # as many at most
    rest = rows.join(head.select("h"), "h", "left_anti")
    both = rows.join(head, "h").unionByName(rest.join(_winners(rest), "h"))
    return both.select(F.col("k").alias(key), F.col("top").alias("keep_id"), F.col("n").cast("long").alias("group_size"),
                       (F.col("u") == F.col("stays")).alias("kept"), F.col("h").alias("text_sha256"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", counters: int = 256) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns (of rows with the same text
    and key, one).  Nulls, ties and empty tables as in ``mark``."""
    names = [f"__c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    of = dict(zip(docs.columns, names, strict=True))
    stays = (mark(docs, key, text, counters).where("kept")
             .select(F.col(key).alias("__key"), F.col("text_sha256").alias("__digest")))
    found = plain.withColumn("__d", digest(F.col(of[text])))
    same = (F.col("__d") == F.col("__digest")) & F.col(of[key]).eqNullSafe(F.col("__key"))
    return found.join(stays, same, "left_semi").dropDuplicates(["__d", of[key]]).drop("__d").toDF(*docs.columns)


def oracle_sql(table: str = "documents") -> str:
    return f"""
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{LOWER}')) h FROM {table}),
g AS (SELECT h, max(doc_id) keep_id, count(*) group_size FROM d GROUP BY h)
SELECT doc_id, keep_id, group_size, doc_id = keep_id kept, h text_sha256 FROM d JOIN g USING (h)"""
