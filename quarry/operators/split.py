"""Splits and resampling (R1-R7, R11).  Seeded order is ``md5(id || seed)`` — the same
in Spark and DuckDB — never ``rand()``; positions come from the distributed
``global_row_index``, never from a one-task window."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.relate import global_row_index


def seeded_key(id_col: str, seed: int | str) -> Column:
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(str(seed))))


def random_split(df: DataFrame, id_col: str, weights: Sequence[float], seed: int = 42) -> list[DataFrame]:
    """Weighted random split by a seeded hash of ``id_col``: each row falls into one part,
    whatever the partitioning and however often the parts are computed."""
    h = F.conv(F.substring(seeded_key(id_col, seed), 1, 8), 16, 10).cast("double") / float(16 ** 8)
    marked, total, low, parts = df.withColumn("__h", h), float(sum(weights)), 0.0, []
    for i, w in enumerate(weights):
        high = 1.0 if i == len(weights) - 1 else low + w / total
        parts.append(marked.where((F.col("__h") >= low) & (F.col("__h") < high)).drop("__h"))
        low = high
    return parts


def shuffled_split(df: DataFrame, id_col: str, test_size: float = 0.25, seed: int = 42,
                   out: str = "is_test") -> DataFrame:
    """R2: exact sizes — ceil(test_size * n) rows, first in seeded order, are the test set."""
    n = df.count()
    n_test = math.ceil(test_size * n)
    idx = global_row_index(df.withColumn("__k", seeded_key(id_col, seed)), ["__k"], "__i")
    return idx.withColumn(out, F.col("__i") < n_test).drop("__k", "__i")


def hashed_split(df: DataFrame, id_col: str, test_size: float = 0.25, seed: int = 42,
                 out: str = "is_test") -> DataFrame:
    """R2 at scale: a per-row hash threshold — no ranking pass, sizes exact in expectation."""
    h = F.conv(F.substring(seeded_key(id_col, seed), 1, 8), 16, 10).cast("double") / float(16 ** 8)
    return df.withColumn(out, h < test_size)


def chronological_split(df: DataFrame, order: Sequence[str], train_share: float = 0.9,
                        out: str = "is_train") -> DataFrame:
    """The first int(train_share * n) rows in ``order`` train, the rest test."""
    n = df.count()
    n_train = int(n * train_share)
    idx = global_row_index(df, list(order), "__i")
    return idx.withColumn(out, F.col("__i") < n_train).drop("__i")


def date_split(df: DataFrame, date: str, first_test: str, out: str = "is_train") -> DataFrame:
    """Rows before a date train, the rest test; rows without a date test."""
    return df.withColumn(out, F.coalesce(F.col(date) < F.lit(first_test).cast("date"), F.lit(False)))


def last_n_split(df: DataFrame, order: Sequence[str], n_test: int, out: str = "is_test") -> DataFrame:
    """The last ``n_test`` rows in ``order`` are the test set."""
    n = df.count()
    idx = global_row_index(df, list(order), "__i")
    return idx.withColumn(out, F.col("__i") >= n - n_test).drop("__i")


def stratified_folds(df: DataFrame, id_col: str, label: str, k: int = 10, seed: int = 42,
                     out: str = "fold") -> DataFrame:
    """Within each label, rows in seeded order are dealt round-robin to k folds."""
    idx = global_row_index(df, [seeded_key(id_col, seed)], "__i", group=[label])  # the key is not written with the rows
    return idx.withColumn(out, (F.col("__i") % k).cast("int")).drop("__i")


def contiguous_folds(df: DataFrame, order: Sequence[str], k: int = 5, out: str = "fold") -> DataFrame:
    """R7 (regressors): unshuffled k-fold — the first n % k folds get one extra row."""
    n = df.count()
    q, r = divmod(n, k)
    idx = global_row_index(df, list(order), "__i")
    big = (q + 1) * r  # rows in the r larger folds
    i = F.col("__i")
    fold = F.when(i < big, F.floor(i / (q + 1))).otherwise(r + F.floor((i - big) / F.lit(max(q, 1))))
    return idx.withColumn(out, fold.cast("int")).drop("__i")


def stratified_contiguous_folds(df: DataFrame, order: Sequence[str], label: str, k: int = 5,
                                out: str = "fold") -> DataFrame:
    """R7 (classifiers): unshuffled, stratified — each class's rows, in order, dealt to folds."""
    idx = global_row_index(df, list(order), "__i", group=[label])
    return idx.withColumn(out, (F.col("__i") % k).cast("int")).drop("__i")


def random_baseline(df: DataFrame, id_col: str, label: str, seed: int = 42, out: str = "pred") -> DataFrame:
    """Mark round(n * positive rate) rows, chosen in seeded order, as predicted positive."""
    n, n_pos = df.agg(F.count(F.lit(1)), F.sum(F.col(label).cast("long"))).first()
    m = int(round(n * (n_pos or 0) / n)) if n else 0
    idx = global_row_index(df.withColumn("__k", seeded_key(id_col, seed)), ["__k"], "__i")
    return idx.withColumn(out, (F.col("__i") < m).cast("int")).drop("__k", "__i")
