"""Projection, predicate and cleaning helpers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def drop_columns(df: DataFrame, *cols: str) -> DataFrame:
    """P1."""
    return df.drop(*cols)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """P2."""
    return df.withColumnsRenamed(dict(mapping))


def select_range(df: DataFrame, start: int | None = None, stop: int | None = None) -> DataFrame:
    """Positional column slice, like ``iloc[:, start:stop]``."""
    return df.select(df.columns[start:stop])


def features_label(df: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """P5: all columns but the label, and the label."""
    return df.drop(label), df.select(label)


def any_contains(df: DataFrame, token: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows where any string column contains ``token``."""
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    cond = reduce(lambda a, b: a | b, [F.coalesce(F.col(c).contains(token), F.lit(False)) for c in cols])
    return df.filter(cond)


def keep_frequent_classes(df: DataFrame, label: str, min_count: int) -> DataFrame:
    """Keep rows whose class has at least ``min_count`` rows (aggregate + semi join)."""
    keep = df.groupBy(label).count().where(F.col("count") >= min_count).select(label)
    return df.join(keep, label, "left_semi")


def date_range(df: DataFrame, col: str, start, end) -> DataFrame:
    """P10: inclusive range."""
    return df.filter(F.col(col).between(F.lit(start), F.lit(end)))


def drop_null_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """P11."""
    return df.na.drop("any", subset=subset)


def binarize(c: Column, threshold: float) -> Column:
    """``> threshold`` -> 1, else 0."""
    return (c > threshold).cast("int")


def map_values(c: Column, mapping: Mapping, keep_unmapped: bool = True) -> Column:
    """Replace by lookup; values not in the mapping stay (or become null)."""
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    looked = F.try_element_at(m, c)
    return F.coalesce(looked, c) if keep_unmapped else looked


def parse_suffixed(c: Column, suffix: str = "M", factor: float = 1000.0, missing: str = "-") -> Column:
    """``"123.45M"`` -> 123.45 * factor; ``missing`` (or junk) -> null."""
    stripped = F.regexp_replace(F.regexp_replace(c, ",", ""), suffix, "")
    return F.when(c == missing, F.lit(None).cast("double")).otherwise(
        stripped.try_cast("double") * F.lit(factor))


def parse_number(c: Column) -> Column:
    """Number with thousands separators."""
    return F.regexp_replace(c, ",", "").try_cast("double")


def impute_mean(df: DataFrame, cols: Sequence[str], fit_df: DataFrame | None = None) -> DataFrame:
    """Replace nulls by the column mean of ``fit_df`` (default: ``df``) — fit, then transform.

    Each mean is a lazy scalar subquery (one global aggregate), so no join is planned.
    """
    fit_df = fit_df if fit_df is not None else df
    return df.withColumns({c: F.coalesce(F.col(c), fit_df.select(F.avg(c)).scalar()) for c in cols})


def cast_all(df: DataFrame, cols: Sequence[str], dtype: str = "float") -> DataFrame:
    """P17."""
    return df.withColumns({c: F.col(c).cast(dtype) for c in cols})


def round_numeric(df: DataFrame, decimals: int = 3) -> DataFrame:
    """Round every floating column half-to-even, as pandas does."""
    fl = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.bround(F.col(c), decimals) for c in fl})
