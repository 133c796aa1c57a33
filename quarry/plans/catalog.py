"""Registry of the queries exposed to the driver, each with its DuckDB twin.

A query is ``fn(spark, sf_dir) -> DataFrame``.  Floating columns are rounded on both
sides (same decimals, chosen by magnitude) so that summation order cannot change
the compared value.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def round_half_up(c, d: int):
    """floor(x * 10^d + 0.5) / 10^d — the same IEEE steps in both engines (their own
    round() functions break exact decimal ties differently)."""
    s = float(10 ** d)
    return (F.floor(c.cast("double") * s + 0.5) / s).cast("double")


def rounded(df: DataFrame, spec: Mapping[str, int]) -> DataFrame:
    return df.withColumns({c: round_half_up(F.col(c), d) for c, d in spec.items()})


def sql_round(expr: str, d: int) -> str:
    s = float(10 ** d)
    return f"CAST(floor(CAST({expr} AS DOUBLE) * {s!r} + 0.5) / {s!r} AS DOUBLE)"


def sql_rounded(body: str, spec: Mapping[str, int]) -> str:
    rep = ", ".join(f"{sql_round(c, d)} AS {c}" for c, d in spec.items())
    return f"SELECT * REPLACE ({rep}) FROM ({body}) AS __q"
