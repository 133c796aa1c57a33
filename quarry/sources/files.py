"""File scans and persistence."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.session import scratch_path


def csv_scan(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True,
             sep: str = ",") -> DataFrame:
    """CSV with an explicit schema; ``sep`` may be several characters (``::``)."""
    return spark.read.schema(schema).option("header", header).option("sep", sep).csv(path)


def dated_csv_scan(spark: SparkSession, path: str, schema: T.StructType | str, date_col: str,
                   fmt: str = "yyyy-MM-dd", header: bool = True) -> DataFrame:
    """S3: the date column arrives as text and is parsed with an explicit format."""
    df = csv_scan(spark, path, schema, header)
    return df.withColumn(date_col, F.to_date(F.col(date_col), fmt))


def write_csv(df: DataFrame, path: str, header: bool = True, sep: str = ",") -> str:
    df.write.mode("overwrite").option("header", header).option("sep", sep).csv(path)
    return path


def new_scratch(spark: SparkSession, kind: str) -> str:
    """A fresh folder under the shared checkpoint location (never a machine-local temp)."""
    return scratch_path(spark, f"{kind}/{uuid.uuid4().hex}")


def first_rows(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    """S5: "first n rows" needs an explicit order in Spark; planned as a per-task top-n."""
    return df.orderBy(*order).limit(n)


def inline_rows(spark: SparkSession, rows: Sequence[Sequence], schema: T.StructType | str) -> DataFrame:
    """S6."""
    return spark.createDataFrame(list(rows), schema)


@contextlib.contextmanager
def cached(df: DataFrame) -> Iterator[DataFrame]:
    """Cache around iterative work, always released."""
    df.cache()
    try:
        yield df
    finally:
        df.unpersist()


TRIAL_SCHEMA = T.StructType([
    T.StructField("trial_id", T.StringType()),
    T.StructField("params", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("score", T.DoubleType()),
    T.StructField("best_step", T.IntegerType()),
    T.StructField("status", T.StringType()),
])


def save_trials(trials: DataFrame, path: str) -> str:
    """Trials persisted as Parquet."""
    trials.write.mode("overwrite").parquet(path)
    return path


def best_trial(spark: SparkSession, path: str, minimize: bool = True) -> DataFrame:
    """Reload trials and keep the best completed one (ties: lowest trial id)."""
    t = spark.read.schema(TRIAL_SCHEMA).parquet(path).where(F.col("status") == "COMPLETED")
    return t.orderBy(F.asc("score") if minimize else F.desc("score"), "trial_id").limit(1)
