"""Online logistic learning on Structured Streaming (ST1, ST2).

A file source with ``maxFilesPerTrigger=1`` delivers one chunk per micro-batch;
``foreachBatch`` runs one distributed SGD pass (per-partition SGD + averaging) on the
chunk starting from the latest saved weights, then appends ``(batch_id, weights)`` to a
small Parquet state table in the shared checkpoint folder.  A batch id already in
the state is skipped, so a replayed batch (after a failure) is never applied twice.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.linear import train_logistic_sgd

STATE_SCHEMA = T.StructType([T.StructField("batch_id", T.LongType()),
                             T.StructField("w", T.ArrayType(T.DoubleType()))])


def latest_weights(spark: SparkSession, state_path: str, dim: int) -> tuple[int, np.ndarray]:
    """The last saved weights, or zeros if the state folder doesn't exist yet.  Any other
    failure to read the state is raised: training must not start anew unnoticed."""
    try:
        st = spark.read.schema(STATE_SCHEMA).parquet(state_path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return -1, np.zeros(dim)
    r = st.orderBy(F.desc("batch_id")).limit(1).collect()
    if not r:
        return -1, np.zeros(dim)
    return int(r[0].batch_id), np.asarray(r[0].w, dtype=float)


def run_online(spark: SparkSession, source_dir: str, schema: T.StructType,
               featurize: Callable[[DataFrame], DataFrame], dim: int, state_path: str, checkpoint: str,
               learning_rate: float = 0.01, seed: int = 42) -> np.ndarray:
    """ST1: consume every file under ``source_dir`` (one per trigger); return final weights."""
    now = latest_weights(spark, state_path, dim)  # read once a run; no one else writes the state

    def step(batch: DataFrame, batch_id: int) -> None:
        nonlocal now
        last, w = now
        if batch_id <= last:
            return  # replay of an applied batch
        feats = featurize(batch)
        w = train_logistic_sgd(feats, dim, epochs=1, learning_rate=learning_rate, seed=seed + batch_id, w0=w)
        batch.sparkSession.createDataFrame([(int(batch_id), [float(x) for x in w])], STATE_SCHEMA) \
            .coalesce(1).write.mode("append").parquet(state_path)
        now = int(batch_id), np.asarray(w, dtype=float)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source_dir)
    q = (stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return latest_weights(spark, state_path, dim)[1]


def score(df: DataFrame, w: np.ndarray, features: str = "features", out: str = "prob") -> DataFrame:
    """ST2: probabilities from the last saved weights."""
    from quarry.operators.linear import predict_linear
    return predict_linear(df, w, features, out, logistic=True)
