"""How much text goes to Python at a time."""

from __future__ import annotations

import ctypes
import ctypes.util
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import SparkSession

BATCH_KEY, DEFAULT, BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "4m"


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most 4 MB in this session, unless it sets a size of its own.

    Texts of all lengths come in batches of up to 10,000 rows; at Spark's 64 MB an executor
    holds several such buffers for every task, on both sides, and keeps the memory.  Results
    don't depend on the size.
    """
    if spark.conf.get(BATCH_KEY, DEFAULT) == DEFAULT:
        spark.conf.set(BATCH_KEY, BYTES)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for mapInArrow, giving its memory back to the system when a task ends: Spark
    keeps the Python worker for later tasks, and it would keep the memory of the largest."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(ctypes.util.find_library("c")), "malloc_trim", None)  # glibc alone has it
            if trim is not None:
                trim(0)

    return whole
