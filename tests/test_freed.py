"""What iterations and preparations leave on the disks."""

from __future__ import annotations

import os
import time

import numpy as np
from pyspark.sql import functions as F

from quarry import session
from quarry.operators import packed, relate, sparse_kmeans, split, topics


def tables(spark) -> int:
    """Checkpoints that lie in the shared folder."""
    path = spark.sparkContext._jsc.sc().getCheckpointDir().get().removeprefix("file:")
    return sum(x.startswith("rdd-") for x in os.listdir(path))


def shuffles(spark) -> int:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle") for i in range(files.size()))


def weights(spark):
    rng = np.random.default_rng(5)
    rows = [(d, int(t), float(rng.random() + 0.1)) for d in range(40) for t in rng.choice(12, 5, replace=False)]
    return spark.createDataFrame(rows, "doc_id bigint, index int, value double")


def left(spark, run) -> int:
    before = tables(spark)
    run()
    return tables(spark) - before


def test_shuffles_go_when_the_table_is_written(spark):
    spark._jvm.System.gc()
    time.sleep(2)
    before = shuffles(spark)
    for write in (session.kept, lambda df: relate.dealt(df, "k"), lambda df: session.stored(df, "t")):
        df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
        assert sorted(r[1] for r in write(df).collect()) == [142, 143, 143, 143, 143, 143, 143]
    for _ in range(50):
        if shuffles(spark) <= before:
            break
        time.sleep(0.2)
    assert shuffles(spark) <= before
    assert spark.conf.get(session.FREE_SHUFFLES, None) is None


def test_freed_tables_and_the_last_of_a_scope(spark):
    def run():
        a = session.kept(spark.range(5))
        with session.last_kept():
            session.kept(spark.range(6))
            b = session.kept(spark.range(7))
        assert b.count() == 7
        session.freed(a, None)
    assert left(spark, run) == 1
    t = session.stored(spark.range(9), "t")
    assert t.count() == 9 and os.path.isdir(t.kept_at.removeprefix("file:"))
    session.freed(t)
    assert not os.path.isdir(t.kept_at.removeprefix("file:"))


def test_topics_leave_no_more_after_more_iterations(spark):
    tf = weights(spark).withColumnRenamed("value", "tf")
    few, many = (left(spark, lambda n=n: topics.lda(tf, 3, n, block_rows=60)) for n in (2, 5))
    assert few == many <= 1
    few, many = (left(spark, lambda n=n: topics.nmf(weights(spark), 3, n, tol=0.0, block_rows=60)) for n in (2, 5))
    assert few == many <= 2


def test_kmeans_leaves_its_result_alone(spark):
    w = weights(spark).withColumnRenamed("value", "weight")
    assert left(spark, lambda: sparse_kmeans.fit(w, [2, 3], restarts=2, block_rows=60)) <= 2


def test_packed_folds_leave_the_packed_rows_alone(spark):
    df = spark.range(200).select("id", F.array(F.col("id").cast("double")).alias("x"), (F.col("id") % 2).alias("label"))

    def run():
        with session.last_kept():
            rows = packed.pack(split.stratified_folds(df, "id", "label", 4), "id", "label", features="x", fold="fold")
        assert rows.groupBy("fold").count().collect() and rows.count() == 200
    assert left(spark, run) == 1


def test_a_job_over_packed_rows_leaves_no_shuffle(spark):
    rows = packed.pack(spark.range(50).select("id", F.array(F.col("id").cast("double")).alias("x"), F.lit(1.0).alias("label")), "id", "label", features="x")
    spark._jvm.System.gc()
    time.sleep(2)
    before = shuffles(spark)
    assert packed.summed(rows, 1, lambda batches: np.array([float(sum(b.num_rows for b in batches))])) == [50.0]
    for _ in range(50):
        if shuffles(spark) <= before:
            break
        time.sleep(0.2)
    assert shuffles(spark) <= before
