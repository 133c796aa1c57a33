"""Steps that are written, sent or read once, not again for every use or every row of a key."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from quarry.operators import bayes, encode, linear, svm
from quarry.plans import q_bayes, q_models, q_text
from quarry.sources import fixtures as fx
from quarry.streaming import online
from tests.conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def corpus(spark, tmp_path):
    texts = [(i, f"the apple tree and {'pear' if i % 2 else 'plum'} word{i // 2}", "en", "s", 1) for i in range(8)]
    spark.createDataFrame(texts, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, i % 2, 0) for i in (0, 1, 2, 3, 3)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_stop_words_are_no_join(spark, corpus, monkeypatch):
    seen, count = [], encode.term_counts
    monkeypatch.setattr(q_text.en, "term_counts", lambda toks: seen.append(toks) or count(toks))
    tf, _, _ = q_text._bow_parts(spark, corpus)
    assert "Join" not in plan(seen[0])
    assert {r.term for r in tf.select("term").distinct().collect()} == {"apple", "tree", "pear", "plum", *(f"word{i}" for i in range(4))}


def test_bag_of_labelled_documents_is_written_once(spark, corpus):
    feats, _ = q_bayes._doc_features(spark, corpus)
    assert "Join" not in plan(feats)
    got = {(r.doc_id, r.feature) for r in feats.collect()}
    assert {d for d, _ in got} == {0, 1, 2, 3} and len(got) == feats.count()
    assert {f for _, f in got} == {"pear", "plum", "word0", "word1"}  # df of all documents: apple and tree are in over half


def test_distinct_rows_are_not_sorted_out_again(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (2, "b"), (3, "b")], "row_id int, feature string")
    labels = spark.createDataFrame([(1, 0), (2, 1), (3, 1)], "row_id int, label int")
    two = [bayes.fit_bernoulli(x, labels, distinct=d).predict_proba(x, labels) for x, d in ((rows, True), (rows.unionAll(rows), False))]
    assert plan(two[0]).count("Aggregate") < plan(two[1]).count("Aggregate")
    one, other = ({r.row_id: r.probs for r in t.collect()} for t in two)
    assert all(one[k] == pytest.approx(other[k]) for k in (1, 2, 3))


def test_clicks_are_joined_once(spark):
    tr, te = q_models._clicks_split(spark, SF_SMALL, "row_id")
    assert "Join" not in plan(tr) and "Join" not in plan(te)
    whole = fx.clicks(spark, SF_SMALL).select("row_id", "label", *q_models.CAT).collect()
    both = tr.unionByName(te).select("row_id", tr["label"].cast("int"), *q_models.CAT).collect()
    assert sorted(map(tuple, both)) == sorted(map(tuple, whole))
    from quarry.operators.split import hashed_split
    want = hashed_split(fx.clicks(spark, SF_SMALL).select("row_id"), "row_id", 0.3, 42).where("is_test")
    assert sorted(r.row_id for r in te.collect()) == sorted(r.row_id for r in want.collect())


def test_small_dictionary_is_broadcast_a_large_one_not(spark):
    rows = spark.createDataFrame([(i, "ab"[i % 5 == 0]) for i in range(50)] + [(50, None), (51, "z")], "id int, feature string")
    vocab = spark.createDataFrame([("a", 0), ("b", 1)], "feature string, index int")
    for most, hint in ((2, True), (1, False)):
        got = encode.meet_dictionary(rows, vocab, "feature", most)
        assert ("strategy=broadcast" in plan(got)) == hint
        assert got.count() == 50 and got.where("index = 1").count() == 10


def test_matrix_of_a_batch():
    batch = pa.RecordBatch.from_pydict({"x": pa.array([[9.0, 9.0], [1.0, 2.0], [3.0, None]])}).slice(1)
    got = linear._matrix(batch, "x")
    assert got.shape == (2, 2) and got[0].tolist() == [1.0, 2.0] and np.isnan(got[1, 1])
    with pytest.raises(ValueError):
        linear._matrix(pa.RecordBatch.from_pydict({"x": pa.array([[1.0], [1.0, 2.0, 3.0]])}), "x")


def test_stream_reads_its_state_once(spark, tmp_path, monkeypatch):
    for i in range(4):
        spark.createDataFrame([([1.0, float(j % 3)], float(j % 2)) for j in range(20)], "features array<double>, label double").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    calls, read = [], online.latest_weights
    monkeypatch.setattr(online, "latest_weights", lambda *a: calls.append(1) or read(*a))
    schema = spark.read.parquet(f"{tmp_path}/in").schema
    w = online.run_online(spark, f"{tmp_path}/in", schema, lambda d: d, 2, f"{tmp_path}/state", f"{tmp_path}/ck")
    states = {r.batch_id: r.w for r in spark.read.parquet(f"{tmp_path}/state").collect()}
    assert sorted(states) == [0, 1, 2, 3] and states[3] == w.tolist()
    assert len(calls) <= 2  # at the start, and for the result
    again = online.run_online(spark, f"{tmp_path}/in", schema, lambda d: d, 2, f"{tmp_path}/state", f"{tmp_path}/ck2")  # replayed
    assert again.tolist() == w.tolist() and spark.read.parquet(f"{tmp_path}/state").count() == 4


def test_prices_shuffle_no_line(spark, tmp_path, monkeypatch):
    """The table of days goes to the lines, whatever size Spark takes it for; over DATES it doesn't."""
    rows = [(d * 10 + i, 7, 1, 1, 2.0, float(100 * d + i), day) for d, day in enumerate(("1995-01-01 00:00:00", "1995-01-02 00:00:00", None)) for i in range(3)]
    lines = spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, day string")
    lines.withColumn("l_shipdate", F.col("day").cast("timestamp_ntz")).drop("day").write.parquet(f"{tmp_path}/lineitem.parquet")
    for most, hint in ((2, False), (3, True)):  # two dates and the missing one
        monkeypatch.setattr(fx, "DATES", most)
        got = fx.prices(spark, str(tmp_path))
        assert ("strategy=broadcast" in plan(got)) == hint
        assert [tuple(r)[1:] for r in got.orderBy("date").collect()] == [(0.0, 2.0, 2.0, 0.0, 6.0), (100.0, 102.0, 102.0, 100.0, 6.0)]


def test_words_with_another_lemma_go_to_the_tokens(spark, tmp_path, monkeypatch):
    """Tokens are not shuffled for their lemmas; with too many lemmas they are, to the same end."""
    docs = [(1, "Cats cat dogs red dogs", "en", "s", 1), (2, "dog red", "en", "s", 1), (3, None, "en", "s", 1), (1, "zz", "en", "s", 1)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "red", "b", "t", 1, 1.0)], "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    for most, hint in ((500_000, True), (1, False)):
        monkeypatch.setattr(q_text, "_LEMMAS", most)
        got = q_text.f5_j3_clean_documents(spark, str(tmp_path))
        assert ("strategy=broadcast" in plan(got)) == hint
        found = {r.doc_id: sorted(r.clean_text.split()) for r in got.collect()}
        assert found == {1: ["cat", "cat", "dog", "dog", "zz"], 2: ["dog"]}


def test_a_pass_of_the_linear_svm_has_few_tasks(spark):
    """Every task of every evaluation reports to the driver: their number is that of the cores, not of the input's files."""
    df = spark.range(120, numPartitions=40).selectExpr("cast(id % 3 as double) label", "array(cast(id % 3 = 1 as double), cast(id % 3 = 2 as double), id / 120) x", "1.0D weight")
    df = df.select("label", array_to_vector("x").alias("features"), "weight")
    group, sc = "few-tasks-svm", spark.sparkContext
    sc.setJobGroup(group, group)
    try:
        binary = svm.linear_svc(1.0, 120, 5).fit(df.where("label < 2"))
        many = linear.one_vs_rest(svm.linear_svc(1.0, 120, 5, weight_col="weight"), "weight").fit(df)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    stages = [tracker.getStageInfo(i) for j in tracker.getJobIdsForGroup(group) for i in tracker.getJobInfo(j).stageIds]
    wide = [s for s in stages if s is not None and "treeAggregate" in s.name]
    assert len(wide) > 20 and max(s.numTasks for s in wide) <= sc.defaultParallelism
    assert binary.transform(df.where("label < 2")).where("label = prediction").count() == 80
    assert many.transform(df).where("label = prediction").count() == 120
