"""No row is lost to a null group, a null feature or a large count."""

from pyspark.sql import functions as F

from quarry.operators import metrics, relate, split, tree


def test_null_labels_keep_their_rows(spark):
    rows = [(i, None if i % 5 == 0 else i % 2) for i in range(100)]
    df = spark.createDataFrame(rows, "id bigint, label int")
    folds = split.stratified_folds(df, "id", "label", 10, 42)
    assert folds.count() == 100
    sizes = {(r.label, r.fold): r["count"] for r in folds.groupBy("label", "fold").count().collect()}
    assert all(sizes[None, f] == 2 for f in range(10))
    idx = relate.global_row_index(df, ["id"], "i", group=["label"])
    assert sorted(r.i for r in idx.where("label IS NULL").collect()) == list(range(20))


def test_null_features_stay_in_the_tree(spark):
    rows = [([None if i % 3 == 0 else str(i), "a" if i % 2 else None], float(i % 4)) for i in range(60)]
    df = spark.createDataFrame(rows, "x array<string>, y double")
    t = tree.train_tree(df, "x", "y", ["num", "cat"], 4, 1, "mse")
    for i, n in t.nodes.items():
        if not n.is_leaf:
            assert n.n == t.nodes[2 * i].n + t.nodes[2 * i + 1].n
    leaf = df.select(t.route(F.col("x")).alias("leaf")).groupBy("leaf").count().collect()
    assert {r.leaf: r["count"] for r in leaf} == {i: n.n for i, n in t.nodes.items() if n.is_leaf}


def test_deep_trees_predict(spark):
    df = spark.createDataFrame([([str(i)], float(i)) for i in range(40)], "x array<string>, y double")
    t = tree.train_tree(df, "x", "y", ["num"], 12, 1, "mse")
    assert max(n.depth for n in t.nodes.values()) >= 6
    got = df.select("y", t.predict(F.col("x")).alias("p")).collect()
    assert all(abs(r.y - r.p) <= 1 for r in got)


def test_auc_of_huge_counts(spark, monkeypatch):
    """Counts whose product leaves the range of a long."""
    n = 4_000_000_000
    counts = spark.createDataFrame([(0.2, 0, n), (0.8, n, 0)], "score double, pos bigint, neg bigint")
    monkeypatch.setattr(metrics, "score_counts", lambda *a, **k: counts)
    assert metrics.auc(counts, "pos", "score").first().auc == 1.0


def test_parts_of_a_random_split_are_disjoint_and_whole(spark):
    df = spark.range(1000).repartition(7)
    a, b = split.random_split(df, "id", [0.7, 0.3], 1)
    left, right = {r.id for r in a.collect()}, {r.id for r in b.collect()}
    assert not left & right and len(left | right) == 1000 and 620 < len(left) < 780


def test_classification_report_of_null_pairs(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 2), (2, 2), (3, 1)], "y int, p int")
    got = {r["class"]: r for r in metrics.classification_report(df, "y", "p").collect()}
    assert got["2"].precision == 2 / 3 and got["2"].recall == 1.0 and got["3"].support == 1 and got["accuracy"].recall == 0.6
