"""Decision trees.

The scratch CART is grown level by level: ONE aggregate per level scores every
candidate split of every frontier node (counts per (node, feature, value) first, so a
hot value is combined before the shuffle; numeric ">=" splits get their right-hand
totals from distributed running sums).  Only the per-node winners — at most
2^depth rows — reach the driver; rows then move to their child through a literal
map keyed by node id, so no join is needed.  Ensembles use Spark ML.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.relate import running_sums


# ------------------------------------------------------------------ impurity

def gini_expr(counts: Sequence[Column], n: Column) -> Column:
    """1 - sum p^2; an empty group scores 0."""
    s = None
    for c in counts:
        t = F.try_divide(c, n) * F.try_divide(c, n)
        s = t if s is None else s + t
    return F.when(n > 0, 1 - s).otherwise(F.lit(0.0))


def entropy_expr(counts: Sequence[Column], n: Column) -> Column:
    """-sum p log2 p; an empty group scores 0."""
    s = None
    for c in counts:
        p = F.try_divide(c, n)
        t = F.when(c > 0, -p * F.log2(p)).otherwise(F.lit(0.0))
        s = t if s is None else s + t
    return F.when(n > 0, s).otherwise(F.lit(0.0))


def impurity(df: DataFrame, group: Sequence[str], label: str, classes: Sequence,
             criterion: str = "gini") -> DataFrame:
    """Impurity of the label distribution per group."""
    if criterion not in ("gini", "entropy"):
        raise ValueError(f"unknown criterion {criterion}")
    agg = df.groupBy(*group).agg(*[F.count_if(F.col(label) == c).alias(f"c{i}") for i, c in enumerate(classes)],
                                 F.count(F.lit(1)).alias("n"))
    fn = gini_expr if criterion == "gini" else entropy_expr
    return agg.select(*group, "n", fn([F.col(f"c{i}") for i in range(len(classes))], F.col("n")).alias(criterion))


def weighted_impurity(children: DataFrame, n_col: str = "n", imp_col: str = "gini") -> DataFrame:
    """Sum over children of n_g / n * impurity_g (one row)."""
    tot = children.select(F.sum(n_col)).scalar()
    return children.agg((F.sum(F.col(n_col) * F.col(imp_col)) / tot).alias("weighted"))


def variance_by(df: DataFrame, group: Sequence[str], y: str) -> DataFrame:
    """Population variance (reference "mse") per group; empty -> 0."""
    return df.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.var_pop(y), F.lit(0.0)).alias("mse"))


# ------------------------------------------------------------------ scratch CART

def goes_right(x: Column, numeric: Column, value: Column) -> Column:
    """Whether a feature passes a split; null and unparsable features don't."""
    hit = F.when(numeric, x.try_cast("double") >= value.try_cast("double")).otherwise(x == value)
    return F.coalesce(hit, F.lit(False))


@dataclass
class Node:
    node_id: int
    depth: int
    n: int
    prediction: float
    feature: int | None = None
    value: str | None = None
    numeric: bool = True
    is_leaf: bool = True


@dataclass
class Tree:
    nodes: dict[int, Node] = field(default_factory=dict)
    kinds: list[str] = field(default_factory=list)
    names: list[str] = field(default_factory=list)

    def to_df(self, spark) -> DataFrame:
        rows = [(n.node_id, n.depth, n.n, n.is_leaf, n.feature, n.value, float(n.prediction))
                for n in sorted(self.nodes.values(), key=lambda x: x.node_id)]
        return spark.createDataFrame(rows, "node_id long, depth int, n long, is_leaf boolean, feature int, "
                                           "value string, prediction double")

    def rules(self) -> list[tuple[int, int, int, str, float]]:
        """A row for each leaf: its id, depth, training rows, the conditions that lead to
        it joined by AND (TRUE for a tree of one leaf), and its prediction.  A leaf's id in
        binary is the path: 1, then a digit per level, 1 where the condition holds."""
        rows = []
        for leaf in sorted(i for i, n in self.nodes.items() if n.is_leaf):
            path = [leaf >> k for k in range(leaf.bit_length() - 1, -1, -1)]
            tests = [self._condition(self.nodes[up], down & 1 == 1) for up, down in zip(path, path[1:], strict=False)]
            at = self.nodes[leaf]
            rows.append((leaf, len(tests), at.n, " AND ".join(tests) or "TRUE", float(at.prediction)))
        return rows

    def _condition(self, node: Node, holds: bool) -> str:
        """The SQL condition of one side of a split."""
        name = self.names[node.feature] if self.names else f"feature_{node.feature}"
        if node.numeric:
            return f"{name} {'>=' if holds else '<'} {node.value}"
        return f"{name} {'=' if holds else '<>'} '{node.value}'"

    def _walk(self, x: Column) -> tuple[Column, list[int]]:
        """Place (in the sorted node ids) of the leaf a row reaches: one fold over the levels
        of a constant node array, so the expression's size doesn't grow with the depth."""
        ids = sorted(self.nodes)
        at = {i: p for p, i in enumerate(ids)}
        rows = [{"f": (n.feature or 0) + 1, "num": n.numeric, "v": n.value,
                 "l": at.get(2 * i, p), "r": at.get(2 * i + 1, p)} if not n.is_leaf else {"f": 1, "num": True, "v": None, "l": p, "r": p}
                for p, (i, n) in enumerate((i, self.nodes[i]) for i in ids)]
        table = F.from_json(F.lit(json.dumps(rows)), "array<struct<f:int,num:boolean,v:string,l:int,r:int>>")
        depth = max((n.depth for n in self.nodes.values()), default=1)

        def go(cur: Column, _: Column) -> Column:
            node = F.get(table, cur)
            return F.when(goes_right(F.get(x, node["f"] - 1), node["num"], node["v"]), node["r"]).otherwise(node["l"])

        return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), go), ids

    def route(self, x: Column) -> Column:
        """Leaf id reached by a row whose features are the string array ``x``.  A null or
        unparsable feature goes left, as it does in training."""
        place, ids = self._walk(x)
        return F.get(F.from_json(F.lit(json.dumps(ids)), "array<bigint>"), place)

    def predict(self, x: Column) -> Column:
        place, ids = self._walk(x)
        return F.get(F.from_json(F.lit(json.dumps([float(self.nodes[i].prediction) for i in ids])), "array<double>"), place)


def _stats_cols(task: str, y: Column, classes: Sequence) -> list[Column]:
    if task == "classification":
        return [F.count_if(y == c).cast("double").alias(f"k{i}") for i, c in enumerate(classes)]
    return [F.count(F.lit(1)).cast("double").alias("k0"), F.sum(y).alias("k1"), F.sum(y * y).alias("k2")]


def _score(task: str, criterion: str, side: str, m: int) -> tuple[Column, Column]:
    """(n, n * impurity) of one side from its stats columns ``{side}{i}``."""
    if task == "classification":
        cs = [F.col(f"{side}{i}") for i in range(m)]
        n = cs[0]
        for c in cs[1:]:
            n = n + c
        imp = gini_expr(cs, n) if criterion == "gini" else entropy_expr(cs, n)
        return n, n * imp
    n, s, ss = F.col(f"{side}0"), F.col(f"{side}1"), F.col(f"{side}2")
    return n, F.when(n > 0, ss - F.try_divide(s * s, n)).otherwise(F.lit(0.0))  # n * population variance


def train_tree(df: DataFrame, x: str, y: str, kinds: Sequence[str], max_depth: int, min_size: int,
               criterion: str = "gini", classes: Sequence | None = None,
               names: Sequence[str] = ()) -> Tree:
    """Grow a CART.  ``x`` is an array<string> column of features whose
    ``kinds`` are "num" (split x >= v) or "cat" (split x == v); the true side is
    right.  ``criterion`` gini / entropy (classification, leaf = majority, lowest
    label on ties) or mse (regression, leaf = mean)."""
    task = "regression" if criterion == "mse" else "classification"
    if criterion not in ("gini", "entropy", "mse"):
        raise ValueError(f"unknown criterion {criterion}")
    if task == "classification" and classes is None:
        classes = [r[0] for r in df.select(y).distinct().orderBy(y).collect()]
    m = len(classes) if task == "classification" else 3
    spark = df.sparkSession
    rows = df.select(F.col(x).alias("__x"), F.col(y).cast("double" if task == "regression" else
                                                          df.schema[y].dataType).alias("__y"),
                     F.lit(1).cast("long").alias("node"))
    tree = Tree(kinds=list(kinds), names=list(names))
    frontier = {1: 1}  # node id -> depth

    def pred_of(stats: list[float]) -> float:
        if task == "classification":
            best = max(range(m), key=lambda i: (stats[i], -i))
            return float(classes[best])
        return stats[1] / stats[0] if stats[0] else 0.0

    while frontier:
        yy = F.col("__y")
        tot = rows.groupBy("node").agg(*_stats_cols(task, yy, classes))
        tot_rows = {r.node: [r[f"k{i}"] for i in range(m)] for r in tot.collect()}  # <= frontier size
        long = rows.select("node", "__y", F.posexplode("__x").alias("f", "xs"))
        num_idx = [i for i, k in enumerate(kinds) if k == "num"]
        cat_idx = [i for i, k in enumerate(kinds) if k == "cat"]
        cands = []
        if num_idx:
            cn = (long.where(F.col("f").isin(num_idx)).withColumn("xn", F.col("xs").try_cast("double"))
                  .groupBy("node", "f", "xn").agg(*_stats_cols(task, yy, classes)))
            rs = running_sums(cn, [F.desc("xn")], {f"r{i}": F.col(f"k{i}") for i in range(m)}, ["node", "f"])
            rs = rs.where(F.col("xn").isNotNull())  # no split at a missing value; its rows stay on the left
            cands.append(rs.select("node", "f", F.lit(True).alias("num"), F.col("xn").alias("vn"),
                                   F.col("xn").cast("string").alias("vs"), *[f"r{i}" for i in range(m)]))
        if cat_idx:
            cc = (long.where(F.col("f").isin(cat_idx)).groupBy("node", "f", "xs")
                  .agg(*_stats_cols(task, yy, classes)))
            cc = cc.where(F.col("xs").isNotNull())
            cands.append(cc.select("node", "f", F.lit(False).alias("num"), F.lit(None).cast("double").alias("vn"),
                                   F.col("xs").alias("vs"), *[F.col(f"k{i}").alias(f"r{i}") for i in range(m)]))
        cand = cands[0] if len(cands) == 1 else cands[0].unionByName(cands[1])
        totals = tot.select(F.col("node").alias("__n"), *[F.col(f"k{i}").alias(f"t{i}") for i in range(m)])
        cand = cand.join(totals, F.col("node") == F.col("__n"))
        cand = cand.withColumns({f"l{i}": F.col(f"t{i}") - F.col(f"r{i}") for i in range(m)})
        nl, sl = _score(task, criterion, "l", m)
        nr, sr = _score(task, criterion, "r", m)
        score = F.round((sl + sr) / (nl + nr), 12)
        best = cand.groupBy("node").agg(F.min_by(
            F.struct("f", "num", "vs", *[f"l{i}" for i in range(m)], *[f"r{i}" for i in range(m)]),
            F.struct(score, "f", "vn", "vs")).alias("b")).collect()  # one row per frontier node
        nxt: dict[int, int] = {}
        routes = {}
        for r in best:
            nd, b = r.node, r.b
            d = frontier[nd]
            st = tot_rows[nd]
            lst = [b[f"l{i}"] for i in range(m)]
            rst = [b[f"r{i}"] for i in range(m)]
            n_l = sum(lst) if task == "classification" else lst[0]
            n_r = sum(rst) if task == "classification" else rst[0]
            n_all = sum(st) if task == "classification" else st[0]
            if n_l == 0 or n_r == 0:
                tree.nodes[nd] = Node(nd, d, int(n_all), pred_of(st))
                continue
            tree.nodes[nd] = Node(nd, d, int(n_all), pred_of(st), b.f, b.vs, bool(b.num), False)
            routes[nd] = (b.f, bool(b.num), b.vs)
            for child, cst, cn in ((2 * nd, lst, n_l), (2 * nd + 1, rst, n_r)):
                if d >= max_depth or cn <= min_size:
                    tree.nodes[child] = Node(child, d + 1, int(cn), pred_of(cst))
                else:
                    nxt[child] = d + 1
        if not nxt:
            break
        moves = spark.createDataFrame([(nd, f, num, vs, 2 * nd in nxt, 2 * nd + 1 in nxt) for nd, (f, num, vs) in routes.items()],
                                      "__m long, __f int, __num boolean, __v string, __l boolean, __r boolean")
        # at most one row per node of this level
        moved = rows.join(F.broadcast(moves), F.col("node") == F.col("__m"))
        right = goes_right(F.get("__x", F.col("__f")), F.col("__num"), F.col("__v"))
        rows = (moved.where(F.when(right, F.col("__r")).otherwise(F.col("__l")))
                .select("__x", "__y", (2 * F.col("node") + right.cast("long")).alias("node")))
        rows = rows.checkpoint(eager=True)  # cut lineage each level; survives executor loss
        frontier = nxt
    return tree


# ------------------------------------------------------------------ Spark ML trees

def spark_tree_classifier(max_depth: int = 12, min_instances: int = 1, weight_col: str | None = None,
                          features: str = "features", label: str = "label"):
    """M21 (Spark has minInstancesPerNode, not min_samples_split)."""
    from pyspark.ml.classification import DecisionTreeClassifier
    kw = {"weightCol": weight_col} if weight_col else {}
    return DecisionTreeClassifier(maxDepth=max_depth, minInstancesPerNode=min_instances, featuresCol=features,
                                  labelCol=label, impurity="gini", **kw)


def spark_forest_classifier(n_trees: int = 100, max_depth: int = 10, weight_col: str | None = None,
                            features: str = "features", label: str = "label", seed: int = 42):
    """M22."""
    from pyspark.ml.classification import RandomForestClassifier
    kw = {"weightCol": weight_col} if weight_col else {}
    return RandomForestClassifier(numTrees=n_trees, maxDepth=max_depth, featureSubsetStrategy="sqrt",
                                  featuresCol=features, labelCol=label, seed=seed, **kw)


def spark_gbt_classifier(n_iter: int = 20, max_depth: int = 5, step: float = 0.1,
                         features: str = "features", label: str = "label", seed: int = 42, weight_col: str | None = None):
    """Logistic-loss gradient-boosted trees."""
    from pyspark.ml.classification import GBTClassifier
    kw = {"weightCol": weight_col} if weight_col else {}
    return GBTClassifier(maxIter=n_iter, maxDepth=max_depth, stepSize=step, featuresCol=features,
                         labelCol=label, seed=seed, **kw)


def weighted_rows(est, n: float):
    """``est`` (a tree without resampling) for rows that stand for as many as they weigh, ``n``
    in all: the least rows of a node become a least weight."""
    least = est.getMinInstancesPerNode()
    if least > 1:
        # halfway to one row less, so that rounding refuses no node; below 2 * least rows none can be split
        est = est.setMinInstancesPerNode(1).setMinWeightFractionPerNode((least - 0.5) / n) if n >= 2 * least else est.setMaxDepth(0)
    return est


def spark_tree_regressor(max_depth: int = 10, features: str = "features", label: str = "label"):
    """M25."""
    from pyspark.ml.regression import DecisionTreeRegressor
    return DecisionTreeRegressor(maxDepth=max_depth, featuresCol=features, labelCol=label)


def spark_forest_regressor(n_trees: int = 100, max_depth: int = 10, features: str = "features",
                           label: str = "label", seed: int = 42):
    """M25."""
    from pyspark.ml.regression import RandomForestRegressor
    return RandomForestRegressor(numTrees=n_trees, maxDepth=max_depth, featuresCol=features, labelCol=label,
                                 seed=seed, featureSubsetStrategy="onethird")


def balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """class_weight='balanced': n / (k * n_c), from one grouped count joined by label."""
    n = df.select(F.count(F.lit(1))).scalar()
    k = df.select(F.count_distinct(label)).scalar()
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("__nc"))
    return df.join(c, label).withColumn(out, n / (k * F.col("__nc"))).drop("__nc")


def importances(model, names: Sequence[str]) -> list[tuple[str, float]]:
    """Feature importances by name (model-sized)."""
    imp = model.featureImportances.toArray().tolist()
    return list(zip(names, imp))
