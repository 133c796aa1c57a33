"""Helpers for joins on shared keys: hot keys split into cells, and components of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir


def cells(keyed: DataFrame, key: str, member: str, limit: int) -> DataFrame:
    """Rows that share a key with others, dealt to cells so that any two members of a key
    meet in one cell and no cell gets many more than ``2 * limit`` of them.

    A key with more than ``limit`` rows is cut into blocks by a hash of ``member``; each
    cell holds two blocks.  Adds ``cell``; rows alone with their key are left out.
    """
    n = F.count(F.lit(1)).over(Window.partitionBy(key))
    met = keyed.withColumn("__n", n).where("__n > 1")
    blocks = F.ceil(F.col("__n") / limit).cast("int")
    own = F.pmod(F.xxhash64(member), blocks).cast("int")
    met = met.withColumns({"__b": blocks, "__o": own})
    pair = F.transform(F.sequence(F.lit(0), F.col("__b") - 1),
                       lambda c: F.least("__o", c) * F.col("__b") + F.greatest("__o", c))
    return met.select(*keyed.columns, F.explode(F.when(F.col("__b") == 1, F.array(F.lit(0))).otherwise(pair)).alias("cell"))


BLOCK = 1 << 20  # links that one task contracts at a time


def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) as stars: every node with the least node that these links join it to."""
    a, b = [], []

    def stars() -> pa.RecordBatch:
        nodes, at = np.unique(np.concatenate(a + b), return_inverse=True)
        x, y = at[:len(at) // 2], at[len(at) // 2:]
        label = np.arange(len(nodes))
        while True:
            before = label.copy()
            least = np.minimum(label[x], label[y])
            np.minimum.at(label, x, least)
            np.minimum.at(label, y, least)
            label = label[label]
            if (label == before).all():
                break
        out = label != np.arange(len(nodes))
        return pa.RecordBatch.from_arrays([pa.array(nodes[out]), pa.array(nodes[label[out]])], names=["a", "b"])

    for batch in batches:
        a.append(batch.column(0).to_numpy())
        b.append(batch.column(1).to_numpy())
        if sum(map(len, a)) >= BLOCK:
            yield stars()
            a, b = [], []
    if a:
        yield stars()


def components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(node, root) for every node of the links (a, b), which are longs: root is the least
    node reachable.

    Each round contracts blocks of at most ``BLOCK`` links where they are, then takes two
    steps over all of them: every node's larger neighbours move to its least neighbour,
    then its smaller ones do.  It ends when these steps change nothing.  Rounds are
    checkpointed, so a lost executor costs one; minima are combined before the shuffle.
    """
    ensure_checkpoint_dir(edges.sparkSession)

    def state(links: DataFrame) -> tuple:
        return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = edges.select("a", "b").where("a != b").checkpoint()
    for _ in range(max_rounds):
        blocks = -(-now.count() // BLOCK) or 1
        now = now.coalesce(blocks).mapInArrow(contract, "a bigint, b bigint").distinct().checkpoint()
        before = state(now)
        if not before[0]:
            break
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        now = (large.join(down, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
               .unionByName(down.select("a", F.col("m").alias("b"))).distinct().checkpoint())
        if state(now) == before:
            break
    else:
        raise RuntimeError(f"links did not settle in {max_rounds} rounds")
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(nodes.select(F.col("root").alias("node"), "root").distinct())
