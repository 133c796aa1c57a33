"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

The ring has 2^16 positions.  Each shard owns ``vnodes`` of them (md5 of ``shard:vnode``);
a key sits at the position of its md5 and belongs to the next virtual node clockwise.
Every shard has a capacity; what overflows a full shard continues clockwise to the next
virtual node whose shard has room.

All keys of one arc (the positions that lead to the same virtual node) meet the same
nodes in the same order, so the walk is worked out on the key *counts* of the arcs, a
table whose size is fixed by the ring, not by the data.  A row then needs only its rank
within its arc: rank ranges of an arc map to shards, and to gapless slots in them.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir

RING = 1 << 16


def ring_nodes(n_shards: int, vnodes: int) -> list[tuple[int, int]]:
    """(position, shard) of every virtual node, clockwise; the lowest shard keeps a
    position that several hash to."""
    at: dict[int, int] = {}
    for s in range(n_shards):
        for v in range(vnodes):
            pos = int(hashlib.md5(f"{s}:{v}".encode()).hexdigest()[:4], 16)
            at[pos] = min(s, at.get(pos, s))
    return sorted(at.items())


def capacities(demand: list[int], slack: float) -> list[int]:
    """Most rows of each shard.  Without slack the capacities add up to the number of
    rows and differ by one at most; the larger ones go to the shards most asked for."""
    k, n = len(demand), sum(demand)
    low, extra = divmod(n, k)
    if slack > 0:
        return [max(low + (extra > 0), int(n * (1 + slack) / k) + 1)] * k
    first = sorted(range(k), key=lambda s: (-demand[s], s))[:extra]
    return [low + (s in first) for s in range(k)]


def walk(nodes: list[tuple[int, int]], counts: list[int], n_shards: int,
         slack: float) -> list[tuple[int, int, int, int, int]]:
    """Segments (arc, first rank, end rank, shard, first slot) for ``counts`` keys per arc.

    Keys take their home shard first, arcs in ring order.  Two sweeps round the ring then
    carry the overflow clockwise, first in first out, to every node whose shard has room.
    """
    demand = [0] * n_shards
    for (_, s), c in zip(nodes, counts, strict=True):
        demand[s] += c
    room, filled, out = capacities(demand, slack), [0] * n_shards, []

    def put(arc: int, start: int, end: int, s: int) -> int:
        take = min(end - start, room[s] - filled[s])
        if take > 0:
            out.append((arc, start, start + take, s, filled[s]))
            filled[s] += take
        return start + max(take, 0)

    over = {}
    for arc, (_, s) in enumerate(nodes):
        done = put(arc, 0, counts[arc], s)
        if done < counts[arc]:
            over[arc] = (done, counts[arc])
    carried: list[tuple[int, int, int]] = []
    for step in range(2 * len(nodes)):
        arc = step % len(nodes)
        while carried and filled[nodes[arc][1]] < room[nodes[arc][1]]:
            a, start, end = carried.pop(0)
            if (done := put(a, start, end, nodes[arc][1])) < end:
                carried.insert(0, (a, done, end))
        if arc in over:
            carried.append((arc, *over.pop(arc)))
    return out


def ring_position(key: Column) -> Column:
    """Position of a key: the first 16 bits of the md5 of its text (null: of no text)."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 4), 16, 10).cast("int")


def shard(docs: DataFrame, n_shards: int = 24, vnodes: int = 64, slack: float = 0.0,
          key: str = "doc_id", text: str = "text", salts: int = 16) -> DataFrame:
    """One row per input row: ``key``, size (UTF-8 bytes of the text and 8), text_crc32,
    home_shard (before overflow), shard, slot (0, 1, ... without gaps in each shard).

    Without ``slack`` the shards' row counts differ by one at most; with it a shard holds
    at most ``(1 + slack)`` times the mean.  Null text counts as empty, a null key hashes
    as empty text, repeated rows each get a slot of their own, an empty table gives no
    rows, and other columns of the input are not read.  Equal texts are not kept together.

    A key that holds a third of all rows sits at one ring position; ``salts`` sub-cells
    per position keep its ranking out of a single task.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    nodes = ring_nodes(n_shards, vnodes)
    if len({s for _, s in nodes}) < n_shards:
        raise ValueError("a shard lost all of its virtual nodes to others; raise vnodes")
    at = [p for p, _ in nodes]
    arc_of = ",".join(str(bisect_left(at, p) % len(at)) for p in range(RING))
    arcs = F.split(F.lit(arc_of), ",").cast("array<int>")  # folded to one constant
    body = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    rows = (docs.select(F.col(key).alias("k"), (F.octet_length(body) + 8).cast("long").alias("size"),
                        F.crc32(body).alias("crc"), ring_position(F.col(key)).alias("pos"))
            .withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
            .checkpoint())  # narrow rows, read twice below; fixes the salts
    cells = (rows.groupBy("pos", "salt").agg(F.count(F.lit(1)).alias("n"))
             .withColumn("arc", F.get(arcs, F.col("pos"))))
    counts = [0] * len(nodes)
    for r in cells.groupBy("arc").agg(F.sum("n").alias("n")).collect():  # at most one row per virtual node
        counts[r.arc] = r.n
    plan = walk(nodes, counts, n_shards, slack)
    spark = docs.sparkSession
    values = ",".join(str((*seg, nodes[seg[0]][1])) for seg in plan) or "(-1, 0L, 0L, 0, 0L, 0)"
    segments = spark.sql("SELECT CAST(col1 AS INT) arc, CAST(col2 AS BIGINT) lo, CAST(col3 AS BIGINT) hi, CAST(col4 AS INT) shard, "
                         f"CAST(col5 AS BIGINT) base, CAST(col6 AS INT) home_shard FROM VALUES {values}")
    before = Window.partitionBy("arc").orderBy("pos", "salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.select("pos", "salt", "arc", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("pos", "salt").orderBy("k", "crc", "size")
    ranked = (rows.join(starts, ["pos", "salt"])
              .withColumn("rank", F.col("start") + F.row_number().over(within) - 1))
    # one segment per arc and one more for each shard that fills: bounded by the ring
    placed = ranked.join(F.broadcast(segments), "arc").where("rank >= lo AND rank < hi")
    return placed.select(F.col("k").alias(key), "size", F.col("crc").alias("text_crc32"), "home_shard", "shard",
                         (F.col("base") + F.col("rank") - F.col("lo")).alias("slot"))
