"""Prefix trie of conversations, rolled up by centroid decomposition.

Rebuilding.  Turns are range-partitioned by (conversation, turn) and numbered in one pass
over the sorted partitions; a conversation that spans partitions goes on where the one
before ended, so no task holds a whole conversation.  A prefix of turns is known by four
polynomials of its turns' digests modulo 2^31 - 1 and its length.

Nodes.  A node is known by (least member, depth).  A member that is the least at some
depth is so at all greater ones: conversation m owns the nodes (m, d) from some depth on,
and the *stems* table has, for its smaller depths, the conversation that owns its prefix.

Roll-up.  A component is a connected part of the parent-edge forest.  Its centroid is the
deepest node whose subtree holds half of the component.  The total of the centroid's
subtree is added to all nodes from the centroid to the component's top; then the centroid
goes, and each child's part and the part above are components of their own.  Each pair of
an ancestor and a descendant is counted exactly once, in the component where they part,
and a component has at most half the weight of the one it comes from, whatever the depth
of the trie.  Components over ``limit`` nodes are split by joins; smaller ones are dealt to
tasks, many at a time, and finished there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir

P = np.uint64(2**31 - 1)
BASES = np.array([1_178_421_727, 2_003_911_463, 948_204_673, 1_517_346_811], np.uint64)
INVERSES = np.array([pow(int(b), -1, int(P)) for b in BASES], np.uint64)
HEAD = 8  # turns that a conversation takes from another at most
KEYS = ["k0", "k1", "k2", "k3"]
IDS_A_PIECE = 128  # conversation ids that are hashed together


# --- turns ------------------------------------------------------------------------------

def _powers(base: np.ndarray, n: np.ndarray) -> np.ndarray:
    """base^n modulo P, one column for each base."""
    out = np.ones((len(n), 4), np.uint64)
    square, left = base.copy(), n.astype(np.uint64)
    while left.any():
        odd = (left & np.uint64(1)).astype(bool)
        out[odd] = out[odd] * square % P
        square = square * square % P
        left = left >> np.uint64(1)
    return out


def _pieces(conv: np.ndarray) -> np.ndarray:
    """Where a new conversation begins in sorted ids."""
    return np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]]))


def _running(conv: np.ndarray, digests: np.ndarray, carry: tuple[int | None, int, np.ndarray]) -> tuple[np.ndarray, np.ndarray, tuple]:
    """Turn number (from 1) and prefix polynomials of sorted turns.  ``carry``: the last
    conversation so far, its turns and its polynomials; the new one is returned, too."""
    first = _pieces(conv)
    of = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(conv))))
    goes_on = carry[0] is not None and conv[0] == carry[0]
    number = np.arange(len(conv)) - first[of] + 1
    if goes_on:
        number[of == 0] += carry[1]
    terms = (digests % P) * _powers(BASES, number) % P
    sums = np.cumsum(terms, axis=0)  # a batch has far fewer than 2^32 rows
    before = np.where((first > 0)[:, None], sums[first - 1], np.uint64(0))
    prefix = sums - before[of]
    if goes_on:
        prefix[of == 0] += carry[2]
    prefix %= P
    return number, prefix, (int(conv[-1]), int(number[-1]), prefix[-1])


def _columns(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return (batch.column("c").to_numpy(),
            np.stack([batch.column(k).to_numpy() for k in KEYS], axis=1).astype(np.uint64))


def _end_of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row: the partition's last conversation with its turns and polynomials here."""
    carry: tuple = (None, 0, np.zeros(4, np.uint64))
    for batch in batches:
        if batch.num_rows:
            pid = batch.column("pid")[0].as_py()
            carry = _running(*_columns(batch), carry)[2]
    if carry[0] is not None:
        yield pa.RecordBatch.from_pydict({"pid": pa.array([pid], pa.int32()), "last": [carry[0]], "n": [carry[1]],
                                          "k": [[int(v) for v in carry[2]]]})


def numbered(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Each turn of a conversation (c) with its number i from 1, the UTF-8 bytes of its text
    and the polynomials k0-k3 of all turns up to it.

    Null turns come first, ties by the digest of (role, text); null role or text is empty;
    rows without a conversation are left out.
    """
    spark = turns.sparkSession
    ensure_checkpoint_dir(spark)
    who, said = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in (role, text))
    # the length tells where the role ends
    md5 = F.md5(F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, said).cast("binary"))
    rows = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("c"), F.col(turn).alias("t"), F.octet_length(said).cast("long").alias("bytes"),
        *[F.conv(F.substring(md5, 8 * i + 1, 8), 16, 10).cast("long").alias(k) for i, k in enumerate(KEYS)],
        F.monotonically_increasing_id().alias("u"))  # so that many copies of a row can be split
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["c", "t", *KEYS, "u"]
    ranged = (rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
              .select("c", *KEYS, "bytes", F.spark_partition_id().alias("pid")).checkpoint())
    ends = ranged.mapInArrow(_end_of_partition, "pid int, last long, n long, k array<long>")
    starts: dict[int, tuple] = {}
    carry: tuple = (None, 0, np.zeros(4, np.uint64))
    for r in sorted(ends.collect(), key=lambda r: r.pid):  # one row for each partition
        starts[r.pid] = carry
        k = np.array(r.k, np.uint64)
        if r["last"] == carry[0]:  # all of the partition goes on with that conversation
            carry = (carry[0], carry[1] + r.n, (carry[2] + k * _powers(BASES, np.array([carry[1]]))[0]) % P)
        else:
            carry = (r["last"], r.n, k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if now is None:
                now = starts[batch.column("pid")[0].as_py()]
            ids, digests = _columns(batch)
            number, prefix, now = _running(ids, digests, now)
            yield pa.RecordBatch.from_arrays([batch.column("c"), pa.array(number), *[pa.array(prefix[:, j].astype(np.int64)) for j in range(4)],
                                              batch.column("bytes")], names=["c", "i", *KEYS, "bytes"])

    return ranged.mapInArrow(run, "c long, i long, k0 long, k1 long, k2 long, k3 long, bytes long")


# --- rebuilt conversations --------------------------------------------------------------

def taken(conv: Column) -> Column:
    """How many turns a conversation takes from another: crc32 of its decimal id, modulo 9."""
    return F.pmod(F.crc32(conv.cast("string").cast("binary")), F.lit(HEAD + 1)).cast("int")


def source(conv: Column) -> Column:
    """Which conversation it takes them from."""
    return conv - conv % 5


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (c, e: how many rebuilt turns) and prefixes (c, d, k0-k3, bytes, e) of
    the rebuilt conversations of ``numbered`` turns, d from 1."""
    head = F.when(F.col("i") <= HEAD, F.struct("i", *KEYS, "bytes"))
    convs = (turns.groupBy("c").agg(F.max("i").alias("n"), F.sort_array(F.collect_list(head)).alias("own"))  # at most 8 turns each
             .withColumns({"h": taken(F.col("c")), "b": source(F.col("c"))}))
    lent = convs.select(F.col("c").alias("b"), F.col("own").alias("base"))
    convs = convs.join(lent, "b", "left").withColumn("base", F.coalesce(F.slice("base", F.lit(1), F.col("h")), F.array().cast(lent.schema["base"].dataType)))
    convs = convs.select("c", "h", "own", "base", (F.size("base") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("e")).checkpoint()
    first = convs.select("c", "e", F.explode("base").alias("x")).select("c", F.col("x.i").alias("d"), *[f"x.{k}" for k in KEYS], "x.bytes", "e")
    # own turns from the one after h: taken off the prefix they had, moved, put on the new one
    p = int(P)
    at = F.size("base")

    def key(j: int, k: str) -> Column:
        had = F.coalesce(F.get("own", F.col("h") - 1)[k], F.lit(0))
        new = F.coalesce(F.get("base", at - 1)[k], F.lit(0))
        back = F.array(*[F.lit(pow(int(INVERSES[j]), i, p)) for i in range(HEAD + 1)])
        return (new + (F.col(k) - had + p) % p * F.get(back, F.col("h") - at)) % p

    rest = (turns.join(convs.where("e > 0"), "c").where("i > h")
            .select("c", (at + F.col("i") - F.col("h")).cast("long").alias("d"), *[key(j, k).alias(k) for j, k in enumerate(KEYS)], "bytes", "e"))
    return convs.select("c", "e"), first.unionByName(rest)


# --- components in a task ---------------------------------------------------------------

def _roll_up(conv: np.ndarray, depth: np.ndarray, parent: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Sums of ``weights`` (rows, columns) over the subtrees of a forest of components, by
    centroid decomposition.  ``parent`` numbers the rows, -1 at the tops."""
    n = len(conv)
    size = np.ones(n, np.int64)
    order = np.argsort(depth, kind="stable")
    levels = np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)
    for rows in reversed(levels):
        rows = rows[parent[rows] >= 0]
        np.add.at(size, parent[rows], size[rows])
    # preorder: children of a node one after another
    pre = np.zeros(n, np.int64)
    at = 0
    for rows in levels:
        tops = rows[parent[rows] < 0]
        pre[tops] = at + np.cumsum(size[tops]) - size[tops]
        at += size[tops].sum()
        rows = rows[parent[rows] >= 0]
        rows = rows[np.argsort(parent[rows], kind="stable")]
        if len(rows):
            sums = np.cumsum(size[rows]) - size[rows]
            first = _pieces(parent[rows])
            of = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(rows))))
            pre[rows] = pre[parent[rows]] + 1 + sums - sums[first][of]
    end = pre + size
    total = np.zeros_like(weights)
    # rows in preorder; a component's rows keep that order among themselves
    row = np.argsort(pre)
    comp = np.cumsum(parent[row] < 0) - 1
    left = size.copy()  # rows of the subtree that are in the component
    while len(row):
        by = np.argsort(comp, kind="stable")
        row, comp = row[by], comp[by]
        start = _pieces(comp)
        of = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(row))))
        half = np.flatnonzero(2 * left[row] >= left[row[start]][of])
        centre = np.full(len(start), -1)
        centre[of[half]] = half  # the last of them in preorder is the deepest
        c = row[centre][of]
        below = (pre[row] >= pre[c]) & (pre[row] < end[c])
        above = (pre[row] <= pre[c]) & (end[row] > pre[c])
        sums = np.add.reduceat(np.where(below[:, None], weights[row], 0), start, axis=0)
        total[row[above]] += sums[of[above]]
        taken_off = left[c]
        rest = above & (row != c)
        left[row[rest]] -= taken_off[rest]
        # children of the centroid head components of their own
        child = np.flatnonzero(below & (parent[row] == c))
        name = of * 2  # the part above keeps its number
        if len(child):
            inner = np.flatnonzero(below & (row != c))
            under = np.searchsorted(child, inner, side="right") - 1
            name[inner] = 2 * len(start) + under
        keep = row != c
        row, comp = row[keep], name[keep]
    return total


def _finish(columns: list[str]) -> Callable:
    """Batches of whole components, sorted by component (tc, td), rolled up."""

    def roll(table: pa.Table) -> pa.RecordBatch:
        conv, depth, up = (table.column(x).to_numpy() for x in ("m", "d", "p"))
        top = np.stack([table.column(x).to_numpy() for x in ("tc", "td")], axis=1)
        # number nodes by (m, d) and look their parents up; a top's parent is elsewhere
        names = np.unique(conv)
        span = int(depth.max()) + 2
        ids = np.searchsorted(names, conv) * span + depth
        order = np.argsort(ids)
        at = np.searchsorted(ids[order], np.searchsorted(names, up) * span + depth - 1)
        is_top = (depth == top[:, 1]) & (conv == top[:, 0])
        parent = np.where(is_top, -1, order[np.minimum(at, len(order) - 1)])
        weights = np.stack([table.column(x).to_numpy() for x in ("leaf", "saved")], axis=1)
        total = _roll_up(conv, depth, parent, weights)
        out = {c: table.column(c) for c in columns}
        out["leaves"] = pa.array(table.column("leaves").to_numpy() + total[:, 0])
        out["tokens"] = pa.array(table.column("tokens").to_numpy() + total[:, 1])
        return pa.Table.from_pydict(out).combine_chunks().to_batches()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            tc, td = batch.column("tc").to_numpy(), batch.column("td").to_numpy()
            cut = np.flatnonzero((tc[1:] != tc[:-1]) | (td[1:] != td[:-1]))
            last = int(cut[-1]) + 1 if len(cut) else 0
            before = held[-1] if held else None
            if before is not None and (before.column("tc")[-1].as_py(), before.column("td")[-1].as_py()) != (tc[0], td[0]):
                yield roll(pa.Table.from_batches(held))
                held = []
            if last:
                yield roll(pa.Table.from_batches([*held, batch.slice(0, last)]))
                held = []
            held.append(batch.slice(last))
        if held:
            yield roll(pa.Table.from_batches(held))

    return run


# --- components over all tasks ----------------------------------------------------------

NODE = ["m", "d", "p", "o", "n_convs", "n_children", "leaf", "saved"]


MOST_SENT = 10_000  # components whose centroids are sent to all tasks; more are joined by key


def _split(big: DataFrame, stems: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """One round: the centroids of the ``n`` components in ``big`` (finished), and the rest
    in its new components."""
    def by_component(one: DataFrame) -> DataFrame:
        """A row for each component, sent to all tasks if there are few: a component that
        holds most nodes then stays spread over them."""
        one = one.checkpoint()
        return F.broadcast(one) if n <= MOST_SENT else one

    tops = by_component(big.groupBy("tc", "td").agg(F.max("weight").alias("all")))
    centre = (big.join(tops, ["tc", "td"]).where(2 * F.col("weight") >= F.col("all")).groupBy("tc", "td")
              .agg(F.max_by("m", "d").alias("cm"), F.max_by("o", "d").alias("co"), F.max_by("weight", "d").alias("cw"), F.max("d").alias("cd"))).checkpoint()
    rows = big.join(by_component(centre), ["tc", "td"])
    # whose prefixes a conversation shares at the centroid's depth and at the next one
    under = rows.where("d > cd AND cd < o").select("tc", "td", "cd", "m").distinct()
    stem = stems.select(F.col("c").alias("m"), F.col("d").alias("sd"), F.col("m").alias("sm"))
    look = (under.join(stem, "m").where("sd = cd OR sd = cd + 1").groupBy("tc", "td", "m")
            .agg(F.max(F.when(F.col("sd") == F.col("cd"), F.col("sm"))).alias("r0"), F.max(F.when(F.col("sd") > F.col("cd"), F.col("sm"))).alias("r1")))
    path = (centre.select("tc", "td", "cd", F.col("cm").alias("m")).join(stem, "m").where("sd <= cd")
            .select("tc", "td", F.col("sd").alias("d"), F.col("sm").alias("pm")))
    rows = rows.join(look, ["tc", "td", "m"], "left").join(path, ["tc", "td", "d"], "left")
    is_centre = (F.col("d") == F.col("cd")) & (F.col("m") == F.col("cm"))
    below = is_centre | ((F.col("d") > F.col("cd")) & (F.coalesce("r0", "m") == F.col("cm")))
    above = is_centre | ((F.col("d") < F.col("cd")) & (F.coalesce("pm", "cm") == F.col("m")))
    rows = rows.select("tc", "td", *NODE, "weight", "leaves", "tokens", "cd", "cw", F.coalesce("r1", "m").alias("child"),
                       is_centre.alias("is_centre"), below.alias("below"), above.alias("above")).checkpoint()
    total = by_component(rows.where("below").groupBy("tc", "td").agg(F.sum("leaf").alias("s_leaf"), F.sum("saved").alias("s_saved")))
    rows = rows.join(total, ["tc", "td"])
    out = rows.select(
        F.when(F.col("below") & ~F.col("is_centre"), F.col("child")).otherwise(F.col("tc")).alias("tc"),
        F.when(F.col("below") & ~F.col("is_centre"), F.col("cd") + 1).otherwise(F.col("td")).alias("td"), *NODE,
        F.when(F.col("above"), F.col("weight") - F.col("cw")).otherwise(F.col("weight")).alias("weight"),
        (F.col("leaves") + F.when(F.col("above"), F.col("s_leaf")).otherwise(0)).alias("leaves"),
        (F.col("tokens") + F.when(F.col("above"), F.col("s_saved")).otherwise(0)).alias("tokens"), "is_centre").checkpoint()
    return out.where("is_centre").drop("is_centre"), out.where("NOT is_centre").drop("is_centre")


def rolled_up(nodes: DataFrame, stems: DataFrame, limit: int) -> DataFrame:
    """``nodes`` with ``leaves`` and ``tokens``, the sums of leaf and saved over each subtree."""
    columns = [*NODE, "leaves", "tokens"]
    now = nodes.withColumns({"leaves": F.lit(0).cast("long"), "tokens": F.lit(0).cast("long")})
    small, done = [], []
    while True:
        large = now.groupBy("tc", "td").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > limit).drop("size").checkpoint()
        n = large.count()
        if not n:
            small.append(now)
            break
        large = F.broadcast(large) if n <= MOST_SENT else large
        small.append(now.join(large, ["tc", "td"], "left_anti"))
        finished, now = _split(now.join(large, ["tc", "td"], "left_semi"), stems, n)
        done.append(finished)
    parts = small[0]
    for more in small[1:]:
        parts = parts.unionByName(more)
    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = parts.repartition(n, "tc", "td").sortWithinPartitions("tc", "td").select("tc", "td", *columns)
    out = dealt.mapInArrow(_finish(columns), ", ".join(f"{c} long" for c in columns))
    for more in done:
        out = out.unionByName(more.select(*columns))
    return out


# --- who ends where ---------------------------------------------------------------------

def _in_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (m, d, c) as (m, d, least c, decimal ids joined by commas) of a few ids each."""
    for batch in batches:
        m, d, c = (batch.column(x).to_numpy() for x in ("m", "d", "c"))
        if not len(m):
            continue
        first = np.flatnonzero(np.concatenate([[True], (m[1:] != m[:-1]) | (d[1:] != d[:-1])]))
        starts = np.concatenate([np.arange(a, b, IDS_A_PIECE) for a, b in zip(first, np.append(first[1:], len(m)), strict=True)])
        ids = c.astype(str)
        text = [",".join(ids[a:b]) for a, b in zip(starts, np.append(starts[1:], len(m)), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(m[starts]), pa.array(d[starts]), pa.array(c[starts]), pa.array(text)], names=["m", "d", "c", "ids"])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's pieces in order, joined by commas; holds one piece at a time."""
    at, state = None, None
    for batch in batches:
        ms, ds, out = [], [], []
        for m, d, ids in zip(*(batch.column(x).to_pylist() for x in ("m", "d", "ids")), strict=True):
            if (m, d) == at:
                state.update(b"," + ids.encode())
                continue
            if at is not None:
                ms.append(at[0])
                ds.append(at[1])
                out.append(state.hexdigest())
            at, state = (m, d), hashlib.sha256(ids.encode())
        yield pa.RecordBatch.from_pydict({"m": pa.array(ms, pa.int64()), "d": pa.array(ds, pa.int64()), "sha": pa.array(out, pa.string())})
    if at is not None:
        yield pa.RecordBatch.from_pydict({"m": [at[0]], "d": [at[1]], "sha": [state.hexdigest()]})


def ends(members: DataFrame) -> DataFrame:
    """(m, d, sha) of nodes (m, d) at which conversations c end.  Ids are sorted and joined
    in all tasks; one task hashes a node's joined pieces, one after another."""
    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = members.repartitionByRange(n, "m", "d", "c").sortWithinPartitions("m", "d", "c").mapInArrow(_in_pieces, "m long, d long, c long, ids string")
    return pieces.repartition(n, "m", "d").sortWithinPartitions("m", "d", "c").mapInArrow(_hashed, "m long, d long, sha string")


# --- the trie ---------------------------------------------------------------------------

def trie(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", limit: int = 512) -> DataFrame:
    """The nodes of the prefix trie of the rebuilt conversations: conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Turns are ordered by ``turn``, null first; equal ones by a digest of (role, text), and
    repeated rows are turns of their own.  Null role or text is empty.  Rows without a
    conversation id belong to none and are left out; other columns are not read.  The root
    (depth 0) has no text and no parent.  A table without conversations gives no rows.
    """
    spark = turns.sparkSession
    convs, prefixes = rebuilt(numbered(turns, conv, turn, role, text))
    prefixes = prefixes.checkpoint()
    zero = F.lit(0).cast("long")
    total = convs.agg(F.min("c").alias("m"), F.count(F.lit(1)).alias("n_convs"), F.sum(F.col("e") + 1).alias("weight")).first()  # one row
    if total.m is None:
        return spark.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    root = F.lit(total.m).cast("long")
    top = spark.range(1).select(zero.alias("d"), root.alias("m"), F.lit(total.n_convs).cast("long").alias("n_convs"), zero.alias("bytes"),
                                F.lit(total.weight).cast("long").alias("weight"))
    named = (prefixes.groupBy("d", *KEYS).agg(F.min("c").alias("m"), F.count(F.lit(1)).alias("n_convs"), F.max("bytes").alias("bytes"),
                                              F.sum(F.col("e") - F.col("d") + 1).alias("weight")).checkpoint())
    # who owns each prefix, and from which depth on a conversation owns its own
    owners = prefixes.select("c", "d", "e", *KEYS).join(named.select("d", "m", *KEYS), ["d", *KEYS]).select("c", "d", "e", "m").checkpoint()
    own = (named.groupBy(F.col("m").alias("c")).agg(F.min("d").alias("o"))
           .withColumn("o", F.when(F.col("c") == root, zero).otherwise(F.col("o"))))
    stems = (owners.join(own, "c").where("d < o").select("c", "d", "m", "o")
             .unionByName(own.where("o > 0").select("c", zero.alias("d"), root.alias("m"), "o")).checkpoint())
    # the parent of (m, d) is (m, d - 1), or the end of m's stem
    stem_end = stems.where("d = o - 1").select(F.col("c").alias("m"), "o", F.col("m").alias("stem"))
    nodes = (named.drop(*KEYS).unionByName(top).join(stem_end, "m", "left").withColumn("o", F.coalesce("o", zero))
             .withColumn("p", F.when(F.col("d") == 0, F.lit(-1).cast("long")).when(F.col("d") == F.col("o"), F.col("stem")).otherwise(F.col("m")))).checkpoint()
    children = nodes.where("d > 0").groupBy(F.col("p").alias("m"), (F.col("d") - 1).alias("d")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = (nodes.join(children, ["m", "d"], "left").withColumn("n_children", F.coalesce("n_children", zero))
             .select("m", "d", "p", "o", "n_convs", "n_children", (F.col("n_children") == 0).cast("long").alias("leaf"),
                     ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"), "weight", root.alias("tc"), zero.alias("td"))).checkpoint()
    rolled = rolled_up(nodes, stems.select("c", "d", "m"), limit)
    ended = (owners.where("d = e").select("m", "d", "c")
             .unionByName(convs.where("e = 0").select(root.alias("m"), zero.alias("d"), "c")))
    out = rolled.join(ends(ended), ["m", "d"], "left")
    return out.select(F.col("m").alias("conv_id"), F.col("d").alias("depth"), F.when(F.col("d") > 0, F.col("p")).alias("parent_conv_id"), "n_convs",
                      "n_children", F.col("leaves").alias("n_leaves"), F.col("tokens").alias("saved_tokens"),
                      F.coalesce("sha", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))


def oracle_sql() -> str:
    """The same nodes by plain sums over all pairs of an ancestor and a descendant; crc32
    from its table's rule, byte by byte."""
    crc = """list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
      lambda a, s: xor(a >> 8, list_reduce([xor(a, s) & 255, 1, 2, 3, 4, 5, 6, 7, 8]::BIGINT[],
        lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)))"""
    return f"""
WITH t AS (SELECT conv_id c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) i,
             coalesce(role, '') r, coalesce(text, '') s FROM conversations WHERE conv_id IS NOT NULL),
h AS (SELECT c, xor({crc}, 4294967295) % 9 h FROM (SELECT DISTINCT c FROM t)),
x AS (SELECT h.c, t.i d, r, s FROM h JOIN t ON t.c = h.c - h.c % 5 WHERE t.i <= h),
y AS (SELECT c, d, r, s FROM x UNION ALL
      SELECT t.c, t.i - h.h + coalesce(k, 0), r, s FROM t JOIN h USING (c) LEFT JOIN (SELECT c, count(*) k FROM x GROUP BY 1) USING (c) WHERE t.i > h.h),
z AS (SELECT c, d, strlen(s) bytes, list(struct_pack(r := r, s := s)) OVER (PARTITION BY c ORDER BY d) k FROM y
      UNION ALL SELECT c, 0, 0, [] FROM h),
e AS (SELECT c, max(d) e FROM z GROUP BY 1),
o AS (SELECT c, d, min(c) OVER (PARTITION BY k) m, bytes FROM z),
n AS (SELECT m, d, count(*) n, max(bytes) bytes, string_agg(CASE WHEN d = e THEN c::VARCHAR END, ',' ORDER BY c) ids FROM o JOIN e USING (c) GROUP BY 1, 2),
p AS (SELECT n.m, n.d, q.m p FROM n LEFT JOIN o q ON q.c = n.m AND q.d = n.d - 1),
l AS (SELECT p m, d - 1 d, count(*) k FROM p WHERE d > 0 GROUP BY 1, 2),
w AS (SELECT n.m, n.d, (l.k IS NULL)::INT leaf, (n - 1) * bytes saved FROM n LEFT JOIN l USING (m, d)),
u AS (SELECT o.m, o.d, sum(leaf) leaves, sum(saved) saved FROM w JOIN o ON o.c = w.m AND o.d <= w.d GROUP BY 1, 2)
SELECT n.m conv_id, n.d depth, p.p parent_conv_id, n.n n_convs, coalesce(l.k, 0) n_children, u.leaves::BIGINT n_leaves, u.saved::BIGINT saved_tokens,
  sha256(coalesce(ids, '')) ends_sha256
FROM n JOIN p USING (m, d) JOIN u USING (m, d) LEFT JOIN l USING (m, d)"""
