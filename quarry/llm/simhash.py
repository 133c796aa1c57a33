"""SimHash near-duplicates with pivot distance tables.

Reference fingerprints (pivots): the zero word, 32 words with two neighbouring bits set,
and 31 pseudo-random words.  Every distinct fingerprint has a table row of its Hamming
distances to them.  Two fingerprints within k bits differ by at most k in each of these
coordinates.

The first 33 distances also give the number of set bits of each bit pair: (d0 - di + 2) / 2.
Within k bits at most k of these 32 numbers differ, so of k + 3 groups of them at least
three agree: every triple of groups keys an exact index from which the candidate pairs
come.  Candidates go when their largest coordinate difference exceeds k; survivors are
verified by their Hamming distance.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.graph import cells, components
from quarry.session import ensure_checkpoint_dir

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
PIVOTS = np.array([0, *(3 << (2 * i) for i in range(32)),
                   *(xxhash.xxh64_intdigest(f"pivot {i}") for i in range(31))], np.uint64)
HOT = 4096    # distinct fingerprints of one index key in a cell's block
DENSE = 24    # longer runs of a key are searched breadth first


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def fingerprint(text: str | None, words: int) -> int:
    """Bit i is set if it is in over half the hashes of the text's shingles."""
    parts = (text or "").encode().translate(LOWER).split()  # splits at 20, 09-0D only
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    n = max(1, len(parts) - words + 1)
    starts = [0, *(ends[:n - 1] + 1).tolist()]
    stops = ends[-n:].tolist()
    digest = xxhash.xxh64_digest
    counts = np.zeros(64, np.int64)
    for i in range(0, n, 65536):  # bounds the memory of very long texts
        h = b"".join([digest(joined[a:b], 42) for a, b in zip(starts[i:i + 65536], stops[i:i + 65536], strict=True)])
        counts += np.unpackbits(np.frombuffer(h, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = 3, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc``, text_key (hash of the text), fp (the fingerprint as a signed long).  Null and
    wordless texts have zero."""
    kind = docs.schema[doc].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t.as_py(), words) for t in b.column(2)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps.view(np.int64))], names=["k", "text_key", "fp"])

    narrow = docs.select(F.col(doc).alias("k"), text_key(docs[text]).alias("text_key"), F.col(text).cast("string").alias("t"))
    return narrow.mapInArrow(run, f"k {kind}, text_key bigint, fp bigint").withColumnRenamed("k", doc)


def pivot_table(fps: np.ndarray) -> np.ndarray:
    """Hamming distances (rows: fingerprints, columns: pivots)."""
    return np.bitwise_count(fps[:, None] ^ PIVOTS[None, :])


def index_keys(fps: np.ndarray, max_bits: int) -> np.ndarray:
    """Keys (rows: fingerprints, columns: triples of groups) from the pivot table."""
    d = pivot_table(fps).astype(np.int64)
    pairs = (d[:, :1] - d[:, 1:33] + 2) // 2  # set bits of each bit pair: 0, 1 or 2
    groups = np.array_split(np.arange(32), max_bits + 3)
    codes = [pairs[:, g] @ (3 ** np.arange(len(g))) for g in groups]
    keys = []
    for no, (i, j, k) in enumerate(itertools.combinations(range(len(groups)), 3)):
        key = np.full(len(fps), no, np.int64)
        for g in (i, j, k):
            key = key * 3 ** len(groups[g]) + codes[g]
        keys.append(key)
    return np.stack(keys, axis=1)


def links_in(fps: np.ndarray, max_bits: int) -> Iterator[tuple[int, int]]:
    """Links that span the components of a set of fingerprints (not all pairs)."""
    table = pivot_table(fps).astype(np.int8)
    left = np.arange(len(fps))
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = left
            for p in range(33, 41):  # a few coordinates discard nearly all
                near = near[np.abs(table[near, p] - table[x, p]) <= max_bits]
            near = near[np.abs(table[near] - table[x]).max(axis=1) <= max_bits] if len(near) else near
            near = near[np.bitwise_count(fps[near] ^ fps[x]) <= max_bits]
            if len(near):
                left = np.setdiff1d(left, near, assume_unique=True)
                queue += near.tolist()
                yield from ((int(fps[x]), int(fps[y])) for y in near)


def link_runs(keys: np.ndarray, fps: np.ndarray, max_bits: int) -> np.ndarray:
    """Links (rows of two fingerprints) among equal keys; ``keys`` are sorted."""
    edge = np.flatnonzero(np.diff(keys)) + 1
    starts = np.concatenate([[0], edge])
    sizes = np.diff(np.concatenate([starts, [len(keys)]]))
    found = []
    small = np.repeat((sizes > 1) & (sizes <= DENSE), sizes)
    k, f = keys[small], fps[small]
    if len(k):
        table = pivot_table(f).astype(np.int8)
        for s in range(1, int(sizes[(sizes > 1) & (sizes <= DENSE)].max())):
            i = np.flatnonzero(k[s:] == k[:-s])
            for part in np.array_split(i, max(1, len(i) // 100_000)):
                part = part[np.abs(table[part] - table[part + s]).max(axis=1) <= max_bits] if len(part) else part
                part = part[np.bitwise_count(f[part] ^ f[part + s]) <= max_bits]
                found.append(np.stack([f[part], f[part + s]], axis=1))
    for a, n in zip(starts[sizes > DENSE].tolist(), sizes[sizes > DENSE].tolist(), strict=True):
        found.append(np.array(list(links_in(np.unique(fps[a:a + n]), max_bits)), np.uint64).reshape(-1, 2))
    return np.concatenate(found) if found else np.empty((0, 2), np.uint64)


def links(distinct: DataFrame, max_bits: int) -> DataFrame:
    """(a, b): links that span the same components as all pairs of ``fp`` within
    ``max_bits``; between fingerprints that share an index key with few others, all."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = b.column(0).to_numpy().view(np.uint64)
            for i in range(0, len(fps), 4096):
                keys = index_keys(fps[i:i + 4096], max_bits)
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(fps[i:i + 4096], keys.shape[1]).view(np.int64))],
                                                 names=["key", "fp"])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_k, keep_c, keep_f = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
        for b in itertools.chain(batches, [None]):
            if b is not None:
                keep_k = np.concatenate([keep_k, b.column(0).to_numpy()])
                keep_c = np.concatenate([keep_c, b.column(1).to_numpy()])
                keep_f = np.concatenate([keep_f, b.column(2).to_numpy().view(np.uint64)])
            if not len(keep_k):
                continue
            new = np.concatenate([[True], (np.diff(keep_k) != 0) | (np.diff(keep_c) != 0)])
            run = np.cumsum(new)
            end = len(run) if b is None else int(np.flatnonzero(new)[-1])  # the last run may go on
            if end:
                out = link_runs(run[:end], keep_f[:end], max_bits).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(out[:, 0]), pa.array(out[:, 1])], names=["a", "b"])
                keep_k, keep_c, keep_f = keep_k[end:], keep_c[end:], keep_f[end:]

    rows = distinct.select("fp").mapInArrow(keyed, "key bigint, fp bigint")
    met = cells(rows, "key", "fp", HOT)
    return (met.repartition("key", "cell").sortWithinPartitions("key", "cell", "fp").select("key", F.col("cell").cast("long").alias("cell"), "fp")
            .mapInArrow(link, "a bigint, b bigint").distinct())


def near_duplicates(docs: DataFrame, words: int = 3, max_bits: int = 3, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc``, text_key, fp, root (the component's least fingerprint), component_id (the least
    ``doc`` reachable over links, itself included) for every input row.

    Null and wordless texts share the fingerprint zero.  Null ids never name a component
    that has another id.  Repeated rows are kept, an empty table gives no rows, other
    columns are not read.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    rows = fingerprints(docs, words, doc, text).select(F.col(doc).alias("k"), "text_key", "fp").checkpoint()
    classes = rows.groupBy("fp").agg(F.min("k").alias("least")).checkpoint()
    roots = components(links(classes, max_bits)).checkpoint()
    linked = roots.join(classes, roots["node"] == classes["fp"]).select("fp", "root", "least")
    joint = linked.join(linked.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "root", "component_id")
    named = classes.join(joint, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), F.coalesce("component_id", "least").alias("component_id"))
    # written, so that both sides of the join are shuffled for it and a hot one can be split
    return rows.join(named.checkpoint(), "fp").select(F.col("k").alias(doc), "text_key", "fp", "root", "component_id")


def keep_one(docs: DataFrame, words: int = 3, max_bits: int = 3, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with all columns, one row of each component: that of the least id (a null id
    only where there is no other; of repeated rows one)."""
    found = near_duplicates(docs, words, max_bits, doc, text)
    first = found.groupBy("root").agg(F.min(F.struct(F.col(doc).isNull().alias("n"), F.col(doc).alias("d"), F.col("text_key").alias("k"))).alias("w"))

    def row_key(d: Column, k: Column) -> Column:
        return F.md5(F.concat_ws(" ", d.cast("string"), k.cast("string")).cast("binary"))

    keys = first.select(row_key(F.col("w.d"), F.col("w.k")).alias("__row"))
    marked = docs.withColumn("__row", row_key(docs[doc], text_key(docs[text])))
    return marked.join(keys, "__row", "left_semi").dropDuplicates(["__row"]).drop("__row")
