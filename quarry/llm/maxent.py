"""Language model: hashed maximum entropy over n-gram and skip features, softmax factored by
word classes.

log P(w | text before) = log P(class of w | features) + log P(w | class).

Classes: each of the most frequent words is a class of its own; all others, unseen ones too,
fall into classes by their last two bytes.  The class softmax has one weight row for each
hashed feature: the previous word, the word before it (skip) and both together (bigram).
Frequent words keep a feature row of their own, others share one by their last three bytes.
The word softmax within a class has the word's own count as its only feature, for which the
best weights are known: smoothed relative counts.

Training starts from the class counts of each feature (their log ratio to the class shares)
and then takes distributed gradient steps: every task scores its tokens in sparse numpy
batches, sums (observed - expected) per feature row, and Spark adds the tasks' sums.  Each
step uses its share of the texts of all the corpus; together the steps cover it once.

Words outside the ``head`` are looked up by a shuffle on their 64-bit hash.  None of them is
frequent enough to be a hot key: a word that were would be in the head.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.words import EMPTY, Words, blocks
from quarry.session import ensure_checkpoint_dir

OWN = 24             # words that are classes of their own
CLASSES = 48
HEAD = 1 << 17       # most words whose counts every task holds
ROWS = 1 << 12       # weight rows of each feature
OWN_ROWS = 3072      # words with a feature row of their own
GROUPS = 3           # previous word, word before it, both
ALPHA = 0.1          # added to every count
BATCH = 1 << 13      # tokens scored at a time
SLOTS = 1 << 20      # of a worker's two tables of the head


def spread(n: np.ndarray, size: int) -> np.ndarray:
    return ((n.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % size


def tokens_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash (63 bits), ending class and ending row of the tokens of all texts, and the texts'
    sizes; every text closes with the end token, which has no bytes."""
    w = Words(texts)
    off = np.searchsorted(w.line, w.first_line)
    counts = np.diff(off)
    n = len(texts)
    at = np.arange(len(w.hash)) + np.repeat(np.arange(n), counts)

    def close(values: np.ndarray, end: int) -> np.ndarray:
        out = np.full(len(w.hash) + n, end, values.dtype)
        out[at] = values
        return out

    two, three = close(w.last(2), 0), close(w.last(3), 0)
    return (close((w.hash >> np.uint64(1)).view(np.int64), int(EMPTY >> np.uint64(1))), OWN + spread(two, CLASSES - OWN),
            OWN_ROWS + spread(three, ROWS - OWN_ROWS), counts + 1)


@dataclass
class Vocabulary:
    """The head words' hashes by rank, and totals over the training tokens."""
    hashes: np.ndarray
    counts: np.ndarray
    tokens: int            # N
    distinct: int          # V
    class_tokens: np.ndarray
    class_words: np.ndarray
    weights: np.ndarray | None = None  # groups x rows x classes
    bias: np.ndarray | None = None     # log shares of the classes


class Coder:
    """Codes tokens: the head rank, or else -1 - hash; class; feature row.

    Two tables of ranks by different bits of the hash find the head words; where words fall
    into one slot the more frequent has it.  A word without a slot in either counts as
    outside the head, which is never one of the frequent ones."""

    def __init__(self, vocab: Vocabulary):
        self.hashes = np.append(vocab.hashes, -1)
        self.tables = []
        for shift in (0, 24):
            table = np.full(SLOTS, len(vocab.hashes), np.int32)
            slot = (vocab.hashes >> shift) & (SLOTS - 1)
            table[slot[::-1]] = np.arange(len(vocab.hashes), dtype=np.int32)[::-1]
            self.tables.append((shift, table))

    def texts(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Codes, classes and feature rows of the tokens of all texts, and the texts' sizes."""
        h, kind, row, size = tokens_of(texts)
        code = -1 - h
        for shift, table in self.tables:
            rank = table[(h >> shift) & (SLOTS - 1)]
            code = np.where(self.hashes[rank] == h, rank, code)
        return code, np.where((code >= 0) & (code < OWN), code, kind), np.where((code >= 0) & (code < OWN_ROWS), code, row), size


def features(row: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Rows of the three features of every token (groups x tokens); before a text's start
    stands the last row."""
    starts = np.cumsum(size) - size
    none = ROWS - 1
    one = np.concatenate([[none], row[:-1]])
    one[starts] = none
    two = np.concatenate([[none], one[:-1]])
    two[starts] = none
    both = ((one * 0x9E3779B1 + two * 0x85EBCA77) >> 7) & (ROWS - 1)
    return np.stack([one, two, both])


def log_classes(vocab: Vocabulary, f: np.ndarray) -> np.ndarray:
    """log P(class | features), tokens x classes."""
    z = vocab.bias + vocab.weights[0][f[0]]
    for g in range(1, GROUPS):
        z += vocab.weights[g][f[g]]
    z -= z.max(axis=1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def train_rows(docs: DataFrame, mod: int, rest: int, doc: str, text: str) -> DataFrame:
    """Texts that are learned from, with a number that deals them to gradient steps."""
    crc = F.crc32(F.coalesce(F.col(doc).cast("string"), F.lit("")).cast("binary"))
    return docs.where(F.pmod(crc, F.lit(mod)) != rest).select(F.col(text).cast("string").alias("t"), F.xxhash64(text).alias("h"))


def vocabulary(train: DataFrame) -> tuple[Vocabulary, DataFrame]:
    """The vocabulary of the training texts, and (wh, c): the count of every word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def merged() -> tuple[np.ndarray, ...]:
            h, kind, n = (np.concatenate(x) for x in zip(*held, strict=True))
            words, at, inverse = np.unique(h, return_index=True, return_inverse=True)
            return words, kind[at], np.bincount(inverse, weights=n).astype(np.int64)

        for _, some in blocks(t.as_py() for b in batches for t in b.column(0)):
            h, kind, _, _ = tokens_of(some)
            held.append((h, kind, np.ones(len(h), np.int64)))
            if sum(len(x[0]) for x in held) > 2_000_000:
                held = [merged()]
                if len(held[0][0]) > 1_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in held.pop()], names=["wh", "kind", "n"])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in merged()], names=["wh", "kind", "n"])

    counts = (train.select("t").mapInArrow(count, "wh bigint, kind bigint, n bigint").groupBy("wh")
              .agg(F.sum("n").alias("c"), F.max("kind").alias("kind")).checkpoint())
    # the head: all words from a count on that few enough reach, found from a short histogram
    step = F.floor(F.log2("c") * 64)
    at_least, room = None, HEAD
    for r in counts.groupBy(step.alias("s")).count().orderBy(F.desc("s")).collect():  # at most 64 rows per doubling
        room -= r["count"]
        if room < 0:
            break
        at_least = r.s
    head = counts.where(step >= at_least).collect() if at_least is not None else []  # at most HEAD rows
    head.sort(key=lambda r: (-r.c, r.wh))
    tokens, words = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    for r in counts.groupBy("kind").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("n")).collect():  # at most CLASSES
        tokens[r.kind], words[r.kind] = r.c, r.n
    total, distinct = int(tokens.sum()), int(words.sum())
    for i, r in enumerate(head[:OWN]):
        tokens[i], words[i] = r.c, 1
        tokens[r.kind] -= r.c
        words[r.kind] -= 1
    return Vocabulary(np.array([r.wh for r in head], np.int64), np.array([r.c for r in head], np.int64), total, distinct, tokens, words), counts.select("wh", "c")


def summed(parts: DataFrame, shape: tuple[int, ...]) -> np.ndarray:
    """Sum of the tasks' dense arrays, sent in slices (slice number, float32 bytes); the whole,
    whose size is the model's, reaches the driver."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for i, data in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                got = np.frombuffer(data.as_buffer(), np.float32)
                sums[i] = sums[i] + got if i in sums else got.astype(np.float64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], names=["i", "data"])

    out = np.zeros(shape).reshape(-1, SLICE)
    for r in parts.repartition("i").mapInArrow(add, "i int, data binary").collect():
        out[r.i] = np.frombuffer(r.data, np.float64)
    return out.reshape(shape)


SLICE = 64 * CLASSES


def slices(total: np.ndarray) -> Iterator[pa.RecordBatch]:
    flat = total.astype(np.float32).reshape(-1, SLICE)
    used = np.flatnonzero(flat.any(axis=1))
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array([flat[i].tobytes() for i in used], pa.binary())], names=["i", "data"])


def fit(docs: DataFrame, mod: int = 10, rest: int = 0, steps: int = 2, rate: float = 0.5, doc: str = "doc_id",
        text: str = "text") -> tuple[Vocabulary, DataFrame]:
    """Model and word counts, from all documents whose crc32 (of the id's text) mod ``mod`` is
    not ``rest``."""
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    train = train_rows(docs, mod, rest, doc, text)
    vocab, counts = vocabulary(train)
    shape = (GROUPS, ROWS, CLASSES)
    sent = spark.sparkContext.broadcast(vocab)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, total = Coder(sent.value), np.zeros(shape)
        for _, some in blocks(t.as_py() for b in batches for t in b.column(0)):
            _, kind, row, size = coder.texts(some)
            f = features(row, size)
            for g in range(GROUPS):
                total[g] += np.bincount(f[g] * CLASSES + kind, minlength=ROWS * CLASSES).reshape(ROWS, CLASSES)
        yield from slices(total)

    n = summed(train.select("t").mapInArrow(cells, "i int, data binary"), shape)
    share = (vocab.class_tokens + 1) / (vocab.tokens + CLASSES)
    seen = n.sum(axis=2, keepdims=True)
    vocab.bias = np.log(share).astype(np.float32)
    # each feature alone would add its log ratio; half of it, as the features overlap
    vocab.weights = (0.5 * np.log((n + 20 * share) / (seen + 20) / share)).astype(np.float32)

    for step in range(steps):
        now = spark.sparkContext.broadcast(vocab)

        def gradient(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            model = now.value
            coder, total = Coder(model), np.zeros(shape, np.float32)
            for _, some in blocks(t.as_py() for b in batches for t in b.column(0)):
                _, kind, row, size = coder.texts(some)
                every = features(row, size)
                for i in range(0, len(kind), BATCH):
                    f, k = every[:, i:i + BATCH], kind[i:i + BATCH]
                    rest_ = -np.exp(log_classes(model, f))
                    rest_[np.arange(len(k)), k] += 1
                    for g in range(GROUPS):
                        order = np.argsort(f[g].astype(np.uint16), kind="stable")  # 16 bits sort by radix
                        at = f[g][order]
                        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
                        total[g][at[first]] += np.add.reduceat(rest_[order], first, axis=0)
            yield from slices(total)

        dealt = train.where(F.pmod("h", F.lit(steps)) == step).select("t")
        g = summed(dealt.mapInArrow(gradient, "i int, data binary"), shape)
        expected = seen / steps * share + 20 / steps  # scale of each weight's curvature
        vocab.weights = (vocab.weights + rate * np.clip(g / expected, -1, 1)).astype(np.float32)
    return vocab, counts


def score(docs: DataFrame, vocab: Vocabulary, counts: DataFrame, mod: int = 10, rest: int = 0, doc: str = "doc_id",
          text: str = "text") -> DataFrame:
    """One row per input row: ``doc``, held_out, n_tokens, n_known (their word occurs in
    training), train_tokens, base_score (add-0.1 unigrams) and score, both log10.

    Null texts count as empty, which leaves the end token.  Null ids hash as empty text.
    Repeated rows are scored each, an empty table gives no rows (and trains a model of
    unseen words), other columns are not read.
    """
    kind = docs.schema[doc].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(vocab)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = sent.value
        coder = Coder(v)
        base_all = np.log10(v.tokens + ALPHA * (v.distinct + 1))
        class_all = np.log10(v.class_tokens + ALPHA * (v.class_words + 1))
        log_count = np.log10(v.counts + ALPHA)
        for b in (whole.slice(first, len(some)) for whole in batches for first, some in blocks(whole.column(2).to_pylist())):
            code, klass, row, size = coder.texts([(t.as_py() or "").encode() for t in b.column(2)])
            starts = np.cumsum(size) - size
            every = features(row, size)
            by_class = np.empty(len(code))
            for i in range(0, len(code), BATCH):
                k = klass[i:i + BATCH]
                by_class[i:i + BATCH] = log_classes(v, every[:, i:i + BATCH])[np.arange(len(k)), k]
            known = code >= 0
            own = np.where(known, log_count[np.maximum(code, 0)], 0.0) if len(log_count) else np.zeros(len(code))
            base = np.add.reduceat(own - base_all, starts)
            full = np.add.reduceat(own + by_class / np.log(10) - class_all[klass], starts)
            rows = b.num_rows
            # words outside the head: one row per text and word, to be joined with their counts
            owner = np.repeat(np.arange(rows), size)[~known]
            wh = -1 - code[~known]
            order = np.lexsort((wh, owner))
            owner, wh = owner[order], wh[order]
            new = np.concatenate([[True], (np.diff(owner) != 0) | (np.diff(wh) != 0)]) if len(wh) else np.empty(0, bool)
            first = np.flatnonzero(new)
            tf = np.diff(np.concatenate([first, [len(wh)]]))
            key = b.column(1).to_numpy()
            m = len(first)
            yield pa.RecordBatch.from_arrays([b.column(1), b.column(1), b.column(0), pa.array(size), pa.array(np.add.reduceat(known.astype(np.int64), starts)),
                                              pa.array(base), pa.array(full)], names=NAMES)
            if m:
                yield pa.RecordBatch.from_arrays([pa.array(key[owner[first]]), pa.array(wh[first]), pa.nulls(m, b.schema.field(0).type), pa.array(-tf),
                                                  pa.nulls(m, pa.int64()), pa.nulls(m, pa.float64()), pa.nulls(m, pa.float64())], names=NAMES)

    narrow = docs.select(F.col(doc).alias("k"), F.xxhash64(F.col(doc).cast("string"), F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("rk"),
                         F.col(text).cast("string").alias("t"))
    parts = narrow.mapInArrow(run, f"rk bigint, wh bigint, k {kind}, n bigint, known bigint, base double, full double")
    met = parts.join(counts, "wh", "left")  # a text's own row carries its key as wh and is told by n > 0
    tail = F.col("n") < 0
    there = F.when(tail & F.col("c").isNotNull(), -F.col("n")).otherwise(0)
    part = F.when(tail, -F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + F.lit(ALPHA)))
    per = met.groupBy("rk").agg(
        F.max("k").alias("k"), F.count_if(~tail).alias("copies"), F.max("n").alias("n_tokens"), F.max("known").alias("known"),
        F.max("base").alias("base"), F.max("full").alias("full"), F.sum(there).alias("there"), F.coalesce(F.sum(part), F.lit(0.0)).alias("part"))
    per = per.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))
    crc = F.crc32(F.coalesce(F.col("k").cast("string"), F.lit("")).cast("binary"))
    return per.select(F.col("k").alias(doc), (F.pmod(crc, F.lit(mod)) == rest).alias("held_out"), "n_tokens",
                      (F.col("known") + (F.col("there") / F.col("copies")).cast("long")).alias("n_known"), F.lit(vocab.tokens).cast("long").alias("train_tokens"),
                      (F.col("base") + F.col("part") / F.col("copies")).alias("base_score"), (F.col("full") + F.col("part") / F.col("copies")).alias("score"))


NAMES = ["rk", "wh", "k", "n", "known", "base", "full"]
