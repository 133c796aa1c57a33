"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted
index, distance-weighted votes, votes calibrated by leave-one-out frequencies.

Terms are words, as ``^word$``, and the 5-character pieces of that (so inflected and joined
forms share terms).  The terms that count are all those much more frequent in toxic examples
than in the others, however rare.  A text's vector has (1 + ln tf) * idf * g2 of these, scaled
to length 1; g2, the log-likelihood ratio of a term's counts, keeps words that toxic examples
have by chance from counting like insults.

Examples are ordered so that similar ones are neighbours, and cut into blocks.  The index
holds, for each term, its postings and its largest weight in each block.  A query sums
these into an upper bound of the cosine of every block, visits blocks from the highest
bound down, and stops when the bound falls below the k-th cosine found: the k nearest are
exact.  The model's size is set by ``max_examples`` and their texts, whatever the corpus.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir

SEPARATOR = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")  # of lower-cased text
GRAM, BLOCK, BINS = 5, 32, 50


def marked(text: str | None) -> str:
    """Lower-cased words, each as ``^word$``, end to end."""
    return "^" + SEPARATOR.sub("$^", (text or "").lower()) + "$"


def terms_of(word: str) -> set[str]:
    """``^word$`` and its pieces."""
    return {word, *(word[i:i + GRAM] for i in range(len(word) - GRAM + 1))}


def spread(start: np.ndarray, ids: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the entries of all ``ids`` in a flat table, and the ``w`` of each."""
    n = start[ids + 1] - start[ids]
    return np.repeat(start[ids] - np.cumsum(n) + n, n) + np.arange(n.sum()), np.repeat(w, n)


@dataclass
class Model:
    terms: dict[str, int]
    idf: np.ndarray        # times g2
    start: np.ndarray      # of each term's postings
    example: np.ndarray    # postings: ascending example numbers of each term
    weight: np.ndarray
    block_start: np.ndarray  # of each term's blocks
    block: np.ndarray      # ascending blocks of each term
    block_max: np.ndarray  # its largest weight in each
    label: np.ndarray
    ids: np.ndarray        # document ids of the examples
    prior: float           # share of toxic examples among those without any term
    k: int
    curve: np.ndarray | None = None  # calibrated score at the middle of each bin of votes
    finder: object = None  # of the terms, made where it is used

    def __getstate__(self) -> dict:
        return self.__dict__ | {"finder": None}

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and weights of a text's terms, found in one pass over it."""
        if self.finder is None:
            self.finder = ahocorasick.Automaton()
            for t, i in self.terms.items():
                self.finder.add_word(t, i)
            self.finder.make_automaton()
        if not self.terms:
            return np.empty(0, np.int64), np.empty(0)
        tf = Counter(i for _, i in self.finder.iter(marked(text)))
        ids = np.array(sorted(tf), np.int64)
        w = (1 + np.log(np.array([tf[i] for i in ids.tolist()], float))) * self.idf[ids] if len(ids) else np.empty(0)
        return ids, w / np.linalg.norm(w) if len(w) else w

    def nearest(self, ids: np.ndarray, w: np.ndarray, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and cosines of the k nearest examples, exactly; the lower number wins
        ties.  ``skip`` is left out (an example must not find itself)."""
        at, q = spread(self.block_start, ids, w)
        bound = np.bincount(self.block[at], q * self.block_max[at], len(self.label) // BLOCK + 1)
        at, q = spread(self.start, ids, w)
        post, part = self.example[at], q * self.weight[at]
        order = np.argsort(-bound, kind="stable")
        total = np.zeros(len(self.label))
        best, cos, i, step = np.empty(0, np.int64), np.empty(0), 0, 8
        while i < len(order) and bound[order[i]] > 0 and (len(cos) < self.k or bound[order[i]] >= cos[-1] - 1e-12):
            visit = np.zeros(len(bound), bool)
            visit[order[i:i + step]] = True
            take = visit[post // BLOCK]
            total += np.bincount(post[take], part[take], len(total))
            if skip >= 0:
                total[skip] = 0
            found = np.flatnonzero(total)
            best = found[np.lexsort((found, -total[found]))[:self.k]]
            cos = total[best]
            i, step = i + step, step * 2
        return best, cos

    def vote(self, near: np.ndarray, cos: np.ndarray) -> float:
        """Share of toxic neighbours, weighted by cosine, with the prior as one neighbour
        at cosine 0.5."""
        return float((cos @ self.label[near] + 0.5 * self.prior) / (cos.sum() + 0.5))

    def calibrated(self, vote: float) -> float:
        if self.curve is None:
            return vote
        return float(np.interp(vote, (np.arange(BINS) + 0.5) / BINS, self.curve))

    def score(self, text: str | None) -> float:
        ids, w = self.vector(text)
        return self.calibrated(self.vote(*self.nearest(ids, w))) if len(ids) else self.prior


def isotonic(hits: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Rising frequencies of each bin: neighbours that fall are pooled; empty bins lie
    between their neighbours."""
    pools: list[list[float]] = []
    used = np.flatnonzero(counts)
    for i in used.tolist():
        pools.append([hits[i], counts[i], 1])
        while len(pools) > 1 and pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1]:
            h, c, n = pools.pop()
            pools[-1] = [pools[-1][0] + h, pools[-1][1] + c, pools[-1][2] + n]
    rate = np.repeat([p[0] / p[1] for p in pools], [int(p[2]) for p in pools])
    return np.interp(np.arange(len(counts)), used, rate) if len(used) else (np.arange(len(counts)) + 0.5) / len(counts)


def fit(docs: DataFrame, labels: DataFrame, held_out_mod: int = 4, held_out_rest: int = 2, doc: str = "doc_id",
        text: str = "text", label: str = "toxic", max_examples: int = 20_000, min_docs: int = 1,
        min_lift: float = 5.0, min_g2: float = 0.0, k: int = 15) -> Model:
    """Model from at most ``max_examples`` labelled documents (the least by hash of their
    id), none of them held out.  Every term counts that toxic examples have ``min_lift``
    times as often as the others.  ``min_docs`` (toxic examples with it) and ``min_g2`` (the
    log-likelihood ratio of its counts) can ask for more.  Null labels are left out;
    of differing labels of a document the majority holds, toxic on a tie; of the rows of an
    id the text with the least hash is the example.  Without
    examples the model scores 0."""
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    chosen = (labels.where(F.col(label).isNotNull() & F.col(doc).isNotNull())
              .groupBy(F.col(doc).alias("k")).agg((F.avg(label) >= 0.5).cast("int").alias("y"))
              .where(F.pmod(F.crc32(F.col("k").cast("string").cast("binary")), F.lit(held_out_mod)) != held_out_rest)
              .orderBy(F.xxhash64("k"), "k").limit(max_examples))
    sample = (docs.select(F.col(doc).alias("k"), F.col(text).cast("string").alias("t"))
              .join(F.broadcast(chosen), "k")
              .groupBy("k").agg(F.min(F.struct(F.xxhash64("t").alias("h"), "t")).alias("one"), F.min("y").alias("y"))
              .select("k", "one.t", "y").checkpoint())  # one row per id, at most max_examples

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: tuple[Counter, Counter] = (Counter(), Counter())
            for i, (t, y) in enumerate(zip(b.column(0), b.column(1).to_pylist(), strict=True)):
                words = set(re.findall(r"\^[^$]+\$", marked(t.as_py())))
                seen[y].update(set().union(*map(terms_of, words)))
                if i == b.num_rows - 1 or len(seen[0]) + len(seen[1]) > 200_000:  # bounds the memory
                    for z in (0, 1):
                        yield pa.RecordBatch.from_arrays([pa.array(list(seen[z]), pa.string()), pa.array([z] * len(seen[z]), pa.int32()),
                                                          pa.array(list(seen[z].values()), pa.int64())], names=["term", "y", "n"])
                        seen[z].clear()

    total = {r.y: r["count"] for r in sample.groupBy("y").count().collect()}
    n1, n0 = total.get(1, 0), total.get(0, 0)
    by = (sample.select("t", "y").mapInArrow(count, "term string, y int, n bigint").groupBy("term")
          .agg(F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("a"),
               F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("b")))
    p, q = (F.col("a") + 0.5) / (n1 + 1.0), (F.col("b") + 0.5) / (n0 + 1.0)
    lift = p / q
    df = F.col("a") + F.col("b")
    share = (n1 + 0.5) / (n1 + n0 + 1.0)

    def surprise(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    g2 = 2 * (surprise(F.col("a"), df * share) + surprise(F.col("b"), df * (1 - share)))
    picked = (by.where((F.col("a") >= min_docs) & (lift >= min_lift) & (g2 >= min_g2))
              .select("term", df.alias("df"), g2.alias("gain")).orderBy("term").collect())  # terms of max_examples texts
    terms = {r.term: i for i, r in enumerate(picked)}
    idf = np.array([(np.log((1 + n1 + n0) / (1 + r.df)) + 1) * max(r.gain, 1e-6) for r in picked])
    bare = Model(terms, idf, np.zeros(1, int), np.empty(0, int), np.empty(0), np.zeros(1, int),
                 np.empty(0, int), np.empty(0), np.empty(0), np.empty(0), 0.0, k)
    small = spark.sparkContext.broadcast(bare)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = small.value
        for b in batches:
            out = [model.vector(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array([v[0] for v in out], pa.list_(pa.int64())),
                                              pa.array([v[1] for v in out], pa.list_(pa.float64()))], names=["k", "y", "i", "w"])

    kind = sample.schema["k"].dataType.simpleString()
    coded = sample.mapInArrow(vectors, f"k {kind}, y int, i array<bigint>, w array<double>").checkpoint()
    none = coded.where("size(i) = 0").agg(F.sum("y").alias("t"), F.count(F.lit(1)).alias("n")).first()
    rows = coded.where("size(i) > 0").select("k", "y", "i", "w").collect()  # at most max_examples short vectors
    rows.sort(key=lambda r: (r.i[int(np.argmax(r.w))], r.i, r.k))  # similar examples share blocks
    bare.prior = (none.t or 0) / none.n if none.n else 0.0
    bare.label = np.array([r.y for r in rows], float)
    bare.ids = np.array([r.k for r in rows])
    term = np.concatenate([np.empty(0, np.int64), *(r.i for r in rows)]).astype(np.int64)
    weight = np.concatenate([np.empty(0), *(r.w for r in rows)])
    example = np.repeat(np.arange(len(rows)), [len(r.i) for r in rows])
    by = np.lexsort((example, term))
    term, bare.example, bare.weight = term[by], example[by], weight[by]
    bare.start = np.searchsorted(term, np.arange(len(terms) + 1))
    block = bare.example // BLOCK
    first = np.flatnonzero(np.concatenate([[True], (np.diff(term) != 0) | (np.diff(block) != 0)])[:len(term)])
    bare.block, bare.block_start = block[first], np.searchsorted(term[first], np.arange(len(terms) + 1))
    bare.block_max = np.maximum.reduceat(bare.weight, first) if len(first) else np.empty(0)
    full = spark.sparkContext.broadcast(bare)

    def left_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = full.value
        at = {x: e for e, x in enumerate(model.ids.tolist())}
        for b in batches:
            votes = [model.vote(*model.nearest(np.array(i, np.int64), np.array(w), at.get(x, -1)))
                     for x, i, w in zip(*(b.column(c).to_pylist() for c in (0, 2, 3)), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([min(BINS - 1, int(v * BINS)) for v in votes], pa.int32()), b.column(1)], names=["bin", "y"])

    hits, counts = np.zeros(BINS), np.zeros(BINS)
    for r in coded.where("size(i) > 0").mapInArrow(left_out, "bin int, y int").groupBy("bin").agg(
            F.sum("y").alias("t"), F.count(F.lit(1)).alias("n")).collect():  # at most BINS rows
        hits[r.bin], counts[r.bin] = r.t, r.n
    bare.curve = isotonic(hits, counts)
    return bare


def score(docs: DataFrame, model: Model, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc``, score (0 to 1), nearest (ids of the nearest examples), cosines, terms (those
    the text shares with the model) for every input row.  Texts without any such term,
    empty and null ones among them, score the share of toxic examples without one.
    Repeated rows and null ids are kept, an empty table gives no rows, other columns are
    not read."""
    kind = docs.schema[doc].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        names = list(m.terms)
        known: dict[tuple, tuple] = {}
        for b in batches:
            scores, near, cosines, evidence = [], [], [], []
            for t in b.column(1):
                ids, w = m.vector(t.as_py())
                if not len(ids):
                    found = (m.prior, [], [], [])
                else:
                    key = (ids.tobytes(), w.tobytes())
                    found = known.get(key)
                    if found is None:
                        if len(known) > 50_000:
                            known.clear()
                        e, c = m.nearest(ids, w)
                        found = known[key] = (m.calibrated(m.vote(e, c)), m.ids[e].tolist(), c.tolist(), [names[i] for i in ids.tolist()])
                for column, x in zip((scores, near, cosines, evidence), found, strict=True):
                    column.append(x)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(scores, pa.float64()), pa.array(near, pa.list_(b.schema.field(0).type)),
                 pa.array(cosines, pa.list_(pa.float64())), pa.array(evidence, pa.list_(pa.string()))],
                names=["k", "score", "nearest", "cosines", "terms"])

    narrow = docs.select(F.col(doc).alias("k"), F.col(text).cast("string").alias("t"))
    return narrow.mapInArrow(run, f"k {kind}, score double, nearest array<{kind}>, cosines array<double>, terms array<string>").withColumnRenamed("k", doc)


def reject(docs: DataFrame, model: Model, threshold: float = 0.3, text: str = "text") -> DataFrame:
    """``docs`` with all columns, without the rows whose text scores ``threshold`` or more.
    Null and empty texts score the model's prior, repeated rows go or stay together, and an
    empty table gives no rows.  Only the texts go to Python; rows are filtered by Spark."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("boolean")
    def stays(texts: pa.Array) -> pa.Array:
        m = shared.value
        return pa.array([m.score(t.as_py()) < threshold for t in texts], pa.bool_())

    return docs.where(stays(F.col(text).cast("string")))
