"""Line dedup by an exact set-similarity join.

A line is the set of its words (A-Z lower-cased).  Of two lines whose Jaccard similarity
is 0.8 or more the later one (by document id, then line) is removed.  The join:

* rarity: one pass counts all words in a sketch of fixed size.  Any order of words that
  all lines share keeps the join exact; the sketch makes it an order by rarity.
* prefix filter: matching lines share one of their n - ceil(0.8 n) + 1 rarest words, so
  lines meet only under these;
* length filter, positional filter (what can still be shared behind the first common word)
  and a parity filter (bits that an odd number of words hash to differ in no more places
  than the sets do; long lines have more bits, or any two would pass) discard pairs as they meet;
* survivors are verified on the whole sets.

Equal sets are one row per task, however many lines hold them, and one more whenever the
task meets an earlier line of the set than before.  A word whose count makes
its group hot is dealt to cells in which any two blocks of the group meet.  A line needs
one earlier match only: it first verifies its few best candidates; only lines left without
a match look at all of theirs, in a second round.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.batches import small_batches, tidy
from quarry.llm.words import Words, blocks
from quarry.session import ensure_checkpoint_dir

SKETCH_BITS, CHUNKS = 20, 256
FLUSH = 1 << 13     # lines worked on at a time
BLOCK = 1 << 18     # bytes of text worked on at a time; arrays take some 60 times as much
PAIRS = 500_000     # candidates held at a time
HOT = 200_000       # occurrences of a word per block of its group
WITNESSES = 16      # candidates per line and word in the first round
BEST = 1            # of them that are verified first
WIDE = 80           # words from which a line has 128 parity bits; 256 from twice, 512 from four times as many
ONE = np.uint64(1)
WORD = np.uint64((1 << 34) - 1)  # bits of a word's hash that order and key it; sets are verified on 51


class Lines:
    """Lines with words of some documents, flattened: ``owner`` (document), ``number`` (line),
    ``size`` (words in the set) and, end to end, the sets' ``words`` (51-bit hashes)."""

    def __init__(self, first: int, w: Words, lo: int, hi: int):
        base = w.line[lo]
        keys = np.sort(((w.line[lo:hi] - base).astype(np.uint64) << np.uint64(51)) | (w.hash[lo:hi] >> np.uint64(13)))
        keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
        self.words = keys & np.uint64((1 << 51) - 1)
        line = (keys >> np.uint64(51)).astype(np.int64)
        self.start = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]]))
        self.size = np.diff(np.concatenate([self.start, [len(line)]]))
        at = line[self.start] + base
        text = np.searchsorted(w.first_line, at, side="right") - 1
        self.owner, self.number = text + first, at - w.first_line[text]

    def only(self, which: np.ndarray) -> Lines:
        """The lines marked in ``which``."""
        out = Lines.__new__(Lines)
        out.words, out.size = self.words[np.repeat(which, self.size)], self.size[which]
        out.start, out.owner, out.number = np.cumsum(out.size) - out.size, self.owner[which], self.number[which]
        return out

    def ids(self) -> np.ndarray:
        """A hash of each set."""
        mixed = (np.add.reduceat(self.words * np.uint64(0xD6E8FEB86659FD93), self.start) ^ self.size.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed ^ (mixed >> np.uint64(29))).view(np.int64)

    def parity(self) -> pa.Array:
        """Each line's parity bits: 8, 16, 32 or 64 bytes.  A word's first bits choose one of up
        to 8 parts, so that the XOR of neighbouring parts is the parity in half as many bits."""
        width = 1 + (self.size >= WIDE) + 2 * (self.size >= 2 * WIDE) + 4 * (self.size >= 4 * WIDE)
        first = np.cumsum(width) - width
        part = np.repeat(first, self.size) + ((self.words >> np.uint64(48)).astype(np.int64) * np.repeat(width, self.size) >> 3)
        edge = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))  # words are sorted, so parts are
        bits = np.zeros(int(width.sum()), np.uint64)
        bits[part[edge]] = np.bitwise_xor.reduceat(ONE << ((self.words >> np.uint64(42)) & np.uint64(63)), edge)
        ends = (np.concatenate([[0], np.cumsum(width)]) * 8).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(width), [None, pa.py_buffer(ends), pa.py_buffer(bits)])


def lines_of(texts: Iterator[str | None]) -> Iterator[Lines]:
    """Bounded blocks of the lines that have words."""
    for first, some in blocks(texts, BLOCK):
        w = Words(some)
        at = 0
        while at < len(w.line):
            end = int(np.searchsorted(w.line, w.line[at] + FLUSH))
            yield Lines(first, w, at, end)
            at = end


def no_id(lines: np.ndarray, nz: np.ndarray) -> np.ndarray:
    """Line numbers, below zero in documents without an id (nz = 0), so that (d, number) is a
    line's place: null ids are stored as the least long and come before it."""
    return (lines - np.where(nz == 0, 1 << 31, 0)).astype(np.int32)


class Seen:
    """Sets that a task has given, with the least place given for each, in a table of fixed
    size; a set that another one displaced is given again."""

    def __init__(self, bits: int = 18):
        self.shift, n = np.uint64(64 - bits), 1 << bits
        self.sid, self.d, self.line = np.zeros(n, np.int64), np.full(n, np.iinfo(np.int64).max), np.zeros(n, np.int32)

    def fresh(self, sid: np.ndarray, d: np.ndarray, line: np.ndarray) -> np.ndarray:
        """Which of the sets (each once) were not given yet, or only at a later place."""
        at = ((sid.view(np.uint64) * np.uint64(0xD6E8FEB86659FD93)) >> self.shift).astype(np.int64)
        new = (self.sid[at] != sid) | (d < self.d[at]) | ((d == self.d[at]) & (line < self.line[at]))
        at = at[new]
        self.sid[at], self.d[at], self.line[at] = sid[new], d[new], line[new]
        return new


def pack(counts: np.ndarray) -> list[tuple[int, bytes]]:
    """A sketch as rows of its chunks that are not empty."""
    return [(i, zlib.compress(c.tobytes(), 1)) for i, c in enumerate(counts.reshape(CHUNKS, -1)) if c.any()]


def total(rows: DataFrame, bits: int) -> np.ndarray:
    """Sum of all tasks' sketches: chunks meet by number, and 2^bits numbers reach the driver."""
    width = (1 << bits) // CHUNKS

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for i, data in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                got = np.frombuffer(zlib.decompress(data.as_buffer()), np.uint32)
                sums[i] = np.minimum(sums.get(i, np.zeros(width, np.uint64)) + got, np.uint64(2**32 - 1))
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([s.astype(np.uint32).tobytes() for s in sums.values()], pa.binary())],
                                         names=["chunk", "data"])

    out = np.zeros((CHUNKS, width), np.uint32)
    met = rows.select("chunk", "data").where("chunk IS NOT NULL").repartition("chunk")
    for r in met.mapInArrow(tidy(add), "chunk int, data binary").collect():
        out[r.chunk] = np.frombuffer(r.data, np.uint32)
    return out.ravel()


def members(ids: DataFrame, bits: int) -> np.ndarray:
    """A Bloom filter (one hash) of a column of longs; its size is fixed, others join exactly."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << bits, np.uint32)
        for b in batches:
            seen[place(b.column(0).to_numpy(), bits)] = 1
        rows = pack(seen)
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["chunk", "data"])

    return total(ids.mapInArrow(tidy(mark), "chunk int, data binary"), bits) > 0


def place(ids: np.ndarray, bits: int) -> np.ndarray:
    return (ids.view(np.uint64) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - bits)


def scan(narrow: DataFrame) -> DataFrame:
    """One row per document (line null; how many lines it has, and how many with words), one
    per line with words (id of its set), and the sketch of word counts, in one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.uint32)
        none = pa.nulls
        for b in batches:
            texts, m = b.column(3), b.num_rows
            n = pc.add(pc.count_substring(texts, "\n").cast(pa.int64()), 1)
            worded = np.zeros(m, np.int64)
            d, nz, tk = (b.column(i).to_numpy() for i in range(3))
            for x in lines_of(t.as_py() for t in texts):
                np.add.at(counts, (x.words & np.uint64((1 << SKETCH_BITS) - 1)).view(np.int64), np.uint32(1))
                np.add.at(worded, x.owner, 1)
                many = len(x.size)
                yield pa.RecordBatch.from_arrays([pa.array(d[x.owner]), pa.array(nz[x.owner]), pa.array(tk[x.owner]), none(many, pa.int64()), none(many, pa.int64()),
                                                  pa.array(x.number), pa.array(x.ids()), none(many, pa.int32()), none(many, pa.binary())], names=NAMES)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), n, pa.array(worded), none(m, pa.int64()), none(m, pa.int64()),
                                              none(m, pa.int32()), none(m, pa.binary())], names=NAMES)
        rows = pack(counts)
        m = len(rows)
        yield pa.RecordBatch.from_arrays([none(m, pa.int64()), none(m, pa.int32()), *(none(m, pa.int64()) for _ in range(5)), pa.array([r[0] for r in rows], pa.int32()),
                                          pa.array([r[1] for r in rows], pa.binary())], names=NAMES)

    return narrow.mapInArrow(tidy(run), "d bigint, nz int, tk bigint, n_lines bigint, worded bigint, line bigint, sid bigint, chunk int, data binary")


NAMES = ["d", "nz", "tk", "n_lines", "worded", "line", "sid", "chunk", "data"]


def prefixes(narrow: DataFrame, counts, share: Fraction, wanted=None) -> DataFrame:
    """Rows (key, n, pos, sid, parity, od, ol): the rarest words of every distinct set, again
    where a task meets the set at a smaller place: the least (od, ol) is the set's first.  With
    ``wanted`` (a filter over words) only rows of these words."""
    num, den = share.numerator, share.denominator

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = counts.value
        level = np.minimum(63, (4 * np.log2(np.maximum(sketch, 1))) // 2).astype(np.uint64)
        given = Seen()
        for b in batches:
            d, nz = b.column(0).to_numpy(), b.column(1).to_numpy()
            for x in lines_of(t.as_py() for t in b.column(3)):
                ids, od = x.ids(), d[x.owner]
                ol = no_id(x.number, nz[x.owner])
                by = np.lexsort((ol, od, ids))
                first = by[np.concatenate([[True], ids[by][1:] != ids[by][:-1]])]
                fresh = np.zeros(len(ids), bool)
                fresh[first] = given.fresh(ids[first], od[first], ol[first])
                if wanted is not None:
                    fresh &= np.logical_or.reduceat(wanted.value[place((x.words & WORD).view(np.int64), SKETCH_BITS)], x.start)
                if not fresh.any():
                    continue
                x, ids, od, ol = x.only(fresh), ids[fresh], od[fresh], ol[fresh]
                line = np.repeat(np.arange(len(x.size), dtype=np.uint64), x.size)
                low = x.words & np.uint64((1 << SKETCH_BITS) - 1)
                keys = np.sort((line << np.uint64(40)) | (level[low] << np.uint64(34)) | (x.words & WORD))
                line = (keys >> np.uint64(40)).astype(np.int64)
                pos = np.arange(len(keys)) - x.start[line]
                n = x.size[line]
                take = pos <= n - -(-num * n // den)
                word = (keys & WORD).astype(np.int64)
                if wanted is not None:
                    take &= wanted.value[place(word, SKETCH_BITS)]
                line, pos, n, word = line[take], pos[take], n[take], word[take]
                blocks = sketch[word & ((1 << SKETCH_BITS) - 1)].astype(np.int64) // HOT + 1
                cell, rows = np.zeros(len(word), np.int64), np.arange(len(word))
                if (blocks > 1).any():  # every two blocks of a hot word meet in one cell
                    rows = np.repeat(rows, blocks)
                    other = np.arange(len(rows)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
                    many = blocks[rows]
                    own = (ids[line[rows]].view(np.uint64) % many.astype(np.uint64)).astype(np.int64)
                    cell = np.minimum(own, other) * many + np.maximum(own, other)
                at = line[rows]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(word[rows] + (cell << 34)), pa.array(n[rows].astype(np.int32)), pa.array(pos[rows].astype(np.int32)), pa.array(ids[at]),
                     pa.array(od[at]), pa.array(ol[at]), x.parity().take(pa.array(at))], names=[*PREFIX, "parity"])

    return narrow.mapInArrow(tidy(run), "key bigint, n int, pos int, sid bigint, od bigint, ol int, parity binary")


PREFIX = ["key", "n", "pos", "sid", "od", "ol"]


class Parity:
    """Parity bits of many lines, compared in as many bits as both lines have."""

    def __init__(self, bits: pa.Array):
        _, ends, data = bits.buffers()
        ends = np.frombuffer(ends, np.int32)[bits.offset:bits.offset + len(bits) + 1].astype(np.int64) // 8
        self.width, self.first = np.diff(ends), ends[:-1] - ends[0]
        words = np.frombuffer(data, np.uint64)[ends[0]:ends[-1]]
        self.sums = np.concatenate([[np.uint64(0)], np.bitwise_xor.accumulate(words)])

    def part(self, at: np.ndarray, k: int, parts: int) -> np.ndarray:
        """The k-th of so many parts, neighbours folded into one."""
        size = self.width[at] // parts
        first = self.first[at] + k * size
        return self.sums[first + size] ^ self.sums[first]

    def within(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of pairs (i, j) those that differ in at most so many bits, and in how many."""
        apart, live = np.zeros(len(i), np.int64), np.arange(len(i))
        ok = np.ones(len(i), bool)
        for parts in (1, 2, 4, 8):
            live = live[ok[live] & (np.minimum(self.width[i[live]], self.width[j[live]]) >= parts)]
            if not len(live):
                break
            apart[live] = sum(np.bitwise_count(self.part(i[live], k, parts) ^ self.part(j[live], k, parts)).astype(np.int64) for k in range(parts))
            ok[live] = apart[live] <= most[live]
        return np.flatnonzero(ok), apart[ok]


def meet(rows: dict[str, np.ndarray], parity: Parity, share: Fraction, limit: int | None,
         only: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Candidates (later sid, earlier sid, parity difference, cut) among rows sorted by key
    and n, in pieces of about PAIRS; with ``only`` (a filter over sids) those of these later
    lines.  With a ``limit`` all come in one piece, at most so many of a row, and ``cut``
    has the rows of lines with as many candidates under a word, or more."""
    num, den = share.numerator, share.denominator
    key, n = rows["key"], rows["n"].astype(np.int64)
    rest = n - rows["pos"]
    ends = np.concatenate([np.flatnonzero(np.diff(key)) + 1, [len(key)]])
    run_end = np.repeat(ends, np.diff(np.concatenate([[0], ends])))

    def check(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        both = n[i] + n[j]
        need = -(-num * both // (num + den))  # least overlap of a match
        ok = (den * n[i] >= num * n[j]) & (np.minimum(rest[i], rest[j]) >= need) & (rows["sid"][i] != rows["sid"][j])
        i, j, both, need = i[ok], j[ok], both[ok], need[ok]
        near, apart = parity.within(i, j, both - 2 * need)
        i, j = i[near], j[near]
        late, tie = np.zeros(len(i), bool), np.ones(len(i), bool)
        for c in ("od", "ol", "sid"):
            late |= tie & (rows[c][i] > rows[c][j])
            tie &= rows[c][i] == rows[c][j]
        new = np.stack([np.where(late, i, j), np.where(late, j, i), apart], axis=1)
        return new if only is None else new[only[place(rows["sid"][new[:, 0]], SKETCH_BITS)]]

    def piece(out: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        found = np.concatenate(out) if out else np.empty((0, 3), np.int64)
        cut = np.empty(0, np.int64)
        if limit is not None and len(found):
            found = best(found, key, limit)
            at, many = np.unique(found[:, 0], return_counts=True)
            cut = at[many >= limit]  # there may be more
        return rows["sid"][found[:, 0]], rows["sid"][found[:, 1]], found[:, 2], cut

    out: list[np.ndarray] = []
    held = floor = 0
    alive = np.arange(len(key))
    step = 1
    while len(alive := alive[alive + step < run_end[alive]]):  # the step-th row behind each
        alive = alive[den * n[alive] >= num * n[alive + step]]  # sorted by n: none further fits
        for part in np.array_split(alive, len(alive) // 100_000 + 1):
            out.append(check(part, part + step))
            held += len(out[-1])
            if held > PAIRS + floor:
                if limit is None:
                    yield piece(out)
                    out, held = [], 0
                else:  # what stays is at most ``limit`` a row; as many again may come before the next cut
                    out = [best(np.concatenate(out), key, limit)]
                    held = floor = len(out[0])
        step += 1
    yield piece(out)


def best(found: np.ndarray, key: np.ndarray, limit: int) -> np.ndarray:
    """The ``limit`` candidates of each row that differ least in parity."""
    found = found[np.lexsort((found[:, 1], found[:, 2], found[:, 0]))]
    new = np.concatenate([[True], np.diff(found[:, 0]) != 0])
    start = np.maximum.accumulate(np.where(new, np.arange(len(found)), 0))
    return found[np.arange(len(found)) - start < limit]


def candidates(rows: DataFrame, share: Fraction, limit: int | None, only=None) -> DataFrame:
    """(late, early, apart, word): pairs of sets and how far their parities differ; where the candidates of a line were cut, a row names
    the word instead of the earlier set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[str, np.ndarray]] = []
        bits: list[pa.Array] = []
        size = 0
        for b in itertools.chain(batches, [None]):
            if b is not None and b.num_rows:
                held.append({c: b.column(i).to_numpy() for i, c in enumerate(PREFIX)})
                bits.append(b.column(len(PREFIX)))
                size += b.num_rows
            if not size or (b is not None and (size < 50_000 or held[-1]["key"][-1] == held[0]["key"][0])):
                continue
            rows, parity = {c: np.concatenate([h[c] for h in held]) for c in PREFIX}, pa.concat_arrays(bits)
            end = size if b is None else int(np.searchsorted(rows["key"], rows["key"][-1]))  # the last group may go on
            group = {c: v[:end] for c, v in rows.items()}
            keep = np.lexsort((group["ol"], group["od"], group["sid"], group["n"], group["key"]))  # equal sets: the first line
            group = {c: v[keep] for c, v in group.items()}
            one = np.concatenate([[True], (np.diff(group["key"]) != 0) | (np.diff(group["sid"]) != 0)])
            group = {c: v[one] for c, v in group.items()}
            for late, early, apart, cut in meet(group, Parity(parity.take(pa.array(keep[one]))), share, limit, None if only is None else only.value):
                none = pa.nulls(len(cut), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([late, group["sid"][cut]])), pa.concat_arrays([pa.array(early), none]), pa.concat_arrays([pa.array(apart), none]),
                     pa.concat_arrays([pa.nulls(len(early), pa.int64()), pa.array(group["key"][cut] & ((1 << 34) - 1))])], names=["late", "early", "apart", "word"])
            held, bits, size = [{c: v[end:] for c, v in rows.items()}], [parity.slice(end)], size - end

    met = rows.repartition("key").sortWithinPartitions("key")  # by one long: a radix sort
    return met.mapInArrow(tidy(run), "late bigint, early bigint, apart bigint, word bigint").distinct()


def sets_of(narrow: DataFrame, wanted, bits: int) -> DataFrame:
    """(sid, words): the sets that a filter over ids lets pass, once per task and set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in lines_of(t.as_py() for t in b.column(3)):
                ids, at = np.unique(x.ids(), return_index=True)
                hit = wanted.value[place(ids, bits)]
                ids, at = ids[hit], at[hit]
                words = [x.words[x.start[i]:x.start[i] + x.size[i]].view(np.int64) for i in at.tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(words, pa.list_(pa.int64()))], names=["sid", "words"])

    return narrow.mapInArrow(tidy(run), "sid bigint, words array<bigint>").dropDuplicates(["sid"])


def matched(pairs: DataFrame, sets: DataFrame, share: Fraction) -> DataFrame:
    """Lines (late) with an earlier one at the given Jaccard similarity, among (late, early)."""
    both = (pairs.join(sets.select(F.col("sid").alias("late"), F.col("words").alias("lw")), "late")
            .join(sets.select(F.col("sid").alias("early"), F.col("words").alias("ew")), "early"))
    shared = F.size(F.array_intersect("lw", "ew"))
    same = shared * share.denominator >= (F.size("lw") + F.size("ew") - shared) * share.numerator
    return both.where(same).select("late").distinct()


def verify(narrow: DataFrame, pairs: DataFrame, share: Fraction, broadcast: Callable, bits: int = 22) -> DataFrame:
    """``matched`` over (late, early, apart): the ``BEST`` candidates of each line by parity
    first, the others only for lines that these left without a match."""
    ids = pairs.select(F.explode(F.array("late", "early")).alias("sid")).distinct()
    sets = sets_of(narrow, broadcast(members(ids, bits)), bits).checkpoint()
    rank = F.row_number().over(Window.partitionBy("late").orderBy("apart", "early"))
    ranked = pairs.withColumn("rank", rank).checkpoint()
    first = matched(ranked.where(F.col("rank") <= BEST).select("late", "early"), sets, share).checkpoint()
    left = ranked.where(F.col("rank") > BEST).join(first, "late", "left_anti").select("late", "early")
    return first.unionByName(matched(left, sets, share))


def dedup(docs: DataFrame, similarity: str = "0.8", doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc``, text_key (hash of the text), n_lines, n_removed and kept (numbers, from 0, of
    the lines with words that stay) for every input row.

    A line without words always stays and is not in ``kept``.  Null texts have one empty
    line.  ``doc`` is any integer (else a TypeError); null comes before all.  Rows that repeat an id and text
    are one document (each row gets its result); rows of one id with different texts are
    in the order of their sets' hashes.  An empty table gives no rows; other columns are
    not read.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    small_batches(spark)
    kind = docs.schema[doc].dataType
    if not isinstance(kind, T.IntegralType):
        raise TypeError(f"{doc} is {kind.simpleString()}; lines are ordered by integer ids")
    broadcast, share = spark.sparkContext.broadcast, Fraction(similarity)
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    # (d, nz) orders ids with null before all longs
    narrow = docs.select(F.coalesce(F.col(doc).cast("long"), F.lit(-2**63).cast("long")).alias("d"), F.col(doc).isNotNull().cast("int").alias("nz"),
                         F.xxhash64(body).alias("tk"), body.alias("t"))
    seen = scan(narrow).checkpoint()
    counts = broadcast(total(seen, SKETCH_BITS))
    found = candidates(prefixes(narrow, counts, share), share, WITNESSES).checkpoint()
    pairs = found.where("early IS NOT NULL").select("late", "early", "apart")
    later = verify(narrow, pairs, share, broadcast).checkpoint()
    open_ = found.where("early IS NULL").join(later, "late", "left_anti").select("late", "word").checkpoint()
    if not open_.isEmpty():  # lines whose best candidates failed: all that meet them under the words that were cut
        words, only = (broadcast(members(open_.select(c), SKETCH_BITS)) for c in ("word", "late"))
        again = candidates(prefixes(narrow, counts, share, words), share, None, only).select("late", "early", "apart")
        again = again.join(open_.select("late"), "late", "left_semi").join(pairs.select("late", "early"), ["late", "early"], "left_anti").checkpoint()
        later = later.unionByName(verify(narrow, again, share, broadcast)).distinct()
    lines = seen.where("line IS NOT NULL")
    first = lines.groupBy("sid").agg(F.min(F.struct("d", "nz", "line", "tk")).alias("f"))
    stay = first.join(later.withColumnRenamed("late", "sid"), "sid", "left_anti").select("f.d", "f.nz", "f.tk", "f.line")
    kept = stay.groupBy("d", "nz", "tk").agg(F.array_sort(F.collect_list("line")).alias("kept"))
    rows = seen.where("n_lines IS NOT NULL").select("d", "nz", "tk", "n_lines", "worded")
    out = rows.join(kept, ["d", "nz", "tk"], "left")
    kept_lines = F.coalesce("kept", F.array().cast("array<bigint>"))
    return out.select(F.when(F.col("nz") == 1, F.col("d")).cast(kind).alias(doc), F.col("tk").alias("text_key"), "n_lines",
                      (F.col("worded") - F.size(kept_lines)).alias("n_removed"), kept_lines.alias("kept"))


def remove(docs: DataFrame, similarity: str = "0.8", doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with all columns, removed lines cut from the texts.  Texts that lose nothing
    are returned as they were."""
    plan = (dedup(docs, similarity, doc, text).where("n_removed > 0")
            .select(F.col(doc).alias("__d"), F.col("text_key").alias("__k"), F.col("kept").alias("__s")).dropDuplicates(["__d", "__k"]))  # a null id is one value
    key = F.xxhash64(F.coalesce(docs[text].cast("string"), F.lit("")))
    joined = docs.join(plan, docs[doc].eqNullSafe(F.col("__d")) & (key == F.col("__k")), "left")
    lines = F.filter(F.split(F.col(text), "\n", -1), lambda x, i: ~x.rlike(r"[^\x20\x09-\x0D]") | F.array_contains("__s", i.cast("long")))
    return joined.withColumn(text, F.when(F.col("__k").isNull(), F.col(text)).otherwise(F.array_join(lines, "\n"))).select(*docs.columns)
