"""Quality by distribution divergence: Jensen-Shannon distance of a text's character-class
and common-word histograms to language references, behind base rules.

A reference is the histogram, over all documents of a language, of character classes and
of its ``top`` most frequent words (all others in one bin).  A text is held against every
reference, so a wrong language tag does it no harm, and the nearest by words counts.  It is
kept if

* its word distance is at most ``word_base + word_noise / sqrt(n_words)`` (short texts
  stray further by chance alone), and below that of a text without any common word; and
* its character distance to the same reference is at most ``char_limit``.

A histogram of fewer than ``min_words`` words or ``min_chars`` characters says too little:
that distance is not held against the text.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
BLANK = b" \t\n\x0b\x0c\r"
NOT_CHARS = BLANK + bytes(range(0x80, 0xC0))  # blanks, and bytes that continue a character
SYMBOLS = b"[#*$%&|<>]"[1:-1]
SALTS = 64  # parts of a language's vocabulary that are ranked apart
CLASSES = ["vowel", "consonant", "upper", "digit", "blank", "mark", "symbol", "beyond ASCII"]


def class_table() -> np.ndarray:
    """Class of every byte; bytes that continue a character count nowhere (8)."""
    kind = np.full(256, 6)
    kind[list(range(97, 123))] = 1
    kind[list(b"aeiou")] = 0
    kind[list(range(65, 91))] = 2
    kind[list(range(48, 58))] = 3
    kind[list(BLANK)] = 4
    kind[list(b".,;:!?'\"-")] = 5
    kind[0x80:0xC0] = 8
    kind[0xC0:] = 7
    return kind


_KIND = class_table()


def classes(data: bytes) -> np.ndarray:
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    return np.bincount(_KIND, weights=counts, minlength=9)[:8]


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2, 0 to 1) along the last axis."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        a = np.where(p > 0, p * np.log2(p / m), 0).sum(-1)
        b = np.where(q > 0, q * np.log2(q / m), 0).sum(-1)
    return np.sqrt(np.maximum(0, (a + b) / 2))


@dataclass
class References:
    langs: list[str]
    words: dict[bytes, int]   # numbers of the words common in any language
    word: np.ndarray          # languages x (words + others): shares
    own: np.ndarray           # which words count for a language
    char: np.ndarray          # languages x classes: shares

    def __post_init__(self) -> None:
        empty = np.zeros_like(self.word)
        empty[:, -1] = 1
        self.none = distance(empty, self.word) if len(self.langs) else np.empty(0)

    def compare(self, words: list[bytes], chars: np.ndarray) -> tuple[int, float, float]:
        """Nearest language by words, its word distance and character distance."""
        u = len(self.words)
        get = self.words.get
        counts = np.bincount(np.fromiter((get(w, u) for w in words), np.int64, len(words)), minlength=u + 1)[:u] * self.own
        shares = np.concatenate([counts, (len(words) - counts.sum(1))[:, None]], axis=1) / max(1, len(words))
        d = distance(shares, self.word)
        i = int(np.argmin(d))
        return i, float(d[i]), float(distance(chars / max(1.0, chars.sum()), self.char[i]))


def references(docs: DataFrame, top: int = 100, max_langs: int = 200, text: str = "text", lang: str = "lang") -> References:
    """References of the ``max_langs`` languages with most words, which bounds the model;
    counts cover all texts.  Rows without a language or a word give nothing.  Texts of any
    further language aren't held against these (see ``assess``)."""

    ensure_checkpoint_dir(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words: dict[str, Counter] = defaultdict(Counter)
            chars: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(8))
            for la, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                data = (t.as_py() or "").encode()
                words[la].update(data.translate(LOWER).split())
                chars[la] += classes(data)
            for la, found in words.items():
                yield pa.RecordBatch.from_arrays([pa.array([la] * len(found), pa.string()), pa.array(list(found), pa.binary()),
                                                  pa.array(list(found.values()), pa.int64()), pa.nulls(len(found), pa.int32())], names=["l", "w", "n", "c"])
                yield pa.RecordBatch.from_arrays([pa.array([la] * 8, pa.string()), pa.nulls(8, pa.binary()), pa.array(chars[la].astype(np.int64)),
                                                  pa.array(range(8), pa.int32())], names=["l", "w", "n", "c"])

    rows = docs.where(F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("l"), F.col(text).cast("string").alias("t"))
    sums = rows.mapInArrow(count, "l string, w binary, n bigint, c int").groupBy("l", "w", "c").agg(F.sum("n").alias("n"))
    sums = sums.withColumn("salt", F.pmod(F.xxhash64("w"), F.lit(SALTS))).checkpoint()
    totals = sums.where("w IS NOT NULL").groupBy("l").agg(F.sum("n").alias("all"))
    largest = totals.orderBy(F.desc("all"), "l").limit(max_langs)
    order = [F.desc("n"), "w"]
    # the most frequent words of each part of a vocabulary, and then of these
    part = F.row_number().over(Window.partitionBy("l", "salt").orderBy(*order))
    some = sums.where("w IS NOT NULL").withColumn("rank", part).where(F.col("rank") <= top)
    common = some.withColumn("rank", F.row_number().over(Window.partitionBy("l").orderBy(*order))).where(F.col("rank") <= top)
    model = common.unionByName(sums.where("w IS NULL").withColumn("rank", F.lit(0)))
    found = model.join(F.broadcast(largest), "l").orderBy(F.desc("all"), "l", "rank").collect()  # max_langs * (top + 8) rows
    langs = list(dict.fromkeys(r.l for r in found))
    words: dict[bytes, int] = {}
    for r in found:
        if r.c is None:
            words.setdefault(bytes(r.w), len(words))
    share = np.zeros((len(langs), len(words) + 1))
    char = np.zeros((len(langs), 8))
    at = {la: i for i, la in enumerate(langs)}
    for r in found:
        if r.l in at and r.c is None:
            share[at[r.l], words[bytes(r.w)]] = r.n / r["all"]
        elif r.l in at:
            char[at[r.l], r.c] = r.n
    share[:, -1] = 1 - share.sum(1)
    return References(langs, words, share, share[:, :-1] > 0, char / np.maximum(1, char.sum(1, keepdims=True)))


def repeated_words(words: list[bytes]) -> int:
    """Words inside a window of three that the text holds twice or more."""
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    if len(windows) == max(0, len(words) - 2):
        return 0
    twice = np.fromiter((windows[w] > 1 for w in zip(words, words[1:], words[2:], strict=False)), bool, len(words) - 2)
    hit = np.zeros(len(words), bool)
    for shift in range(3):
        hit[shift:len(words) - 2 + shift] |= twice
    return int(hit.sum())


NAMES = ["k", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "nearest", "word_distance", "char_distance"]


def assess(docs: DataFrame, refs: References, doc: str = "doc_id", text: str = "text", min_words: int = 50, min_chars: int = 200,
           word_base: float = 0.24, word_noise: float = 2.0, char_limit: float = 0.31, lang: str = "lang") -> DataFrame:
    """One row per input row: ``doc``, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed (under 50 words, or over half of them repeat), kept,
    nearest (language), word_distance, char_distance (null where not held against it).

    Null and empty texts have no words and fail the base rules.  Without any reference, or
    none for the language that the row names, the base rules alone decide.  Repeated rows and null ids are kept, an empty table gives no
    rows, other columns are not read.
    """
    kind = docs.schema[doc].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(refs)

    def one(text: str | None, named: str | None, ref: References) -> tuple:
        data = (text or "").encode()
        words = data.split()  # splits at 20, 09-0D only
        n = len(words)
        lines = [x for x in data.split(b"\n") if x.strip()]
        repeats = repeated_words(words)
        failed = n < 50 or 100 * repeats > 50 * n
        base = (n, len(data.translate(None, NOT_CHARS)), len(data) - len(data.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeats, failed)
        if n < min_words or not ref.langs or (named is not None and named not in ref.langs):
            return (*base, not failed, None, None, None)
        chars = classes(data)
        i, by_word, by_char = ref.compare(data.translate(LOWER).split(), chars)
        if chars.sum() < min_chars:
            by_char = None
        near = by_word <= word_base + word_noise / n ** 0.5 and by_word < 0.99 * ref.none[i] and (by_char is None or by_char <= char_limit)
        return (*base, bool(not failed and near), ref.langs[i], by_word, by_char)

    types = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.string(), pa.float64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [one(t.as_py(), la.as_py(), shared.value) for t, la in zip(b.column(1), b.column(2), strict=True)]
            columns = list(zip(*rows, strict=True)) or [()] * len(types)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=NAMES)

    narrow = docs.select(F.col(doc).alias("k"), F.col(text).cast("string").alias("t"), F.col(lang).cast("string").alias("l"))
    return narrow.mapInArrow(run, f"k {kind}, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
                             "base_failed boolean, kept boolean, nearest string, word_distance double, char_distance double").withColumnRenamed("k", doc)
