"""Token ids as ORC: integer run-length encoded columns, row indexes, and Bloom filters on
document ids, in files that hold ascending ranges of document ids.

Stripes are independent, so Spark reads a file with one task per stripe range.  A lookup
of one document skips files and stripes by their minimum and maximum ids, then row groups
by row index and Bloom filter; nothing but metadata is read of the others.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.bpe import Memo, PieceModel

WORDS = 200_000  # entries of each of a worker's two generations


SAFE = "A-Za-zÀ-ÖØ-öø-ÿ"  # letters of one case rule that no neighbour composes with


class WordCodec:
    """Encodes texts whose white space is dropped.  A text of ASCII and Latin letters is
    lower-cased and split into pre-tokens in one go; each is encoded once by the library's
    model and kept.  In other texts a blank or line feed always separates, so every stretch
    between them is encoded once and kept: one with other characters, or with a special
    token in it, takes the library's whole way."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.find = re.compile("[^ \n]+").findall
        self.safe = re.compile(f"[\t\n\r -~{SAFE}]*").fullmatch
        self.split = re.compile(f"[{SAFE}]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\\s0-9{SAFE}]+").findall
        self.pieces = Memo(PieceModel(self.tok).ids, 2 * WORDS)
        self.known = Memo(self.word, WORDS)

    def simple(self, text: str) -> bool:
        return self.safe(text) is not None and not any(s in text for s in self.special)

    def word(self, word: str) -> bytes:
        if self.simple(word):
            return b"".join(map(self.pieces.__getitem__, self.split(word.lower())))
        return np.asarray(self.tok.encode(word, add_special_tokens=False).ids, np.int32).tobytes()

    def parts(self, text: str) -> Iterator[bytes]:
        if self.simple(text):
            return map(self.pieces.__getitem__, self.split(text.lower()))
        return map(self.known.__getitem__, self.find(text))

    def encode(self, texts: list[str | None], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Values and offsets of the ids of all texts, each closed by ``end_id``."""
        end = np.int32(end_id).tobytes()
        coded = [b"".join([*self.parts(t or ""), end]) for t in texts]
        offsets = np.cumsum([0, *map(len, coded)]) // 4
        return np.frombuffer(b"".join(coded), np.int32), offsets.astype(np.int32)


@lru_cache(maxsize=2)
def word_codec(path: str) -> WordCodec:
    return WordCodec(path)


def write(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 1, doc: str = "doc_id", text: str = "text",
          partitions: int | None = None, stripe_bytes: int = 16 << 20, index_stride: int = 1000) -> str:
    """Write one ORC file per range of ids: ``doc``, row (ascending over all files), n_tokens
    and ids, ``end_id`` appended.  Null texts count as empty; null keys come first; rows
    that repeat a key follow each other in the order of their texts' hash; an empty table
    leaves files without rows; other columns of the input are not read."""
    kind = docs.schema[doc].dataType.simpleString()
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = word_codec(tokenizer_path)
        for big in batches:
            for i in range(0, big.num_rows, 512):
                b = big.slice(i, 512)
                values, offsets = own.encode(b.column(1).to_pylist(), end_id)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(offsets).astype(np.int64)),
                                                  pa.ListArray.from_arrays(offsets, values)], names=["k", "n_tokens", "ids"])

    tie = [F.xxhash64("t"), F.monotonically_increasing_id()]  # a key on many rows may span files
    ranged = (docs.select(F.col(doc).alias("k"), F.col(text).cast("string").alias("t"))
              .select("k", "t", tie[0].alias("h"), tie[1].alias("m"))
              .repartitionByRange(n, "k", "h", "m").sortWithinPartitions("k", "h", "m").select("k", "t"))
    coded = ranged.mapInArrow(run, f"k {kind}, n_tokens bigint, ids array<int>")
    (coded.select(F.col("k").alias(doc), F.monotonically_increasing_id().alias("row"), "n_tokens", "ids")
     .write.mode("overwrite").option("compression", "zstd").option("orc.stripe.size", stripe_bytes)
     .option("orc.create.index", "true").option("orc.row.index.stride", index_stride)
     .option("orc.bloom.filter.columns", doc).option("orc.bloom.filter.fpp", "0.01").orc(path))
    return path


def read(spark: SparkSession, path: str) -> DataFrame:
    """The written rows; filters on the document id prune files, stripes and row groups."""
    return spark.read.orc(path)


def summary(spark: SparkSession, path: str, doc: str = "doc_id") -> DataFrame:
    """Per document, from the files: ``doc``, start (ids of all documents before it),
    n_tokens, ids_crc32 (unsigned, of the ids as little-endian unsigned 32-bit integers)."""
    stored = read(spark, path)
    kind = stored.schema[doc].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(2)
            values = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            at = lists.offsets.to_numpy()
            crc = [zlib.crc32(values[s:e].tobytes()) for s, e in itertools.pairwise(at.tolist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(np.diff(at).astype(np.int64)),
                                              pa.array(crc, pa.int64())], names=["k", "row", "n_tokens", "ids_crc32"])

    docs = (stored.select(F.col(doc).alias("k"), "row", "ids")
            .mapInArrow(run, f"k {kind}, row bigint, n_tokens bigint, ids_crc32 bigint")
            .withColumn("file", F.shiftright("row", 33)))
    # one row per file, from the n_tokens column alone
    files = stored.groupBy(F.shiftright("row", 33).alias("file")).agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    earlier = Window.partitionBy("file").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    out = docs.join(files, "file").withColumn("start", F.col("base") + F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)))
    return out.select(F.col("k").alias(doc), "start", "n_tokens", "ids_crc32")
