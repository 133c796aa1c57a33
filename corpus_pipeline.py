"""From raw documents to token ids: five stages, each on all that its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as
Parquet under the shared checkpoint folder and gives the next stage what it reads back.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import bpe, decontaminate, line_dedup, simhash, toxicity
from quarry.llm.batches import small_batches
from quarry.llm.queries import TOXIC_FROM, table, tokenizer
from quarry.sources.files import new_scratch


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the labelled examples nearest to them don't show to be toxic.  Null and
    empty texts score the share of toxic examples without a telling term; repeated rows
    stay or go together.  Of an empty table no row is left, here and in the stages below."""
    small_batches(spark)
    return toxicity.reject(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")), TOXIC_FROM)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that repeat an earlier one (Jaccard of words >= 0.8); one
    that loses all of its lines stays, empty.  n_chars follows the text.  A null text stays
    null, null ids come before all others, and rows that repeat an id and a text are one
    document whose lines are judged once."""
    small_batches(spark)
    cut = line_dedup.remove(docs, "0.8")
    return cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by fingerprints within 3 bits; null and empty texts
    share the fingerprint zero and are one group."""
    small_batches(spark)
    return simhash.keep_one(docs, words=3, max_bits=3)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window; null and empty texts have none and stay."""
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"), "documents", n=10)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text (null: none), and the hash of the text that decoding them gives."""
    small_batches(spark)
    path = tokenizer("byte_bpe_50k.json")
    coded = bpe.decode(bpe.encode(docs, path), path)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_lines), ("simhash", drop_near_copies),
          ("decontamination", drop_benchmark), ("bpe", encode)]

#: The nearest-example scores, the fingerprints and the token ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
