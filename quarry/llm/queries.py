"""Registered queries of the package and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import bpe, conversation_trie, decontaminate, exact_dedup, line_dedup, maxent, quality, sharding, simhash
from quarry.llm import token_orc, toxicity, warc, whitening
from quarry.sources.files import new_scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    """Where the public vocabulary ``name`` is installed (the same place on every node)."""
    import public_tokenizers
    return public_tokenizers.path(name)


TOXIC_FROM = 0.3  # score from which a document counts as toxic


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels"), held_out_mod=4, held_out_rest=2))
    held_out = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"),
                         F.slice("nearest", 1, 5).alias("evidence"))


@query
def op2_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_orc.write(table(spark, sf_dir, "documents"), new_scratch(spark, "token-orc"), tokenizer("word_bpe_49k.json"))
    return token_orc.summary(spark, path)


@query
def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer("byte_bpe_50k.json")
    coded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path), path)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.assess(docs, quality.references(docs))


@query
def op5_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return maxent.score(docs, *maxent.fit(docs, mod=10, rest=0), mod=10, rest=0)


@query
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derive(warc.responses(table(spark, sf_dir, "pages")))


ORACLE["op6_warc"] = warc.oracle_sql()


@query
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, max_bits=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "kept")


@query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


ORACLE["op9_decontamination"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w FROM benchmark),
g AS (SELECT DISTINCT item, least(len(w), 10) n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') gram
      FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) i FROM b WHERE len(w) > 0)),
x AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') gram
      FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) i FROM d, (SELECT DISTINCT n FROM g) WHERE len(w) >= n)),
h AS (SELECT doc_id, x.i, g.n, g.item FROM x JOIN g ON x.gram = g.gram AND x.n = g.n),
c AS (SELECT doc_id, count(DISTINCT p) n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) p FROM h) GROUP BY 1),
t AS (SELECT doc_id, count(*) n_items, string_agg(item, ',' ORDER BY item) items FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY 1)
SELECT d.doc_id, len(d.w) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items,
       sha256(coalesce(items, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)"""


@query
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents"), n_shards=24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "home_shard")


@query
def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.trie(table(spark, sf_dir, "conversations"))


ORACLE["op11_conversation_trie"] = conversation_trie.oracle_sql()


@query
def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark(table(spark, sf_dir, "documents"))


ORACLE["op12_exact_dedup"] = exact_dedup.oracle_sql()


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return whitening.whiten(vectors, whitening.fit(vectors, components=8))
