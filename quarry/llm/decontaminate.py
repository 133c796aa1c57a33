"""Benchmark decontamination: a broadcast hash set of normalised benchmark windows.

Text is lower-cased (A-Z) and cut into words; every 10 consecutive words of a benchmark
item form a window (a shorter item is one window).  Training texts are scanned once: the
64-bit hash of each of their windows is looked up in the broadcast table, hits are
verified word by word in the same stage, and only hits and one row per document leave it.
DataFrame functions only.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"          # of lower-cased text
ANY_CASE = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"  # what separates words of original text


def words(text: Column) -> Column:
    """Words of a text; null has none."""
    low = F.translate(F.coalesce(text.cast("string"), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.regexp_extract_all(low, F.lit(WORD), F.lit(0))


def benchmark_windows(benchmark: DataFrame, n: int = 10, item: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct windows: gram (words joined by spaces), len, h (its hash), items (ids as
    text, sorted).  Items without words give none; rows of one id count as one item."""
    w = benchmark.select(F.col(item).cast("string").alias("item"), words(F.col(text)).alias("w")).where("size(w) > 0")
    size = F.least(F.size("w"), F.lit(n))
    grams = F.transform(F.sequence(F.lit(1), F.size("w") - size + 1), lambda i: F.slice("w", i, size))
    return (w.select("item", F.explode(grams).alias("g"))
            .groupBy(F.array_join("g", " ").alias("gram"), F.size("g").alias("len"), F.xxhash64("g").alias("h"))
            .agg(F.array_sort(F.collect_set("item")).alias("items")))


def _scan(docs: DataFrame, grams: DataFrame, lengths: list[int], text: str, carry: list[Column]) -> DataFrame:
    """One row per document row (pos null) and one per verified hit (pos, len, items)."""
    base = docs.select(*carry, words(F.col(text)).alias("w"))
    base = base.select("*", F.explode(F.array(*[F.lit(x) for x in lengths])).alias("wl"))
    hashes = F.when(F.size("w") >= F.col("wl"),
                    F.transform(F.sequence(F.lit(1), F.size("w") - F.col("wl") + 1),
                                lambda i: F.xxhash64(F.slice("w", i, F.col("wl")))))
    # element 0 stands for the document itself and never matches
    base = base.select("*", F.concat(F.array(F.lit(None).cast("long")), F.coalesce(hashes, F.array().cast("array<long>"))).alias("hs"))
    windows = base.select(*[c for c in base.columns if c != "hs"], F.posexplode_outer("hs").alias("pos", "wh"))
    same = ((F.col("wh") == F.col("h")) & (F.col("wl") == F.col("len"))
            & (F.array_join(F.slice("w", F.greatest("pos", F.lit(1)), F.col("wl")), " ") == F.col("gram")))
    found = windows.join(F.broadcast(grams), same, "left_outer")
    return found.where((F.col("gram").isNotNull()) | ((F.col("pos") == 0) & (F.col("wl") == lengths[0])))


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = 10, doc: str = "doc_id", text: str = "text",
                  item: str = "item_id", broadcast_bytes: int = 32 << 20) -> DataFrame:
    """One row per input row: ``doc``, text_key (hash of the text), n_words, spans (first
    word from 0, length; the verified windows), n_hit (words inside any of them), n_items,
    items (ids as text, sorted as strings), contaminated.

    Nulls have no words; rows that repeat a (doc, text) pair get equal results each; empty
    tables give no rows or no hits; other columns are not read.  The windows are broadcast
    if their bytes, counted first, fit ``broadcast_bytes``; a larger benchmark is looked
    up in as many blocks of that size, each against all documents.
    """
    grams = benchmark_windows(benchmark, n, item, text)
    stat = grams.agg(F.sum(F.octet_length("gram") + 64 + F.size("items") * 24).alias("b"),
                     F.sort_array(F.collect_set("len")).alias("l")).first()  # at most n lengths
    lengths, blocks = list(stat.l) or [n], 1 + int(stat.b or 0) // broadcast_bytes
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    carry = [F.col(doc).alias("d"), F.xxhash64(body).alias("tk"), F.octet_length(body).alias("tb")]
    parts = [_scan(docs, grams if blocks == 1 else grams.where(F.pmod("h", F.lit(blocks)) == b), lengths, text, carry)
             .select("d", "tk", "tb", F.size("w").alias("n_words"), "pos", "len", "items",
                     (F.col("gram").isNull() & F.lit(b == 0)).alias("own")) for b in range(blocks)]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    hit = F.when(F.col("items").isNotNull(), F.struct((F.col("pos") - 1).alias("pos"), F.col("len").alias("len")))
    per = rows.groupBy("d", "tk", "tb").agg(
        F.max("n_words").cast("long").alias("n_words"), F.count_if("own").alias("copies"),
        F.array_sort(F.collect_set(hit)).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))

    def cover(a: Column, x: Column) -> Column:
        end = x["pos"] + x["len"]
        return F.struct((a["n"] + F.greatest(F.lit(0), end - F.greatest(a["end"], x["pos"]))).alias("n"),
                        F.greatest(a["end"], end).alias("end"))

    per = per.withColumn("n_hit", F.aggregate("spans", zero, cover, lambda a: a["n"]).cast("long"))
    per = per.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))
    return per.select(F.col("d").alias(doc), F.col("tk").alias("text_key"), "n_words", "spans", "n_hit",
                      F.size("items").cast("long").alias("n_items"), "items", (F.col("n_hit") > 0).alias("contaminated"))


def remove(docs: DataFrame, benchmark: DataFrame, mode: str = "documents", n: int = 10, doc: str = "doc_id",
           text: str = "text", item: str = "item_id") -> DataFrame:
    """``docs`` with all its columns, without contaminated documents (``documents``) or
    with hit words and the separators before them cut from their texts (``spans``).  A
    text left whole is returned as it was, null texts too."""
    bad = (contamination(docs, benchmark, n, doc, text, item).where("contaminated")
           .select(F.col(doc).alias("__d"), F.col("text_key").alias("__k"), F.col("spans").alias("__s"))
           .dropDuplicates(["__d", "__k"]))
    key = F.xxhash64(F.coalesce(docs[text].cast("string"), F.lit("")))
    same = docs[doc].eqNullSafe(F.col("__d")) & (key == F.col("__k"))
    if mode == "documents":
        return docs.join(bad, same, "left_anti")
    pieces = F.regexp_extract_all(F.col(text), F.lit(f"[{ANY_CASE}]*[^{ANY_CASE}]+"), F.lit(0))
    kept = F.filter(pieces, lambda p, i: ~F.exists("__s", lambda s: (i >= s["pos"]) & (i < s["pos"] + s["len"])))
    tail = F.regexp_extract(F.col(text), f"[{ANY_CASE}]*$", 0)
    cut = F.when(F.col("__s").isNull(), F.col(text)).otherwise(F.concat(F.array_join(kept, ""), tail))
    return docs.join(bad, same, "left").withColumn(text, cut).select(*docs.columns)
