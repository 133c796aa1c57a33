"""Registered queries: text functions, vector math and encoders (F*, X*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import text as tx
from quarry.functions import vector as vx
from quarry.functions.stopwords import ENGLISH
from quarry.operators import encode as en
from quarry.operators import sparse_kmeans
from quarry.operators.topics import top_terms
from quarry.plans.catalog import register, rounded, sql_rounded
from quarry.session import kept, stored
from quarry.sources import fixtures as fx
from quarry.sources.tables import table

_STOP_VALUES = ", ".join(f"('{w}')" for w in ENGLISH)


def _stop_df(spark):
    return spark.createDataFrame([(w,) for w in ENGLISH], "word string")


@register("f1_f4_clean_text", f"""
SELECT doc_id, array_to_string({tx.alpha_tokens_sql('text')}, ' ') AS clean_text FROM documents""")
def f1_f4_clean_text(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", tx.join_tokens(tx.alpha_tokens(F.col("text"))).alias("clean_text"))


_RULE_VALUES = ", ".join(f"({i}, '{s}', '{r}')" for i, (s, r) in enumerate(tx.NOUN_SUFFIX_RULES))
_LEMMA_CTES = f"""kept AS (SELECT doc_id, pos, token FROM tokens WHERE token NOT IN (SELECT word FROM part_words)),
vocab AS (SELECT DISTINCT token FROM kept),
rules AS (SELECT * FROM (VALUES {_RULE_VALUES}) AS r(rid, suf, rep)),
cand AS (SELECT v.token, left(v.token, length(v.token) - length(r.suf)) || r.rep AS cand
         FROM vocab v, rules r WHERE suffix(v.token, r.suf) AND length(v.token) > length(r.suf)),
known AS (SELECT token, cand FROM cand WHERE cand IN (SELECT token FROM vocab)
          UNION ALL SELECT token, token FROM vocab),
lem AS (SELECT token, arg_min(cand, (length(cand), cand)) AS lemma FROM known GROUP BY 1)"""


def _kept_and_lemmas(spark, sf_dir):
    kept = tx.remove_listed(fx.tokens(spark, sf_dir), fx.part_words(spark, sf_dir))
    return kept, tx.noun_lemmas(kept)


@register("f9_noun_lemmas", fx.with_sql(["tokens", "part_words"], "SELECT token, lemma FROM lem", _LEMMA_CTES))
def f9_noun_lemmas(spark, sf_dir):
    return _kept_and_lemmas(spark, sf_dir)[1]


_LEMMAS = 500_000  # words with another lemma that are broadcast, at most


@register("f5_j3_clean_documents", fx.with_sql(["tokens", "part_words"], """
SELECT doc_id, string_agg(lemma, ' ' ORDER BY pos) AS clean_text FROM kept JOIN lem USING (token) GROUP BY 1""",
                                                _LEMMA_CTES))
def f5_j3_clean_documents(spark, sf_dir):
    """lower -> split -> letters only -> drop names -> noun lemma -> join, per document."""
    kept, lem = _kept_and_lemmas(spark, sf_dir)
    # most words are their own lemma: the others are counted and go to the tokens, which
    # are then shuffled by document alone
    changed = lem.where("lemma != token").checkpoint()
    per_doc = (kept.join(F.broadcast(changed) if changed.count() <= _LEMMAS else changed, "token", "left").groupBy("doc_id")
               .agg(F.array_sort(F.collect_list(F.struct("pos", F.coalesce("lemma", "token").alias("lemma")))).alias("__s")))
    return per_doc.select("doc_id", tx.join_tokens(F.transform("__s", lambda s: s["lemma"])).alias("clean_text"))


@register("f6_vectoriser_tokens", f"SELECT doc_id, {tx.word_tokens_sql('text')} AS tokens FROM documents")
def f6_vectoriser_tokens(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", tx.word_tokens(F.col("text")).alias("tokens"))


@register("f7_word_punct_tokens",
          "SELECT doc_id, regexp_extract_all(text, '" + tx.WORD_OR_PUNCT.replace("'", "''")
          + "') AS tokens FROM documents")
def f7_word_punct_tokens(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", tx.word_punct_tokens(F.col("text")).alias("tokens"))


@register("f8_sentences")
def f8_sentences(spark, sf_dir):
    """Sentence segmentation (Java BreakIterator); no DuckDB twin, rows-only check."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.posexplode(tx.sentences(F.col("text"))).alias("sentence", "words"))


@register("f10_porter_stems")
def f10_porter_stems(spark, sf_dir):
    """Porter stems of the corpus vocabulary (one Arrow UDF call per distinct token)."""
    return tx.stems(fx.tokens(spark, sf_dir))


_W = [round((i + 1) / 64.0 - 0.5, 6) for i in range(64)]
_W_SQL = "[" + ", ".join(repr(w) for w in _W) + "]"
_Z_SQL = ("list_reduce(list_transform(range(1, 65), lambda i: CAST(embedding[i] AS DOUBLE) * "
          f"{_W_SQL}[i]), lambda a, b: a + b)")
_VEC_SPEC = {"z": 6, "sig": 6, "dsig": 6, "loss": 6, "norm": 6}


@register("f11_f15_vector_math", sql_rounded(f"""
SELECT vec_id, z, sig, sig * (1 - sig) AS dsig,
       -(label % 2) * ln(sig) - (1 - (label % 2)) * ln(1 - sig) AS loss, norm, amin, amax FROM (
  SELECT vec_id, label, z, CASE WHEN z >= 0 THEN 1 / (1 + exp(-z)) ELSE exp(z) / (1 + exp(z)) END AS sig,
         sqrt(list_reduce(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)),
                          lambda a, b: a + b)) AS norm,
         CAST(list_position(embedding, list_min(embedding)) - 1 AS INTEGER) AS amin,
         CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS amax
  FROM (SELECT *, {_Z_SQL} AS z FROM embeddings))""", _VEC_SPEC))
def f11_f15_vector_math(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    z = vx.dot_const(F.col("embedding"), _W)
    s = vx.sigmoid(F.col("z"))
    out = (e.withColumn("z", z).withColumn("sig", s)
           .select("vec_id", "z", "sig", (F.col("sig") * (1 - F.col("sig"))).alias("dsig"),
                   vx.log_loss((F.col("label") % 2).cast("double"), F.col("sig")).alias("loss"),
                   vx.norm(F.col("embedding")).alias("norm"),
                   vx.argmin(F.col("embedding")).cast("int").alias("amin"),
                   vx.argmax(F.col("embedding")).cast("int").alias("amax")))
    return rounded(out, _VEC_SPEC)


# ---------------------------------------------------------------- encoders

_CAT = ["p_brand", "p_type", "c_mktsegment", "o_orderpriority"]
_FIT_CUTOFF = "1999-01-01"


def _stack_sql(cols, where=""):
    return " UNION ALL ".join(f"SELECT row_id, '{c}=' || {c} AS feature FROM clicks {where}" for c in cols)


@register("x7_one_hot_long", fx.with_sql(["clicks"], f"""
SELECT row_id, feature, index, 1.0 AS value FROM ({_stack_sql(_CAT)}) st JOIN vocab USING (feature)""",
                                         f"""vocab AS (SELECT feature, row_number() OVER (ORDER BY feature) - 1 AS index
  FROM (SELECT DISTINCT feature FROM ({_stack_sql(_CAT, f"WHERE l_shipdate < TIMESTAMP '{_FIT_CUTOFF}'")})))"""))
def x7_one_hot_long(spark, sf_dir):
    """Fit the category vocabulary on rows shipped before the cutoff, encode every row;
    categories never seen while fitting produce no feature (all zeros)."""
    c = fx.clicks(spark, sf_dir)
    vocab = en.category_vocabulary(c.where(F.col("l_shipdate") < F.lit(_FIT_CUTOFF).cast("timestamp_ntz")), _CAT)
    return en.one_hot_long(c, "row_id", _CAT, vocab)


# The market segments of the customer table.
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@register("x8_dummies", "SELECT c_custkey, " + ", ".join(
    f"CAST(c_mktsegment = '{s}' AS INTEGER) AS c_mktsegment_{s}" for s in SEGMENTS) + " FROM customer")
def x8_dummies(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return en.dummies(c, ["c_mktsegment"], max_categories=50)


@register("x9_f16_dict_vectoriser", fx.with_sql(["clicks"], """
SELECT row_id, feature, index FROM (SELECT row_id, unnest(['linestatus=' || l_linestatus,
                                                            'segment=' || c_mktsegment]) AS feature FROM clicks)
JOIN (SELECT feature, row_number() OVER (ORDER BY feature) - 1 AS index FROM (
        SELECT DISTINCT unnest(['linestatus=' || l_linestatus, 'segment=' || c_mktsegment]) AS feature
        FROM clicks)) USING (feature)"""))
def x9_f16_dict_vectoriser(spark, sf_dir):
    c = fx.clicks(spark, sf_dir)
    m = F.create_map(F.lit("linestatus"), F.col("l_linestatus"), F.lit("segment"), F.col("c_mktsegment"))
    feats = c.select("row_id", F.explode(en.map_features(m)).alias("feature"))
    vocab = en.label_encode(feats, "feature")
    return en.meet_dictionary(feats, vocab, "feature").select("row_id", "feature", "index")


@register("x9_f16_inverse_map", fx.with_sql(["clicks"], """
SELECT row_id, l_linestatus AS linestatus, c_mktsegment AS segment, 2 AS n FROM clicks"""))
def x9_f16_inverse_map(spark, sf_dir):
    """Maps encoded as hot positions, and rebuilt from these and the dictionary alone."""
    c = fx.clicks(spark, sf_dir)
    m = F.create_map(F.lit("linestatus"), F.col("l_linestatus"), F.lit("segment"), F.col("c_mktsegment"))
    feats = c.select("row_id", F.explode(en.map_features(m)).alias("feature"))
    vocab = en.label_encode(feats, "feature")
    hot = en.meet_dictionary(feats, vocab, "feature").select("row_id", "index")
    back = en.inverse_map_features(hot, vocab, "row_id")
    return back.select("row_id", F.col("features")["linestatus"].alias("linestatus"), F.col("features")["segment"].alias("segment"), F.size("features").alias("n"))


@register("x10_label_encode", """
SELECT p_type, row_number() OVER (ORDER BY p_type) - 1 AS index FROM (SELECT DISTINCT p_type FROM part)""")
def x10_label_encode(spark, sf_dir):
    return en.label_encode(table(spark, sf_dir, "part"), "p_type")


_Z_SPEC = {"l_quantity": 6, "l_extendedprice": 6}


@register("x11_standardise", sql_rounded(fx.with_sql(["clicks"], f"""
SELECT row_id, (l_quantity - mq) / sq AS l_quantity, (l_extendedprice - mp) / sp AS l_extendedprice
FROM clicks, (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq, avg(l_extendedprice) AS mp,
                     stddev_pop(l_extendedprice) AS sp FROM clicks
              WHERE l_shipdate < TIMESTAMP '{_FIT_CUTOFF}')"""), _Z_SPEC))
def x11_standardise(spark, sf_dir):
    c = fx.clicks(spark, sf_dir)
    scale = en.standard_scaler(c.where(F.col("l_shipdate") < F.lit(_FIT_CUTOFF).cast("timestamp_ntz")),
                               ["l_quantity", "l_extendedprice"])
    return rounded(scale(c.select("row_id", "l_quantity", "l_extendedprice")), _Z_SPEC)


@register("x12_pca_whiten")
def x12_pca_whiten(spark, sf_dir):
    """Centred, whitened PCA of the embeddings to 8 components (rows-only check)."""
    e = table(spark, sf_dir, "embeddings")
    out, _ = en.pca(e, "embedding", 8, whiten=True)
    return out.select("vec_id", "label", "pca")


def _bow_ctes(limit: str) -> str:
    return f"""toks AS (SELECT doc_id, unnest({tx.word_tokens_sql('text')}) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM toks
       WHERE term NOT IN (SELECT w FROM (VALUES {_STOP_VALUES}) AS s(w)) GROUP BY 1, 2),
st AS (SELECT term, count(*) AS df, sum(tf) AS total FROM tf GROUP BY 1),
vocab AS (SELECT term, df FROM st WHERE df >= 2 AND df <= (SELECT count(*) FROM documents) * 0.5
          {limit}),
vi AS (SELECT term, df, row_number() OVER (ORDER BY term) - 1 AS index FROM vocab)"""


_BOW_CTES = _bow_ctes("")  # every term within the document-frequency bounds
_TOP_TERMS = 500           # X13's max_features


def _bow_parts(spark, sf_dir, max_features=None):
    d = table(spark, sf_dir, "documents")
    # the stop words are a constant of the plan: joined to them, every word would be shuffled
    toks = (d.select("doc_id", F.explode(tx.word_tokens(F.col("text"))).alias("token"))
            .where(~F.col("token").isin(sorted({w.lower() for w in ENGLISH}))))
    # tokenising every document is the expensive part; the term counts feed the vocabulary
    # fit and every transform, so they are written once under the shared checkpoint folder
    tf = stored(en.term_counts(toks), "term_counts")
    n_docs = d.select(F.count(F.lit(1))).scalar()
    vocab = en.fit_vocabulary(tf, n_docs, min_df=2, max_df=0.5, max_features=max_features)
    # Spark takes the compressed file's size for the table's and would broadcast the counts
    return tf if max_features else tf.hint("merge"), vocab, n_docs


@register("x13_bag_of_words", fx.with_sql([], "SELECT doc_id, term, index, tf FROM tf JOIN vi USING (term)",
                                          _bow_ctes(f"ORDER BY total DESC, term LIMIT {_TOP_TERMS}")))
def x13_bag_of_words(spark, sf_dir):
    tf, vocab, _ = _bow_parts(spark, sf_dir, max_features=_TOP_TERMS)
    return en.bag_of_words(tf, vocab).select("doc_id", "term", "index", "tf")


_TFIDF_SQL = """
SELECT doc_id, term, index, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM (
  SELECT doc_id, term, index, tf * (ln((1 + (SELECT count(*) FROM documents)) / (1 + df)) + 1) AS w
  FROM tf JOIN vi USING (term))"""


@register("x14_tfidf", sql_rounded(fx.with_sql([], _TFIDF_SQL, _BOW_CTES), {"weight": 6}))
def x14_tfidf(spark, sf_dir):
    tf, vocab, n = _bow_parts(spark, sf_dir)
    return rounded(en.tfidf(tf, vocab, n), {"weight": 6})


def _tfidf(spark, sf_dir):
    """(weights, vocabulary): TF-IDF rows of all documents over the whole vocabulary; those who
    use the weights read them once."""
    tf, vocab, n = _bow_parts(spark, sf_dir)
    vocab = kept(vocab)
    return en.tfidf(tf, vocab, n).select("doc_id", "index", "weight"), vocab


@register("m39_scores_given_labels", sql_rounded(fx.with_sql([], f"""
SELECT lang AS cluster, count(*) AS n_docs, coalesce(greatest(any_value(q) - any_value(s2) / count(*), 0.0), 0.0) AS ss
FROM documents LEFT JOIN (
  SELECT lang, sum(s * s) AS s2, sum(q) AS q FROM (
    SELECT lang, index, sum(weight) AS s, sum(weight * weight) AS q FROM ({_TFIDF_SQL}) JOIN documents USING (doc_id) GROUP BY lang, index)
  GROUP BY lang) USING (lang)
GROUP BY lang""", _BOW_CTES), {"ss": 6}))
def m39_scores_given_labels(spark, sf_dir):
    """Squared distances to the mean TF-IDF vector of each language, the clusters given."""
    labels = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("cluster"))
    return rounded(sparse_kmeans.scores_of(_tfidf(spark, sf_dir)[0], labels), {"ss": 6})


@register("m38_m39_tfidf_elbow")
def m38_m39_tfidf_elbow(spark, sf_dir):
    """k-means of TF-IDF documents, k = 1..20 with two starts each, trained side by side:
    inertia and the sum of per-cluster norms."""
    return sparse_kmeans.fit(_tfidf(spark, sf_dir)[0], range(1, 21), restarts=2).scores


@register("m38_t5_tfidf_clusters")
def m38_t5_tfidf_clusters(spark, sf_dir):
    """Four clusters of TF-IDF documents: size and the ten heaviest terms of each centre."""
    weights, vocab = _tfidf(spark, sf_dir)
    got = sparse_kmeans.fit(weights, [4], restarts=1)
    sizes = got.labels.groupBy("cluster").agg(F.count(F.lit(1)).alias("n_docs"))
    named = got.centres.join(vocab.select("index", "term"), "index").select(F.col("cluster").alias("topic"), "term", "weight")
    top = top_terms(named, 10)
    return top.join(sizes, top["topic"] == sizes["cluster"]).drop("topic")
