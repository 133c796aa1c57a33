"""Feature transformers.

Relational forms keep features long — ``(row, feature, value)`` — so nothing is
densified; vocabularies are bounded by their parameters (``max_features``) or by
category counts, and are joined by key (AQE broadcasts them when measured small).
Spark ML stages are used where their meaning matches the reference's library.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (PCA, FeatureHasher, OneHotEncoder, RFormula, StringIndexer,
                                VectorAssembler)
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.relate import global_row_index


# ------------------------------------------------------------------ Spark ML stages

def onehot_stages(cols: Sequence[str], features: str = "features") -> list:
    """Frequency-ordered indexers (unseen kept), one-hot, assembler."""
    index, vector = ([f"{c}__{kind}" for c in cols] for kind in ("index", "onehot"))
    # one indexer for all columns: their counts come from a single pass
    return [StringIndexer(inputCols=list(cols), outputCols=index, handleInvalid="keep", stringOrderType="frequencyDesc"),
            OneHotEncoder(inputCols=index, outputCols=vector), VectorAssembler(inputCols=vector, outputCol=features)]


def fit_onehot(train: DataFrame, cols: Sequence[str], features: str = "features") -> PipelineModel:
    """Fit the encoding on the training rows only."""
    return Pipeline(stages=onehot_stages(cols, features)).fit(train)


def fit_hot_positions(train: DataFrame, cols: Sequence[str]):
    """X1-X3 without vectors: the number of (column, value) pairs of the training rows, and
    a function that adds to any rows the positions that are hot, as an int array.  Values
    unseen while fitting have no position, so their row is all zeros in that column."""
    labels = StringIndexer(inputCols=list(cols), outputCols=[f"{c}__i" for c in cols], handleInvalid="keep").fit(train).labelsArray
    starts = [sum(len(v) for v in labels[:i]) for i in range(len(cols))]

    def positions(df: DataFrame, out: str = "hot") -> DataFrame:
        # the dictionaries are constants of the plan: as many entries as the weights have
        at = [F.try_element_at(F.from_json(F.lit(json.dumps({v: s + i for i, v in enumerate(values)})), "map<string,int>"), F.col(c).cast("string"))
              for c, values, s in zip(cols, labels, starts, strict=True)]
        return df.withColumn(out, F.array_compact(F.array(*at)))

    return sum(len(v) for v in labels), positions


def hashed_features(cols: Sequence[str], num_features: int = 10_000, out: str = "features") -> FeatureHasher:
    """X5."""
    return FeatureHasher(numFeatures=num_features, inputCols=list(cols), outputCol=out)


def formula_features(formula: str, out: str = "features", label: str = "label") -> RFormula:
    """R-style formula with interactions (``a:b``), unseen levels kept."""
    return RFormula(formula=formula, featuresCol=out, labelCol=label, handleInvalid="keep")


# ------------------------------------------------------------------ relational encoders

def meet_dictionary(df: DataFrame, dictionary: DataFrame, key: str, most: int = 100_000) -> DataFrame:
    """Inner join to a dictionary by ``key``.  One counted to hold at most ``most`` entries is
    broadcast: joined by shuffle, all rows of a frequent entry would meet in one task."""
    small = dictionary.limit(most + 1).count() <= most
    return df.join(F.broadcast(dictionary) if small else dictionary, key)


def category_vocabulary(fit_df: DataFrame, cols: Sequence[str], out: str = "index") -> DataFrame:
    """X7/X9 fit: every (column, value) seen while fitting as ``name = col=value``,
    indexed in sorted name order."""
    names = fit_df.select(F.explode(F.array(*[F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in cols])).alias("feature"))
    return global_row_index(names.where(F.col("feature").isNotNull()).distinct(), ["feature"], out)


def one_hot_long(df: DataFrame, id_col: str, cols: Sequence[str], vocab: DataFrame,
                 index: str = "index") -> DataFrame:
    """X7/X9 transform: (id, feature, index, value=1); values unseen at fit time vanish."""
    names = F.array(*[F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in cols])
    stacked = df.select(id_col, F.explode(names).alias("feature"))  # one scan for all columns
    return (meet_dictionary(stacked, vocab.select("feature", index), "feature")
            .select(id_col, "feature", index, F.lit(1.0).alias("value")))


def dummies(df: DataFrame, cols: Sequence[str], max_categories: int) -> DataFrame:
    """One 0/1 column per distinct value of each chosen column (``get_dummies``).

    Distinct values become columns of the plan; the caller says how many columns a table
    may get (``max_categories`` each).  For more, ``one_hot_long`` has no bound.
    """
    out = df
    for c in cols:
        vals = [r[0] for r in df.select(c).distinct().where(F.col(c).isNotNull())
                .orderBy(c).limit(max_categories + 1).collect()]
        if len(vals) > max_categories:
            raise ValueError(f"{c}: more than {max_categories} categories")
        out = out.withColumns({f"{c}_{v}": (F.col(c) == F.lit(v)).cast("int") for v in vals}).drop(c)
    return out


def map_features(m: Column) -> Column:
    """A string map as ``key=value`` feature names."""
    return F.transform(F.map_entries(m), lambda e: F.concat(e["key"], F.lit("="), e["value"]))


def inverse_map_features(encoded: DataFrame, vocab: DataFrame, id_col: str, index: str = "index", out: str = "features") -> DataFrame:
    """X9 inverse / F16: the string map of each row, from its hot positions (id, index) and
    the dictionary (feature, index).  A key is what stands before the first ``=``; of
    several values that a row has of a key the last in order stays, so that a key occurs
    once.  Positions without a dictionary entry are left out."""
    named = meet_dictionary(encoded, vocab.select("feature", index), index)
    at = F.instr("feature", "=")
    pairs = named.select(id_col, F.substring(F.col("feature"), F.lit(1), at - 1).alias("__key"), F.substring(F.col("feature"), at + 1, F.length("feature")).alias("__value"))
    once = pairs.groupBy(id_col, "__key").agg(F.max("__value").alias("__value"))
    return once.groupBy(id_col).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("__key", "__value")))).alias(out))


def label_encode(df: DataFrame, col: str, out: str = "index") -> DataFrame:
    """Sorted distinct labels -> 0..k-1 (dictionary, join it back)."""
    return global_row_index(df.select(col).distinct().where(F.col(col).isNotNull()), [col], out)


def standard_scaler(fit_df: DataFrame, cols: Sequence[str]):
    """X11: returns ``transform(df)`` that standardises with the fit rows' mean and
    *population* std (zero std leaves the column centred, like the library)."""
    row = fit_df.agg(*[F.avg(c).alias(f"m_{c}") for c in cols],
                     *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).first()
    stats = {c: (row[f"m_{c}"], row[f"s_{c}"] or 1.0) for c in cols}

    def transform(df: DataFrame) -> DataFrame:
        return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in stats.items()})
    transform.stats = stats  # type: ignore[attr-defined]
    return transform


def pca(df: DataFrame, vec_col: str, k: int, whiten: bool = False, out: str = "pca"):
    """Centred PCA (Spark's PCA projects uncentred rows, so centre first);
    ``whiten`` scales components to unit sample variance.  Returns (df, model)."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    vec = array_to_vector(F.col(vec_col)) if dict(df.dtypes)[vec_col].startswith("array") else F.col(vec_col)
    base = df.withColumn("__v", vec)
    mean = base.select(Summarizer.mean(F.col("__v")).alias("m")).first().m.toArray().tolist()
    centred = base.withColumn("__c", array_to_vector(F.zip_with(vector_to_array("__v"),
                              F.array(*[F.lit(x) for x in mean]), lambda a, b: a - b)))
    model = PCA(k=k, inputCol="__c", outputCol="__p").fit(centred)
    proj = model.transform(centred).withColumn(out, vector_to_array("__p")).drop("__v", "__c", "__p")
    if whiten:
        sd = proj.select(*[F.stddev_samp(F.col(out)[i]).alias(f"s{i}") for i in range(k)]).first()
        scale = F.array(*[F.lit(1.0 / (sd[i] or 1.0)) for i in range(k)])
        proj = proj.withColumn(out, F.zip_with(out, scale, lambda a, b: a * b))
    return proj, model


# ------------------------------------------------------------------ bag of words / TF-IDF

def term_counts(tokens: DataFrame, doc: str = "doc_id", token: str = "token") -> DataFrame:
    """(doc, term, tf) from long-form tokens."""
    return tokens.groupBy(doc, F.col(token).alias("term")).agg(F.count(F.lit(1)).alias("tf"))


def fit_vocabulary(tf: DataFrame, n_docs: Column | int, min_df: float = 1, max_df: float = 1.0,
                   max_features: int | None = None, doc: str = "doc_id") -> DataFrame:
    """X13 fit: (term, df, total, index).  ``min_df``/``max_df`` are counts when >= 1
    (ints) and fractions of ``n_docs`` otherwise; then the ``max_features`` most
    frequent terms (ties: term order) are kept and indexed alphabetically."""
    stats = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total"))
    n = F.lit(n_docs) if isinstance(n_docs, int) else n_docs
    lo = F.lit(min_df) if isinstance(min_df, int) else F.ceil(n * min_df)
    hi = F.lit(max_df) if isinstance(max_df, int) else n * max_df
    kept = stats.where((F.col("df") >= lo) & (F.col("df") <= hi))
    if max_features is not None:
        kept = kept.orderBy(F.desc("total"), F.asc("term")).limit(max_features)
    return global_row_index(kept, ["term"], "index")


def bag_of_words(tf: DataFrame, vocab: DataFrame) -> DataFrame:
    """X13 transform: (doc, term, index, tf) restricted to the vocabulary."""
    return tf.join(vocab.select("term", "index"), "term")


def tfidf(tf: DataFrame, vocab: DataFrame, n_docs: Column | int, doc: str = "doc_id") -> DataFrame:
    """weight = tf * (ln((1 + n) / (1 + df)) + 1), L2-normalised per document."""
    n = F.lit(n_docs) if isinstance(n_docs, int) else n_docs
    raw = tf.join(vocab.select("term", "index", "df"), "term").withColumn(
        "w", F.col("tf") * (F.log((1 + n) / (1 + F.col("df"))) + 1))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(doc)))
    return raw.select(doc, "term", "index", (F.col("w") / norm).alias("weight"))

