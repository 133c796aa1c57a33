"""Text column functions (F1-F10).  All are JVM-side expressions except the Porter
stemmer, which runs once per *distinct* token in an Arrow batch UDF."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Unicode whitespace as Python's str.split() sees it, written for both Java regex and RE2.
WHITESPACE = (r"[\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
              r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+")
LETTERS_ONLY = r"^\p{L}+$"
# Library-default vectoriser token: a run of two or more word characters.
WORD2 = r"[\p{L}\p{N}_]{2,}"
# Word tokens with punctuation split off (words keep an inner apostrophe part).
WORD_OR_PUNCT = r"[\p{L}\p{N}_]+(?:'[\p{L}\p{N}_]+)?|[^\p{L}\p{N}_\s]"



def alpha_tokens_sql(text: str) -> str:
    """DuckDB twin of ``alpha_tokens``."""
    return (f"list_filter(string_split_regex(lower({text}), '{WHITESPACE}'), "
            f"lambda x: regexp_matches(x, '{LETTERS_ONLY}'))")


def word_tokens_sql(text: str) -> str:
    """DuckDB twin of ``word_tokens``."""
    return f"regexp_extract_all(lower({text}), '{WORD2}')"


def lower(c: Column) -> Column:
    """F1."""
    return F.lower(c)


def split_ws(c: Column) -> Column:
    """``str.split()`` — split on whitespace runs, drop empty pieces."""
    return F.filter(F.split(c, WHITESPACE), lambda x: x != "")


def letters_only(tokens: Column) -> Column:
    """keep tokens made only of letters (``str.isalpha``)."""
    return F.filter(tokens, lambda x: x.rlike(LETTERS_ONLY))


def alpha_tokens(text: Column) -> Column:
    """F1+F2+F3 composed."""
    return letters_only(split_ws(F.lower(text)))


def join_tokens(tokens: Column, sep: str = " ") -> Column:
    """F4."""
    return F.array_join(tokens, sep)


def word_tokens(text: Column) -> Column:
    """lower-cased words of two or more word characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD2), 0)


def word_punct_tokens(text: Column) -> Column:
    """words and single punctuation marks as separate tokens."""
    return F.regexp_extract_all(text, F.lit(WORD_OR_PUNCT), 0)


def sentences(text: Column) -> Column:
    """F8: sentence segmentation; one array of words per sentence (Java BreakIterator)."""
    return F.sentences(text)


def remove_listed(tokens_df: DataFrame, listed: DataFrame, token_col: str = "token",
                  listed_col: str = "word") -> DataFrame:
    """J3/J4 over long-form tokens: anti-join against a word list (names, stop words).

    The list is joined by key; Spark/AQE broadcast it when its measured size allows.
    """
    lst = listed.select(F.lower(F.col(listed_col)).alias("__w")).distinct()
    return tokens_df.join(lst, F.col(token_col) == F.col("__w"), "left_anti")


# ---------------------------------------------------------------- lemmas

# WordNet's noun detachment rules (suffix, replacement), in their order.
NOUN_SUFFIX_RULES = [("s", ""), ("ses", "s"), ("xes", "x"), ("zes", "z"),
                     ("ches", "ch"), ("shes", "sh"), ("men", "man"), ("ies", "y")]


def noun_lemmas(vocab: DataFrame, token_col: str = "token",
                lemma_table: DataFrame | None = None) -> DataFrame:
    """(token, lemma) for every distinct token.

    A lemma table wins when given; otherwise each plural-suffix rule proposes a base
    form, a proposal counts only if it is itself a corpus word, and the shortest
    known form wins (the token itself is always known).  All relational: the rule
    list is a literal array, the vocabulary check a join.
    """
    # written once: the joins below read it three times, and what it comes from may be long
    words = vocab.select(F.col(token_col).alias("token")).distinct().checkpoint()
    rules = F.array(*[F.struct(F.lit(s).alias("suf"), F.lit(r).alias("rep"))
                      for s, r in NOUN_SUFFIX_RULES])
    cand = (
        words.select("token", F.explode(rules).alias("r"))
        .where(F.col("token").endswith(F.col("r.suf")) &
               (F.length("token") > F.length(F.col("r.suf"))))
        .select("token", F.concat(F.expr("substring(token, 1, length(token) - length(r.suf))"),
                                  F.col("r.rep")).alias("cand"))
    )
    known = cand.join(words.select(F.col("token").alias("cand")), "cand", "left_semi")
    best = (
        known.unionByName(words.select("token", F.col("token").alias("cand")))
        .groupBy("token")
        .agg(F.min_by("cand", F.struct(F.length("cand"), F.col("cand"))).alias("lemma"))
    )
    if lemma_table is not None:
        lt = lemma_table.select(F.col("token").alias("__t"), F.col("lemma").alias("__l"))
        best = (best.join(lt, best.token == lt.__t, "left")
                .select("token", F.coalesce("__l", "lemma").alias("lemma")))
    return best


# ---------------------------------------------------------------- Porter stemmer

_VOWELS = frozenset("aeiou")


def _cons(w: str, i: int) -> bool:
    ch = w[i]
    if ch in _VOWELS:
        return False
    if ch == "y":
        return i == 0 or not _cons(w, i - 1)
    return True


def _measure(stem: str) -> int:
    """m in [C](VC)^m[V]."""
    m, prev_vowel = 0, False
    for i in range(len(stem)):
        is_v = not _cons(stem, i)
        if prev_vowel and not is_v:
            m += 1
        prev_vowel = is_v
    return m


def _has_vowel(stem: str) -> bool:
    return any(not _cons(stem, i) for i in range(len(stem)))


def _double_cons(w: str) -> bool:
    return len(w) >= 2 and w[-1] == w[-2] and _cons(w, len(w) - 1)


def _cvc(w: str) -> bool:
    return (len(w) >= 3 and _cons(w, len(w) - 3) and not _cons(w, len(w) - 2)
            and _cons(w, len(w) - 1) and w[-1] not in "wxy")


# Suffix tables of Porter (1980), steps 2, 3 and 4, in the paper's order.
_STEP2 = [("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
          ("izer", "ize"), ("abli", "able"), ("alli", "al"), ("entli", "ent"), ("eli", "e"),
          ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"),
          ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"),
          ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble")]
_STEP3 = [("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
          ("ful", ""), ("ness", "")]
_STEP4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent",
          "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize"]


def porter_stem(word: str) -> str:
    """Porter (1980) stemmer on one lower-case word."""
    w = word
    if len(w) <= 2:
        return w
    # step 1a
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith("ies"):
        w = w[:-2]
    elif w.endswith("ss"):
        pass
    elif w.endswith("s"):
        w = w[:-1]
    # step 1b
    extra = False
    if w.endswith("eed"):
        if _measure(w[:-3]) > 0:
            w = w[:-1]
    elif w.endswith("ed") and _has_vowel(w[:-2]):
        w, extra = w[:-2], True
    elif w.endswith("ing") and _has_vowel(w[:-3]):
        w, extra = w[:-3], True
    if extra:
        if w.endswith(("at", "bl", "iz")):
            w += "e"
        elif _double_cons(w) and w[-1] not in "lsz":
            w = w[:-1]
        elif _measure(w) == 1 and _cvc(w):
            w += "e"
    # step 1c
    if w.endswith("y") and _has_vowel(w[:-1]):
        w = w[:-1] + "i"
    # step 2
    for suf, rep in _STEP2:
        if w.endswith(suf):
            if _measure(w[: -len(suf)]) > 0:
                w = w[: -len(suf)] + rep
            break
    # step 3
    for suf, rep in _STEP3:
        if w.endswith(suf):
            if _measure(w[: -len(suf)]) > 0:
                w = w[: -len(suf)] + rep
            break
    # step 4
    for suf in _STEP4:
        if w.endswith(suf):
            stem = w[: -len(suf)]
            if _measure(stem) > 1:
                if suf != "ion" or stem.endswith(("s", "t")):
                    w = stem
            break
    # step 5a
    if w.endswith("e"):
        m = _measure(w[:-1])
        if m > 1 or (m == 1 and not _cvc(w[:-1])):
            w = w[:-1]
    # step 5b
    if _measure(w) > 1 and _double_cons(w) and w.endswith("l"):
        w = w[:-1]
    return w


@F.pandas_udf(T.StringType())
def _stem_udf(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else porter_stem(x))


def stems(vocab: DataFrame, token_col: str = "token") -> DataFrame:
    """(token, stem), computed once per distinct token; join it back to occurrences."""
    words = vocab.select(F.col(token_col).alias("token")).distinct()
    return words.select("token", _stem_udf("token").alias("stem"))
