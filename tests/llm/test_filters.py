"""Toxicity, quality, language model and benchmark decontamination against plain versions."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from quarry.llm import decontaminate, maxent, quality, toxicity
from tests.llm import data

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall("[^\x20\x09-\x0D]+", text or "")


# --- toxicity -------------------------------------------------------------------------

def toxic_rows():
    rnd = random.Random(9)
    out, labels = [], []
    for i in range(300):
        bad = i % 5 == 0
        text = data.prose(rnd, 60) + (" " + " ".join(rnd.choice(["vilest", "wretch", "scoundrelly", "scoundrel"]) for _ in range(3)) if bad else "")
        out.append((i, text))
        labels.append((i, int(bad)))
    return out, labels


def test_toxicity_on_held_out_documents(spark):
    rows, labels = toxic_rows()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    marks = spark.createDataFrame([*labels, (None, 1), (7, None)], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, marks, min_docs=3, min_g2=5.0)
    held = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    assert held and not held & set(model.ids.tolist())
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert all((got[i].score >= 0.3) == bool(y) for i, y in labels if i in held)
    kept = {r.doc_id for r in toxicity.reject(docs, model).collect()}
    assert kept == {i for i in got if got[i].score < 0.3}


def test_nearest_examples_are_exact(spark):
    rows, labels = toxic_rows()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"), min_docs=3, min_lift=1.2, min_g2=0.0)
    full = np.zeros((len(model.label), len(model.terms)))
    for t in range(len(model.terms)):
        lo, hi = model.start[t], model.start[t + 1]
        full[model.example[lo:hi], t] = model.weight[lo:hi]
    for _, text in rows[::7]:
        ids, w = model.vector(text)
        if not len(ids):
            continue
        near, cos = model.nearest(ids, w)
        every = full[:, ids] @ w
        want = np.sort(every)[::-1][:model.k]
        assert np.allclose(cos, want[want > 0]) and np.allclose(every[near], cos)


def test_toxicity_edge_rows(spark):
    rows, labels = toxic_rows()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"), min_docs=3, min_g2=5.0)
    scored = toxicity.score(data.docs(spark), model).collect()
    assert len(scored) == len(data.rows()) and all(0 <= r.score <= 1 for r in scored)
    assert toxicity.score(data.empty(spark), model).count() == 0
    assert toxicity.reject(data.docs(spark), model).columns == data.docs(spark).columns
    none = toxicity.fit(data.empty(spark), spark.createDataFrame([], "doc_id bigint, toxic int"))
    assert {r.score for r in toxicity.score(docs, none).collect()} == {0.0}


def test_a_labelled_id_on_many_rows_is_one_example(spark):
    rows, labels = toxic_rows()
    one = next(i for i, y in labels if y and zlib.crc32(str(i).encode()) % 4 != 2)
    docs = spark.createDataFrame([*rows, *([rows[one]] * 300), *((one, f"vilest other {i}") for i in range(50))], "doc_id bigint, text string")
    marks = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    model = toxicity.fit(docs.repartition(3), marks, min_docs=3, min_g2=5.0)
    assert len(model.ids) == len(set(model.ids.tolist())) and one in model.ids.tolist()


def test_rare_toxic_words_are_found(spark):
    """With the defaults: 400 insults, each in few of the toxic examples."""
    rnd = random.Random(3)
    bad = ["".join(rnd.choice("bcdfgklmnprstvz") + rnd.choice("aeiou") for _ in range(4)) for _ in range(400)]
    rows = [(i, data.prose(rnd, 20) + (f" {bad[i // 5 % 400]}" if i % 5 == 0 else "")) for i in range(12_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    marks = spark.createDataFrame([(i, int(i % 5 == 0)) for i, _ in rows], "doc_id bigint, toxic int")
    got = [r for r in toxicity.score(docs, toxicity.fit(docs, marks)).collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    found = [r.doc_id % 5 == 0 for r in got if r.score >= 0.3]
    assert sum(found) >= 0.95 * sum(r.doc_id % 5 == 0 for r in got) and sum(found) >= 0.95 * len(found)


# --- quality --------------------------------------------------------------------------

def base(text):
    w = words(text)
    windows = Counter(zip(w, w[1:], w[2:]))
    hit = {p for i, x in enumerate(zip(w, w[1:], w[2:])) if windows[x] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    n = len(w)
    return (n, sum(map(len, w)), len(re.findall("[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit), n < 50 or 100 * len(hit) > 50 * n)


def test_quality_base_rules(spark):
    docs = data.docs(spark)
    got = quality.assess(docs, quality.references(docs)).collect()
    want = sorted((str(r.doc_id), *base(r.text)) for r in docs.collect())
    assert sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == want
    assert not any(r.kept for r in got if r.base_failed)
    assert quality.assess(data.empty(spark), quality.references(data.empty(spark))).count() == 0


def test_references_are_plain_histograms(spark):
    """The most frequent words of a language, ties by their bytes, and their shares of all."""
    from collections import Counter
    texts = {"x": ["b a a c", "A d b"], "y": ["é é z"], "z": [None, " "]}
    rows = [(la, t) for la, ts in texts.items() for t in ts] + [(None, "a a a a a a")]
    got = quality.references(spark.createDataFrame(rows, "lang string, text string").repartition(3), top=2)
    assert got.langs == ["x", "y"]
    for i, la in enumerate(got.langs):
        words = Counter(w for t in texts[la] for w in t.lower().encode().split())
        top = sorted(words, key=lambda w: (-words[w], w))[:2]
        share = {w: got.word[i, j] for w, j in got.words.items() if got.own[i, j]}
        assert share == {w: pytest.approx(words[w] / sum(words.values())) for w in top}
        assert got.word[i, -1] == pytest.approx(1 - sum(share.values()))


def test_texts_of_a_language_without_reference_meet_the_base_rules_alone(spark):
    prose = [" ".join(f"{la}{j % 17}" for j in range(200 + i)) for la in "xy" for i in range(4)]
    docs = spark.createDataFrame([(i, t, "x" if i < 4 else "y") for i, t in enumerate(prose)], "doc_id bigint, text string, lang string")
    got = {r.doc_id: r for r in quality.assess(docs, quality.references(docs, max_langs=1)).collect()}
    apart = [i for i in got if got[i].nearest is None]
    assert apart in ([0, 1, 2, 3], [4, 5, 6, 7]) and all(got[i].kept != got[i].base_failed for i in apart)


def test_quality_by_divergence(spark):
    rnd = random.Random(4)
    good = [data.prose(rnd, 120) for _ in range(60)]
    junk = [" ".join(f"{rnd.randrange(10**6)}{rnd.choice('#*%|')}" for _ in range(120)), data.prose(rnd, 120).upper()]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(good + junk)], "doc_id bigint, text string, lang string")
    got = {r.doc_id: r for r in quality.assess(docs, quality.references(docs)).collect()}
    assert all(got[i].kept for i in range(60)) and not got[60].kept and not got[61].kept
    assert abs(float(quality.distance(np.array([1.0, 0]), np.array([0, 1.0]))) - 1) < 1e-12


# --- language model -------------------------------------------------------------------

def test_maxent_base_counts(spark):
    docs = data.docs(spark)
    vocab, counts = maxent.fit(docs)
    got = maxent.score(docs, vocab, counts).collect()
    tokens = [(r.doc_id, [w.encode() for w in words((r.text or "").translate(LOWER))] + [b""]) for r in docs.collect()]
    c = Counter(w for d, ws in tokens if zlib.crc32(("" if d is None else str(d)).encode()) % 10 for w in ws)
    n, v = sum(c.values()), len(c)
    want = sorted((str(d), len(ws), sum(c[w] > 0 for w in ws), round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), 6)) for d, ws in tokens)
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == want
    assert {r.train_tokens for r in got} == {n}
    assert maxent.score(data.empty(spark), vocab, counts).count() == 0


def test_maxent_words_outside_the_head(spark, monkeypatch):
    docs = data.docs(spark).select("doc_id", "text")
    whole = sorted((str(r.doc_id), r.n_known, round(r.base_score, 6), round(r.score, 4)) for r in maxent.score(docs, *maxent.fit(docs, steps=1)).collect())
    monkeypatch.setattr(maxent, "HEAD", 40)
    monkeypatch.setattr(maxent, "OWN_ROWS", 40)
    some = maxent.score(docs, *maxent.fit(docs, steps=1)).collect()
    assert sorted((str(r.doc_id), r.n_known, round(r.base_score, 6)) for r in some) == [w[:3] for w in whole]


def test_maxent_is_a_distribution_and_learns(spark):
    rnd = random.Random(8)
    # two languages with words of their own: context tells which comes next
    a, b = ["ka", "ko", "ki", "ku"] * 1, ["zem", "zim", "zum", "zom"]
    rows = [(i, " ".join(rnd.choice(a if i % 2 else b) for _ in range(80))) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    vocab, counts = maxent.fit(docs)
    f = maxent.features(np.array([1, 2, 3, 4]), np.array([4]))
    assert np.allclose(np.exp(maxent.log_classes(vocab, f)).sum(axis=1), 1, atol=1e-4)
    held = [r for r in maxent.score(docs, vocab, counts).collect() if r.held_out]
    assert sum(r.score for r in held) > 0.8 * sum(r.base_score for r in held)


def test_maxent_gradient_sums_are_exact(spark):
    """One distributed step equals the same step over all tokens at once."""
    rnd = random.Random(6)
    docs = spark.createDataFrame([(i, data.prose(rnd, 30)) for i in range(40)], "doc_id bigint, text string").repartition(5)
    start, _ = maxent.fit(docs, steps=0)
    after, _ = maxent.fit(docs, steps=1, rate=0.5)
    coder = maxent.Coder(start)
    texts = [r.text.encode() for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 10]
    _, kind, row, size = coder.texts(texts)
    f = maxent.features(row, size)
    rest = -np.exp(maxent.log_classes(start, f))
    rest[np.arange(len(kind)), kind] += 1
    g = np.zeros_like(start.weights, dtype=float)
    for i in range(maxent.GROUPS):
        np.add.at(g[i], f[i], rest)
    moved = (after.weights - start.weights) / 0.5
    some = np.abs(moved) > 1e-4
    assert some.any() and (np.sign(moved[some]) == np.sign(g[some])).all()


# --- benchmark decontamination ----------------------------------------------------------

def bench_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def contamination(text, items, n=10):
    w, hit, found = bench_words(text), set(), set()
    for item, itext in items:
        iw = bench_words(itext)
        size = min(n, len(iw))
        grams = {tuple(iw[i:i + size]) for i in range(len(iw) - size + 1)} if iw else set()
        for i in range(len(w) - size + 1):
            if size and tuple(w[i:i + size]) in grams:
                hit |= set(range(i, i + size))
                found.add(str(item))
    return len(w), len(hit), sorted(found)


def test_contamination(spark):
    texts = data.texts()
    items = [(1, texts[1][100:260]), (2, "one"), (10, texts[5]), (3, ""), (4, None), (5, "Amber, FALCON!"), (6, texts[1][100:260])]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    docs = data.docs(spark)
    want = sorted((str(r.doc_id), *contamination(r.text, items)) for r in docs.collect())
    for limit in (32 << 20, 4000):  # at once, and in blocks
        got = decontaminate.contamination(docs, bench, broadcast_bytes=limit).collect()
        assert sorted((str(r.doc_id), r.n_words, r.n_hit, r["items"]) for r in got) == want
    assert decontaminate.contamination(data.empty(spark), bench).count() == 0
    assert {r.n_hit for r in decontaminate.contamination(docs, bench.where("false")).collect()} == {0}


def test_contaminated_documents_and_spans_go(spark):
    texts = data.texts()
    items = [(1, texts[1][100:260])]
    bench, docs = spark.createDataFrame(items, "item_id bigint, text string"), data.docs(spark)
    left = decontaminate.remove(docs, bench).collect()
    assert sorted(str((r.doc_id, r.text)) for r in left) == sorted(str((r.doc_id, r.text)) for r in docs.collect() if not contamination(r.text, items)[1])
    cut = decontaminate.remove(docs, bench, "spans")
    assert cut.columns == docs.columns and cut.count() == docs.count()
    for r in cut.where("doc_id = 1").collect():
        n, hit, _ = contamination(texts[1], items)
        assert len(bench_words(r.text)) == n - hit and contamination(r.text, items)[1] == 0
