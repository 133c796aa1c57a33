"""Conversation trie, exact dedup and whitening against plain versions."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from quarry.llm import conversation_trie, exact_dedup, whitening
from tests.llm import data

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TURNS = "conv_id bigint, turn bigint, role string, text string, c string, d string, m string, k0 string, pid string, u string"


# --- conversation trie ------------------------------------------------------------------

def plain_trie(rows):
    """Nodes as (conv_id, depth, parent, n_convs, n_children, n_leaves, saved, sha)."""
    turns = defaultdict(list)
    for c, t, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            turns[c].append((t is not None, t or 0, tie, role, text))
    turns = {c: [(r, s) for *_, r, s in sorted(v)] for c, v in turns.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(turns):
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        new = turns.get(base, [])[:h] + turns[c][h:]
        for d in range(len(new) + 1):
            members[tuple(new[:d])].append(c)
        ends[tuple(new)].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for k in members:
        if k:
            children[k[:-1]] += 1
    for k, of in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += children[k] == 0
            saved[k[:d]] += (len(of) - 1) * len(k[-1][1].encode()) if k else 0
    return {(of[0], len(k), members[k[:-1]][0] if k else None, len(of), children[k], leaves[k], saved[k],
             hashlib.sha256(",".join(map(str, ends[k])).encode()).hexdigest()) for k, of in members.items()}


def conversations(kind):
    rnd = random.Random(kind)
    rows = []
    if kind == "shared":
        for c in range(120):
            rows += [(c, t, rnd.choice(["user", "bot"]), rnd.choice(["a", "b", "ünï"])) for t in range(rnd.randrange(1, 9))]
    elif kind == "copies":  # one conversation that most have, and a long one
        rows = [(c, t, "user", f"t{t}") for c in range(0, 400, 5) for t in range(4)]
        rows += [(c, t, "user", f"t{t}") for c in range(400, 700) for t in range(4)]
        rows += [(9001, t, "bot", f"x{t % 3}") for t in range(700)] + [(9002, t, "bot", f"x{t % 3}") for t in range(650)]
    elif kind == "odd":
        rows = [(None, 1, "user", "no id"), (7, None, None, None), (7, None, "user", "b"), (7, 2, "user", "c"), (7, 2, "user", "c"), (-3, 1, "user", "a"),
                (-5, 1, "user", "a"), (1 << 61, 1, "u", ""), (12, 1, None, "x" * 50_000), (13, 3, "", "é😀"), (10, 1, "a", "bc"), (15, 1, "ab", "c"), (16, 1, "ab", "c")]
    return [(*r, *["clash"] * 6) for r in rows]


@pytest.mark.parametrize("limit", [40, 4096])
@pytest.mark.parametrize("kind", ["shared", "copies", "odd"])
def test_trie_is_that_of_plain_prefixes(spark, kind, limit):
    rows = conversations(kind)
    turns = spark.createDataFrame(rows, TURNS)
    got = conversation_trie.trie(turns, limit=limit).collect()
    assert len(got) == len({(r.conv_id, r.depth) for r in got})
    assert {tuple(r) for r in got} == plain_trie(rows)


def test_trie_of_an_empty_table(spark):
    got = conversation_trie.trie(spark.createDataFrame([(None, 1, "a", "b", *["x"] * 6)], TURNS))
    assert got.count() == 0 and got.columns[-1] == "ends_sha256"
    assert conversation_trie.trie(spark.createDataFrame([], TURNS)).count() == 0


def test_roll_up_in_a_task_needs_few_rounds():
    """A path and a star of 4,096 nodes, and random trees, summed as by walking up."""
    rnd = random.Random(3)
    for shape in ("path", "star", "random"):
        n = 4096
        up = [-1] + [{"path": i - 1, "star": 0, "random": rnd.randrange(max(0, i - 40), i)}[shape] for i in range(1, n)]
        depth = np.zeros(n, np.int64)
        for i in range(1, n):
            depth[i] = depth[up[i]] + 1
        w = np.array([[1, rnd.randrange(2**50)] for _ in range(n)])
        want = w.copy()
        for i in range(n - 1, 0, -1):
            want[up[i]] += want[i]
        assert (conversation_trie._roll_up(np.arange(n), depth, np.array(up), w) == want).all()


# --- exact dedup ------------------------------------------------------------------------

@pytest.mark.parametrize("counters", [1, 3, 256])
def test_exact_dedup_keeps_the_largest_id(spark, counters):
    rows = data.rows() * 2 + [(1000 + i, "Hot TEXT" if i % 3 else f"rare {i}", *data.rows()[0][2:]) for i in range(300)]
    docs = spark.createDataFrame(rows, data.SCHEMA).repartition(5)
    groups = defaultdict(list)
    for d, text, *_ in rows:
        groups[hashlib.sha256((text or "").translate(LOWER).encode()).hexdigest()].append(d)
    got = exact_dedup.mark(docs, counters=counters).collect()
    top = {h: max((d for d in v if d is not None), default=None) for h, v in groups.items()}
    assert sorted(str((r.doc_id, r.keep_id, r.group_size, r.text_sha256)) for r in got) == \
        sorted(str((d, top[h], len(v), h)) for h, v in groups.items() for d in v)
    kept = [r for r in got if r.kept]
    assert len(kept) == len(groups) == len({r.text_sha256 for r in kept}) and all(r.doc_id == r.keep_id for r in kept)
    left = exact_dedup.keep_one(docs, counters=counters)
    assert left.columns == docs.columns and left.count() == len(groups)


def test_exact_dedup_of_an_empty_table(spark):
    assert exact_dedup.mark(data.empty(spark)).count() == 0


def test_summary_holds_every_frequent_digest(spark):
    """Over many blocks and merges, what more than one row in counters + 1 has is found."""
    rows = spark.range(0, 200_000, 1, 6).selectExpr(
        "CASE WHEN id % 7 = 0 THEN 'a' WHEN id % 11 = 0 THEN 'b' ELSE cast(id as string) END h", "monotonically_increasing_id() u")
    found = {r.h for r in exact_dedup.frequent(rows, counters=16).collect()}
    assert {"a", "b"} <= found and len(found) <= 16


# --- whitening --------------------------------------------------------------------------

VECTORS = "vec_id bigint, embedding array<float>, component string, k string, v string"


def vectors(n, size, seed=0):
    rnd = np.random.default_rng(seed)
    x = rnd.standard_normal((n, size)) @ rnd.standard_normal((size, size)) * 0.3
    return [(i, [float(v) for v in row], "clash", "clash", "clash") for i, row in enumerate(x.astype(np.float32))]


def test_whitening_is_that_of_a_dense_decomposition(spark):
    good = vectors(500, 12)
    bad = [(900, None), (901, [float("nan")] * 12), (902, [float("inf")] + [0.0] * 11), (903, [None] + [0.0] * 11), (904, []), (905, [1.0] * 5)]
    good += [good[3], (None, *good[4][1:])]
    table = spark.createDataFrame(good + [(*b, "clash", "clash", "clash") for b in bad], VECTORS).repartition(4)
    model = whitening.fit(table)
    got = whitening.whiten(table, model).toPandas()
    x = np.floor(1024 * np.array([v for _, v, *_ in good], dtype=np.float32).astype(float)).astype(np.int64) + 100_000
    n = len(x)
    y = x - x.sum(axis=0) / n
    cov = y.T @ y / n
    e, q = np.linalg.eigh(cov)
    e, q = e[::-1][:8], q[:, ::-1][:, :8]
    q = q * np.sign((q * (model.projection * np.sqrt(e))).sum(axis=0))
    white, dev = y @ q / np.sqrt(e), np.square(n * x - x.sum(axis=0)).sum(axis=1)
    assert len(got) == 8 * n and set(got.n) == {n} and got.identity_error.max() < 1e-9 and got.identity_error.nunique() == 1
    want = sorted((str(v), c + 1, int(dev[i]), round(white[i, c], 6) + 0.0, round(e[c] / np.trace(cov), 9)) for i, (v, *_) in enumerate(good) for c in range(8))
    have = sorted((str(None if v != v else int(v)), c, d, round(w, 6) + 0.0, round(x, 9)) for v, c, d, w, x in
                  zip(got.vec_id, got.component, got.deviation, got.whitened, got.explained, strict=True))
    assert [h[:3] for h in have] == [w[:3] for w in want]
    assert np.allclose([h[3:] for h in have], [w[3:] for w in want], atol=2e-6)


def test_whitening_of_few_flat_and_huge_vectors(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert whitening.fit(empty) is None and whitening.whiten(empty, None).count() == 0
    flat = spark.createDataFrame([(i, [1.0, 2.0, float(i % 2)], "", "", "") for i in range(10)], VECTORS)
    got = whitening.whiten(flat, whitening.fit(flat)).toPandas()
    assert set(got.component) == {1, 2, 3} and got[got.component > 1].whitened.eq(0).all() and got.identity_error.max() < 1e-9
    huge = spark.createDataFrame([(0, [1e12, 0.0], "", "", ""), (1, [-1e12, 3.0], "", "", ""), (2, [1e30, 0.0], "", "", "")], VECTORS)
    got = whitening.whiten(huge, whitening.fit(huge)).toPandas()
    assert set(got.vec_id) == {0, 1} and got.deviation.isna().all()


@pytest.mark.parametrize("a", [np.zeros((4, 4)), np.eye(5) * 3, np.diag([1.0, 1, 2, 2, 2, 5]), np.ones((6, 6)), np.diag([1e-9, 1.0, 1e9])])
def test_decomposition_of_awkward_matrices(a):
    values, q = whitening.eigenvectors(a)
    assert np.allclose(q.T @ q, np.eye(len(a)), atol=1e-13) and np.allclose(a @ q, q * values, atol=1e-13 * max(1, np.abs(a).max()))
    assert (np.diff(values) <= 1e-12).all()


def test_decomposition_of_random_matrices():
    rnd = np.random.default_rng(2)
    for n in (1, 2, 7, 64):
        a = rnd.standard_normal((n, n))
        a = a @ a.T
        values, q = whitening.eigenvectors(a)
        assert np.allclose(values, np.linalg.eigvalsh(a)[::-1], atol=1e-12 * n * n) and np.allclose(a @ q, q * values, atol=1e-12 * n * n)
