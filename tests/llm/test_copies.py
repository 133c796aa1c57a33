"""SimHash, line dedup, sharding, components and WARC records against plain versions."""

import gzip
import hashlib
import random
import re
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quarry.llm import graph, line_dedup, sharding, simhash, warc
from quarry.sources.files import new_scratch
from tests.llm import data

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall("[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def roots(n, pairs):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


# --- simhash --------------------------------------------------------------------------

def fingerprint(text):
    w = words(text)
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 3]).encode(), seed=42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_components(spark):
    docs = data.docs(spark)
    rows = [(r.doc_id, fingerprint(r.text)) for r in docs.collect()]
    near = [(i, j) for i in range(len(rows)) for j in range(i) if (rows[i][1] ^ rows[j][1]).bit_count() <= 3]
    root = roots(len(rows), near)
    least = defaultdict(lambda: None)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root[i]] = d if least[root[i]] is None else min(d, least[root[i]])
    want = sorted(str((d, f, least[root[i]])) for i, (d, f) in enumerate(rows))
    got = simhash.near_duplicates(docs).collect()
    assert sorted(str((r.doc_id, r.fp % 2**64, r.component_id)) for r in got) == want
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(root))
    assert simhash.near_duplicates(data.empty(spark)).count() == 0


@pytest.mark.parametrize("hot", [4096, 20])
def test_links_lose_no_pair(spark, monkeypatch, hot):
    """Random fingerprints, and a crowd of close ones that fills index keys."""
    monkeypatch.setattr(simhash, "HOT", hot)
    rnd = random.Random(3)
    fps = {rnd.getrandbits(64) for _ in range(300)}
    for f in list(fps)[:100]:
        fps.add(f ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(1, 4))))
    centre = rnd.getrandbits(64)
    fps |= {centre ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 6))) for _ in range(200)}
    fps = sorted(fps)
    pairs = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3]
    want = roots(len(fps), pairs)
    table = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp bigint").repartition(4)
    found = [(r.a % 2**64, r.b % 2**64) for r in simhash.links(table, 3).collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in found)
    at = {f: i for i, f in enumerate(fps)}
    assert roots(len(fps), [(at[a], at[b]) for a, b in found]) == want


def test_pivot_coordinates_bound_the_distance():
    rnd = np.random.default_rng(1)
    a = rnd.integers(0, 2**63, 500, np.uint64)
    b = a ^ (np.uint64(1) << rnd.integers(0, 64, 500).astype(np.uint64)) ^ (np.uint64(1) << rnd.integers(0, 64, 500).astype(np.uint64))
    gap = np.abs(simhash.pivot_table(a).astype(int) - simhash.pivot_table(b).astype(int)).max(axis=1)
    assert (gap <= np.bitwise_count(a ^ b)).all()


@pytest.mark.parametrize("block", [1 << 20, 7])
def test_components(spark, monkeypatch, block):
    monkeypatch.setattr(graph, "BLOCK", block)
    rnd = random.Random(2)
    n = 400
    pairs = [(i, i + 1) for i in range(0, 120)] + [(200, i) for i in range(201, 260)] + [(rnd.randrange(300, n), rnd.randrange(300, n)) for _ in range(60)]
    want = roots(n, pairs)
    edges = spark.createDataFrame([p if rnd.random() < 0.5 else p[::-1] for p in pairs], "a bigint, b bigint").repartition(3)
    got = {r.node: r.root for r in graph.components(edges).collect()}
    touched = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {x: want[x] for x in touched}
    assert graph.components(edges.where("false")).count() == 0


# --- line dedup -----------------------------------------------------------------------

def later_lines(rows):
    """Lines (document key, number) that match an earlier one, all pairs looked at."""
    lines = sorted({((-1 if d is None else d), no, t, frozenset(w)) for d, t in rows
                    for no, x in enumerate((t or "").translate(LOWER).split("\n")) if (w := words(x))}, key=lambda x: (x[0], x[1]))
    gone = set()
    for i, (d, no, t, s) in enumerate(lines):
        if any(5 * len(s & o[3]) >= 4 * len(s | o[3]) for o in lines[:i]):
            gone.add((d, t, no))
    return gone


def line_docs():
    rnd = random.Random(12)
    line = [data.prose(rnd, rnd.choice([1, 3, 8, 20, 60])) for _ in range(40)]
    out = []
    for i in range(60):
        some = [rnd.choice(line) if rnd.random() < 0.4 else data.prose(rnd, rnd.choice([2, 12, 50])) for _ in range(rnd.randint(1, 6))]
        if rnd.random() < 0.5:
            some.append(" ".join(w if rnd.random() < 0.95 else "changed" for w in rnd.choice(line).split()))
        out.append((i, "\n".join(some)))
    return [*out, (60, None), (61, ""), (62, " \n\t\n"), (63, "Same\nsame\nSAME same"), (None, "no id\nSame")]


@pytest.mark.parametrize("hot,witnesses", [(200_000, 3), (30, 1)])
def test_line_dedup(spark, monkeypatch, hot, witnesses):
    monkeypatch.setattr(line_dedup, "HOT", hot)
    monkeypatch.setattr(line_dedup, "WITNESSES", witnesses)
    rows = line_docs()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    gone = later_lines(rows)
    text = dict(rows)
    for r in line_dedup.dedup(docs).collect():
        t = text[r.doc_id]
        worded = [no for no, x in enumerate((t or "").split("\n")) if words(x)]
        assert r.kept == [no for no in worded if (-1 if r.doc_id is None else r.doc_id, t, no) not in gone]
        assert r.n_lines == (t or "").count("\n") + 1 and r.n_removed == len(worded) - len(r.kept)


def test_line_dedup_over_blocks_in_descending_order(spark):
    """The earliest line of a set counts, also if a task reads a later one in a block before."""
    same, near = "a b c d e f g h i j", "a b c d e f g h i x"
    filler = [(i, "\n".join(f"w{i}x{j}" for j in range(line_dedup.FLUSH + 1))) for i in (7, 5, 3)]
    rows = [(8, same), filler[0], (6, near), filler[1], (4, same), filler[2], (2, same)]
    got = {r.doc_id: r.kept for r in line_dedup.dedup(spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)).collect()}
    assert [got[i] for i in (2, 4, 6, 8)] == [[0], [], [], []]
    assert all(len(got[i]) == line_dedup.FLUSH + 1 for i in (3, 5, 7))


def test_line_dedup_orders_all_integers(spark):
    """Negative, very large and null ids, and far more lines than fit in 20 bits of a key."""
    same, near = "a b c d e f g h i j", "a b c d e f g h i x"
    rows = [(2**60 + 1, same), (2**43 + 1, near), (1, same), (-5, "p q r s t u"), (-2**63, near), (None, "p q r s t u"), (7, "p q r s t u")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.kept for r in line_dedup.dedup(docs).collect()}
    assert got == {-2**63: [0], None: [0], 1: [], -5: [], 7: [], 2**43 + 1: [], 2**60 + 1: []}
    left = {r.doc_id: r.text for r in line_dedup.remove(docs).collect()}
    assert left[-5] == "" and left[-2**63] == near and left[None] == "p q r s t u" and len(left) == 7
    long = "\n" * (2**20 + 5) + "l m n o p q\nl m n o p r s\nl m n o p q"
    r = line_dedup.dedup(spark.createDataFrame([(1, long)], "doc_id bigint, text string")).first()
    assert r.kept == [2**20 + 5, 2**20 + 6] and r.n_removed == 1
    with pytest.raises(TypeError):
        line_dedup.dedup(docs.withColumn("doc_id", F.col("doc_id").cast("string")))


def long_lines(rnd, sizes, shared=6):
    """Lines of so many words, no two of them alike but for a few rare words that lines share."""
    return [" ".join({f"r{rnd.randrange(2 * len(sizes))}" for _ in range(shared)} | {f"c{rnd.randrange(3_000)}" for _ in range(n - shared)}) for n in sizes]


def test_long_lines_that_share_words_are_no_candidates(spark):
    """64 parity bits of two lines of 200 words differ in some 32 places, whatever the words."""
    rnd = random.Random(5)
    lines = long_lines(rnd, [rnd.randint(170, 900) for _ in range(120)])
    docs = spark.createDataFrame([(i, 1, i, x) for i, x in enumerate(lines)], "d bigint, nz int, tk bigint, t string")
    share = Fraction("0.8")
    counts = spark.sparkContext.broadcast(line_dedup.total(line_dedup.scan(docs), line_dedup.SKETCH_BITS))
    assert line_dedup.candidates(line_dedup.prefixes(docs, counts, share), share, None).count() == 0


def test_line_dedup_of_long_lines(spark):
    """Near copies about the sizes from which lines have more parity bits, just similar enough or not."""
    rnd = random.Random(6)
    lines = long_lines(rnd, [n for size in (80, 160, 320) for n in range(size - 3, size + 4)] + [1000])
    for x in lines[:]:
        w = x.split()
        for cut, put in ((len(w) // 9, len(w) // 9), (len(w) // 5, 0), (0, len(w) // 4), (len(w) // 9 + 1, len(w) // 9 + 1), (len(w) // 5 + 1, 0), (0, len(w) // 4 + 2)):
            if rnd.random() < 0.6:
                lines.append(" ".join(rnd.sample(w, len(w) - cut) + [f"n{rnd.randrange(10**9)}" for _ in range(put)]))
    rnd.shuffle(lines)
    rows = [(i, "\n".join(lines[i::20])) for i in range(20)]
    gone = later_lines(rows)
    got = line_dedup.dedup(spark.createDataFrame([*rows, rows[3]], "doc_id bigint, text string").repartition(3)).collect()
    assert len(got) == 21 and len(gone) > 20
    for r in got:
        want = [no for no in range(len(lines[r.doc_id::20])) if (r.doc_id, rows[r.doc_id][1], no) not in gone]
        assert r.kept == want and r.n_removed == r.n_lines - len(want)


def test_line_removal_keeps_rows_and_columns(spark):
    docs = data.docs(spark)
    out = line_dedup.remove(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    joined = {r.doc_id: r.text for r in out.collect() if r.doc_id is not None and r.doc_id not in (2, 3)}
    assert joined[12] == joined[13] == "" and joined[0] == data.texts()[0]  # near copies of earlier lines
    assert line_dedup.dedup(data.empty(spark)).count() == 0


# --- sharding -------------------------------------------------------------------------

def test_shards_are_balanced_and_gapless(spark):
    docs = data.docs(spark)
    got = sharding.shard(docs, n_shards=5).collect()
    rows = docs.collect()
    assert sorted(str((r.doc_id, r.size, r.text_crc32)) for r in got) == sorted(
        str((r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode()))) for r in rows)
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
    assert sorted(map(len, by.values()))[-1] - sorted(map(len, by.values()))[0] <= 1
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert sharding.shard(data.empty(spark)).count() == 0


def test_overflow_continues_clockwise(spark):
    """Against placing every key by itself: home first, then round the ring."""
    k, vnodes, n = 4, 8, 500
    nodes = sharding.ring_nodes(k, vnodes)
    at = [p for p, _ in nodes]
    arcs = defaultdict(list)
    for d in range(n):
        pos = int(hashlib.md5(str(d).encode()).hexdigest()[:4], 16)
        arcs[next((i for i, p in enumerate(at) if p >= pos), 0)].append((pos, d))
    counts = [len(arcs[i]) for i in range(len(nodes))]
    room = sharding.capacities([sum(c for c, (_, s) in zip(counts, nodes) if s == x) for x in range(k)], 0.0)
    load, home, queue, want = [0] * k, {}, [], {}
    for i, (_, s) in enumerate(nodes):
        home[i] = min(counts[i], room[s] - load[s])
        load[s] += home[i]
        want.setdefault((i, s), 0)
        want[i, s] += home[i]
    for step in range(2 * len(nodes)):
        i = step % len(nodes)
        s = nodes[i][1]
        while queue and load[s] < room[s]:
            a = queue.pop(0)
            want[a, s] = want.get((a, s), 0) + 1
            load[s] += 1
        if step < len(nodes):
            queue += [i] * (counts[i] - home[i])
    got = defaultdict(int)
    shards = {r.doc_id: r.shard for r in sharding.shard(spark.range(n).selectExpr("id AS doc_id", "'t' AS text"), k, vnodes).collect()}
    for i, keys in arcs.items():
        for _, d in keys:
            got[i, shards[d]] += 1
    assert got == {x: c for x, c in want.items() if c}


def test_limited_movement(spark):
    docs = spark.range(2000).selectExpr("id AS doc_id", "'t' AS text")
    a = {r.doc_id: r.shard for r in sharding.shard(docs, 8).collect()}
    b = {r.doc_id: r.shard for r in sharding.shard(docs, 9).collect()}
    assert sum(a[d] != b[d] for d in a) < 900  # hashing anew would move about 1780
    loose = [r.shard for r in sharding.shard(docs, 8, slack=0.25).collect()]
    assert max(map(loose.count, range(8))) <= 2000 * 1.25 / 8 + 1


# --- WARC -----------------------------------------------------------------------------

PAGES = [(1, "http://a/x", "<html><head><title>A &amp; B</title><style>p{}</style></head><body><p>One<br>two &lt;3&gt; <script>no()</script><a href='x'>link</a></p></body></html>"),
         (2, None, None), (3, "u", ""), (None, "v", "plain é text"), (3, "u", ""), (4, "w", "<!-- a\nb --><P>x</P>" * 3000)]


def test_warc_records(spark):
    pages = spark.createDataFrame([(*p, "clash", "clash") for p in PAGES], "page_id bigint, url string, html string, block string, k string")
    sources = warc.responses(pages)
    got = warc.derive(sources).collect()
    by = {r.record_id: r for r in sources.collect()}
    assert len(got) == 2 * len(PAGES)
    for r in got:
        head, _, payload = by[r.refers_to].block.partition("\r\n\r\n")
        assert r.source_headers == head + "\r\n" and r.target_uri == by[r.refers_to].target_uri
        assert r.payload_digest == "sha1:" + hashlib.sha1(payload.encode()).hexdigest()
        assert r.block_digest == "sha1:" + hashlib.sha1(r.block.encode()).hexdigest() and r.content_length == len(r.block.encode())
    first = {r.warc_type: r.block for r in got if r.page_id == 1}
    assert first["conversion"] == "A & B\nOne\ntwo <3> link"
    assert "title: A &amp; B\r\nlinks: 1\r\n" in first["metadata"] and "\r\n Content-Type: text/html" in first["metadata"]
    assert warc.derive(warc.responses(pages.where("false"))).count() == 0


def test_warc_files_parse(spark):
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string, html string")
    records = warc.derive(warc.responses(pages)).coalesce(1)
    path = warc.write(records, new_scratch(spark, "test-warc"))
    parts = [bytes(r.content) for r in spark.read.format("binaryFile").load(path + "/*.gz").collect()]
    seen = []
    for raw in map(gzip.decompress, parts):
        while raw:
            head, _, rest = raw.partition(b"\r\n\r\n")
            fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
            size = int(fields["Content-Length"])
            seen.append((fields["WARC-Record-ID"], fields["WARC-Refers-To"], rest[:size].decode()))
            assert head.startswith(b"WARC/1.1\r\n") and rest[size:size + 4] == b"\r\n\r\n"
            raw = rest[size + 4:]
    assert sorted(seen) == sorted((r.record_id, r.refers_to, r.block) for r in records.collect())
