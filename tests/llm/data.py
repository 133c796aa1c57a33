"""Small documents with every awkward case, and tables from the shared test data."""

import random

#: Names that operators use inside; extra columns of these names must not disturb them.
CLASHES = ["k", "t", "d", "h", "m", "w", "n", "c", "pos", "len", "items", "gram", "key", "cell", "arc", "salt", "rank", "shard", "size", "row", "file",
           "line", "sid", "tk", "fp", "score", "ids", "term", "y", "root", "spans", "block", "rk", "wh"]

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"{c} string" for c in CLASHES)


def prose(rnd, n):
    return " ".join(rnd.choice("the of and to in is that was for with as by river stone amber falcon copper lantern meadow orchid".split())
                    + rnd.choice(["", "", "", str(rnd.randrange(40)), "."]) for _ in range(n))


def texts():
    rnd = random.Random(5)
    base = [prose(rnd, 80) for _ in range(12)]
    near = [b.replace("river", "harbour", 1) for b in base[:3]]
    long = prose(rnd, 20_000)
    return [*base, *near, base[0], base[0], None, "", " \n\t ", "one", "one two", "Ünïcode É 中文 😀 words", "a" * 30_000, "x\x00y\x1cz", "line\r\nline\n\nline",
            "tail ends <|endoftext|>", long, "\n".join(base[1:4]), base[4].upper()]


def rows():
    out = [(i, t, "en" if i % 3 else None, None if i % 2 else "s", None) for i, t in enumerate(texts())]
    out += [out[2], out[2], (None, "no id here at all", None, None, None), (None, None, None, None, None), (3, "another text of a known id", "en", "s", 5)]
    return [(*r, *["clash"] * len(CLASHES)) for r in out]


def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
