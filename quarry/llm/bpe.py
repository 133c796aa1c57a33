"""Byte-level BPE encoding with content-defined chunk reuse, and decoding.

A gear hash rolls over a text's bytes and cuts chunks before blanks where its top bits are zero, so
texts that share a passage share most of its chunks.  A chunk is split into pre-tokens and
encoded once; later documents take it from the task's chunk table.  (One table per task:
sharing it across tasks would shuffle the text and the ids of every chunk, about twice
the input.)

At a chunk's join the pre-tokens may differ from those of the whole text.  The join is
repaired: the last two pre-tokens of the left side (all that later text can change: a
contraction reads two characters ahead, other rules one) are split again together with
the head of the right chunk, and more of it, until a settled pre-token starts exactly
where the chunk's own split has one.  From there on the chunk's ids hold.  The ids thus
equal those of the whole text; the tests compare them with the library.
"""

from __future__ import annotations

import itertools
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The pre-tokenizer's split pattern, white space as Unicode lists it.
SPLIT = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
         r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
#: Characters that every Unicode version since 2015 puts into the same classes; a text
#: with others is split by the library, whose tables may be of another version.
STABLE = "\x00-՗֑-ۿ‐-⁤ぁ-ヿ一-鿯가-힣"
WINDOW = 16            # bytes that decide on a cut
CUT_BITS = 7           # a chunk has about 2^7 words
MIN_CHUNK, MAX_CHUNK = 64, 8192
PRETOKENS = 120_000    # entries of each of a worker's two generations
CHUNKS = 6_000         # chunks kept per worker; the table starts anew beyond it

_GEAR = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.uint32)


def cut_points(data: np.ndarray) -> np.ndarray:
    """Ascending byte offsets at which the gear hash of the last WINDOW bytes asks for a
    cut.  The hash is sum(gear[b[i-j]] << j); each step doubles the bytes it covers."""
    if len(data) <= WINDOW:
        return np.empty(0, np.int64)
    h = _GEAR[data]
    span = 1
    while span < WINDOW:
        h[span:] = h[span:] + (h[:-span] << np.uint32(span))
        span *= 2
    cut = (h >> np.uint32(32 - CUT_BITS)) == 0
    cut[:-1] &= (data[1:] == 0x20) | (data[1:] == 0x0A)  # only before blanks, so words stay whole
    return np.flatnonzero(cut[:-1]) + 1


def chunk_ends(data: bytes, cuts: np.ndarray) -> list[int]:
    """Ends of a text's chunks: its cuts, none closer than MIN_CHUNK; where the content
    asks for none within MAX_CHUNK bytes, the next character boundary."""
    ends, last, n = [], 0, len(data)
    for c in itertools.chain(cuts.tolist(), [n]):
        while c - last > MAX_CHUNK:
            last += MAX_CHUNK
            while last < n and data[last] & 0xC0 == 0x80:
                last += 1
            ends.append(last)
        if c - last >= MIN_CHUNK or (c == n and c > last):
            ends.append(c)
            last = c
    return ends


HEAD = 12  # pre-tokens of a chunk that are kept for its left join


class Chunk:
    """A chunk, its first and last two pre-tokens and its ids; the rest is split anew when
    a join needs more, which is rare."""

    __slots__ = ("text", "pretokens", "n", "head", "tail", "ids", "head_ids", "tail_ids")

    def __init__(self, text: str, pretokens: list[str]):
        self.text, self.pretokens, self.n = text, pretokens, len(pretokens)
        self.head, self.tail = pretokens[:HEAD], pretokens[-2:]

    def finish(self, pre: Memo) -> None:
        coded = [pre[p] for p in self.pretokens]
        self.pretokens = None
        self.ids = b"".join(coded)
        self.head_ids, self.tail_ids = list(map(len, coded[:HEAD])), list(map(len, coded[-2:]))

    def part(self, sync: int, settled: int, codec: Codec) -> bytes:
        """Ids of pre-tokens ``sync`` to ``settled``, which is ``sync`` or the last but two."""
        if settled == sync:
            return b""
        skip = sum(self.head_ids[:sync]) if sync <= HEAD else sum(len(codec.pre[p]) for p in codec.split(self.text)[:sync])
        return self.ids[skip:len(self.ids) - sum(self.tail_ids[settled - self.n:])]


class Codec:
    """The tokenizer of one worker with its tables of pre-tokens and chunks."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        special = {t.content: i for i, t in self.tok.get_added_tokens_decoder().items()}
        self.special = special
        self.special_re = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True)) + ")") if special else None
        self.split_re = regex.compile(SPLIT)
        self.unstable_re = regex.compile(f"[^{STABLE}]")
        self.pre = Memo(PieceModel(self.tok).ids, PRETOKENS)  # ids as int32
        self.chunks: dict[bytes, Chunk] = {}
        self.reused = self.encoded = 0

    def split(self, text: str) -> list[str]:
        if self.unstable_re.search(text):
            return [text[a:b] for _, (a, b) in self.tok.pre_tokenizer.pre_tokenize_str(text)]
        return self.split_re.findall(text)

    def chunk(self, data: bytes, fresh: list[Chunk]) -> Chunk:
        if (found := self.chunks.get(data)) is not None:
            self.reused += 1
            return found
        self.encoded += 1
        text = data.decode()
        out = self.chunks[data] = Chunk(text, self.split(text))
        fresh.append(out)
        return out

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Ids (int32) of each text.  Splits and repairs first, then encodes the chunks that
        are new."""
        if len(self.chunks) >= CHUNKS:
            self.chunks.clear()
        fresh: list[Chunk] = []
        plans = [self.plan(t, fresh) for t in texts]
        pre = self.pre
        for c in fresh:
            c.finish(pre)
        return [b"".join([b"".join([pre[p] for p in x]) if isinstance(x, list) else x if isinstance(x, bytes)
                          else x[0].part(x[1], x[2], self) for x in plan]) for plan in plans]

    def plan(self, text: str, fresh: list[Chunk]) -> list:
        """What a text's ids are made of: ids, lists of pre-tokens, and (chunk, from, to)."""
        if not any(s in text for s in self.special):
            return self.plan_plain(text, fresh)
        out = []
        for part in self.special_re.split(text):
            out += [np.int32(self.special[part]).tobytes()] if part in self.special else self.plan_plain(part, fresh)
        return out

    def plan_plain(self, text: str, fresh: list[Chunk]) -> list:
        data = text.encode()
        out: list = []
        tail, at = "", 0
        for end in chunk_ends(data, cut_points(np.frombuffer(data, np.uint8))):
            c = self.chunk(data[at:end], fresh)
            at = end
            sync: int | None = 0
            if tail:
                tail, sync = self.repair(tail, c, out)
            if sync is None:
                continue
            settled = max(sync, c.n - 2)
            out.append((c, sync, settled))
            tail = "".join(c.tail[settled - c.n:])
        if tail:
            out.append(self.split(tail))
        return out

    def repair(self, tail: str, c: Chunk, out: list) -> tuple[str, int | None]:
        """Settle the pre-tokens across a join.  Returns the text still open (none if in
        step with the chunk) and the chunk's pre-token from which its own ids hold, or None."""
        shift, m, own = len(tail), 3, c.head
        while True:
            m = min(m, c.n)
            if m > len(own):
                own = self.split(c.text)
            starts = [0, *itertools.accumulate(map(len, own[:m]))]
            pretokens = self.split(tail + c.text[:starts[m]])
            end = -shift
            for j in range(len(pretokens) - 2):
                end += len(pretokens[j])
                if 0 <= end < starts[m] and end in starts:
                    out.append(pretokens[:j + 1])
                    return "", starts.index(end)
            if m == c.n:
                settled = max(0, len(pretokens) - 2)
                out.append(pretokens[:settled])
                return "".join(pretokens[settled:]), None
            m *= 2


class Spelling:
    """The bytes of every id, end to end."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(path)
        special = {t.content for t in tok.get_added_tokens_decoder().values()}
        back = _byte_alphabet()
        spelled = [b""] * tok.get_vocab_size(with_added_tokens=True)
        for text, i in tok.get_vocab(with_added_tokens=True).items():
            spelled[i] = text.encode() if text in special else bytes(back[c] for c in text)
        self.size = np.array(list(map(len, spelled)), np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(spelled), np.uint8)

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """Texts of the lists of ids that ``offsets`` delimit."""
        size = self.size[ids]
        ends = np.concatenate([[0], np.cumsum(size)])
        source = np.repeat(self.start[ids] - ends[:-1], size) + np.arange(ends[-1])
        data = self.bytes[source].tobytes()
        return [data[a:b].decode("utf-8", "replace") for a, b in itertools.pairwise(ends[offsets].tolist())]


class PieceModel:
    """Ids of single pre-tokens, straight from the library's BPE model: the bytes are
    spelled in the byte-level alphabet, as its pre-tokenizer does."""

    def __init__(self, tok):
        self.tokenize = tok.model.tokenize
        self.spell = {b: c for c, b in _byte_alphabet().items()}
        self.blank = self.spell[32]

    def ids(self, piece: str) -> bytes:
        spelled = (piece.replace(" ", self.blank) if piece.isascii() and piece.isprintable()
                   else piece.encode().decode("latin-1").translate(self.spell))
        return array("i", [t.id for t in self.tokenize(spelled)]).tobytes()


class Memo(dict):
    """Results by text, computed on first use.  Two generations of at most ``size`` entries:
    what is in use survives when the older one is dropped."""

    def __init__(self, compute, size: int):
        super().__init__()
        self.compute, self.size, self.old = compute, size, {}

    def __missing__(self, text: str) -> bytes:
        found = self.old.get(text)
        if found is None:
            found = self.compute(text)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[text] = found
        return found


def _byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


@lru_cache(maxsize=2)
def spelling(path: str) -> Spelling:
    return Spelling(path)


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def encode(docs: DataFrame, tokenizer_path: str, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc`` and ids (array<int>) of every row's whole text, as the tokenizers library
    encodes it without adding special tokens.

    Null texts count as empty, empty texts give an empty array, special tokens spelled
    out in a text become their ids, repeated rows and null keys are kept, an empty table
    gives no rows, other columns are not read.
    """
    kind = docs.schema[doc].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(tokenizer_path)
        for b in _slices(batches):
            coded = own.encode_many([t or "" for t in b.column(1).to_pylist()])
            offsets = (np.cumsum([0, *map(len, coded)]) // 4).astype(np.int32)
            values = np.frombuffer(b"".join(coded), np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(offsets, values)], names=["k", "ids"])
        own.chunks.clear()  # the worker may go on with other work

    narrow = docs.select(F.col(doc).alias("k"), F.col(text).cast("string").alias("t"))
    return narrow.mapInArrow(run, f"k {kind}, ids array<int>").withColumnRenamed("k", doc)


def decode(encoded: DataFrame, tokenizer_path: str, doc: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``doc``, ids and decoded (the text; bytes that are not UTF-8 become U+FFFD), special
    tokens included.  Null ids give an empty text."""
    kind = encoded.schema[doc].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = spelling(tokenizer_path)
        for b in _slices(batches):
            lists = b.column(1)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            sizes = lists.value_lengths().fill_null(0).to_numpy()
            texts = own.decode(flat, np.concatenate([[0], np.cumsum(sizes)]))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())], names=["k", "ids", "decoded"])

    narrow = encoded.select(F.col(doc).alias("k"), F.col(ids).alias("ids"))
    return narrow.mapInArrow(run, f"k {kind}, ids array<int>, decoded string").withColumnRenamed("k", doc)
