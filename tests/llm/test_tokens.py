"""Token operators against the tokenizers library and an exact round trip."""

import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.orc
import pytest
from tokenizers import Tokenizer

from quarry.llm import bpe, token_orc
from quarry.sources.files import new_scratch
from tests.llm import data

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
PIECES = ["a", "b", "'", "s", "ll", "'re", " ", "  ", "\n", "\t", "1", "22", "é", "中", "😀", "<|endoftext|>", "<|startoftext|>", "!", "...", "\x1c", "՘",
          " ", "d", "I'd", "the", " of", "​", "word", "Σ", "é", "İ"]


@pytest.fixture
def fine_chunks(monkeypatch):
    """Chunks of a few bytes, so that short texts have many joins."""
    monkeypatch.setattr(bpe, "CUT_BITS", 1)
    monkeypatch.setattr(bpe, "MIN_CHUNK", 3)
    monkeypatch.setattr(bpe, "MAX_CHUNK", 24)


def test_chunked_encoding_equals_the_library(fine_chunks):
    rnd, lib, own = random.Random(1), Tokenizer.from_file(BYTE), bpe.Codec(BYTE)
    for _ in range(4000):
        text = "".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 60)))
        assert np.frombuffer(own.encode_many([text])[0], np.int32).tolist() == lib.encode(text, add_special_tokens=False).ids, repr(text)
    assert own.reused > 0


def test_shared_passages_are_encoded_once():
    rnd, own = random.Random(2), bpe.Codec(BYTE)
    passage = data.prose(rnd, 4000)
    own.encode_many([passage])
    before = own.encoded
    own.encode_many([data.prose(rnd, 60) + passage + data.prose(rnd, 60)])
    assert own.encoded - before < 6 and own.reused > 10


def test_word_codec_equals_the_library():
    rnd, lib, own = random.Random(3), Tokenizer.from_file(WORD), token_orc.WordCodec(WORD)
    for _ in range(4000):
        text = "".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 40)))
        values, _ = own.encode([text], 1)
        assert values.tolist() == [*lib.encode(text, add_special_tokens=False).ids, 1], repr(text)


def test_word_codec_keeps_pre_tokens_of_latin_texts():
    """Words that differ in case and marks alone cost one encoding; the library's whole way is left to other texts."""
    rnd, lib, own = random.Random(4), Tokenizer.from_file(WORD), token_orc.WordCodec(WORD)
    pieces = ["a", "É", "ß", "'", "s", "'LL", "'re", "1", "22", "!", "$%", "_", " ", "\n", "\t", "\r", "Word", "<|", "|>"]
    texts = ["".join(rnd.choices(pieces, k=rnd.randint(0, 20))) for _ in range(2000)]
    values, offsets = own.encode(texts, 1)
    assert [values[a:b].tolist() for a, b in itertools.pairwise(offsets)] == [[*lib.encode(t, add_special_tokens=False).ids, 1] for t in texts]
    assert not own.known
    before = len(own.pieces)
    own.encode(["Zebu, zebu. (ZEBU) zebu's zebu;zebu"], 1)
    assert len(own.pieces) - before <= 7 and not own.known  # zebu and six marks
    own.encode(["word<|endoftext|> other 中"], 1)
    assert set(own.known) == {"word<|endoftext|>", "other", "中"}


def test_encode_and_decode_rows(spark):
    docs = data.docs(spark)
    lib = Tokenizer.from_file(BYTE)
    got = bpe.decode(bpe.encode(docs, BYTE), BYTE).collect()
    want = sorted((str(r.doc_id), lib.encode(r.text or "", add_special_tokens=False).ids) for r in docs.collect())
    assert sorted((str(r.doc_id), r.ids) for r in got) == want
    assert sorted(r.decoded for r in got) == sorted(lib.decode(ids, skip_special_tokens=False) for _, ids in want)
    assert bpe.encode(data.empty(spark), BYTE).count() == 0


def test_orc_files_round_trip(spark):
    docs = data.docs(spark)
    lib = Tokenizer.from_file(WORD)
    path = token_orc.write(docs, new_scratch(spark, "test-orc"), WORD, partitions=3)
    stored = sorted(token_orc.read(spark, path).collect(), key=lambda r: r.row)
    assert [r.doc_id for r in stored] == sorted((r.doc_id for r in docs.collect()), key=lambda x: (x is not None, x))
    want = sorted((str(r.doc_id), [*lib.encode(r.text or "", add_special_tokens=False).ids, 1]) for r in docs.collect())
    assert sorted((str(r.doc_id), r.ids) for r in stored) == want
    got = {(r.doc_id, r.start): r for r in token_orc.summary(spark, path).collect()}
    start = 0
    for r in stored:
        assert got[r.doc_id, start].ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        start += len(r.ids)
    assert len(got) == len(stored)


def test_orc_metadata_prunes(spark, tmp_path):
    many = spark.range(4000).selectExpr("id * 2 AS doc_id", "concat('word ', id) AS text")
    path = token_orc.write(many, str(tmp_path / "orc"), WORD, partitions=4, stripe_bytes=1 << 14, index_stride=1000)
    files = sorted((tmp_path / "orc").glob("part-*.orc"))
    assert len(files) == 4 and sum(pyarrow.orc.ORCFile(f).nstripes for f in files) >= 4
    assert token_orc.read(spark, path).where("doc_id = 4000").count() == 1
    assert token_orc.read(spark, path).where("doc_id = 4001").count() == 0


def test_orc_of_an_empty_table(spark):
    path = token_orc.write(data.empty(spark), new_scratch(spark, "test-orc"), WORD, partitions=2)
    assert token_orc.summary(spark, path).count() == 0
