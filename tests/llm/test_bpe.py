import pickle
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gridtide.llm.bpe import Encoder, bpe_decode, bpe_encode, compiled, unpacked

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def encoder():
    return Encoder(*pickle.loads(compiled(PATH)))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_random_texts(encoder, library):
    draw = random.Random(5)
    pool = ["a", "b", "the", "ing", " ", "  ", "\n", "\t", "\r\n", "'s", "'ll", "12", "é", "ß", "中文", "😀", "***", "--", "aa", " ", "　", "<|endoftext|>", "՘", "\U000323b1", ".", ",", "\x1c", "\x85"]
    for _ in range(4000):
        text = "".join(draw.choices(pool, k=draw.randint(0, 25)))
        assert unpacked(encoder.encode(text)) == library.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("text", ["a" * 5000, "ab" * 3000, "-" * 4999, " " * 300, "=" * 77 + " x", "x" + "\n" * 99, "thththe" * 800])
def test_long_words(encoder, library, text):
    assert unpacked(encoder.encode(text)) == library.encode(text, add_special_tokens=False).ids


def test_every_character(encoder, library):
    for start in [*range(0, 0x3100, 0x100), *range(0xA600, 0xAC00, 0x100), *range(0xF900, 0x12700, 0x100), *range(0x16D00, 0x1F200, 0x100), 0x2B700, 0x2CE00, 0x32300, 0x33400, 0x3D000]:
        chars = [chr(c) for c in range(start, start + 0x100) if not 0xD800 <= c < 0xE000]
        text = "".join(f"a{c}1{c}{c}." for c in chars)
        assert unpacked(encoder.encode(text)) == library.encode(text, add_special_tokens=False).ids, hex(start)


def test_frame(spark, library):
    texts = ["", None, "To be, or not  to be.\n\n", "L'été à 20°", "same", "same", "word " * 50_000]
    rows = [(k, t, "x") for k, t in enumerate(texts)] + [(None, "no id", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = {r.doc_id: r for r in bpe_decode(bpe_encode(docs, PATH), PATH).collect()}
    assert len(got) == len(rows)
    for k, text, _ in rows:
        assert unpacked(got[k].ids) == library.encode(text or "", add_special_tokens=False).ids
        assert got[k].text == (text or "")
    both = bpe_encode(docs, PATH, decoded=True)
    assert sorted(both.collect(), key=str) == sorted(got.values(), key=str)
    assert bpe_decode(bpe_encode(docs.limit(0), PATH), PATH).count() == 0
    assert unpacked(b"") == []


def test_decode_of_broken_bytes(spark, library):
    whole = library.encode("中😀é", add_special_tokens=False).ids
    for ids in (whole[:1], whole[1:], whole[:-1], whole[::-1]):
        df = spark.createDataFrame([(1, bytearray(np.array(ids, "<u4").tobytes()))], "doc_id long, ids binary")
        assert bpe_decode(df, PATH).first().text == library.decode(ids, skip_special_tokens=False)
