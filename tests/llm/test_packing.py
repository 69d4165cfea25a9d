import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gridtide.llm.catalogue import QUERIES
from gridtide.llm.packing import Encoder, hilbert, pack

FOLDER = "/root/testdata/sf0.01"
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def check(pieces, ids_of, size=2048):
    """Every token in one piece, sequences without gaps, no padding; returns the sequences' documents in order."""
    sequences, seen = {}, {}
    for doc, start, length, crc, total, sequence, offset in pieces:
        ids = ids_of(doc)
        assert total == len(ids) and 0 < length <= size
        assert crc == zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes())
        seen.setdefault(doc, []).append((start, length))
        sequences.setdefault(sequence, []).append((offset, length, doc))
    for doc, parts in seen.items():
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        assert at == len(ids_of(doc))
    assert sorted(sequences) == list(range(len(sequences)))
    for parts in sequences.values():
        at = 0
        for offset, length, _ in sorted(parts, key=lambda p: p[0]):
            assert offset == at
            at += length
        assert at == size or at & (at - 1) == 0
    return [doc for k in sorted(sequences) for _, _, doc in sorted(sequences[k], key=lambda p: p[0])], set(seen)


def test_whole_table(spark, library):
    rows = duckdb.sql(f"SELECT doc_id, text, lang FROM '{FOLDER}/documents.parquet'").fetchall()
    coded = {k: library.encode(t or "", add_special_tokens=False).ids + [1] for k, t, _ in rows}
    found = [tuple(r) for r in QUERIES["op13_packing"](spark, FOLDER).collect()]
    order, docs = check(found, coded.__getitem__)
    assert docs == set(coded)
    # neighbours are alike: they share a language far more often than by chance
    lang = {k: c for k, _, c in rows}
    alike = np.mean([lang[a] == lang[b] for a, b in zip(order, order[1:]) if a != b])
    chance = sum((np.mean([c == x for c in lang.values()])) ** 2 for x in set(lang.values()))
    assert alike > chance + 0.3


def test_cases(spark, library):
    rows = [(1, None, 1), (1, None, 1), (None, "", 2), (5, "b " * 5000, 3), (5, "b " * 5000, 3), (7, "x" * 3000, 4)]
    docs = spark.createDataFrame([(k, t, n, n) for k, t, n in rows], "doc_id long, text string, uid long, place long")
    found = pack(docs, PATH, size=64).collect()
    tokens = {k: library.encode(t or "", add_special_tokens=False).ids + [1] for k, t, _ in rows}
    assert sum(r.length for r in found) == sum(len(tokens[k]) for k, _, _ in rows)
    for r in found:
        assert np.frombuffer(r.ids, "<u4").tolist() == tokens[r.doc_id][r.start : r.start + r.length]
    lengths = {}
    for r in sorted(found, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == lengths.get(r.sequence_id, 0)
        lengths[r.sequence_id] = r.offset + r.length
    assert all(n == 64 or n & (n - 1) == 0 for n in lengths.values())
    empty = pack(docs.where("false"), PATH)
    assert empty.collect() == [] and empty.columns == ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]


def test_pieces_as_the_library(library):
    draw, own = random.Random(3), Encoder(PATH)
    letters = [*"aAbzé éÉßẞİıſΣσς'stdm.,;:!?0١³½ª×÷|<> \t\n\x0b\x0c\r\x1c\x1d\x85\xa0 　́ﬁ한中\U0001d400🙂﻿​", "<|endoftext|>", "'re", "'ll", "1.", "l'"]
    texts = ["".join(draw.choice(letters) for _ in range(draw.randrange(14))) for _ in range(8000)]
    for text, ids in zip(texts, own.encode_all(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_bytes_without_word_ends():
    path = public_tokenizers.path("byte_bpe_50k.json")
    text = "two  spaces,\n\nlines"
    assert np.frombuffer(Encoder(path).encode_all([text])[0], "<u4").tolist() == Tokenizer.from_file(path).encode(text).ids


@pytest.mark.parametrize("dims, bits", [(2, 5), (3, 3), (4, 2)])
def test_curve_takes_single_steps(dims, bits):
    grid = np.array(np.meshgrid(*[range(1 << bits)] * dims)).reshape(dims, -1).T
    keys = hilbert(grid, bits)
    assert sorted(keys.tolist()) == list(range(len(grid)))
    assert set(np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(1).tolist()) == {1}
