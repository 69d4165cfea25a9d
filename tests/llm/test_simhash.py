import random

import duckdb
import numpy as np
import pytest
import xxhash

from gridtide.llm.catalogue import QUERIES
from gridtide.llm.simhash import Forest, GrayIndex, gray_rank, near_duplicates

FOLDER = "/root/testdata/sf0.01"


def plain_code(text):
    words = [w for w in __import__("re").findall(r"[^ \t-\r]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))]
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    """rows: (doc_id, code); the smallest id reachable over 4 or fewer differing bits."""
    codes = np.array([c for _, c in rows], np.uint64)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(codes[k + 1 :] ^ codes[k]) <= 4):
            a, b = find(k), find(k + 1 + int(j))
            root[max(a, b)] = min(a, b)
    least = {}
    for k, (doc, _) in enumerate(rows):
        least.setdefault(find(k), []).append(doc)
    return [min((d for d in least[find(k)] if d is not None), default=None) for k in range(len(rows))]


def test_whole_table(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet' ORDER BY doc_id").fetchall()
    coded = [(k, plain_code(t)) for k, t in rows]
    expected = {k: (f"{c:016x}", comp) for (k, c), comp in zip(coded, plain_components(coded))}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op3_simhash"](spark, FOLDER).collect()} == expected
    assert len({c for _, c in expected.values()}) < len(expected)


def chains(draw, n):
    """Codes in clusters, with chains of small steps and dense clouds."""
    codes = []
    while len(codes) < n:
        code = draw.getrandbits(64)
        for _ in range(draw.choice([1, 3, 200])):
            codes.append(code)
            step = code
            for _ in range(draw.randint(0, 5)):
                step ^= 1 << draw.randrange(64)
            code = step
    return codes[:n]


@pytest.mark.parametrize("block, parts", [(4096, 3), (40, 17)])
def test_made_codes(spark, monkeypatch, block, parts):
    from gridtide.llm import simhash

    draw = random.Random(block)
    codes = chains(draw, 1500) + [0, 0]
    cloud = draw.getrandbits(64)
    codes += [cloud ^ (1 << draw.randrange(20)) ^ (1 << draw.randrange(20)) ^ (1 << draw.randrange(20)) for _ in range(700)]
    rows = list(enumerate(codes)) + [(None, codes[5])]
    frame = spark.createDataFrame([(k, j, int(np.uint64(c).view(np.int64))) for j, (k, c) in enumerate(rows)], "doc_id long, doc_tag long, code long")
    monkeypatch.setattr(simhash, "fingerprints", lambda *a: frame)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = near_duplicates(frame, block=block).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    expected = plain_components(rows)
    assert sorted((r.doc_id, r.component_id) for r in got if r.doc_id is not None) == sorted((k, c) for (k, _), c in zip(rows, expected) if k is not None)
    assert [r.component_id for r in got if r.doc_id is None] == [expected[-1]]


def test_index_finds_all_links():
    draw = random.Random(9)
    codes = np.array(sorted(set(chains(draw, 900))), np.uint64)
    codes = codes[np.argsort(gray_rank(codes))]
    assert (np.diff(gray_rank(codes).astype(object)) > 0).all()
    for cut in (0, 100, 700):
        forest, links = Forest(len(codes)), Forest(len(codes))
        if cut:
            GrayIndex(codes[:cut]).link_with(GrayIndex(codes[cut:]), forest, 4)
            pairs = [(a, b) for a in range(cut) for b in cut + np.flatnonzero(np.bitwise_count(codes[cut:] ^ codes[a]) <= 4)]
        else:
            GrayIndex(codes).link(forest, 4)
            pairs = [(a, a + 1 + b) for a in range(len(codes)) for b in np.flatnonzero(np.bitwise_count(codes[a + 1 :] ^ codes[a]) <= 4)]
        links.add(np.array([a for a, _ in pairs], int), np.array([b for _, b in pairs], int))
        assert (forest.root == links.root).all()


def test_odd_rows(spark):
    texts = ["", None, " \n\t", "One two", "one TWO", "é É", "word " * 30_000, "a b c d e", "a b c d e"]
    docs = spark.createDataFrame([(10 + k, t, "x") for k, t in enumerate(texts)] + [(None, "alone here now", "x")], "doc_id long, text string, code string")
    got = {r.doc_id: r for r in near_duplicates(docs).collect()}
    assert {got[k].component_id for k in (10, 11, 12)} == {10}
    assert got[13].component_id == got[14].component_id == 13
    assert got[18].component_id == 17
    assert got[None].component_id is None
    assert all(np.int64(got[10 + k].code).view(np.uint64) == plain_code(t) for k, t in enumerate(texts))
    assert near_duplicates(docs.limit(0)).count() == 0
