import random
import re

import pytest

from gridtide.llm import decontaminate
from gridtide.llm.decontaminate import contamination


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_hits(docs, items, window):
    """By doc_id: the number of words, of hit words, and the items, by comparing everything."""
    wins = {}
    for item, text in items:
        w = words(text)
        for k in range(max(1, len(w) - window + 1)) if w and item is not None else ():
            wins.setdefault(tuple(w[k : k + window]), set()).add(str(item))
    sizes = {len(w) for w in wins}
    out = {}
    for doc, text in docs:
        w = words(text)
        places, found = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in wins:
                    places.update(range(k, k + n))
                    found |= wins[tuple(w[k : k + n])]
        out[doc] = (len(w), len(places), sorted(found))
    return out


@pytest.mark.parametrize("limit", [200_000, -1])
@pytest.mark.parametrize("window", [10, 4])
def test_made_texts(spark, monkeypatch, window, limit):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", limit)
    draw = random.Random(window)
    pool = ["the", "of", "é", "É", "2024", "Word", "word", "x", "rare1", "rare2"]
    text = lambda n: draw.choice([" ", ", ", "\n"]).join(draw.choices(pool, k=n))
    items = [(k, text(draw.choice([1, 3, 4, 9, 10, 11, 14]))) for k in range(25)] + [(100, None), (101, " .,"), (None, "rare1 rare2"), (7, "the the the the the"), (7, "the the the the the")]
    items = [i for i in items if len(words(i[1])) != 1 or i[0] == 3]
    docs = []
    for k in range(150):
        middle = draw.choice(items)[1] if draw.random() < 0.4 else ""
        docs.append((k, f"{text(draw.randint(0, 20))} {middle or ''} {text(draw.randint(0, 20))}"))
    docs += [(1000, None), (1001, ""), (1002, "the " * 20_000)]
    left = spark.createDataFrame([(k, t, [0]) for k, t in docs], "doc_id long, text string, items array<int>")
    right = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r.items) for r in contamination(left, right, window).collect()}
    assert got == plain_hits(docs, items, window)
    assert sum(bool(v[1]) for v in got.values()) > 10


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (1, "z"), (None, "x a b c y")], "doc_id long, text string")
    items = spark.createDataFrame([("q", "A, b! c")], "item_id string, text string")
    got = sorted((r.doc_id or 0, r.n_words, r.n_hit, r.items, r.contaminated) for r in contamination(docs, items).collect())
    assert got == [(0, 5, 3, ["q"], True), (1, 1, 0, [], False), (1, 4, 3, ["q"], True), (1, 4, 3, ["q"], True)]
    assert [r.n_hit for r in contamination(docs, items.limit(0)).collect()] == [0] * 4
    assert contamination(docs.limit(0), items).count() == 0
