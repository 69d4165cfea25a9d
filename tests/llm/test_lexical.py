import math
import random
import re
from collections import Counter

import duckdb
import pytest

from gridtide.llm import lexical
from gridtide.llm.catalogue import QUERIES, SQL
from gridtide.llm.lexical import build_index, search

FOLDER = "/root/testdata/sf0.01"


def words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def plain_search(docs, items, k):
    """Per item the rows (rank, doc_id, score)."""
    held = [(d, Counter(words(t))) for d, t in docs]
    held = [(d, c) for d, c in held if c]
    n, length = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c in held:
            m = 100 - 50 + (50 * c.total() * n) // length
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m)) for t in set(words(text)) if t in c
            )
            if score > 0:
                scores.append((-score, d is None, d or 0))
        out += [(item, rank, None if none else d, -s) for rank, (s, none, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def found(rows):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in rows), key=str)


def test_whole_table(spark):
    rows = found(QUERIES["op12_ranked_search"](spark, FOLDER).collect())
    for name in ("documents", "benchmark"):
        duckdb.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    assert rows == sorted(duckdb.sql(SQL["op12_ranked_search"]).fetchall(), key=str)
    docs, items = (duckdb.sql(f"SELECT * FROM {name}").fetchall() for name in ("documents", "benchmark"))
    assert rows == plain_search([d[:2] for d in docs], items, 50)


def made(seed):
    draw = random.Random(seed)
    vocabulary = ["the", "a", "É", "straße", "naïve", "x1", "7", "日本", "rare", "rarer"]
    weights = [30, 20, 8, 8, 5, 5, 3, 2, 1, 1]
    docs = [(k, " ".join(draw.choices(vocabulary, weights, k=draw.choice([1, 2, 3, 8, 40])))) for k in range(200)]
    docs += [(900 + k, "the same words, The SAME words") for k in range(60)] + [(None, "rare"), (None, None), (3, ""), (4, "!?"), (4, docs[4][1]), (5, "the " * 30_000 + "rare")]
    items = [(k, " ".join(draw.choices(vocabulary, k=draw.choice([1, 3, 6])))) for k in range(30)]
    return docs, items + [(50, None), (51, "..."), (52, "unheard of"), (53, "same Same same"), (54, "words rare")]


@pytest.mark.parametrize("k, pairs, docs_held, lot", [(5, 20, 3, 7), (50, 200_000, 1024, 4096), (1, 100, 50, 1), (400, 1000, 8, 40)])
def test_made_tables(spark, monkeypatch, k, pairs, docs_held, lot):
    for name, value in (("PAIRS", pairs), ("DOCS", docs_held), ("ITEMS", lot), ("TOGETHER", 3)):
        monkeypatch.setattr(lexical, name, value)
    docs, items = made(k)
    if lot == 1:
        items = items[:3] + items[-5:]
    table = spark.createDataFrame([(*d, 1.0, 2, "x") for d in docs], "doc_id long, text string, score double, rank int, terms string")
    asked = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, doc_id long")
    assert found(search(build_index(table), asked, k).collect()) == plain_search(docs, items, k)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert search(build_index(docs.where("false")), items).collect() == []
    assert search(build_index(docs), items.where("false")).collect() == []
    assert search(build_index(docs.withColumn("text", docs.text.substr(9, 1))), items).collect() == []


def test_repeated_queries_ask_each(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "a c"), (3, "d")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "b"), (1, "b")], "item_id long, text string")
    assert [(r.item_id, r["rank"], r.doc_id) for r in search(build_index(docs), items).collect()] == [(1, 1, 1), (1, 1, 1)]
