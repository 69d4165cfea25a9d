import hashlib
import random
import re

import duckdb

from gridtide.llm.catalogue import QUERIES
from gridtide.llm.secrets import ADDED, BASE, scan_secrets, trigram_query

FOLDER = "/root/testdata/sf0.01"


def plain_spans(text, rules):
    """(begin, rank, kind, end) of all counted matches, by plain regular expressions."""
    found = []
    for rank, rule in enumerate(rules):
        pattern = rule.pattern.replace("{24,}", "+") if rule.kind == "hex" else rule.pattern
        least = 24 if rule.kind == "hex" else rule.least
        found += [(m.start(), rank, rule.kind, m.end()) for m in re.finditer(pattern, text or "") if len(m[rule.group]) >= least]
    return sorted(found)


def plain_text(spans):
    return ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in spans)


def test_trigram_queries():
    assign, access, hexes = (trigram_query(r.pattern) for r in BASE)
    assert frozenset(["tok", "oke", "ken"]) in assign and len(assign) == 6
    assert access == frozenset([frozenset(["aki", "kia"])])
    assert hexes == frozenset([frozenset()])
    assert trigram_query("ab+c") == frozenset([frozenset()])
    assert trigram_query("(abc|x)(def)+") == frozenset([frozenset(["abc", "def"]), frozenset(["def"])]) - {frozenset(["abc", "def"])}


def test_whole_table(spark):
    got = {r.doc_id: r for r in QUERIES["op4_secrets"](spark, FOLDER).collect()}
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall()
    assert len(got) == len(rows)
    hits = 0
    for k, text in rows:
        base = plain_spans(text, BASE)
        hits += bool(base)
        assert got[k].base_sha256 == hashlib.sha256(plain_text(base).encode()).hexdigest()
        assert [got[k].n_assign, got[k].n_access, got[k].n_hex] == [sum(s[2] == kind for s in base) for kind in ("assign", "access", "hex")]
        assert got[k].spans == plain_text(plain_spans(text, BASE + ADDED))
    assert hits > 10


def test_made_texts(spark):
    draw = random.Random(3)
    pool = ["password", "TOKEN", "api_key", "apikey", "secret", "passwd", "=", ":", " ", '"', "'", "abcdef", "0123456789abcdef", "AKIA", "ABCDEFGH1234", "é", "😀", "x", "\n", "-----BEGIN RSA PRIVATE KEY-----", "eyJhbGciOi12", ".eyJhbGciOi12", ".abcdefgh12", "xoxb-1234567890", "ghp_" + "a1" * 18, "K"]
    texts = ["", None, "password=token:abcdef", "a" * 23, "a" * 24, "AKIA" * 5, "AKIA" + "Z" * 15] + ["".join(draw.choices(pool, k=draw.randint(1, 14))) for _ in range(400)]
    texts += [("token = abcdefg\n" * 3000), ("f" * 30 + " ") * 2000]
    rows = [(k, t, [1]) for k, t in enumerate(texts)] + [(None, "secret: abcdefgh", [2]), (7, texts[7], [3]), (7, texts[7], [3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans array<int>")
    got = scan_secrets(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        expected = plain_spans(r.text, BASE + ADDED)
        assert [(s.begin, s.kind, s.end) for s in r.spans] == [(a, kind, b) for a, _, kind, b in expected]
        assert [(s.begin, s.kind, s.end) for s in r.base] == [(a, kind, b) for a, rank, kind, b in expected if rank < 3]
    assert scan_secrets(docs.limit(0)).count() == 0
