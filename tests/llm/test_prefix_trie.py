import hashlib
import random
import zlib

import duckdb
import pytest

from gridtide.llm import prefix_trie
from gridtide.llm.catalogue import QUERIES, SQL
from gridtide.llm.prefix_trie import SpillingQueue, build_trie, numbered_turns, spliced

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string, depth long, up string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def plain_rebuilt(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, hashlib.md5(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).digest(), (role or "", text or "")))
    own = {c: [x[-1] for x in sorted(t)] for c, t in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        out[c] = tuple(own.get(base, [])[:h] + turns[h:])
    return out


def plain_trie(built):
    nodes, ends = {}, {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(turns[:d], []).append(c)
        ends.setdefault(turns, []).append(c)
    kids = {}
    for p in nodes:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    total = {}
    for p in sorted(nodes, key=len, reverse=True):
        below = [total[k] for k in kids.get(p, [])]
        size = len(p[-1][1].encode()) if p else 0
        total[p] = (sum(b[0] for b in below) or 1, sum(b[1] for b in below) + (len(nodes[p]) - 1) * size)
    return sorted(
        (
            min(members),
            len(p),
            min(nodes[p[:-1]]) if p else None,
            len(members),
            len(kids.get(p, [])),
            *total[p],
            hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest(),
        )
        for p, members in nodes.items()
    )


def ordered(rows):
    return sorted((tuple(r[c] for c in COLUMNS) for r in rows), key=lambda r: r[:2])


def test_whole_table(spark):
    rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{FOLDER}/conversations.parquet'").fetchall()
    found = ordered(QUERIES["op11_prefix_trie"](spark, FOLDER).collect())
    assert found == plain_trie(plain_rebuilt(rows))
    duckdb.sql(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM '{FOLDER}/conversations.parquet'")
    cursor = duckdb.execute(SQL["op11_prefix_trie"])
    names = [d[0] for d in cursor.description]
    assert ordered(dict(zip(names, r)) for r in cursor.fetchall()) == found


def made(n, seed):
    draw = random.Random(seed)
    rows = []
    for c in range(-3, n):
        if draw.random() < 0.1:
            continue
        for turn in range(draw.choice([1, 2, 3, 9, 14])):
            rows.append((c, draw.choice([turn, turn, None]), draw.choice(["user", "bot", None]), draw.choice(["", None, "é", "hello"])))
    rows += [(None, 1, "user", "lost"), (5, 1, "user", "é"), (5, 1, "user", "é"), (7, 3, "user", "long " * 20_000)]
    rows += [(40, k, "user", f"turn {k // 2}") for k in range(300)] + [(41, k, "user", f"turn {k // 2}") for k in range(280)]
    return rows


@pytest.mark.parametrize("limit, block", [(None, 4096), (2, 16), (5, 3), (40, 64)])
def test_made_conversations(spark, monkeypatch, limit, block):
    monkeypatch.setattr(prefix_trie, "BLOCK", block)
    rows = made(120, limit or 0)
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    found = ordered(build_trie(spliced(numbered_turns(table)), limit=limit).collect())
    assert found == plain_trie(plain_rebuilt(rows))


def test_empty(spark):
    table = spark.createDataFrame([], SCHEMA)
    assert build_trie(spliced(numbered_turns(table))).collect() == []
    lost = spark.createDataFrame([(None, 1, "a", "b", 1, "c")], SCHEMA)
    assert build_trie(spliced(numbered_turns(lost))).collect() == []


@pytest.mark.parametrize("held", [1, 3, 1000])
def test_queue_spills(held):
    draw, queue, plain = random.Random(held), SpillingQueue(held), []
    for _ in range(2000):
        if plain and draw.random() < 0.45:
            assert queue.first() == min(plain)
            plain.remove(queue.pop())
        else:
            plain.append((draw.randrange(50), draw.randrange(9), 1, 2))
            queue.push(plain[-1])
    while plain:
        plain.remove(queue.pop())
    assert queue.first() is None
