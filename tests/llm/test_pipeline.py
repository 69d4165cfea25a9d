import hashlib
import pickle
import zlib

import duckdb
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from gridtide.llm import toxicity
from gridtide.llm.lines import drop_shared_lines
from tests.llm.test_decontaminate import plain_hits
from tests.llm.test_simhash import plain_code, plain_components

FOLDER = "/root/testdata/sf0.01"
BLANK = " \t\n\x0b\x0c\r"


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def plain_lines(texts, least):
    """Texts without the lines whose key is in `least` texts or more."""
    keys = [[lowered(line.strip(BLANK)) for line in (t or "").split("\n")] for t in texts]
    seen = {}
    for own in keys:
        for key in set(own) - {""}:
            seen[key] = seen.get(key, 0) + 1
    return ["\n".join(line for line, key in zip((t or "").split("\n"), own) if seen.get(key, 0) < least) for t, own in zip(texts, keys)]


def test_against_brute_force(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet' ORDER BY doc_id").fetchall()
    items = duckdb.sql(f"SELECT item_id, text FROM '{FOLDER}/benchmark.parquet'").fetchall()
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    model = toxicity.train(docs, labels, toxicity.may_learn())
    model = pickle.loads(pickle.dumps(model))
    left = [(k, t) for k, t in rows if model.score(t or "") < corpus_pipeline.TOXIC]
    assert len(left) < len(rows)
    left = list(zip([k for k, _ in left], plain_lines([t for _, t in left], 10)))
    component = plain_components([(k, plain_code(t)) for k, t in left])
    left = [(k, t) for (k, t), c in zip(left, component) if c == k]
    hit = plain_hits(left, items, 10)
    left = [(k, t) for k, t in left if not hit[k][1]]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert sorted(got) == [k for k, _ in left]
    for (k, text), code in zip(left, library.encode_batch([t for _, t in left], add_special_tokens=False)):
        ids = b"".join(i.to_bytes(4, "little") for i in code.ids)
        assert got[k].ids == ids and got[k].n_tokens == len(code.ids)
        assert got[k].ids_sha256 == hashlib.sha256(ids).hexdigest()
        assert got[k].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(60).withColumn("score", F.lit("x"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.schema.simpleString() == docs.schema.simpleString()
        docs = spark.createDataFrame(out.toPandas(), docs.schema)


def test_odd_documents(spark):
    rows = [(None, None, None, None, None), (None, "a word here", "en", "s", 3), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "x " * 50_000, None, "s", 5), (2, "another text with this id", "en", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for frame, expected in ((docs, 4), (docs.limit(0), 0)):
        for _, stage in corpus_pipeline.STAGES:
            frame = stage(spark, frame, FOLDER)
        assert frame.count() == expected


@pytest.mark.parametrize("parts, least", [(3, 3), (40, 5), (7, 200)])
def test_lines_over_many_partitions(spark, parts, least):
    """Frequent lines that fill several partitions, and lines at the threshold."""
    texts = [("\n".join(["Common", f" own {k}", f"\tgroup {k % 70}", "", "COMMON ", f"group {k % 3}" if k % 2 else "é É"])) for k in range(400)]
    texts += [None, "", "\n\n", "common", "é É", "É É"]
    rows = [(k, t, 1) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, keep int")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = {r.doc_id: r for r in drop_shared_lines(docs, least).collect()}
        twice = drop_shared_lines(docs.union(docs), least).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for (k, text, _), kept in zip(rows, plain_lines(texts, least)):
        assert got[k].text == kept and got[k].n_lines == (text or "").count("\n") + 1
        assert got[k].n_dropped == got[k].n_lines - len(kept.split("\n")) or not kept
    assert sorted((r.doc_id, r.text) for r in twice) == sorted([(k, r.text) for k, r in got.items()] * 2)
    assert drop_shared_lines(docs.limit(0), least).count() == 0


def test_lines_of_repeated_ids(spark):
    rows = [(1, "a\nb"), (1, "a\nc"), (None, "a"), (None, None), (2, "a")]
    got = drop_shared_lines(spark.createDataFrame(rows, "doc_id long, text string"), 4).collect()
    assert sorted((r.doc_id or 0, r.text, r.n_dropped) for r in got) == [(0, "", 0), (0, "", 1), (1, "b", 1), (1, "c", 1), (2, "", 1)]


def test_held_out_ids(spark):
    got = spark.range(500).withColumnRenamed("id", "doc_id").select("doc_id", toxicity.is_held_out(3, 1).alias("out")).collect()
    assert all(r.out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
