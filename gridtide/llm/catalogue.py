"""The registered queries of this subpackage: whole tables in, contracted columns out."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from gridtide.llm import langid, toxicity
from gridtide.llm.bpe import bpe_encode
from gridtide.llm.decontaminate import contamination
from gridtide.llm.lexical import build_index, search
from gridtide.llm.lines import drop_shared_lines
from gridtide.llm.neighbours import nearest
from gridtide.llm.packing import pack
from gridtide.llm.pages import extract_text
from gridtide.llm.prefix_trie import build_trie, numbered_turns, spliced
from gridtide.llm.secrets import scan_secrets, span_text
from gridtide.llm.simhash import near_duplicates
from gridtide.llm.surrogates import replace_personal

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]):
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, folder, "labels"), toxicity.may_learn(3, 1))
    scored = toxicity.score_toxicity(docs, model)
    return scored.select("doc_id", toxicity.is_held_out(3, 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query
def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = contamination(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "benchmark"), window=10)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


SQL["op2_decontamination"] = r"""
WITH low AS (SELECT 'd' AS side, doc_id AS id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
             UNION ALL
             SELECT 'b', item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
  split AS (SELECT side, id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM low),
  wins AS (SELECT DISTINCT id AS item_id, array_to_string(w[s : s + 9], ' ') AS win, least(len(w), 10) AS n
           FROM (SELECT id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS s FROM split WHERE side = 'b' AND len(w) > 0)),
  lens AS (SELECT DISTINCT n FROM wins),
  runs AS (SELECT id AS doc_id, n, s, array_to_string(w[s : s + n - 1], ' ') AS win
           FROM (SELECT id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS s FROM split, lens WHERE side = 'd' AND len(w) >= n)),
  hits AS (SELECT doc_id, s, wins.n, item_id FROM runs JOIN wins ON runs.win = wins.win AND runs.n = wins.n),
  covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(s, s + n - 1)) AS p FROM hits) GROUP BY doc_id),
  items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT id AS doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM split LEFT JOIN covered ON id = covered.doc_id LEFT JOIN items ON id = items.doc_id
WHERE side = 'd'
"""


@query
def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(table(spark, folder, "documents"), shingle=4, distance=4)
    code = F.lower(F.lpad(F.hex("code"), 16, "0"))
    return found.select("doc_id", code.alias("fingerprint"), "component_id")


@query
def op4_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = scan_secrets(table(spark, folder, "documents").select("doc_id", "text"))
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = '{kind}')) as long)").alias(f"n_{kind}") for kind in ("assign", "access", "hex")]
    return found.select("doc_id", *counts, F.sha2(span_text("base").cast("binary"), 256).alias("base_sha256"), span_text("spans").alias("spans"))


@query
def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = drop_shared_lines(table(spark, folder, "documents").select("doc_id", "text"), min_docs=10, min_chars=1)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


SQL["op5_line_dedup"] = """
WITH lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS pos
               FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)),
  keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
  shared AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(s.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (s.key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN shared s ON keyed.key = s.key
GROUP BY doc_id
"""


@query
def op6_pii_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    # the key is a secret of whoever runs this; a test table has no secrets
    replaced = replace_personal(table(spark, folder, "documents").select("doc_id", "text"), key=b"surrogates of the test tables")
    spans = F.array_join(F.transform("entities", lambda e: F.concat_ws(":", e["kind"], e["begin"].cast("string"), e["end"].cast("string"))), ",")
    return replaced.select("doc_id", F.size("entities").cast("long").alias("n_entities"), spans.alias("entities"), "text")


@query
def op7_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    coded = bpe_encode(table(spark, folder, "documents"), path, decoded=True)
    return coded.select(
        "doc_id",
        F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


@query
def op8_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query
def op9_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return extract_text(table(spark, folder, "pages")).select("page_id", "url", "text", "n_chars")


@query
def op10_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs, ~toxicity.is_held_out(4, 2))
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", toxicity.is_held_out(4, 2).alias("held_out"), "lang_pred", "score", "rejected")


@query
def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return build_trie(spliced(numbered_turns(table(spark, folder, "conversations")), every=5, most=8))


SQL["op11_prefix_trie"] = """
WITH crc_steps AS (SELECT list(v ORDER BY n) AS t
                   FROM (SELECT n, list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: CASE WHEN a & 1 = 1 THEN xor(3988292384, a >> 1) ELSE a >> 1 END) AS v
                         FROM range(256) bytes(n))),
  own AS (SELECT conv_id, list({'r': role, 't': text} ORDER BY turn NULLS FIRST, md5(strlen(role) || ':' || role || text)) AS s
          FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL) GROUP BY conv_id),
  heads AS (SELECT conv_id, s, conv_id - conv_id % 5 AS base,
                   xor(list_reduce([4294967295] || list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
                                   lambda a, b: xor(t[(xor(a, b) & 255) + 1], a >> 8)), 4294967295) % 9 AS h
            FROM own, crc_steps),
  built AS (SELECT x.conv_id, list_concat(coalesce(b.s[1:x.h], []), x.s[x.h + 1:]) AS s FROM heads x LEFT JOIN own b ON b.conv_id = x.base),
  steps AS (SELECT conv_id, s[1:d] AS p, d AS depth, len(s) = d AS ends FROM (SELECT *, unnest(range(len(s) + 1)) AS d FROM built)),
  nodes AS (SELECT p, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                   coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '') AS ended FROM steps GROUP BY p, depth),
  kids AS (SELECT p[1:depth - 1] AS p, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
  subtrees AS (SELECT a.p, a.depth, count(*) FILTER (k.p IS NULL) AS n_leaves,
                      CAST(sum((b.n_convs - 1) * CASE WHEN b.depth = 0 THEN 0 ELSE strlen(b.p[-1].t) END) AS BIGINT) AS saved_tokens
               FROM nodes a JOIN nodes b ON b.depth >= a.depth AND b.p[1:a.depth] = a.p LEFT JOIN kids k ON k.p = b.p AND k.depth = b.depth
               GROUP BY a.p, a.depth)
SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens,
       sha256(n.ended) AS ends_sha256
FROM nodes n JOIN subtrees s ON s.p = n.p AND s.depth = n.depth
  LEFT JOIN kids k ON k.p = n.p AND k.depth = n.depth
  LEFT JOIN nodes up ON up.depth = n.depth - 1 AND up.p = n.p[1:n.depth - 1]
"""


@query
def op12_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    index = build_index(table(spark, folder, "documents"))
    return search(index, table(spark, folder, "benchmark"), k=50)


SQL["op12_ranked_search"] = r"""
WITH low AS (SELECT doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
  words AS (SELECT doc_id, unnest(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM low),
  held AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
  sizes AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM held GROUP BY doc_id),
  totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
  norms AS (SELECT doc_id, 100 - 50 + (50 * n * docs) // terms AS m FROM sizes, totals),
  asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
  weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM held, totals GROUP BY term, docs),
  scores AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
             FROM asked JOIN weights USING (term) JOIN held USING (term) JOIN norms USING (doc_id) GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0
QUALIFY rank <= 50
"""


@query
def op13_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), end=1, size=2048)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)


if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
