"""Benchmark decontamination as a prefix-filtered set join, in DataFrame functions only.

A window is `window` consecutive words of a benchmark item (the whole item where it is shorter). A
window is contained in a document only if all its shingles are, so it is enough to join on one of them:
the prefix of its shingles, ordered by rarity in the documents. The place of that shingle in the window
bounds where the window can start (positional bound) and end (length bound); the words around it, which
come along, verify the containment exactly.

Cases: null has no words. Items without words, and items whose id is null, take no part; repeated items
count once. A document is a row; rows with equal id and text get equal results. Null ids are ids like
others. Columns of the input whose names the result uses are replaced. An empty table on either side
gives no hits.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtide.session import cut

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SHINGLE = 5
WHOLE = 0x2545F4914F6CDD1D  # stands for the shingle of the row that a document has of its own
BROADCAST_ROWS = 200_000  # shingles of the benchmark up to here (16 bytes each) go to all executors


def _lowered(text: Column) -> Column:
    """A-Z in lower case, all else as it is; plain ASCII takes the quicker way."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    return F.regexp_extract_all(_lowered(text), F.lit(WORD), F.lit(0))


def _tag(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col).cast("string"), F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def benchmark_windows(benchmark: DataFrame, window: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Different windows as `window_id`, `win` (words), and `items` that have them; one row per item and window."""
    items = benchmark.select(F.col(id_col).cast("string").alias("item_id"), words(F.col(text_col)).alias("w"))
    items = items.where(F.col("item_id").isNotNull() & (F.size("w") > 0))
    at = F.expr(f"sequence(1, greatest(size(w) - {window} + 1, 1))")
    each = items.select("item_id", "w", F.explode(at).alias("start")).select("item_id", F.slice("w", F.col("start"), F.lit(window)).alias("win"))
    return each.distinct().withColumn("window_id", F.xxhash64("win"))


def _shingle(words_col: str, place: Column, length: int) -> Column:
    """The hash of `length` words from a place (from 0) on."""
    return F.xxhash64(*[F.get(F.col(words_col), place + k) for k in range(length)])


def _length(words_col: str) -> Column:
    """Words in a shingle of a window."""
    return F.least(F.size(words_col), F.lit(SHINGLE))


def shingle_places(docs: DataFrame, shingles: DataFrame, lengths: list[int], window: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Where the shingles occur, and how long the documents are, in one pass over the texts.

    For each document there is a row with place -1 and `n_words`; for each occurrence, `pos` (from 0), the
    words `around` it and how many of them come `before` it. A document of equal rows is there once.
    """
    wanted = shingles.select("n", "shingle").distinct()
    small = wanted.count() <= BROADCAST_ROWS
    doc_words = docs.select(_tag(id_col, text_col).alias("doc_tag"), words(F.col(text_col)).alias("w"))
    whole = F.lit(WHOLE)
    around = F.expr(f"slice(w, greatest(pos - {window - 2}, 1), {2 * window})")
    before = F.expr(f"least(pos, {window - 1})").cast("int")
    found = None
    for k, n in enumerate(lengths or [1]):
        start = 0 if k else -1  # the row of the document comes with the first length
        places = F.expr(f"sequence({start}, greatest(size(w) - {n}, {start}))")
        per_doc = doc_words.where(F.size("w") >= n) if k else doc_words
        hashed = F.when(F.col("pos") < 0, whole).otherwise(_shingle("w", F.col("pos"), n)).alias("shingle")
        keys = wanted.where(F.col("n") == n).select("shingle").unionByName(docs.sparkSession.range(1).select(whole.alias("shingle")))
        if small:
            # words stay in the row of the document until a place has matched
            placed = per_doc.select("doc_tag", "w", F.explode(places).alias("pos")).select("doc_tag", "w", "pos", hashed)
            part = placed.join(F.broadcast(keys), "shingle", "left_semi")
        else:  # places first, so that words never travel with every shingle
            placed = per_doc.select("doc_tag", "w", F.explode(places).alias("pos")).select("doc_tag", "pos", hashed)
            part = placed.join(keys, "shingle", "left_semi").join(doc_words.dropDuplicates(["doc_tag"]), "doc_tag")
        at = F.col("pos") >= 0
        part = part.select(
            "doc_tag", "pos", F.lit(n).alias("n"), "shingle", F.when(~at, F.size("w")).alias("n_words"), F.when(at, around).alias("around"), before.alias("before")
        )
        found = part if found is None else found.unionByName(part)
    return found.distinct()


def window_hits(windows: DataFrame, shingles: DataFrame, found: DataFrame) -> DataFrame:
    """`doc_tag`, `item_id`, `start` (from 1) and `size` of each occurrence of a window in a document."""
    found = found.where(F.col("pos") >= 0)
    rarity = found.groupBy("n", "shingle").agg(F.count("*").alias("times"))
    # a shingle that no document has leaves its window nothing to match
    ranked = shingles.join(rarity, ["n", "shingle"], "left").withColumn("times", F.coalesce("times", F.lit(0)))
    prefix = ranked.groupBy("window_id").agg(F.min(F.struct("times", "shingle", "at", "n")).alias("p"))
    unique = windows.select("window_id", "win").distinct()
    probes = prefix.where(F.col("p.times") > 0).select("window_id", "p.shingle", "p.at", "p.n").join(unique, "window_id")
    placed = found.join(probes, ["n", "shingle"])
    inside = (F.col("pos") >= F.col("at")) & (F.size("around") - F.col("before") + F.col("at") >= F.size("win"))
    same = F.slice("around", F.greatest(F.col("before") - F.col("at") + 1, F.lit(1)), F.size("win")) == F.col("win")
    hits = placed.where(inside).where(same).select("doc_tag", "window_id", (F.col("pos") - F.col("at") + 1).alias("start"), F.size("win").alias("size"))
    return hits.join(windows.select("window_id", "item_id"), "window_id").select("doc_tag", "item_id", "start", "size")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with `n_words`, `n_hit` (words inside hits), `items` (sorted ids) and `contaminated`."""
    spark = docs.sparkSession
    windows = cut(benchmark_windows(benchmark, window), "windows")
    unique = windows.select("window_id", "win", _length("win").alias("n")).distinct()
    lengths = sorted(r.n for r in unique.select("n").distinct().collect())  # at most SHINGLE rows
    parts = [spark.createDataFrame([], "window_id long, n int, at int, shingle long")]
    for n in lengths:
        each = unique.where(F.col("n") == n).select("window_id", "n", "win", F.explode(F.expr(f"sequence(0, size(win) - {n})")).alias("at"))
        parts.append(each.select("window_id", "n", "at", _shingle("win", F.col("at"), n).alias("shingle")))
    shingles = cut(functools.reduce(DataFrame.unionByName, parts), "shingles")
    found = cut(shingle_places(docs, shingles, lengths, window, id_col, text_col), "found")
    hits = cut(window_hits(windows, shingles, found).distinct(), "hits")
    covered = hits.select("doc_tag", "start", "size").distinct()
    covered = covered.select("doc_tag", F.explode(F.expr("sequence(start, start + size - 1)")).alias("place")).distinct()
    n_hit = covered.groupBy("doc_tag").agg(F.count("*").alias("n_hit"))
    items = hits.select("doc_tag", "item_id").distinct().groupBy("doc_tag").agg(F.array_sort(F.collect_list("item_id")).alias("items"))
    others = [c for c in docs.columns if c not in ("doc_tag", "n_words", "n_hit", "items", "contaminated")]
    n_words = found.where(F.col("pos") < 0).select("doc_tag", F.col("n_words").cast("long").alias("n_words"))
    rows = docs.select(*others, _tag(id_col, text_col).alias("doc_tag")).join(n_words, "doc_tag")
    joined = rows.join(n_hit.join(items, "doc_tag"), "doc_tag", "left")
    n = F.coalesce("n_hit", F.lit(0)).cast("long")
    return joined.select(*others, "n_words", n.alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"), (n > 0).alias("contaminated"))
