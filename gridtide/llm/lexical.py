"""Ranked lexical search over an index that is stratified by document length.

Documents with the same normaliser `m` form a stratum. A stratum is kept in blocks of bounded size; in a block
each term's postings are grouped by term frequency, so that an impact is computed once per frequency. The
largest frequency of each term bounds what any document of the block can score for a query. Blocks are visited
in two waves by these bounds: first the best ones of each query, which give a score that its k-th result has at
least, then all others whose bound reaches that score. The result is exact.

Only A-Z are lower-cased. A document's `m` is 100 - 50 + (50 * n * N) div L for n terms of its own, N documents
with a term and L terms in all; a term's weight is floor(1000 ln((2N + 2) / (2df + 1))); a score is the sum of
weight * ((10^9 tf) div (1000 tf + 20 m)) over the query's terms, once each.

Cases: null and empty texts have no terms; such documents do not count and such queries find nothing. Every
row is a document or a query of its own, so repeated rows are found, and ask, once each. Equal scores come by
ascending id, null last. Further columns are not read. Empty tables give an empty table.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridtide.llm.batches import slices
from gridtide.session import cut

TERMS = re.compile(rb"[0-9a-z\x80-\xff]+").findall  # of lower-cased UTF-8; a character is never split
PAIRS, DOCS = 200_000, 1024  # a block has about so many postings and documents at most
ITEMS, ITEM_TERMS = 4096, 500_000  # queries asked together have so many rows and terms at most, if more than one
FIRST = 4  # blocks that a task proposes for the first wave of a query
ROWS = 256
TOGETHER = 256  # queries scored in one matrix


def terms_of(text: str | None) -> Counter:
    """How often each term occurs, as UTF-8."""
    return Counter(TERMS((text or "").encode().lower()))


def impact(tf: np.ndarray, m: int) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def term_counts(texts: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """`id`, `n` (terms with repeats), `terms` and their `tfs`, for rows with a term; written, with a `uid`."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, ROWS):
            counts = [terms_of(text) for text in batch.column(1).to_pylist()]
            offsets = pa.array(np.cumsum([0, *map(len, counts)]), pa.int32())
            terms = pa.array(itertools.chain.from_iterable(counts), pa.binary()).cast(pa.string())
            tfs = pa.array(itertools.chain.from_iterable(c.values() for c in counts), pa.int32())
            columns = [
                batch.column(0),
                pa.array([c.total() for c in counts], pa.int64()),
                pa.ListArray.from_arrays(offsets, terms),
                pa.ListArray.from_arrays(offsets, tfs),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n", "terms", "tfs"])

    rows = texts.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    counted = rows.mapInArrow(count, f"id {kind}, n long, terms array<string>, tfs array<int>").where("n > 0")
    return cut(counted.withColumn("uid", F.monotonically_increasing_id()), "terms")


@dataclass
class Index:
    blocks: DataFrame
    n_docs: int


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """The written index of all documents and terms.

    A stratum of any size is dealt to blocks by the rows' own numbers, so no task holds one.
    """
    counted = term_counts(docs, id_col, text_col)
    n_docs, length = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    rows = counted.withColumn("m", F.expr(f"50 + (50 * n * {n_docs}L) div {max(length, 1)}L"))
    size = F.greatest(F.ceil(F.sum(F.size("terms")) / PAIRS), F.ceil(F.count("*") / DOCS))
    # m is 50 and more in whole steps, and all m - 50 add up to 50 N at most: there are at most 10 sqrt(N) + 1 of them
    strata = F.broadcast(rows.groupBy("m").agg(size.alias("parts")))
    dealt = rows.join(strata, "m").withColumn("block", F.pmod(F.xxhash64("uid"), F.col("parts")))
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = (
        dealt.select("m", "block", "id", "terms", "tfs").repartition(ranges, "m", "block").sortWithinPartitions("m", "block", F.asc_nulls_last("id"))
    )
    kind = rows.schema["id"].dataType.simpleString()
    fields = f"m long, n_docs int, ids array<{kind}>, terms array<string>, df array<int>, top array<int>, runs array<int>, run_tf binary, run_size binary, places binary"
    return Index(cut(sorted_.mapInArrow(_blocks, fields), "strata"), n_docs)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, key = [], None
    for batch in batches:
        m, block = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        edges = np.flatnonzero((np.diff(m) != 0) | (np.diff(block) != 0)) + 1
        for low, high in itertools.pairwise([0, *edges.tolist(), len(m)]):
            if low == high:
                continue
            here = (m[low], block[low])
            if held and here != key:
                yield _block(held)
                held = []
            key = here
            held.append(batch.slice(low, high - low))
    if held:
        yield _block(held)


def _block(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    rows = pa.Table.from_batches(held).combine_chunks()
    sizes = pc.list_value_length(rows["terms"]).to_numpy()
    terms = pc.list_flatten(rows["terms"]).combine_chunks().dictionary_encode()
    code, tf = terms.indices.to_numpy(), pc.list_flatten(rows["tfs"]).to_numpy()
    place = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    order = np.lexsort((place, -tf, code))
    code, tf, place = code[order], tf[order], place[order]
    run = np.flatnonzero(np.concatenate([[True], (np.diff(code) != 0) | (np.diff(tf) != 0)]))
    first = np.flatnonzero(np.concatenate([[True], np.diff(code[run]) != 0]))
    lists = [rows["id"].combine_chunks(), terms.dictionary, np.bincount(code), tf[run[first]], np.diff([*first, len(run)])]
    binary = [tf[run], np.diff([*run, len(code)]), place]
    columns = {"m": rows["m"][:1].combine_chunks(), "n_docs": pa.array([len(sizes)], pa.int32())}
    for name, values in zip(("ids", "terms", "df", "top", "runs"), lists):
        values = values if isinstance(values, pa.Array) else pa.array(values, pa.int32())
        columns[name] = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
    for name, values in zip(("run_tf", "run_size", "places"), binary):
        columns[name] = pa.array([values.astype("<i4").tobytes()], pa.binary())
    return pa.RecordBatch.from_pydict(columns)


@dataclass
class Asked:
    """Queries that are asked together: their terms' weights, and the queries of each term in one array."""

    terms: pa.Array
    weights: np.ndarray
    begin: np.ndarray
    items: np.ndarray
    n_items: int

    def in_block(self, terms: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Places of asked terms in the block and among the asked ones."""
        at = pc.index_in(terms, value_set=self.terms).fill_null(-1).to_numpy(zero_copy_only=False)
        own = np.flatnonzero(at >= 0)
        return own, at[own]

    def bounds(self, m: int, top: np.ndarray, asked: np.ndarray) -> np.ndarray:
        """The most that a document of a block can score, for each query; `top` are largest frequencies."""
        most = self.weights[asked] * impact(top.astype(np.int64), m)
        sizes = self.begin[asked + 1] - self.begin[asked]
        spots = np.repeat(self.begin[asked] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
        out = np.zeros(self.n_items, np.int64)
        np.add.at(out, self.items[spots], np.repeat(most, sizes))
        return out


def _array(batch: pa.RecordBatch, name: str, row: int) -> pa.Array:
    return batch.column(name)[row].values


def _proposals(asked: Asked):
    """The blocks with the best bounds of each query that a task has seen."""

    def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple[int, int]]] = {}
        for batch in batches:
            for row in range(batch.num_rows):
                own, at = asked.in_block(_array(batch, "terms", row))
                bounds = asked.bounds(batch.column("m")[row].as_py(), _array(batch, "top", row).to_numpy()[own], at)
                docs = batch.column("n_docs")[row].as_py()
                for q in np.flatnonzero(bounds).tolist():
                    best[q] = sorted([*best.get(q, []), (int(bounds[q]), docs)], reverse=True)[:FIRST]
        rows = [(q, bound, docs) for q, some in best.items() for bound, docs in some]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(3)], ["q", "bound", "docs"])

    return propose


def _visits(asked: Asked, low: np.ndarray, high: np.ndarray, least: np.ndarray, k: int):
    """Scores the blocks whose bound for a query is at least `low` and below `high`; each task's k best of scores
    from `least` on."""

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple]] = {}
        floor, kind = least.copy(), None
        for batch in batches:
            kind = batch.schema.field("ids").type.value_type
            for row in range(batch.num_rows):
                m = batch.column("m")[row].as_py()
                own, at = asked.in_block(_array(batch, "terms", row))
                bounds = asked.bounds(m, _array(batch, "top", row).to_numpy()[own], at)
                going = np.flatnonzero((bounds >= np.maximum(np.maximum(low, floor), 1)) & (bounds < high))
                if not len(going):
                    continue
                block = _Postings(batch, row, m)
                ids = _array(batch, "ids", row)
                for some in np.array_split(going, -(-len(going) // TOGETHER)):
                    scores = block.scores(asked, own, at, some)
                    for q, line in zip(some.tolist(), scores):
                        found = np.flatnonzero(line >= max(floor[q], 1))
                        if not len(found):
                            continue
                        found = found[np.argsort(-line[found], kind="stable")][:k]  # places follow the ids
                        new = [(-int(s), i is None, 0 if i is None else i) for s, i in zip(line[found], ids.take(pa.array(found)).to_pylist())]
                        best[q] = sorted([*best.get(q, []), *new])[:k]
                        if len(best[q]) == k:
                            floor[q] = max(floor[q], -best[q][-1][0])
        if best:
            rows = [(q, -score, None if empty else i) for q, some in best.items() for score, empty, i in some]
            kinds = (pa.int64(), pa.int64(), kind)
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate(kinds)], ["q", "score", "id"])

    return visit


class _Postings:
    def __init__(self, batch: pa.RecordBatch, row: int, m: int):
        tf, size, self.places = (np.frombuffer(batch.column(c)[row].as_py(), "<i4") for c in ("run_tf", "run_size", "places"))
        runs = np.concatenate([[0], np.cumsum(_array(batch, "runs", row).to_numpy())])
        self.begin = np.concatenate([[0], np.cumsum(size)])[runs]
        self.runs, self.size, self.impact = runs, size, impact(tf.astype(np.int64), m)  # once per frequency
        self.n_docs = batch.column("n_docs")[row].as_py()

    def scores(self, asked: Asked, own: np.ndarray, at: np.ndarray, some: np.ndarray) -> np.ndarray:
        """A line for each of `some` queries, a column for each document."""
        out = np.zeros((len(some), self.n_docs), np.int64)
        line = np.full(asked.n_items, -1)
        line[some] = np.arange(len(some))
        for term, a in zip(own.tolist(), at.tolist()):
            lines = line[asked.items[asked.begin[a] : asked.begin[a + 1]]]
            lines = lines[lines >= 0]
            if len(lines):
                runs = slice(self.runs[term], self.runs[term + 1])
                gain = np.repeat(asked.weights[a] * self.impact[runs], self.size[runs])
                docs = self.places[self.begin[term] : self.begin[term + 1]]
                if len(lines) == 1:
                    out[lines[0], docs] += gain
                else:
                    out[lines[:, None], docs] += gain
        return out


def _asked(spark: SparkSession, index: Index, some: list) -> Asked:
    """Weights come from the document counts of the blocks."""
    items: dict[str, list[int]] = {}
    for q, row in enumerate(some):
        for term in row.terms:
            items.setdefault(term, []).append(q)
    wanted = spark.createDataFrame([(t,) for t in items], "term string")
    counts = index.blocks.select(F.explode(F.arrays_zip("terms", "df")).alias("e")).select(F.col("e.terms").alias("term"), "e.df")
    # the terms of one lot of queries, see ITEM_TERMS
    df = {r.term: r.df for r in counts.join(F.broadcast(wanted), "term").groupBy("term").agg(F.sum("df").alias("df")).collect()}
    terms = sorted(df)
    weights = [math.floor(1000 * math.log((2 * index.n_docs + 2) / (2 * df[t] + 1))) for t in terms]
    lists = [items[t] for t in terms]
    begin = np.cumsum([0, *map(len, lists)])
    return Asked(pa.array(terms, pa.string()), np.array(weights, np.int64), begin, np.array(list(itertools.chain(*lists)), np.int64), len(some))


def _search(spark: SparkSession, index: Index, some: list, id_type: str, k: int) -> DataFrame:
    asked = _asked(spark, index, some)
    kind = index.blocks.schema["ids"].dataType.elementType.simpleString()
    found = f"q long, score long, id {kind}"
    by_bound = Window.partitionBy("q").orderBy(F.desc("bound")).rowsBetween(Window.unboundedPreceding, -1)
    proposed = index.blocks.select("m", "n_docs", "terms", "top").mapInArrow(_proposals(asked), "q long, bound long, docs long")
    enough = proposed.withColumn("before", F.coalesce(F.sum("docs").over(by_bound), F.lit(0))).where(F.col("before") < k)
    none = np.iinfo(np.int64).max
    high = np.full(asked.n_items, none)
    for row in enough.groupBy("q").agg(F.min("bound").alias("bound")).collect():  # a row a query
        high[row.q] = row.bound
    best = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("id"))

    def top(rows: DataFrame) -> DataFrame:
        return rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    low = np.zeros(asked.n_items, np.int64)
    first = cut(top(index.blocks.mapInArrow(_visits(asked, high, np.full(asked.n_items, none), low, k), found)).drop("rank"), "first")
    for row in first.groupBy("q").agg(F.count("*").alias("n"), F.min("score").alias("score")).where(F.col("n") == k).collect():
        low[row.q] = row.score
    second = index.blocks.mapInArrow(_visits(asked, low, high, low, k), found)
    names = spark.createDataFrame([(q, row.id) for q, row in enumerate(some)], f"q long, item_id {id_type}")
    return top(first.unionByName(second)).join(F.broadcast(names), "q").select("item_id", "rank", F.col("id").alias("doc_id"), "score")


def search(index: Index, queries: DataFrame, k: int = 50, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """`item_id`, `rank` (from 1), `doc_id` and `score` of each query's k best documents with a score above 0.

    Queries are asked in lots of bounded size; each lot goes once over the index for bounds and twice for scores,
    and its results are written.
    """
    spark = queries.sparkSession
    kinds = queries.schema[id_col].dataType.simpleString(), index.blocks.schema["ids"].dataType.elementType.simpleString()
    out = spark.createDataFrame([], f"item_id {kinds[0]}, rank int, doc_id {kinds[1]}, score long")
    rows = term_counts(queries, id_col, text_col).select("id", "terms").toLocalIterator()
    lot: list = []
    terms = 0
    for row in itertools.chain(rows, [None]):
        if lot and (row is None or len(lot) == ITEMS or terms + len(row.terms) > ITEM_TERMS):
            out = out.unionByName(cut(_search(spark, index, lot, kinds[0], k), "ranked"))
            lot, terms = [], 0
        if row is not None:
            lot.append(row)
            terms += len(row.terms)
    return out
