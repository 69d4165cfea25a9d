"""Approximate nearest neighbours by largest inner product, with an inverted multi-index.

A vector gets one more component, so that the order by inner product becomes the order by distance. Its two
halves are quantised separately; a cell is a pair of centroids. A query goes through the cells by the sum
of its distances to the two centroids, with a heap, until the cells passed hold `reach` different vectors;
the reach is calibrated on a bounded sample of the queries. The entries of the cells passed, and no others, are
ranked by their exact inner products. Cells are packed into shards, large cells over several, and a query is sent
to the shards of its cells with the sum of distances at which it stopped, which tells its cells there.

The centroids are fitted on a bounded sample (`SAMPLE` vectors); every vector is indexed. The number of
cells grows with the number of vectors, up to `CENTROIDS` squared.

Cases: vectors that are null or zero or hold null or non-finite components take no part, nor do null ids,
nor vectors of another length than most (the shorter length if two are equally frequent). Rows with the same id
are found, and ask, each on its own; a row is no candidate of its own query only. Equal products go to the smaller
id. Fewer than `k` candidates are all returned. An empty table, or one without queries, gives an empty table.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridtide.session import cut

SAMPLE = 16_384
CENTROIDS = 1024  # of each half, at most
PER_CELL = 8  # vectors in a cell that the number of centroids aims at
SHARD, LARGEST_SHARD = 512, 65_536  # vectors in a shard, at least and at most
SHARDS = 24  # that a table is cut into while shards need not be larger
CHUNK = 2048  # queries that meet a shard in one go
CALIBRATION = 256  # queries whose true neighbours are looked up to set the reach
SLACK = 1e-9  # of a sum of distances, which may be added up in another order elsewhere


def fit_centroids(points: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Lloyd's algorithm from spread-out starting points; centroids in order of their main direction."""
    draw = np.random.default_rng(7)
    points = np.unique(points, axis=0)
    k = min(k, len(points))
    centers = points[draw.choice(len(points), k, replace=False)]
    for _ in range(rounds):
        nearest = assign(points, centers)
        count = np.bincount(nearest, minlength=k)
        sums = np.stack([np.bincount(nearest, points[:, d], k) for d in range(points.shape[1])], axis=1)
        centers = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centers)
    spread = centers - centers.mean(axis=0)
    direction = np.linalg.svd(spread, full_matrices=False)[2][0]
    return centers[np.argsort(spread @ direction, kind="stable")]


def distances(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return (points**2).sum(axis=1)[:, None] - 2 * points @ centers.T + (centers**2).sum(axis=1)


def assign(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return distances(points, centers).argmin(axis=1)


@dataclass
class MultiIndex:
    """Codebooks of the halves; after `pack`, also which shards hold each cell."""

    largest: float  # squared length of the longest vector
    first: np.ndarray
    second: np.ndarray
    size: np.ndarray | None = None  # different vectors by cell
    shard: np.ndarray | None = None  # the first shard of a cell
    shards: np.ndarray | None = None  # how many it has

    def halves(self, points: np.ndarray, query: bool) -> tuple[np.ndarray, np.ndarray]:
        more = np.zeros(len(points)) if query else np.sqrt(np.maximum(self.largest - (points**2).sum(axis=1), 0))
        points = np.column_stack([points, more])
        middle = points.shape[1] // 2
        return points[:, :middle], points[:, middle:]

    def cells(self, points: np.ndarray) -> np.ndarray:
        a, b = self.halves(points, False)
        return assign(a, self.first) * len(self.second) + assign(b, self.second)

    def pack(self, cell: np.ndarray, rows: np.ndarray, different: np.ndarray) -> None:
        """Neighbouring small cells share a shard; a large cell has its own.

        Each shard returns its best for each query that touches it, so few large ones are better than
        many small ones, as long as one fits a task.
        """
        per_shard = min(LARGEST_SHARD, max(SHARD, math.ceil(int(rows.sum()) / SHARDS)))
        n = len(self.first) * len(self.second)
        self.size, self.shard, self.shards = np.zeros(n, np.int64), np.full(n, -1, np.int64), np.zeros(n, np.int64)
        self.size[cell] = different
        current, filled = 0, 0
        for c, r in sorted(zip(cell.tolist(), rows.tolist())):
            need = max(1, math.ceil(r / per_shard))
            if filled and filled + r > per_shard:
                current, filled = current + 1, 0
            self.shard[c], self.shards[c] = current, need
            if need > 1:
                current += need
            else:
                filled += r

    def walk(self, queries: np.ndarray) -> Iterator[Iterator[tuple[float, int]]]:
        """For each query the cells that hold vectors, after the sum of the distances to their centroids."""
        a, b = self.halves(queries, True)
        for one, two in zip(distances(a, self.first), distances(b, self.second)):
            yield self._cells_by_sum(one, two)

    def _cells_by_sum(self, one: np.ndarray, two: np.ndarray) -> Iterator[tuple[float, int]]:
        x, y = np.argsort(one, kind="stable"), np.argsort(two, kind="stable")
        near, far = one[x].tolist(), two[y].tolist()
        rows, columns = (x * len(two)).tolist(), y.tolist()
        heap, deep = [(near[0] + far[0], 0, 0)], [0] * len(near)
        while heap:
            total, i, j = heapq.heappop(heap)
            if self.size[rows[i] + columns[j]]:
                yield total, rows[i] + columns[j]
            # the next cells are those whose neighbours towards the corner have all been passed
            deep[i] = j + 1
            if j + 1 < len(far) and (i == 0 or deep[i - 1] > j + 1):
                heapq.heappush(heap, (near[i] + far[j + 1], i, j + 1))
            if i + 1 < len(near) and deep[i + 1] == j:
                heapq.heappush(heap, (near[i + 1] + far[j], i + 1, j))

    def probe(self, queries: np.ndarray, reach: int) -> Iterator[tuple[np.ndarray, float]]:
        """For each query the shards of its cells until `reach` different vectors are passed, and the last sum."""
        for cells in self.walk(queries):
            passed, found, last = 0, set(), 0.0
            for total, cell in cells:
                found.update(range(self.shard[cell], self.shard[cell] + self.shards[cell]))
                passed, last = passed + int(self.size[cell]), total
                if passed >= reach:
                    break
            yield np.array(sorted(found), np.int64), last

    def sums(self, queries: np.ndarray, cells: np.ndarray) -> Iterator[np.ndarray]:
        """For each query its sums of distances to some cells."""
        a, b = self.halves(queries, True)
        x, y = np.divmod(cells, len(self.second))
        for one, two in zip(distances(a, self.first), distances(b, self.second)):
            yield one[x] + two[y]

    def needed(self, query: np.ndarray, cells: list[int]) -> list[int]:
        """For each of some cells the least reach with which the query passes it."""
        held = np.flatnonzero(self.size)
        order = held[np.argsort(next(self.sums(query[None], held)), kind="stable")]
        before = np.cumsum(self.size[order]) - self.size[order]
        place = {int(c): int(n) + 1 for c, n in zip(order, before)}
        return [place[c] for c in cells]


def _matrix(column: pa.Array | pd.Series) -> np.ndarray:
    if isinstance(column, pd.Series):
        return np.stack(column.to_list()).astype(float)
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """`vec_id`, `v` and `row` (a number of its own) of the vectors that take part."""
    v = F.col("v")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & v.isNotNull()).where(fine)
    rows = cut(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    usual = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    return rows if usual is None else rows.where(F.size("v") == usual.d)


RANKED = "query_row long, query_id long, vec_id long, row long, score double"


def _rank(index, k: int):
    """The `k` best of a shard's entries for each query, of the cells that the query has passed."""

    def best(entries: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(entries) and len(queries):
            by = np.lexsort((entries["row"].to_numpy(), entries["vec_id"].to_numpy()))
            ids, own, rows = entries["vec_id"].to_numpy()[by], entries["row"].to_numpy()[by], _matrix(entries["v"])[by]
            cells, cell = np.unique(entries["cell"].to_numpy()[by], return_inverse=True)
            points = _matrix(queries["q"])
            asked = zip(queries["query_row"].to_numpy(), queries["query_id"].to_numpy(), queries["last"].to_numpy(), points, index.value.sums(points, cells))
            for query_row, query_id, last, query, sums in asked:
                passed = np.flatnonzero((sums <= last + SLACK * (abs(last) + index.value.largest))[cell] & (own != query_row))
                # summed row by row, so that equal vectors have equal scores wherever they are
                scores = (rows[passed] * query).sum(axis=1)
                if len(passed) > k:
                    least = np.partition(scores, len(passed) - k)[len(passed) - k]
                    some = np.flatnonzero(scores >= least)
                    passed, scores = passed[some], scores[some]
                some = np.argsort(-scores, kind="stable")[:k]
                at = passed[some]
                out.append(pd.DataFrame({"query_row": query_row, "query_id": query_id, "vec_id": ids[at], "row": own[at], "score": scores[some]}))
        return pd.concat(out) if out else pd.DataFrame({c.split()[0]: [] for c in RANKED.split(", ")}).astype({"query_row": "int64", "query_id": "int64", "vec_id": "int64", "row": "int64"})

    return best


def calibrated_reach(entries: DataFrame, queries: DataFrame, index: MultiIndex, k: int, recall: float) -> int:
    """The least reach that finds `recall` of the true neighbours of a bounded sample of the queries.

    `entries`: (row, vec_id, v, cell) of all vectors; each task returns its `k` best for each sampled query.
    """
    sample = queries.orderBy(F.xxhash64("vec_id"), "vec_id", "row").limit(CALIBRATION).toArrow()
    if not sample.num_rows:
        return 1
    own, points = sample.column("row").to_numpy(), _matrix(sample.column("v").combine_chunks())

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, ids, cell = (batch.column(c).to_numpy() for c in (0, 1, 3))
            scores = np.where(row[None, :] == own[:, None], -np.inf, points @ _matrix(batch.column(2)).T)
            top = np.argsort(-scores, axis=1, kind="stable")[:, :k]
            q, flat = np.repeat(np.arange(len(own)), top.shape[1]), top.ravel()
            yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(ids[flat]), pa.array(cell[flat]), pa.array(scores[q, flat])], ["q", "vec_id", "cell", "score"])

    found = entries.select("row", "vec_id", "v", "cell").mapInArrow(best, "q long, vec_id long, cell long, score double").where(F.col("score") > float("-inf"))
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))
    true: dict[int, list[int]] = {}
    for r in found.withColumn("rank", rank).where(F.col("rank") <= k).select("q", "cell").collect():  # k rows a sampled query
        true.setdefault(r.q, []).append(r.cell)
    needed = sorted(n for q, cells in true.items() for n in index.needed(points[q], cells))
    return needed[math.ceil(recall * len(needed)) - 1] if needed else 1


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 20, reach: int | None = None, recall: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """`query_id`, `rank`, `vec_id`, `score`: the `k` nearest found of each row where `is_query` holds.

    `is_query` is a condition on `vec_id`, an integer. `reach` trades recall against work; by default it is
    what finds `recall` of the true neighbours of `CALIBRATION` queries.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col)
    length = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    total = rows.agg(F.count("*").alias("n"), F.max(length).alias("largest")).first()
    if not total.n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").select("v").limit(SAMPLE).toArrow()
    index = MultiIndex(total.largest, np.zeros(0), np.zeros(0))
    centroids = min(CENTROIDS, max(4, math.ceil(math.sqrt(total.n / PER_CELL))))
    halves = index.halves(_matrix(sample.column("v").combine_chunks()), False)
    index.first, index.second = (fit_centroids(h, centroids) for h in halves)
    books = spark.sparkContext.broadcast(index)  # at most 2 x CENTROIDS centroids

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cell = books.value.cells(_matrix(batch.column(2)))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int64())], ["row", "vec_id", "v", "cell"])

    entries = cut(rows.select("row", "vec_id", "v").mapInArrow(place, "row long, vec_id long, v array<double>, cell long"), "entries")
    # at most CENTROIDS squared rows; equal vectors count once, so that copies do not use up the reach
    sizes = entries.groupBy("cell").agg(F.count("*").alias("n"), F.countDistinct(F.xxhash64("v")).alias("different")).toArrow()
    packed = MultiIndex(index.largest, index.first, index.second)
    packed.pack(*(sizes.column(c).to_numpy() for c in ("cell", "n", "different")))
    whole = spark.sparkContext.broadcast(packed)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, cell = batch.column(0).to_numpy(), batch.column(3).to_numpy()
            mixed = (row.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)
            shard = whole.value.shard[cell] + mixed % whole.value.shards[cell]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shard)], ["row", "vec_id", "v", "cell", "shard"])

    probed = "query_row long, query_id long, q array<double>, last double, shard long"

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                found = list(whole.value.probe(_matrix(part.column(2)), reach))
                sizes = [len(shards) for shards, _ in found]
                at, last = pa.array(np.repeat(np.arange(len(found)), sizes)), np.repeat([last for _, last in found], sizes)
                columns = [*(c.take(at) for c in part.columns), pa.array(last, pa.float64()), pa.array(np.concatenate([s for s, _ in found]))]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in probed.split(", ")])

    dealt = entries.mapInArrow(deal, "row long, vec_id long, v array<double>, cell long, shard long")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    queries = rows.where(is_query).select("row", "vec_id", "v").repartition(parts)
    if reach is None:
        reach = calibrated_reach(entries, queries, packed, k, recall)
    probes = cut(queries.mapInArrow(probe, probed), "probes")
    chunks = probes.groupBy("shard").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    left = dealt.join(chunks, "shard").withColumn("chunk", F.explode(F.expr("sequence(0, chunks - 1)"))).drop("chunks")
    right = probes.join(chunks, "shard").withColumn("chunk", F.pmod(F.xxhash64("query_row"), "chunks").cast("int")).drop("chunks")
    found = left.groupBy("shard", "chunk").cogroup(right.groupBy("shard", "chunk")).applyInPandas(_rank(whole, k), RANKED)
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
