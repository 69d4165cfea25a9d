"""Toxicity scores from a character n-gram linear classifier with naive Bayes feature scaling.

A text is lower-cased, white space runs become one space, and the n-grams of 3 to 6 characters present
in it are hashed. Each feature has the value of its log-count ratio, the logarithm of its smoothed share
among toxic texts over that among the others; a logistic regression weighs these values.

The classifier is fitted on a bounded sample of labelled rows: at most `SAMPLE` rows, those with the
smallest hash of the id. Every n-gram in them is a feature. Its ratio is shrunk by its standard error, so one
whose shares may well be equal has the value 0; rows are lists of the n-grams with other values that they have,
and the regression is fitted row by row, by exact steps on its dual.

Cases: a null text is empty; an empty text gets the score of the intercept. Labels are 0 and 1; null
labels and labels without a document are left out; an id with both labels counts as toxic, and of documents
that share an id one is in the sample, that whose text has the smallest hash. Without labels of both classes every text gets the smoothed share of
toxic ones. Columns of the input whose names the result uses are replaced. An empty table gives an empty
table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtide.llm.batches import slices
from gridtide.session import cut

SAMPLE = 8_000  # labelled rows to fit on, at most
SIZES = (3, 4, 5, 6)
BITS = 20
TASKS = 8  # that count n-grams; each returns two counts for each hash value
ERRORS = 2  # a ratio of so many standard errors, or less, is taken for 0
PENALTY = 1.0
TOXIC_WEIGHT = 4  # the rarer class counts for so many rows
ROUNDS, SETTLED = 400, 1e-4  # passes over the sample at most; a pass that moves no row by more is the last


def ngrams(text: str) -> np.ndarray:
    """Hashes of all n-grams of a text, repeats included."""
    padded = " " + " ".join(text.lower().split()) + " "
    codes = np.frombuffer(padded.encode("utf-32-le", "surrogatepass"), "<u4")
    found, h = [], codes
    for n in range(2, max(SIZES) + 1):
        if len(h) < 2:
            break
        h = h[:-1] * np.uint32(0x01000193) ^ codes[n - 1 :]
        if n in SIZES:
            mixed = (h ^ h >> np.uint32(15)) * np.uint32(0x85EBCA6B) + np.uint32(n)
            found.append(mixed * np.uint32(0x9E3779B1) >> np.uint32(32 - BITS))
    return np.concatenate(found) if found else np.zeros(0, np.uint32)


def present(text: str) -> np.ndarray:
    """The n-grams that a text has, as whole numbers in order."""
    return np.unique(ngrams(text))


@dataclass
class Model:
    weight: np.ndarray  # by hash
    bias: float

    def score(self, text: str) -> float:
        z = self.bias
        if text:
            found = ngrams(text)
            found = np.unique(found[self.weight[found] != 0])
            z += float(self.weight[found].sum(dtype=np.float64))
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


def log_count_ratios(counts: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """For each hash value, the logarithm of its share among toxic rows over that among the others, shrunk.

    `counts` has the rows of each class with the value, `docs` those of the class. Shares are smoothed by one
    row that is spread over both classes, so a value without rows has a ratio of 0.
    """
    share = counts / docs[:, None] + 1 / docs.sum()
    ratio = np.log(share[1] / share[0])
    error = (1 / (share * docs[:, None]) - 1 / (docs[:, None] + docs[:, None] / docs.sum())).sum(axis=0)
    kept = 1 - ERRORS**2 * error / np.maximum(ratio**2, 1e-12)
    return np.where(counts.any(axis=0) & (kept > 0), ratio * kept, 0.0)


def _step(old: float, cost: float, margin: float, size: float) -> float:
    """The dual variable of a row at which, all others held, its loss and its margin agree; 0 to `cost`."""
    low, high = 0.0, cost
    at = min(max(old, 1e-9), cost - 1e-9)
    for _ in range(40):
        slope = math.log(at / (cost - at)) + margin + size * (at - old)
        low, high = (low, at) if slope > 0 else (at, high)
        later = at - slope / (cost / (at * (cost - at)) + size)
        later = later if low < later < high else (low + high) / 2
        if abs(later - at) < 1e-10 * cost:
            break
        at = later
    return at


def fit(rows: list[np.ndarray], toxic: list[int], ratio: np.ndarray) -> Model:
    """L2-penalised logistic regression on rows whose features have the value of their ratio.

    Rows are taken in turns, in an order drawn once a pass from a fixed seed.
    """
    sizes = np.array([float((ratio[row] ** 2).sum()) for row in rows])
    # the intercept is one more feature, as large as a usual row
    constant = math.sqrt(sizes.mean()) + 1
    weight, bias, dual = np.zeros(1 << BITS), 0.0, [0.0] * len(rows)
    draw = np.random.default_rng(1)
    for _ in range(ROUNDS):
        moved = 0.0
        for k in draw.permutation(len(rows)).tolist():
            row, sign, cost = rows[k], 1 if toxic[k] else -1, TOXIC_WEIGHT if toxic[k] else 1
            values = ratio[row]
            margin = sign * (float(weight[row] @ values) + bias * constant)
            at = _step(dual[k], cost, margin, (sizes[k] + constant**2) / PENALTY)
            change = sign * (at - dual[k]) / PENALTY
            weight[row] += change * values
            bias += change * constant
            moved, dual[k] = max(moved, abs(at - dual[k]) / cost), at
        if moved < SETTLED:
            break
    return Model((weight * ratio).astype(np.float32), bias * constant)


def may_learn(remainders: int = 3, held_out: int = 1) -> Column:
    """A condition on `doc_id` that leaves a share of the ids for testing."""
    return ~is_held_out(remainders, held_out)


def is_held_out(remainders: int, remainder: int) -> Column:
    """Whether the CRC-32 of the id as text has this remainder; a null id is never held out."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.coalesce(crc % remainders == remainder, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, allowed: Column | None, rows: int = SAMPLE) -> DataFrame:
    """`toxic` and `text` of the bounded sample; `allowed` is a condition on the labels' `doc_id`."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    if allowed is not None:
        known = known.where(allowed)
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    some = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)  # the bound of the sample
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    copies = texts.join(F.broadcast(some), "doc_id")  # at most `rows` ids
    first = copies.groupBy("doc_id").agg(F.first("toxic").alias("toxic"), F.min(F.struct(F.xxhash64("text"), "text")).alias("row"))
    return first.select("toxic", "row.text")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts, docs = np.zeros((2, 1 << BITS), np.int32), np.zeros(2, np.int64)
    for batch in slices(batches):
        for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts[toxic, present(text)] += 1
            docs[toxic] += 1
    packed = pa.compress(counts.tobytes(), "zstd", asbytes=True)
    yield pa.RecordBatch.from_arrays([pa.array([packed], pa.binary()), pa.array([docs.tolist()])], ["counts", "docs"])


def train(docs: DataFrame, labels: DataFrame, allowed: Column | None = None, rows: int = SAMPLE) -> Model:
    """Fits a model. The driver gets counts, whose size does not depend on the texts, and the n-grams of the
    sampled rows, at most 2^BITS each, a task at a time."""
    chosen = cut(sample(docs, labels, allowed, rows), "sample")
    counts, docs_of = np.zeros((2, 1 << BITS), np.int64), np.zeros(2, np.int64)
    for row in chosen.repartition(TASKS).mapInArrow(_count, "counts binary, docs array<long>").toLocalIterator():
        raw = pa.decompress(row.counts, decompressed_size=counts.size * 4, codec="zstd", asbytes=True)
        counts += np.frombuffer(raw, np.int32).reshape(counts.shape)
        docs_of += row.docs
    if not docs_of.all():
        share = (docs_of[1] + 0.5) / (docs_of.sum() + 1)
        return Model(np.zeros(1 << BITS, np.float32), math.log(share / (1 - share)))
    ratio = log_count_ratios(counts, docs_of)
    telling = ratio != 0

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            each = [present(text) for text in batch.column(1).to_pylist()]
            packed = [has[telling[has]].astype("<u4").tobytes() for has in each]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], ["toxic", "present"])

    got = [(row.present, row.toxic) for row in chosen.mapInArrow(found, "toxic int, present binary").toLocalIterator()]
    got.sort()  # a fixed order, so that the same sample always gives the same model
    return fit([np.frombuffer(packed, "<u4") for packed, _ in got], [label for _, label in got], ratio)


def score_toxicity(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """`docs` with `score`, 0 to 1, higher where toxic is likelier."""
    packed = docs.sparkSession.sparkContext.broadcast(model)  # 4 MB
    others = [c for c in docs.columns if c != "score"]
    rows = docs.select(*others)
    at = others.index(text_col)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            scores = [packed.value.score(t or "") for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*others, "score"])

    return rows.mapInArrow(score, docs.select(*others).schema.add("score", "double"))
