"""Packing of documents into sequences along a space-filling curve.

A document's tokens are hashed into a vector, the vector is projected to a few dimensions, and documents are
range-sorted by the Hilbert key of the projected point. Along that order their tokens form one stream, which
is cut into sequences of `size`. What remains at its end is cut into lengths that are powers of two, so that
no sequence needs padding.

Cases: a null or empty text has the end token alone. Rows with equal keys follow by id (null first) and then
by place in the table, so repeated rows are packed one after another. Further columns are not read. An empty
table gives an empty table.
"""

from __future__ import annotations

import bisect
import functools
import itertools
import json
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridtide.llm.batches import slices
from gridtide.llm.merge_automaton import byte_symbols
from gridtide.operators.ordering import lined_up
from gridtide.session import cut

END = 1
SIZE = 2048
BUCKETS = 1024  # length of a hashed vector
DIMS, BITS = 4, 12  # of the curve
FIXED = 1 << 20  # coordinates are whole multiples of 1 / FIXED, so that their sums do not depend on order
SPREAD = 4  # standard deviations from the mean to the edge of the curve's cube
REMEMBERED = 400_000  # words that a worker keeps; then it starts afresh
LONG = 64  # longer words are not kept
ROWS = 256

# How a vocabulary with word ends splits normalised text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# The same for text in characters that are their own NFC and become lower case one by one, and what is not such text.
SIMPLE_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9 \t-\r]+").findall
SPACE = re.compile(r"[ \t-\r]+")
NOT_SIMPLE = re.compile(r"[^ -~\t-\rÀ-ÖØ-öø-ÿ]|<\|").search


class Words(dict):
    """Ids of single words in lower case, found by the vocabulary's model when first asked for."""

    def __init__(self, model):
        super().__init__()
        self.tokens, self.letters = model.tokenize, byte_symbols()

    def __missing__(self, word: str) -> bytes:
        ids = array("I", [t.id for t in self.tokens(word if word.isascii() else word.encode().decode("latin-1").translate(self.letters))]).tobytes()
        if len(word) <= LONG:
            self[word] = ids
        return ids


class Encoder:
    """Token ids of texts, as the vocabulary's library gives them.

    Where words end with a mark and white space is dropped, a text's ids are those of its words. Simple text is
    split into words here; any other piece between white space is left to the library.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks are parallel
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.apart = parts["model"].get("end_of_word_suffix") is not None and json.dumps(WORDS) in json.dumps(parts["pre_tokenizer"])
        self.words = Words(self.tokenizer.model)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if not self.apart:
            return [self._whole(text) for text in texts]
        if len(self.words) > REMEMBERED:
            self.words.clear()
        return [self._plain(text) if not NOT_SIMPLE(text) else b"".join(self._parts(text)) for text in texts]

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.words.__getitem__, SIMPLE_WORDS(text.lower())))

    def _parts(self, text: str) -> Iterator[bytes]:
        for odd, pieces in itertools.groupby(SPACE.split(text), lambda piece: NOT_SIMPLE(piece) is not None):
            yield from map(self._whole, pieces) if odd else [self._plain(" ".join(pieces))]

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


@functools.lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """The encoder of this worker, which keeps what it has learned from task to task."""
    return Encoder(path)


@functools.lru_cache(maxsize=1)
def _projection() -> np.ndarray:
    return np.random.default_rng(13).choice([-1.0, 1.0], (BUCKETS, DIMS))


def projected(ids: np.ndarray) -> list[int]:
    """The point of a document: square roots of the shares of its hashed tokens, projected."""
    hashed = (ids.astype(np.uint32) * np.uint32(2654435769)) >> np.uint32(22)
    shares = np.sqrt(np.bincount(hashed, minlength=BUCKETS) / len(ids))
    return np.rint(shares @ _projection() * FIXED).astype(np.int64).tolist()


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Place along the Hilbert curve of each row of whole numbers below 2^bits; 62 bits in all at most."""
    axes = points.T.astype(np.int64).copy()
    dims = len(axes)
    for bit in reversed(range(1, bits)):
        low = (1 << bit) - 1
        for k in range(dims):
            flip = axes[k] >> bit & 1 == 1
            swap = np.where(flip, 0, (axes[0] ^ axes[k]) & low)
            axes[0] ^= np.where(flip, low, swap)
            axes[k] ^= swap
    for k in range(1, dims):
        axes[k] ^= axes[k - 1]
    turn = np.zeros_like(axes[0])
    for bit in range(1, bits):
        turn ^= np.where(axes[-1] >> bit & 1 == 1, (1 << bit) - 1, 0)
    axes ^= turn
    key = np.zeros_like(turn)
    for bit in reversed(range(bits)):
        for k in range(dims):
            key = key << 1 | axes[k] >> bit & 1
    return key


def encoded(docs: DataFrame, path: str, end: int = END) -> DataFrame:
    """`uid` (a row's own number), `doc_id`, `n` tokens, `ids` (packed, `end` included) and `point`; written.

    The tokens are written as 16-bit integers where the vocabulary allows it.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, last = encoder(path), np.array([end], "<u4").tobytes()
        for batch in slices(batches, ROWS):
            ids = [np.frombuffer(b + last, "<u4") for b in work.encode_all([t or "" for t in batch.column(1).to_pylist()])]
            narrow = "<u2" if work.tokenizer.get_vocab_size() <= 1 << 16 and end < 1 << 16 else "<u4"
            columns = [
                batch.column(0),
                pa.array([len(i) for i in ids], pa.int64()),
                pa.array([i.astype(narrow).tobytes() for i in ids], pa.binary()),
                pa.array([projected(i) for i in ids], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "ids", "point"])

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    out = rows.mapInArrow(encode, f"doc_id {kind}, n long, ids binary, point array<long>")
    return cut(out.withColumn("uid", F.monotonically_increasing_id()), "tokens")


def along_curve(coded: DataFrame) -> DataFrame:
    """`uid`, `doc_id`, `n` and `key`, the place along the curve, of each row of `encoded`."""
    exact = [F.col("point")[k].cast("decimal(20,0)") for k in range(DIMS)]
    totals = coded.agg(F.count("*"), *[F.sum(x) for x in exact], *[F.sum((x * x).cast("decimal(38,0)")) for x in exact]).first()
    count = max(totals[0], 1)
    mean = np.array([float(x or 0) / count for x in totals[1 : 1 + DIMS]])
    spread = np.sqrt(np.maximum([float(x or 0) / count for x in totals[1 + DIMS :]] - mean**2, 1.0))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = batch.column(3).flatten().to_numpy().reshape(-1, DIMS)
            levels = ((points - mean) / spread / SPREAD + 1) * (1 << BITS - 1)
            key = hilbert(np.clip(levels, 0, (1 << BITS) - 1), BITS)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(key, pa.int64())], ["uid", "doc_id", "n", "key"])

    rows = coded.select("uid", "doc_id", "n", "point")
    return rows.mapInArrow(keyed, f"uid long, doc_id {rows.schema['doc_id'].dataType.simpleString()}, n long, key long")


def placed(rows: DataFrame) -> DataFrame:
    """`uid` and `place`, the tokens before the row along the curve; only counts of ranges meet."""
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lined = lined_up(rows, [], ["key", "doc_id", "uid"], ranges)
    before = Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offset = lined.groupBy("chunk").agg(F.sum("n").alias("n")).select("chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = F.sum("n").over(Window.partitionBy("chunk").orderBy("pos")) - F.col("n")
    # one row a range
    return lined.select("chunk", "uid", inside.alias("inside")).join(F.broadcast(offset), "chunk").select("uid", (F.col("inside") + F.col("offset")).alias("place"))


def last_sequences(total: int, size: int) -> list[int]:
    """Where sequences start after the last whole one, whose lengths are powers of two, and the end."""
    starts = [total - total % size]
    for length in (1 << k for k in reversed(range(size.bit_length()))):
        if total % size & length:
            starts.append(starts[-1] + length)
    return starts


def pack(docs: DataFrame, path: str, end: int = END, size: int = SIZE) -> DataFrame:
    """The pieces of all documents: `doc_id`, `start` and `length` in the document's tokens, `ids` (packed
    little-endian uint32), `doc_tokens`, `sequence_id` and `offset` in the sequence.

    Neighbours along the curve share sequences; every token lies in one piece. Order by `sequence_id` and
    `offset` to get the sequences.
    """
    coded = encoded(docs, path, end)
    total = coded.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    tail = last_sequences(total, size)
    rows = coded.join(placed(along_curve(coded)), "uid").select("doc_id", "n", "ids", "place")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, ROWS):
            out = []
            for row, (n, packed, place) in enumerate(zip(*(c.to_pylist() for c in batch.columns[1:]))):
                ids = packed if len(packed) == 4 * n else np.frombuffer(packed, "<u2").astype("<u4").tobytes()
                at = place
                while at < place + n:
                    late = at >= tail[0]
                    k = bisect.bisect_right(tail, at) - 1 if late else 0
                    first = tail[k] if late else at - at % size
                    stop = min(place + n, tail[k + 1] if late else first + size)
                    out.append((row, at - place, stop - at, ids[4 * (at - place) : 4 * (stop - place)], n, at // size + k, at - first))
                    at = stop
            columns = list(zip(*out))
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
            found = [batch.column(0).take(pa.array(columns[0])), *map(pa.array, columns[1:], kinds)]
            yield pa.RecordBatch.from_arrays(found, ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(pieces, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
