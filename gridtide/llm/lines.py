"""Dropping lines that many documents share.

Every line becomes (hash of its key, document, position). These rows are range-partitioned by hash
and document and sorted by position, so a frequent line spreads over many partitions. One pass over
a partition counts first occurrences in a document and knows what to drop, except for the runs that
begin or end it: of these it returns a count each, and the few rows it could not decide. What leaves
the pass is positions, never text; they become one compressed keep bitmap per document.

Cases: a document is a row; rows with equal id and equal text are one document, counted once, and
all of them lose the same lines. A null or empty text is one empty line. Empty keys are never dropped.
Null ids are ids like others. Columns of the input whose names the result uses are replaced. An empty
table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from gridtide.llm.batches import slices
from gridtide.session import cut

BLANK = b" \t\n\x0b\x0c\r"
DROP, OPEN, COUNT = 0, 1, 2
FOUND = "kind byte, h1 long, h2 long, doc_tag long, pos int, n long"


def _tagged(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The text and a 64-bit tag that stands for the id and the text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.xxhash64(F.col(id_col).cast("string"), text).alias("doc_tag"), text.alias("text"))


def line_keys(text: str) -> list[bytes]:
    """Each line without white space at its ends, A-Z in lower case."""
    return [line.strip(BLANK) for line in text.encode().lower().split(b"\n")]


def _occurrences(min_chars: int):
    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in slices(batches):
            found, places, sizes = [], [], []
            for text in batch.column(1).to_pylist():
                keys = line_keys(text)
                if min_chars <= 1:
                    kept = [k for k, key in enumerate(keys) if key]
                else:
                    kept = [k for k, key in enumerate(keys) if len(key.decode()) >= min_chars]
                found.extend([digest(keys[k]) for k in kept])
                places.extend(kept)
                sizes.append(len(kept))
            pair = np.frombuffer(b"".join(found), "<i8").reshape(-1, 2)
            tags = np.repeat(batch.column(0).to_numpy(), sizes)
            columns = [pair[:, 0].copy(), pair[:, 1].copy(), tags, np.array(places, np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["h1", "h2", "doc_tag", "pos"])

    return hashes


def _stream(min_docs: int):
    def emit(kind: int, rows: np.ndarray) -> pa.RecordBatch:
        """Rows are (h1, h2, doc_tag, pos or count)."""
        n = len(rows)
        last = pa.array(rows[:, 3])
        none = pa.nulls(n, pa.int64())
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n, kind, np.int8)),
                none if kind == DROP else pa.array(rows[:, 0]),
                none if kind == DROP else pa.array(rows[:, 1]),
                none if kind == COUNT else pa.array(rows[:, 2]),
                pa.nulls(n, pa.int32()) if kind == COUNT else last.cast(pa.int32()),
                last if kind == COUNT else none,
            ],
            ["kind", "h1", "h2", "doc_tag", "pos", "n"],
        )

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None  # the last row of the run that goes on
        count, first, held = 0, True, []  # its documents so far, if it began the partition, its undecided rows
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.column_stack([batch.column(k).to_numpy() for k in range(4)]).astype(np.int64)
            previous = np.vstack([rows[:1] if before is None else before, rows[:-1]])
            new_run = (rows[:, 0] != previous[:, 0]) | (rows[:, 1] != previous[:, 1])
            new_doc = new_run | (rows[:, 2] != previous[:, 2])
            if before is None:
                new_doc[0] = True
            begins = np.flatnonzero(np.concatenate([[True], new_run[1:]]))
            ends = np.append(begins[1:], len(rows))
            docs = np.add.reduceat(new_doc.astype(np.int64), begins)
            if new_run[0]:  # the run before ended with its batch
                if first:
                    yield emit(COUNT, np.array([[*before[0, :3], count]]))
                    if held:
                        yield emit(OPEN, np.concatenate(held))
                count, first, held = 0, False, []
            docs[0] += count
            decided = np.repeat(docs >= min_docs, ends - begins)
            if decided[0] and held:
                yield emit(DROP, np.concatenate(held))
                held = []
            if decided.any():
                yield emit(DROP, rows[decided])
            if len(begins) > 1:
                if first:
                    yield emit(COUNT, np.array([[*rows[0, :3], docs[0]]]))
                    if docs[0] < min_docs:
                        yield emit(OPEN, np.concatenate([*held, rows[: ends[0]]]))
                first, held = False, []
            count = int(docs[-1])
            if count < min_docs:
                held.append(rows[begins[-1] :])
            before = rows[-1:]
        if before is not None:
            yield emit(COUNT, np.array([[*before[0, :3], count]]))
            if held:
                yield emit(OPEN, np.concatenate(held))

    return decide


@F.pandas_udf(BinaryType())
def _packed(places: pd.Series) -> pd.Series:
    def pack(dropped: np.ndarray) -> bytes:
        keep = np.ones(8 * (int(max(dropped)) // 8 + 1), np.uint8)
        keep[np.asarray(dropped)] = 0
        return zlib.compress(np.packbits(keep).tobytes(), 1)

    return places.map(pack)


def keep_bitmaps(docs: DataFrame, min_docs: int, min_chars: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_tag` and `keep` for each document that loses lines.

    `keep` is a compressed bitmap, a bit for each line from the first to the last dropped one; later
    lines stay. A line goes if its key has `min_chars` code points and `min_docs` documents have it.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lines = _tagged(docs, id_col, text_col).mapInArrow(_occurrences(min_chars), "h1 long, h2 long, doc_tag long, pos int")
    dealt = lines.repartitionByRange(parts, "h1", "h2", "doc_tag").sortWithinPartitions("h1", "h2", "doc_tag", "pos")
    found = cut(dealt.mapInArrow(_stream(min_docs), FOUND), "lines")
    # two counts a partition; runs that are longer than a partition are whole only here
    shared = found.where(F.col("kind") == COUNT).groupBy("h1", "h2").agg(F.sum("n").alias("total")).where(F.col("total") >= min_docs)
    late = found.where(F.col("kind") == OPEN).join(shared, ["h1", "h2"], "left_semi")
    dropped = found.where(F.col("kind") == DROP).select("doc_tag", "pos").unionByName(late.select("doc_tag", "pos"))
    return dropped.groupBy("doc_tag").agg(F.collect_list("pos").alias("places")).select("doc_tag", _packed("places").alias("keep"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with the kept lines as text, `n_lines` before and `n_dropped`; a null text becomes empty."""
    others = [c for c in docs.columns if c not in (text_col, "n_lines", "n_dropped", "doc_tag", "keep")]
    rows = docs.select(*others, F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias(text_col))
    rows = rows.withColumn("doc_tag", F.xxhash64(F.col(id_col).cast("string"), F.col(text_col)))
    joined = rows.join(bitmaps, "doc_tag", "left").select(*others, text_col, "keep")

    def keep_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts, totals, gone = [], [], []
            kept = batch.column(batch.num_columns - 1).to_pylist()
            for text, keep in zip(batch.column(batch.num_columns - 2).to_pylist(), kept):
                if keep is None:
                    texts.append(text)
                    totals.append(text.count("\n") + 1)
                    gone.append(0)
                    continue
                lines = text.split("\n")
                bits = np.ones(len(lines), bool)
                known = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8))[: len(lines)]
                bits[: len(known)] = known
                texts.append("\n".join([line for line, bit in zip(lines, bits.tolist()) if bit]))
                totals.append(len(lines))
                gone.append(len(lines) - int(bits.sum()))
            columns = [*batch.columns[: batch.num_columns - 2], pa.array(texts, pa.string()), pa.array(totals, pa.int64()), pa.array(gone, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*others, text_col, "n_lines", "n_dropped"])

    schema = joined.drop("keep").schema.add("n_lines", "long").add("n_dropped", "long")
    return joined.mapInArrow(keep_lines, schema)


def drop_shared_lines(docs: DataFrame, min_docs: int, min_chars: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` without the lines that `min_docs` documents share."""
    return apply_bitmaps(docs, keep_bitmaps(docs, min_docs, min_chars, id_col, text_col), id_col, text_col)
