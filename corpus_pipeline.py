"""The corpus pipeline: toxic documents out, shared lines out, one document of each group of near
duplicates, contaminated documents out, and the rest as tokens.

Each stage takes the documents its predecessor kept and returns the columns of `documents`; the last one
returns tokens. Between stages the documents are written to the shared folder. A stage's cases are those of
the operator it calls. A document is a row; rows with equal id and text are one document from the
near-duplicate stage on.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtide.llm import toxicity
from gridtide.llm.bpe import bpe_encode
from gridtide.llm.decontaminate import contamination
from gridtide.llm.lines import drop_shared_lines
from gridtide.llm.simhash import first_of_groups
from gridtide.session import cut

TOXIC = 0.7


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _shielded(docs: DataFrame, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """`work` on the documents with their further columns under names that no operator uses."""
    names = {c: f"column_{k}_" for k, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    return work(docs.withColumnsRenamed(names)).select([F.col(names.get(c, c)).alias(c) for c in docs.columns])


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold; learns from the labelled ones among them."""
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"), toxicity.may_learn())
    return _shielded(docs, lambda rows: toxicity.score_toxicity(rows, model).where(F.col("score") < TOXIC))


def without_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten or more share; `n_chars` follows the text."""
    kept = _shielded(docs, lambda rows: drop_shared_lines(rows, min_docs=10, min_chars=1))
    return kept.withColumn("n_chars", F.char_length("text").cast("long"))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group."""
    return first_of_groups(docs, shingle=4, distance=4)


def without_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    benchmark = _table(spark, sf_dir, "benchmark")
    return _shielded(docs, lambda rows: contamination(rows, benchmark, window=10).where(~F.col("contaminated")))


def as_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """`doc_id`, `n_tokens`, `ids` (packed little-endian uint32) and digests of the ids and the decoded text."""
    coded = bpe_encode(docs, public_tokenizers.path("byte_bpe_50k.json"), decoded=True)
    return coded.select(
        "doc_id",
        F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("line_dedup", without_shared_lines),
    ("simhash_dedup", without_near_duplicates),
    ("decontamination", without_contaminated),
    ("bpe", as_tokens),
]

ORACLE_SQL = None  # SQL has neither the classifier nor XXH64; the tests compare with a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name)
    return docs
