"""File scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# States whose stations are read when files are stored per state.
STATES = ("BA", "RJ", "SP", "MS", "GO", "DF", "MG")
STATE_FILE = "{state}/All_Stations_{state}.csv"

LATIN = "ISO-8859-1"


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    encoding: str = "UTF-8",
) -> DataFrame:
    """CSV with a header row. Without a schema every column is text (no inference pass)."""
    reader = spark.read.option("header", True).option("encoding", encoding)
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", False)
    return reader.csv(path)


def read_states(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    states: tuple[str, ...] | list[str] = STATES,
    pattern: str = STATE_FILE,
    state_col: str = "state",
) -> DataFrame:
    """One CSV per state, all in one scan; the state is taken from the path.

    States without a file are passed over.
    """
    names = "{" + ",".join(states) + "}"
    df = (
        spark.read.schema(schema)
        .option("header", True)
        .csv(f"{root.rstrip('/')}/{pattern.replace('{state}', names)}")
    )
    before, after = pattern.split("{state}")[:2]
    spot = _literal(before) + "([^/]+)" + _literal(after.split("*")[0])
    return df.select("*", F.regexp_extract(F.col("_metadata.file_path"), spot, 1).alias(state_col))


def _literal(text: str) -> str:
    return "".join(f"\\{ch}" if ch in ".*+?()[]^$|" else ch for ch in text)
