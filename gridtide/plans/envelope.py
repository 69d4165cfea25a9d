"""JSON envelopes of the results."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtide.functions.text import number_text
from gridtide.operators.attribution import SERVICES

# Names and name spaces of the envelopes.
TASK_NOUN = "PREDICTIVE_ALGORITHM_RESULT"
SUGGESTION_NOUN = "SERVICE_SUGGESTIONS_INSERT"
VERB = "CHANGE"
XSI = "http://www.w3.org/2001/XMLSchema-instance"
XSD = "http://www.w3.org/2001/XMLSchema"

# Cells of a task, by position; the time stamp follows as the last cell.
TASK_CELLS = [
    "idservico",
    "idnsmanut",
    "status servico",
    "dispositivo",
    "se",
    "alimentador",
    "descricao",
    "quantidade",
    "us servico",
    "prioridade",
    "data cadastro",
    "hora do cadastro",
    "causa",
    "descricao da causa",
    "causa ciga",
]
# Cells of a suggestion, by position, after the time stamp; the second list repeats
# for each service.
SUGGESTION_HEAD = ["cod_alim", "conjunto", "from", "to", "chi_pred", "chi_goal", "chi_diff"]
SUGGESTION_SERVICE = [
    "sugg",
    "avg_us",
    "max_us",
    "max_year_us",
    "cur_year_us",
    "year-1_us",
    "year-2_us",
    "year-3_us",
    "avg_interup",
    "max_interup",
    "max_year_interup",
    "year-1_interup",
    "year-2_interup",
    "year-3_interup",
]
# Which of them are written as text with a decimal comma.
COMMA_HEAD = {"chi_pred", "chi_goal", "chi_diff"}
COMMA_SERVICE = {"avg_us", "max_us", "cur_year_us", "year-1_us", "year-2_us", "year-3_us", "avg_interup"}

SUGGESTION_CELLS = SUGGESTION_HEAD + [f"{s}_{c}" for s in SERVICES for c in SUGGESTION_SERVICE]
COMMA_CELLS = COMMA_HEAD | {f"{s}_{c}" for s in SERVICES for c in COMMA_SERVICE}


def to_envelope(df: DataFrame, noun: str, cells: Sequence[Column]) -> DataFrame:
    """One JSON text per row, `value`: the noun and the cells by position, each in its own type."""
    data = F.array(
        *[
            F.struct(F.lit(i).alias("@index"), c.cast("variant").alias("@value"))
            for i, c in enumerate(cells)
        ]
    )
    row = F.struct(F.lit(noun).alias("@noun"), data.alias("CellsData"))
    return df.select(F.to_json(row, {"ignoreNullFields": "false"}).alias("value"))


def task_envelope(tasks: DataFrame, stamp: Column | None = None) -> DataFrame:
    return to_envelope(tasks, TASK_NOUN, [*[F.col(f"`{c}`") for c in TASK_CELLS], _stamp(stamp)])


def suggestion_envelope(suggestions: DataFrame, stamp: Column | None = None) -> DataFrame:
    cells = [
        number_text(F.col(f"`{c}`"), 2) if c in COMMA_CELLS else F.col(f"`{c}`") for c in SUGGESTION_CELLS
    ]
    return to_envelope(suggestions, SUGGESTION_NOUN, [_stamp(stamp), *cells])


def _stamp(stamp: Column | None) -> Column:
    return F.date_format(F.current_timestamp() if stamp is None else stamp, "yyyy-MM-dd HH:mm:ss")


def frame_of(noun: str) -> tuple[str, str]:
    """The document around the rows: what comes before them and what after."""
    mark = "@rows@"
    document = {
        "Header": {"Noun": noun, "Verb": VERB},
        "payload": {
            "items": [{"Data": {"@xmlns:xsi": XSI, "@xmlns:xsd": XSD, "RowData": [mark]}}],
            "format": None,
        },
    }
    before, after = json.dumps(document).split(json.dumps(mark))
    return before, after


def documents(rows: DataFrame, noun: str, files: int | None = None) -> DataFrame:
    """Lines of text that make each partition one complete JSON document; `files` partitions at most.

    Each partition gets a last row, which sorts behind the others. Rows stream through, so a document may be
    larger than memory. Partitions without rows give no lines.
    """
    before, after = frame_of(noun)
    spark = rows.sparkSession
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    body = rows.select("value", F.pmod(F.xxhash64("value"), F.lit(files)).cast("int").alias("file"), F.lit(False).alias("ends"))
    last = spark.range(files).select(F.lit(after).alias("value"), F.col("id").cast("int").alias("file"), F.lit(True).alias("ends"))
    spread = body.unionByName(last).repartitionById(files, "file").sortWithinPartitions("ends")
    # the lower 33 bits of this number are the place in the partition
    numbered = spread.withColumn("first", F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1)) == 0)
    start = F.when(F.col("ends"), F.lit("")).when(F.col("first"), F.lit(before + "\n")).otherwise(F.lit(","))
    return numbered.where(~(F.col("first") & F.col("ends"))).select(F.concat(start, "value").alias("value"))


def write_documents(rows: DataFrame, noun: str, path: str, files: int | None = None) -> None:
    """One document per file; `files` sets how many at most."""
    documents(rows, noun, files).write.mode("append").text(path)
