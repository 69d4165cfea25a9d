"""A folder of request files, served batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridtide.plans import envelope
from gridtide.plans.requests import Results, format_tasks, run_requests
from gridtide.sources.tables import Tables


def write_results(results: Results, outbox: str, batch: int) -> None:
    """Envelopes, and what could not be served. A batch that is run again writes the same folder."""
    spot = f"{outbox.rstrip('/')}/batch={batch}"
    parts = {
        "suggestions": envelope.documents(
            envelope.suggestion_envelope(results.suggestions), envelope.SUGGESTION_NOUN
        ),
        "tasks": envelope.documents(envelope.task_envelope(format_tasks(results.tasks)), envelope.TASK_NOUN),
    }
    for name, lines in parts.items():
        lines.write.mode("overwrite").text(f"{spot}/{name}")
    for name in ("ignored", "rejects", "errors"):
        getattr(results, name).write.mode("overwrite").json(f"{spot}/{name}")


def serve(
    spark: SparkSession,
    tables: Callable[[], Tables],
    inbox: str,
    outbox: str,
    checkpoint: str,
    once: bool = False,
    **options,
) -> StreamingQuery:
    """Runs every request file that appears in `inbox` (one JSON document per file).

    `tables` is called per batch, so that each batch reads the tables as they are then.
    """

    def run(payloads: DataFrame, batch: int) -> None:
        write_results(run_requests(tables(), payloads, id_col="file", **options), outbox, batch)

    # a file is a document; its path tells equal ones apart
    stream = spark.readStream.text(inbox, wholetext=True).select("value", F.col("_metadata.file_path").alias("file"))
    writer = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
