"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(name: str = "gridtide", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return ship_package(builder.getOrCreate())


def ship_package(spark: SparkSession) -> SparkSession:
    """Sends this package to the executors, whose Python steps import it; once for a session."""
    if not any(f.rpartition("/")[2].startswith("gridtide-") for f in spark.sparkContext.listFiles):
        package = Path(__file__).resolve().parent
        with tempfile.NamedTemporaryFile(prefix="gridtide-", suffix=".zip", delete=False) as file:
            with zipfile.ZipFile(file, "w", zipfile.ZIP_DEFLATED) as archive:
                for source in sorted(package.rglob("*.py")):
                    archive.write(source, source.relative_to(package.parent))
        spark.sparkContext.addPyFile(file.name)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can read: `spark.checkpoint.dir` of the session.

    Only a local session may fall back to a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="gridtide-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def spread(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows partitioned by key over all shuffle partitions.

    For work that is heavy per row: adaptive execution would otherwise merge the few bytes of such
    a table into one task. A `groupBy` on the same keys does not shuffle again.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame, label: str = "step") -> DataFrame:
    """Write `df` to the shared folder and return the written table.

    Used where a value must not change on recomputation (row positions) or where a loop would
    otherwise grow the plan. The result survives the loss of any executor.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
