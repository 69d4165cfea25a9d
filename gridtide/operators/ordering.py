"""Order within groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridtide.session import cut


def lined_up(items: DataFrame, groups: Sequence[str], order: Sequence[str], ranges: int) -> DataFrame:
    """Items with `pos`, which grows with (groups, order), and the `chunk` they lie in.

    Ranges over (groups, order) split a group of any size; the written table fixes them for good.
    """
    return cut(
        items.repartitionByRange(ranges, *groups, *order)
        .sortWithinPartitions(*groups, *order)
        .withColumn("pos", F.monotonically_increasing_id())
        .withColumn("chunk", F.spark_partition_id()),
        "lined",
    )


def places(
    items: DataFrame, groups: Sequence[str], order: Sequence[str], ranges: int | None = None, name: str = "place"
) -> DataFrame:
    """Number of each row within its group, from 1 on, without gathering a group in one task: a row
    number within its range, plus the sizes of the group's earlier ranges."""
    ranges = ranges or int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lined = lined_up(items, groups, order, ranges)
    spot = [*groups, "chunk"]
    before = Window.partitionBy(*groups).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sizes = lined.groupBy(*spot).agg(F.count("*").alias("n"))
    offset = sizes.select(*spot, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy(*spot).orderBy("pos"))
    return lined.join(offset, spot).select(*items.columns, (F.col("offset") + inside).alias(name))
