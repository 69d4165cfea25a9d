"""Table bindings: a name stands for a database table, files or a DataFrame.

The same reading call works for each of them, so that projection and predicate reach the scan
wherever the data lives.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtide.sources import files

Binding = Callable[[SparkSession], DataFrame]

# Keys that are named in conditions for a database, and how many in one of them.
LISTED_KEYS, BATCH = 20_000, 500


def parquet(path: str) -> Binding:
    return lambda spark: spark.read.parquet(path)


def csv(path: str | list[str], schema: T.StructType | None = None, encoding: str = "UTF-8") -> Binding:
    return lambda spark: files.read_csv(spark, path, schema, encoding)


def csv_by_state(root: str, schema: T.StructType, **options) -> Binding:
    return lambda spark: files.read_states(spark, root, schema, **options)


def frame(df: DataFrame) -> Binding:
    return lambda spark: df


class Jdbc:
    """A database table. `split=(column, low, high)` reads it in parallel ranges; `keyed` reads some keys."""

    def __init__(self, url: str, table: str, split: tuple[str, int | str, int | str] | None, partitions: int, options: dict[str, str]):
        self.url, self.table, self.split, self.partitions, self.options = url, table, split, partitions, options

    def __call__(self, spark: SparkSession) -> DataFrame:
        reader = spark.read.format("jdbc").options(url=self.url, dbtable=self.table, **self.options)
        if self.split is not None:
            column, low, high = self.split
            reader = reader.options(partitionColumn=column, lowerBound=low, upperBound=high, numPartitions=self.partitions)
        return reader.load()

    def keyed(self, spark: SparkSession, column: str, wanted: DataFrame) -> DataFrame:
        """Rows of the wanted keys, and perhaps others; the database looks them up, each predicate in a task."""
        predicates = key_predicates(column, wanted, self.partitions)
        if predicates is None:
            return self(spark)
        return spark.read.jdbc(self.url, self.table, predicates=predicates or ["1 = 0"], properties=self.options)


def jdbc(
    url: str,
    table: str,
    split: tuple[str, int | str, int | str] | None = None,
    partitions: int = 64,
    **options: str,
) -> Binding:
    """A database table. `split=(column, low, high)` reads it in parallel ranges."""
    return Jdbc(url, table, split, partitions, options)


def key_predicates(column: str, wanted: DataFrame, ranges: int = 64, listed: int = LISTED_KEYS, batch: int = BATCH) -> list[str] | None:
    """SQL conditions that hold, one or the other, for every wanted key; None if there is no good way.

    Up to `listed` keys are listed, `batch` in a condition. More keys, if they are numbers or dates, become
    ranges from their sorted partitions, which leave out the gaps between; text has an order of its own in
    each database, so many text keys give None.
    """
    kind = wanted.schema[0].dataType
    keys = wanted.toDF("key").where("key is not null").distinct()
    some = [_sql_literal(r.key) for r in keys.limit(listed + 1).collect()]
    name = '"' + column.replace('"', '""') + '"'
    if None in some:
        return None
    if len(some) <= listed:
        some.sort()
        return [f"{name} IN ({', '.join(some[k : k + batch])})" for k in range(0, len(some), batch)]
    if not isinstance(kind, (T.IntegralType, T.DecimalType, T.DateType)):
        return None
    parts = keys.repartitionByRange(ranges, "key").groupBy(F.spark_partition_id()).agg(F.min("key").alias("low"), F.max("key").alias("high"))
    # a row for each range
    return [f"{name} BETWEEN {_sql_literal(r.low)} AND {_sql_literal(r.high)}" for r in parts.orderBy("low").collect()]


def _sql_literal(value) -> str | None:
    if isinstance(value, bool) or not isinstance(value, (int, Decimal, str, datetime.date)):
        return None
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    if isinstance(value, datetime.datetime):
        return None
    return f"DATE '{value.isoformat()}'" if isinstance(value, datetime.date) else str(value)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN means "missing" in the data; Spark aggregates only pass over NULL."""
    fractions = (T.DoubleType, T.FloatType)
    cols = [
        F.when(~F.isnan(F.col(f"`{f.name}`")), F.col(f"`{f.name}`")).alias(f.name)
        if isinstance(f.dataType, fractions)
        else F.col(f"`{f.name}`")
        for f in df.schema
    ]
    return df.select(*cols)


class Tables:
    """Named tables of one session."""

    def __init__(self, spark: SparkSession, bindings: Mapping[str, Binding | DataFrame]):
        self.spark = spark
        self._bindings = {
            name: frame(b) if isinstance(b, DataFrame) else b for name, b in bindings.items()
        }

    def __contains__(self, name: str) -> bool:
        return name in self._bindings

    def read(
        self,
        name: str,
        columns: Sequence[str] | None = None,
        where: Column | str | None = None,
        keys: tuple[str, DataFrame] | None = None,
    ) -> DataFrame:
        """Chosen columns of the rows that meet `where` and whose key is among `keys`.

        `keys` is (column, one-column DataFrame). It becomes a semi join, so the list of keys has no
        length limit; a database also gets conditions that find them, see `key_predicates`.
        """
        if name not in self._bindings:
            raise KeyError(f"no table is bound to {name!r}; bound: {sorted(self._bindings)}")
        binding = self._bindings[name]
        df = binding.keyed(self.spark, *keys) if keys is not None and hasattr(binding, "keyed") else binding(self.spark)
        if where is not None:
            df = df.where(where)
        if keys is not None:
            column, wanted = keys
            wanted = wanted.toDF("__key").distinct()
            df = df.join(wanted, df[column] == wanted["__key"], "left_semi")
        if columns is not None:
            df = df.select(*[F.col(f"`{c}`") for c in columns])
        return nan_to_null(df)
