"""Row selection and column order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Keys = Sequence[str]


def first_per(df: DataFrame, keys: Keys, order: Sequence[Column | str]) -> DataFrame:
    """One row per key, the lowest by `order`. An aggregate, so a key with very many rows is
    reduced before the shuffle; `order` must tell any two rows of a key apart."""
    return _edge_per(df, keys, order, F.min_by)


def last_per(df: DataFrame, keys: Keys, order: Sequence[Column | str]) -> DataFrame:
    """One row per key, the highest by `order`."""
    return _edge_per(df, keys, order, F.max_by)


def _edge_per(df, keys, order, pick):
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*[F.col(o).alias(f"o{i}") if isinstance(o, str) else o.alias(f"o{i}") for i, o in enumerate(order)])
    kept = df.groupBy(*keys).agg(pick(F.struct(*rest), rank).alias("__row"))
    return kept.select(*keys, "__row.*").select(*df.columns)


def put_first(df: DataFrame, first: Sequence[str]) -> DataFrame:
    """Named columns first, all others after in their order."""
    return df.select(*first, *[c for c in df.columns if c not in first])


def columns_except(df: DataFrame, excluded: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in set(excluded)]


def complete_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which all the columns have a value."""
    return df.na.drop(how="any", subset=list(columns))


def cardinality_split(df: DataFrame, columns: Sequence[str], n: int = 11) -> DataFrame:
    """One row per column with its number of distinct values; `high` if that exceeds `n`."""
    if not columns:
        return df.sparkSession.createDataFrame([], "name string, n_distinct bigint, high boolean")
    # (column, value) pairs are reduced on the map side, so no column is collected in one place.
    pairs = df.select(
        F.explode(
            F.array(
                *[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in columns]
            )
        ).alias("p")
    ).select("p.*")
    return (
        pairs.distinct()
        .groupBy("name")
        .agg(F.count("value").alias("n_distinct"))
        .withColumn("high", F.col("n_distinct") > n)
    )
