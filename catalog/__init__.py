"""Operators and jobs run on the test tables, each with the SQL that gives the same answer."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from catalog.bindings import BASE_TABLES, BINDINGS, with_bindings


class Data:
    """The test tables of one folder, and the domain tables derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            if name in BASE_TABLES:
                self._made[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
            else:
                parts, body = BINDINGS[name]
                for part in parts:
                    self[part].createOrReplaceTempView(part)
                self._made[name] = self.spark.sql(body("`"))
        return self._made[name]

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"


@dataclass(frozen=True)
class Check:
    run: Callable[[Data], DataFrame]
    sql: str | None


CHECKS: dict[str, Check] = {}


def check(name: str, sql: str | None = None, uses: tuple[str, ...] = ()):
    """Registers a query. `uses` names the domain tables that `sql` reads."""

    def register(run: Callable[[Data], DataFrame]):
        CHECKS[name] = Check(run, None if sql is None else with_bindings(uses, sql))
        return run

    return register


def load() -> dict[str, Check]:
    from catalog import aggregates, allocation, jobs, modelling, relational, scalars, sources, spatial  # noqa: F401

    return CHECKS
