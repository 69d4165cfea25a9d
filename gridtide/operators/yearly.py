"""Yearly profiles: mean, single years, highest year."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtide.functions.numbers import exact, half_even

# Maintenance group in the data and the service it belongs to.
MAINTENANCE_SERVICES = {"PODA": "poda", "FAIXA": "faixa", "ESTRUTURA": "estruturas"}


def years_back(when: Column, asof: Column) -> Column:
    """0 for the calendar year of `asof`, 1 for the year before, ..."""
    return F.year(asof) - F.year(when)


def yearly_units(
    work: DataFrame,
    keys: Sequence[str],
    back: Column,
    service: Column,
    amounts: Sequence[str] = ("us_pontos", "vlr_us_servico"),
    years: int = 3,
) -> DataFrame:
    """(keys, service, back, value): summed amounts per service and year, missing amounts as 0."""
    value = sum((exact(F.coalesce(F.col(a).cast("double"), F.lit(0.0))) for a in amounts), F.lit(0))
    return (
        work.select(*keys, service.alias("service"), back.alias("back"), value.alias("v"))
        .where(F.col("back").between(0, years) & F.col("service").isNotNull())
        .groupBy(*keys, "service", "back")
        .agg(F.sum("v").alias("value"))
    )


def yearly_profile(
    yearly: DataFrame,
    keys: Sequence[str],
    asof_year: Column,
    services: Sequence[str],
    suffix: str,
    offsets: Sequence[int] = (3, 2, 1, 0),
    digits: int | None = 2,
) -> DataFrame:
    """One row per key with, for each service, `_avg`, `_max`, `_max_year`, `_year-k`, `_cur_year`.

    The mean covers the three years before the current one, the maximum covers `offsets`; the
    earliest year wins a tie. A year without rows counts as 0. One aggregate builds all years of
    all services; the rest is arithmetic on that one row.
    """
    cells = [
        F.coalesce(
            F.sum(F.when((F.col("service") == s) & (F.col("back") == k), F.col("value"))), F.lit(0)
        ).alias(f"{s}__{k}")
        for s in services
        for k in offsets
    ]
    wide = yearly.groupBy(*keys).agg(*cells)

    def shown(c: Column) -> Column:
        return c.cast("bigint") if digits is None else half_even(c, digits).cast("double")

    out: list[Column] = [F.col(k) for k in keys]
    for s in services:
        at = {k: F.col(f"{s}__{k}") for k in offsets}
        mean = (at[3] + at[2] + at[1]) / F.lit(3)
        best = F.array_max(F.array(*[F.struct(at[k].alias("v"), F.lit(k).alias("k")) for k in offsets]))
        out.append(half_even(mean, 2).cast("double").alias(f"{s}_avg_{suffix}"))
        out.append(shown(best["v"]).alias(f"{s}_max_{suffix}"))
        out.append((asof_year - best["k"]).cast("int").alias(f"{s}_max_year_{suffix}"))
        for k in offsets:
            name = f"{s}_cur_year_{suffix}" if k == 0 else f"{s}_year-{k}_{suffix}"
            out.append(shown(at[k]).alias(name))
    return wide.select(*out)
