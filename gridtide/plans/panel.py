"""The feeder x month panel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtide.functions.dates import month_of, season_weight
from gridtide.functions.numbers import share
from gridtide.operators.rows import complete_rows, put_first
from gridtide.schemas import WEATHER
from gridtide.session import cut

# The columns that come first in a panel.
LEADING = ["cod_alim", "ano", "mes", "cons_conjunto", "dec_cj", "chi_total", *WEATHER]

SERIES = ["conjunto", "pred_month", "cod_alim"]
RUN = ["conjunto", "pred_month"]


def runs_of(requests: DataFrame) -> DataFrame:
    """One row per set and date, with the longest horizon asked for."""
    return requests.groupBy(*RUN).agg(F.max("months_ahead").cast("int").alias("months_ahead"))


def feeders_of(runs: DataFrame, feeder_set: DataFrame) -> DataFrame:
    """Runs with one row per feeder of the set."""
    members = feeder_set.select(
        F.col("sigla_conjunto").alias("conjunto"), F.col("alimentador").alias("cod_alim")
    ).distinct()
    return runs.join(members, "conjunto")


def clean_raw(raw: DataFrame) -> DataFrame:
    """Rows with a month and a rural customer count; no tree count means 0."""
    known = complete_rows(raw, ["mes", "qtde_cliente_ru"])
    if "vlr_qtd_arvore" in raw.columns:
        known = known.na.fill({"vlr_qtd_arvore": 0})
    return known.withColumns({"ano": F.col("ano").cast("int"), "mes": F.col("mes").cast("int")})


def one_row_per_month(rows: DataFrame, keys=("cod_alim", "ano", "mes"), label: str = "chi_total") -> DataFrame:
    """Merges rows of the same feeder and month, so that a series is never longer than its months:
    the label is added up, other numbers are averaged. Rows that are alone stay as they are."""

    def merged(f: T.StructField) -> Column:
        if f.name == label:
            return F.sum(label)
        return F.avg(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.max(f.name)

    rest = [f for f in rows.schema if f.name not in keys]
    return rows.groupBy(*keys).agg(*[merged(f).alias(f.name) for f in rest]).select(*rows.columns)


def attach_set(df: DataFrame, feeder_set: DataFrame, key: str = "cod_alim") -> DataFrame:
    """Adds the set of each feeder, as `conjunto`."""
    members = feeder_set.select(F.col("sigla_conjunto").alias("conjunto"), F.col("alimentador").alias(key))
    return df.join(members, key)


def attach_weather(panel: DataFrame, weather: DataFrame, keys=("cod_alim", "month")) -> DataFrame:
    """Rows that have weather, with the leading columns first."""
    joined = panel.join(weather, list(keys), "inner")
    return put_first(joined, [c for c in LEADING if c in joined.columns])


def base_panel(raw: DataFrame, feeder_set: DataFrame, runs: DataFrame) -> DataFrame:
    """Panel rows before each run's date, keyed by set, date and feeder, without weather."""
    feeders = feeders_of(runs, feeder_set)
    last = runs.agg(F.max(F.year("pred_month"))).first()[0]
    known = clean_raw(raw)
    if last is not None:
        known = known.where(F.col("ano") <= last)
    known = known.join(feeders.select("cod_alim").distinct(), "cod_alim", "left_semi")
    rows = one_row_per_month(known).withColumn("month", month_of(F.col("ano"), F.col("mes")))
    return rows.join(feeders, "cod_alim").where(F.col("month") < F.col("pred_month"))


def derive(panel: DataFrame) -> DataFrame:
    return panel.withColumns(
        {
            "DESCR_NOVO": F.col("conjunto"),
            "feeder_effect": share(F.col("qtde_cliente_total"), F.col("cons_conjunto")),
            "month_weighted": season_weight(F.col("mes")),
        }
    )


def first_months(panel: DataFrame) -> DataFrame:
    """Earliest month of each run's history."""
    return panel.groupBy(*RUN).agg(F.min("month").alias("first_month"))


def build_panel(
    raw: DataFrame, feeder_set: DataFrame, runs: DataFrame, weather: DataFrame | None = None
) -> DataFrame:
    """`weather`: (set, date, feeder, month, variables), or None for a panel without weather."""
    panel = base_panel(raw, feeder_set, runs)
    if weather is not None:
        panel = attach_weather(panel, weather, [*SERIES, "month"])
    return derive(panel)


def panel_with_weather(
    raw: DataFrame,
    feeder_set: DataFrame,
    runs: DataFrame,
    points: DataFrame,
    stations: DataFrame,
    history: DataFrame,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """The panel with interpolated weather, and the errors of the interpolation."""
    from gridtide.plans.weather import weather_of_runs

    base = cut(base_panel(raw, feeder_set, runs), "base")
    spans = base.select(*SERIES).distinct().join(first_months(base), RUN)
    weather, errors = weather_of_runs(points, stations, history, spans, **options)
    return derive(attach_weather(base, weather, [*SERIES, "month"])), errors
