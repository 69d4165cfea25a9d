"""Forecast of monthly interrupted customer-hours per feeder, by model search."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtide.functions.numbers import exact
from gridtide.operators.search import against_goal, feature_columns, month_index, refit_predict, search
from gridtide.operators.series import chrono_split, future_rows
from gridtide.plans.panel import RUN, SERIES
from gridtide.schemas import WEATHER
from gridtide.session import cut


@dataclass(frozen=True)
class Forecast:
    panel: DataFrame
    rows: DataFrame
    scores: DataFrame
    errors: DataFrame
    tests: DataFrame


def with_index(panel: DataFrame) -> DataFrame:
    return panel.withColumn("t", month_index("month", "pred_month"))


def forecast(
    panel: DataFrame,
    goals: DataFrame,
    models: Sequence[str] | None = None,
    label: str = "chi_total",
    metrics: Mapping[str, Column] | None = None,
) -> Forecast:
    """One row per set, date, feeder and horizon.

    `goals`: (set, date, horizon, chi_goal). A feeder for which no candidate could be scored, or
    whose champion could not be trained again, has no rows and is listed in `errors`. `metrics` adds
    scores, aggregates over `y` and `pred`; `tests` holds these two for every candidate.
    """
    panel = cut(chrono_split(with_index(panel), SERIES, ["month"]), "panel")
    features = feature_columns(panel)
    best, scores, tests = search(panel, SERIES, label, models, metrics)
    best, panel = cut(best, "champions"), panel.drop("is_train")
    future = with_index(
        future_rows(panel, SERIES, F.col("months_ahead"), F.col("pred_month"), goals, RUN, WEATHER, label)
    )
    future = cut(future, "future")
    preds = cut(refit_predict(panel, future, best, SERIES, features, label, models), "preds")
    rows = preds.join(
        future.select(*SERIES, "month", "horizon", F.col("feeder_effect").alias("effect"), "chi_goal"),
        [*SERIES, "month"],
    )
    rows = rows.withColumn("goal_chi", F.col("chi_goal").cast("double") * F.col("effect"))
    rows = against_goal(rows).select(
        *SERIES, "horizon", "month", "model", "pred", "goal_chi", "delta_chi", "delta_chi_percent", "effect"
    )
    asked = panel.select(*SERIES).distinct()

    def missing(have: DataFrame, reason: str) -> DataFrame:
        return asked.join(have.select(*SERIES).distinct(), SERIES, "left_anti").select(
            *SERIES, F.lit("forecast").alias("stage"), F.lit(reason).alias("reason")
        )

    untrained = missing(preds, "champion gave no prediction").join(best.select(*SERIES), SERIES, "left_semi")
    return Forecast(panel, rows, scores, missing(best, "no candidate could be scored").unionByName(untrained), tests)


def set_totals(rows: DataFrame) -> DataFrame:
    """Forecast of the whole set per horizon."""
    return rows.groupBy(*RUN, "horizon").agg(F.sum(exact(F.col("pred"))).cast("double").alias("set_pred"))
