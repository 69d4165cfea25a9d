"""Suggested maintenance volumes from the gap between forecast and goal."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtide.functions.dates import month_label
from gridtide.functions.numbers import exact, half_even
from gridtide.operators.attribution import SERVICES

YEAR = 12


def horizon_totals(preds: DataFrame, keys: Sequence[str], pred: str = "pred") -> DataFrame:
    """Sum of the predictions over the horizon."""
    return preds.groupBy(*keys).agg(F.sum(exact(F.col(pred))).cast("double").alias("pred_total"))


def recent_actuals(
    panel: DataFrame, keys: Sequence[str], ahead: Column, label: str = "chi_total", asof: str = "pred_month"
) -> DataFrame:
    """Sum of the label over the `12 - ahead` months before `asof`; 0 without such months."""
    start = F.add_months(asof, ahead - YEAR)
    recent = (F.col("month") >= start) & (F.col("month") < F.col(asof))
    return panel.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(recent, exact(F.col(label)))), F.lit(0)).cast("double").alias("actual_total")
    )


def rolling_year(totals: DataFrame) -> DataFrame:
    """`chi_pred`, `chi_goal`, `chi_diff` of a year made of actual and predicted months.

    Needs `pred_total`, `actual_total`, `goal_total` (of the set) and `effect`.
    """
    chi_pred = F.col("actual_total") + F.col("pred_total")
    chi_goal = F.col("goal_total").cast("double") * F.col("effect")
    return totals.withColumns({"chi_pred": chi_pred, "chi_goal": chi_goal, "chi_diff": chi_pred - chi_goal})


def volume(service: str) -> Column:
    """Units of a service that close the gap, if outages went on as attributed; whole number."""
    part = F.try_divide(F.col(f"cnt_{service}").cast("double"), F.col("cnt_total").cast("double"))
    needed = F.try_divide(F.col("chi_diff") * part, F.col(f"avg_{service}"))
    usable = (F.col("chi_diff") > 0) & (F.col("cnt_total") > 0) & (F.col(f"avg_{service}") != 0)
    return F.when(usable, needed.cast("bigint")).otherwise(F.lit(0).cast("bigint"))


def scaled(c: Column, coefficient: float) -> Column:
    """Times the coefficient, rounded half to even."""
    return half_even(c * F.lit(float(coefficient)), 0).cast("bigint")


def suggest_volumes(gap: DataFrame, coefs: Mapping[str, float]) -> DataFrame:
    """Adds `<service>_sugg`, and rounds the three amounts to two digits."""
    with_volumes = gap.withColumns({f"{s}_sugg": scaled(volume(s), coefs[s]) for s in SERVICES})
    return with_volumes.withColumns({c: half_even(F.col(c), 2) for c in ("chi_pred", "chi_goal", "chi_diff")})


def period_columns(df: DataFrame, asof: str = "pred_month", ahead: str = "months_ahead") -> DataFrame:
    """`from` and `to` labels of the suggestion period."""
    return df.withColumns(
        {"from": month_label(F.col(asof)), "to": month_label(F.add_months(asof, F.col(ahead) - 1))}
    )
