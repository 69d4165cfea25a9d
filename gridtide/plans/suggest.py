"""Suggested maintenance volumes per feeder, with yearly statistics."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtide.functions.dates import within
from gridtide.functions.text import plain_columns
from gridtide.operators.attribution import SERVICES, attribute, service_columns, with_cause
from gridtide.operators.goals import goal_totals
from gridtide.operators.suggestions import (
    YEAR,
    horizon_totals,
    period_columns,
    recent_actuals,
    rolling_year,
    suggest_volumes,
)
from gridtide.operators.yearly import MAINTENANCE_SERVICES, years_back, yearly_profile, yearly_units
from gridtide.session import cut

FEEDER = ["pred_month", "cod_alim"]
TRAILING = "trailing"


def _span(feeders: DataFrame) -> tuple:
    """First and last date of the requests: one row, used as literals in the scans."""
    return tuple(feeders.agg(F.min("pred_month"), F.max("pred_month")).first())


def _reach(when: Column, feeders: DataFrame, end_of_year: bool) -> Column:
    """From three calendar years before the first date to the last date (or the end of its year)."""
    low, high = _span(feeders)
    if low is None:
        return F.lit(False)
    end = F.lit(high)
    if end_of_year:
        end = F.make_date(F.year(end) + 1, F.lit(1), F.lit(1))
    return within(when, F.make_date(F.year(F.lit(low)) - 3, F.lit(1), F.lit(1)).cast("timestamp_ntz"), end.cast("timestamp_ntz"))


def outage_periods(when: Column, asof: Column) -> Column:
    """The periods an outage counts in: the 12 months before `asof`, and a year before its year."""
    trailing = within(when, F.add_months(asof, -YEAR), asof)
    back = years_back(when, asof)
    year = F.when(back.between(1, 3), back.cast("string"))
    both = F.array(F.lit(TRAILING), year)
    return F.when(trailing, F.when(year.isNull(), F.array(F.lit(TRAILING))).otherwise(both)).when(
        year.isNotNull(), F.array(year)
    )


def attributed_outages(outages: DataFrame, causes: DataFrame, feeders: DataFrame) -> DataFrame:
    """(date, feeder, period, service, cnt, chi) in one pass over the outages."""
    events = plain_columns(outages)
    events = events.where(_reach(F.col("dat_inicio"), feeders, end_of_year=False)).join(feeders, "cod_alim")
    events = with_cause(events, causes)
    return attribute(events, FEEDER, periods=outage_periods(F.col("dat_inicio"), F.col("pred_month")))


def outage_profile(attributed: DataFrame, feeders: DataFrame) -> DataFrame:
    """Yearly counts of attributed outages as columns."""
    yearly = attributed.where(F.col("period") != TRAILING).select(
        *FEEDER, "service", F.col("period").cast("int").alias("back"), F.col("cnt").alias("value")
    )
    return yearly_profile(
        feeders.join(yearly, FEEDER, "left"), FEEDER, F.year("pred_month"), SERVICES, "interup", (3, 2, 1), None
    )


def maintenance_profile(maintenance: DataFrame, feeders: DataFrame) -> DataFrame:
    """Yearly service units as columns."""
    work = maintenance.where(_reach(F.col("dat_execucao"), feeders, end_of_year=True)).join(feeders, "cod_alim")
    names = F.create_map(*[F.lit(x) for pair in MAINTENANCE_SERVICES.items() for x in pair])
    yearly = yearly_units(
        work,
        FEEDER,
        years_back(F.col("dat_execucao"), F.col("pred_month")),
        F.try_element_at(names, F.col("grupo_dataset_servico")),
    )
    return yearly_profile(feeders.join(yearly, FEEDER, "left"), FEEDER, F.year("pred_month"), SERVICES, "us")


def suggest(
    requests: DataFrame,
    panel: DataFrame,
    forecast_rows: DataFrame,
    goals: DataFrame,
    outages: DataFrame,
    causes: DataFrame,
    maintenance: DataFrame,
    coefs: Mapping[str, float],
) -> DataFrame:
    """One row per request and feeder.

    `requests`: (request_id, conjunto, pred_month, months_ahead); `goals`: the goal window of each
    request; `coefs`: a factor per service. Outages and maintenance are read once for all requests.
    """
    series = ["request_id", "conjunto", "pred_month", "months_ahead", "cod_alim"]
    mine = requests.join(forecast_rows, ["conjunto", "pred_month"]).where(F.col("horizon") <= F.col("months_ahead"))
    ahead = cut(
        horizon_totals(mine, series).join(
            mine.groupBy(*series).agg(F.max_by("effect", "horizon").alias("effect")), series
        ),
        "ahead",
    )
    actual = recent_actuals(
        panel.drop("months_ahead").join(requests, ["conjunto", "pred_month"]), series, F.col("months_ahead")
    )
    goal = goal_totals(goals, ["request_id"])
    feeders = cut(ahead.select(*FEEDER).distinct(), "feeders")
    attributed = cut(attributed_outages(outages, causes, feeders), "attributed")
    trailing = feeders.join(attributed.where(F.col("period") == TRAILING), FEEDER, "left")
    gap = rolling_year(
        ahead.join(actual, series)
        .join(goal, "request_id", "left")
        .join(service_columns(trailing, FEEDER), FEEDER)
    )
    rows = period_columns(suggest_volumes(gap, coefs)).select(
        "request_id",
        "conjunto",
        "cod_alim",
        "from",
        "to",
        "chi_pred",
        "chi_goal",
        "chi_diff",
        *[f"{s}_sugg" for s in SERVICES],
        "pred_month",
        "goal_gaps",
    )
    return (
        rows.join(maintenance_profile(maintenance, feeders), FEEDER)
        .join(outage_profile(attributed, feeders), FEEDER)
        .drop("pred_month")
    )
