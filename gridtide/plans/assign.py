"""Inspection tasks assigned under a budget of service units."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtide.functions.numbers import exact
from gridtide.operators.allocation import OPEN_STATUS, assign_tasks, eligible_tasks, priority_rank
from gridtide.plans.forecast import set_totals
from gridtide.plans.panel import RUN
from gridtide.session import cut

# Fixed value: months for which tasks are assigned.
MONTHS_AHEAD = 2


def assignment_mode(forecast_rows: DataFrame, goals: DataFrame) -> DataFrame:
    """(set, date, horizon, by_feeder): whether the goal of the set covers its forecast."""
    goal = goals.where(F.col("horizon") >= 1).select(*RUN, "horizon", "chi_goal")
    return (
        set_totals(forecast_rows)
        .join(goal, [*RUN, "horizon"], "left")
        .select(*RUN, "horizon", F.coalesce(F.col("chi_goal") >= F.col("set_pred"), F.lit(False)).alias("by_feeder"))
    )


def assign(
    requests: DataFrame,
    forecast_rows: DataFrame,
    goals: DataFrame,
    tasks: DataFrame,
    months: int,
    carry: str = "sum",
    months_ahead: int = MONTHS_AHEAD,
) -> DataFrame:
    """Clean tasks with `request_id`, `conjunto` and `horizon` of the request they are assigned to.

    `requests`: (request_id, conjunto, pred_month, us_services); `goals`: one row per set, date and
    horizon; `months`: how many months back tasks are considered.
    """
    modes = assignment_mode(forecast_rows, goals)
    feeders = (
        requests.join(forecast_rows, RUN)
        .where(F.col("horizon") <= months_ahead)
        .join(modes, [*RUN, "horizon"])
        .select(
            "request_id",
            "conjunto",
            "pred_month",
            F.col("cod_alim").alias("feeder"),
            "horizon",
            "effect",
            "delta_chi_percent",
            "by_feeder",
        )
    )
    feeders = cut(feeders, "feeders")
    eligible = cut(
        eligible_tasks(tasks, feeders.select("request_id", "feeder", "pred_month").distinct(), months), "eligible"
    )
    picks = assign_tasks(
        eligible.select("request_id", "feeder", "idservico", "prio", "date_time", "us"),
        feeders.drop("conjunto", "pred_month"),
        requests.select("request_id", F.col("us_services").cast("double").alias("us_services")),
        months_ahead,
        carry=carry,
    )
    task = ["request_id", "feeder", "idservico"]
    named = picks.join(eligible.select(*task, "prio", "date_time"), task).join(
        requests.select("request_id", "conjunto"), "request_id"
    )
    return _task_rows(tasks, named)


def _task_rows(tasks: DataFrame, picks: DataFrame) -> DataFrame:
    """One row per pick: of the rows with its feeder and id, that which was picked (the first of equal ones)."""
    # this join is done on the rows as stored, so only tasks with a picked id are parsed
    open_tasks = tasks.where(F.col("status servico") == OPEN_STATUS).join(picks.select("idservico").distinct(), "idservico", "left_semi")
    picked = picks.select(
        "feeder",
        "idservico",
        "request_id",
        "conjunto",
        "horizon",
        *[F.col(c).alias(f"picked_{c}") for c in ("prio", "date_time", "us")],
    )
    same = (
        (F.col("date_time") == F.col("picked_date_time"))
        & (exact(F.col("us servico")) == F.col("picked_us"))
        & (priority_rank(F.col("prioridade")) == F.col("picked_prio"))
    )
    rows = open_tasks.join(picked, ["feeder", "idservico"]).where(same)
    keys = ["feeder", "idservico", "request_id", "conjunto", "horizon"]
    rest = [c for c in tasks.columns if c not in keys]
    first = rows.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("task"))
    return first.select("feeder", "idservico", *[F.col("task")[c].alias(c) for c in rest], *keys[2:])
