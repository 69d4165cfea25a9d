"""Monthly goals: wide to long, and the goals of a 12-month window."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtide.functions.numbers import exact
from gridtide.operators.series import month_spine

# Fixed value: goal columns are named day/month/year without zero padding.
GOAL_COLUMN = re.compile(r"^\d{1,2}/\d{1,2}/\d{4}$")
GOAL_FORMAT = "d/M/yyyy"


def goals_long(wide: DataFrame, id_col: str = "SIGLA") -> DataFrame:
    """(id, month, chi_goal): one row per goal cell."""
    months = [c for c in wide.columns if GOAL_COLUMN.match(c)]
    cells = wide.select(id_col, *[exact(F.col(f"`{c}`")).alias(c) for c in months])
    long = cells.unpivot(F.col(id_col), [F.col(f"`{c}`") for c in months], "label", "chi_goal")
    return long.select(id_col, F.to_date("label", GOAL_FORMAT).alias("month"), "chi_goal")


def monthly_goals(long: DataFrame, id_col: str = "SIGLA") -> DataFrame:
    """Sum per set and month; a missing cell makes the sum missing."""
    return long.groupBy(id_col, "month").agg(
        F.when(F.count("*") == F.count("chi_goal"), F.sum("chi_goal")).alias("chi_goal")
    )


def goal_window(monthly: DataFrame, runs: DataFrame, total: int = 12, id_col: str = "SIGLA") -> DataFrame:
    """Goals of each run: `months_ahead` months from `pred_month` on and as many before it as make
    `total`. `horizon` is 1 for `pred_month`, 0 and below for the months before. A month without
    goal stays, with NULL.
    """
    # a horizon beyond `total` has no months before it
    back = F.greatest(F.lit(0), F.lit(total) - F.col("months_ahead"))
    months = month_spine(
        runs,
        F.add_months("pred_month", -back),
        F.add_months("pred_month", F.col("months_ahead") - 1),
    )
    ahead = (F.year("month") - F.year("pred_month")) * 12 + F.month("month") - F.month("pred_month") + 1
    named = monthly.select(F.col(id_col).alias("conjunto"), "month", "chi_goal")
    return months.join(named, ["conjunto", "month"], "left").select(
        *runs.columns, "month", ahead.cast("int").alias("horizon"), "chi_goal"
    )


def goal_totals(window: DataFrame, keys: list[str]) -> DataFrame:
    """Goal of the whole window; missing if any of its months is."""
    return window.groupBy(*keys).agg(
        F.when(F.count("*") == F.count("chi_goal"), F.sum("chi_goal")).alias("goal_total"),
        (F.count("*") - F.count("chi_goal")).alias("goal_gaps"),
    )
