"""Monthly series per key: spine, gap filling, climatology, future rows, splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridtide.functions.dates import season_weight

Keys = Sequence[str]


def month_spine(spans: DataFrame, start: Column, end: Column, name: str = "month") -> DataFrame:
    """One row per month from `start` to `end`, both included."""
    months = F.sequence(start.cast("date"), end.cast("date"), F.expr("interval 1 month"))
    return spans.select("*", F.explode(months).alias(name))


def fill_by_calendar_month(df: DataFrame, keys: Keys, month: str, columns: Keys) -> DataFrame:
    """Missing values become the mean of the same calendar month in the other years.

    One row per key and month is expected, so a window holds one row per year.
    """
    same = Window.partitionBy(*keys, F.month(month))
    filled = {c: F.coalesce(F.col(c), F.avg(c).over(same)) for c in columns}
    return df.withColumns(filled)


def climatology(df: DataFrame, keys: Keys, month_number: str, columns: Keys) -> DataFrame:
    """Mean of each column per key and calendar month."""
    return df.groupBy(*keys, month_number).agg(*[F.avg(c).alias(c) for c in columns])


def chrono_split(df: DataFrame, keys: Keys, order: Keys, frac: float = 0.9) -> DataFrame:
    """Adds `is_train`: the first `int(n * frac)` rows of each key in time order."""
    ahead = Window.partitionBy(*keys).orderBy(*order)
    whole = Window.partitionBy(*keys)
    return df.select(
        "*",
        (
            F.row_number().over(ahead) <= (F.count(F.lit(1)).over(whole).cast("double") * frac).cast("bigint")
        ).alias("is_train"),
    )


def future_rows(
    panel: DataFrame,
    keys: Keys,
    horizon: Column,
    asof: Column,
    goals: DataFrame,
    set_keys: Keys,
    seasonal: Keys,
    label: str = "chi_total",
    month: str = "month",
    feeder: str = "cod_alim",
    goal_driven: str | None = "dec_cj",
) -> DataFrame:
    """The rows to predict: each key's last row carried into `horizon` months from `asof` on.

    Year, month and seasonal weight are those of the new month and the label is 0. Seasonal columns
    take the key's mean for that calendar month where there is one. `goal_driven` takes the middle
    between that mean and the goal per consumer (`goals`: set keys, `horizon`, `chi_goal`), scaled
    by the feeder's share; the consumers are those of the set's latest row.
    """
    seasonal = [c for c in seasonal if c in panel.columns]
    goal_driven = goal_driven if goal_driven in panel.columns else None
    rest = [c for c in panel.columns if c not in keys]
    last = panel.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(month)).alias("row"))
    last = last.select(*keys, "row.*")
    consumers = panel.groupBy(*set_keys).agg(
        F.max_by("cons_conjunto", F.struct(F.col(month), F.col(feeder))).alias("__consumers")
    )
    ahead = (
        last.select("*", F.explode(F.sequence(F.lit(1), horizon)).alias("horizon"))
        .withColumn(month, F.add_months(asof, F.col("horizon") - 1))
        .withColumns(
            {
                "ano": F.year(month),
                "mes": F.month(month),
                "month_weighted": season_weight(F.month(month)),
                label: F.lit(0).cast(panel.schema[label].dataType),
            }
        )
        .join(consumers, list(set_keys))
        .join(goals.select(*set_keys, "horizon", "chi_goal"), [*set_keys, "horizon"], "left")
    )
    by_month = [c for c in (goal_driven, *seasonal) if c]
    if not by_month:
        return ahead.drop("__consumers")
    means = panel.groupBy(*keys, "mes").agg(
        F.lit(True).alias("__known"), *[F.avg(c).alias(f"__{c}") for c in by_month]
    )
    joined = ahead.join(means, [*keys, "mes"], "left")
    known = F.col("__known").isNotNull()
    new = {c: F.when(known, F.col(f"__{c}")).otherwise(F.col(c)).alias(c) for c in seasonal}
    if goal_driven:
        goal = F.try_divide(F.col("chi_goal").cast("double"), F.col("__consumers").cast("double"))
        mid = (goal * F.col("feeder_effect") + F.col(f"__{goal_driven}")) / 2
        new[goal_driven] = F.when(known, mid).otherwise(F.col(goal_driven)).alias(goal_driven)
    return joined.select(*[new.get(c, F.col(c)) for c in ahead.columns if c != "__consumers"])
