"""Model search per series: split, score every candidate, keep the best, predict with it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtide.functions.numbers import half_even, share
from gridtide.operators import models as M
from gridtide.operators.rows import columns_except
from gridtide.session import cut

# Columns that are neither keys of a model nor features.
NOT_FEATURES = (
    "cod_alim",
    "ano",
    "mes",
    "chi_total",
    "cons_conjunto",
    "qtde_cliente_total",
    "qtde_cliente_ru",
    "qtde_cliente_ub",
    "DESCR_NOVO",
)
# Columns of our own that carry keys and dates.
OWN_COLUMNS = ("conjunto", "pred_month", "months_ahead", "month", "t", "is_train")


def feature_columns(panel: DataFrame) -> list[str]:
    return columns_except(panel, [*NOT_FEATURES, *OWN_COLUMNS])


def score(
    df: DataFrame,
    keys: Sequence[str],
    y: str,
    yhat: str,
    p: int = 1,
    metrics: Mapping[str, Column] | None = None,
) -> DataFrame:
    """`mape` (percent, NULL if an actual value is 0), `rmse`, `r2`, `adj_r2` for `p` predictors,
    and further aggregates given as `metrics`. A group with a missing prediction gets no scores.
    """
    off = F.col(y) - F.col(yhat)
    n = F.count(F.lit(1))
    whole = n == F.count(yhat)
    mean_off = F.avg(F.abs(F.when(F.col(y) != 0, off / F.col(y)))) * 100
    r2 = 1 - F.try_divide(F.sum(off * off), F.var_pop(y) * n)
    base = df.groupBy(*keys).agg(
        n.alias("n"),
        F.when(whole & (F.min(F.abs(y)) > 0), mean_off).alias("mape"),
        F.when(whole, F.sqrt(F.avg(off * off))).alias("rmse"),
        F.when(whole, r2).alias("r2"),
        *[c.alias(name) for name, c in (metrics or {}).items()],
    )
    adjusted = 1 - F.try_divide((1 - F.col("r2")) * (F.col("n") - 1), (F.col("n") - p - 1).cast("double"))
    return base.withColumn("adj_r2", adjusted)


def champion(scores: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key the model of lowest MAPE, then RMSE, then name. A missing MAPE comes last."""
    rank = F.struct(F.col("mape").isNull().alias("gap"), "mape", "rmse", "model")
    return (
        scores.where(F.col("rmse").isNotNull())
        .groupBy(*keys)
        .agg(F.min_by(F.struct("model", "mape", "rmse"), rank).alias("best"))
        .select(*keys, "best.*")
    )


def _predict(history, rows, keys, features, label, row_id, candidates, chosen=None):
    """(keys, row_id, model, pred) of all candidates over all kinds."""

    def of(kind):
        return [m for m in candidates if isinstance(m, kind)]

    def mine(kind):
        if chosen is None:
            return rows
        return rows.where(F.col(chosen).isin([m.name for m in of(kind)]))

    parts = []
    if of(M.AggregateModel):
        got = M.predict_aggregates(
            history, mine(M.AggregateModel).select(*keys, row_id, "t", *([chosen] if chosen else [])), keys, label, "t", of(M.AggregateModel)
        )
        if chosen:
            got = got.where(F.col("model") == F.col(chosen))
        parts.append(got.select(*keys, row_id, "model", "pred"))
    if of(M.SeriesModel):
        past, new = history, mine(M.SeriesModel)
        if chosen:
            past = past.join(new.select(*keys).distinct(), list(keys), "left_semi")
        parts.append(M.predict_series(past, new, keys, features, label, row_id, of(M.SeriesModel), chosen))
    if of(M.PanelModel):
        new = mine(M.PanelModel)
        got = M.predict_panel(history, new, keys, features, label, row_id, of(M.PanelModel))
        if chosen:
            got = got.join(new.select(*keys, row_id, chosen), [*keys, row_id]).where(F.col("model") == F.col(chosen))
        parts.append(got.select(*keys, row_id, "model", "pred"))
    return reduce(DataFrame.unionByName, parts)


def month_index(month: str, asof: str) -> Column:
    """Whole months from `asof` to `month`, negative before it."""
    return ((F.year(month) - F.year(asof)) * 12 + F.month(month) - F.month(asof)).cast("int")


def held_out_predictions(
    split: DataFrame,
    keys: Sequence[str],
    features: Sequence[str],
    label: str = "chi_total",
    models: Sequence[str] | None = None,
) -> DataFrame:
    """(keys, month, model, pred, y) on the rows kept for testing."""
    train, test = split.where("is_train"), split.where("not is_train")
    preds = _predict(train, test, keys, features, label, "month", M.models_named(models))
    actual = test.select(*keys, "month", F.col(label).cast("double").alias("y"))
    return preds.join(actual, [*keys, "month"])


def evaluate_models(
    split: DataFrame,
    keys: Sequence[str],
    features: Sequence[str],
    label: str = "chi_total",
    models: Sequence[str] | None = None,
    metrics: Mapping[str, Column] | None = None,
) -> DataFrame:
    """(keys, model, n, mape, rmse, r2, adj_r2, ...) on the rows kept for testing.

    `split` has one row per key and `month`, with `t` and `is_train`. `metrics` may use the columns
    `y` and `pred`.
    """
    preds = held_out_predictions(split, keys, features, label, models)
    return score(preds, [*keys, "model"], "y", "pred", max(len(features), 1), metrics)


def refit_predict(
    history: DataFrame,
    future: DataFrame,
    champions: DataFrame,
    keys: Sequence[str],
    features: Sequence[str],
    label: str = "chi_total",
    models: Sequence[str] | None = None,
) -> DataFrame:
    """Predictions for the future rows by each key's champion, trained on the whole history."""
    named = future.join(champions.select(*keys, F.col("model").alias("__best")), list(keys))
    return _predict(history, named, keys, features, label, "month", M.models_named(models), "__best")


def against_goal(preds: DataFrame, goal: str = "goal_chi", pred: str = "pred") -> DataFrame:
    """`delta_chi` and `delta_chi_percent` (a fraction, two digits; NULL for a goal of 0)."""
    delta = F.col(goal) - F.col(pred)
    return preds.withColumns(
        {"delta_chi": delta, "delta_chi_percent": half_even(share(delta, F.col(goal)), 2)}
    )


def search(
    split: DataFrame,
    keys: Sequence[str],
    label: str = "chi_total",
    models: Sequence[str] | None = None,
    metrics: Mapping[str, Column] | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Champion per key, scores per key and model, and the test predictions behind them."""
    features = feature_columns(split)
    preds = cut(held_out_predictions(split, keys, features, label, models), "tests")
    scores = cut(score(preds, [*keys, "model"], "y", "pred", max(len(features), 1), metrics), "scores")
    return champion(scores, keys), scores, preds
