"""H: preparation, model search, forecast against goals."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog import Data, check
from catalog.relational import FUTURE, GOALS, PANEL, PANEL_USES, goals, panel, text_dates
from gridtide.operators.models import REGISTRY, PanelModel, prepare
from gridtide.operators.rows import cardinality_split
from gridtide.operators.search import (
    against_goal,
    champion,
    evaluate_models,
    feature_columns,
    refit_predict,
)
from gridtide.operators.series import chrono_split, future_rows
from gridtide.plans.forecast import forecast, with_index
from gridtide.plans.panel import RUN, SERIES
from gridtide.session import cut

SQL_MODELS = ["mean", "median", "ols1"]
SERIES_MODELS = ["linear", "ridge", "nearest", "huber", "poisson"]

MODELS = (
    PANEL
    + """
, split AS (SELECT *, datediff('month', pred_month, month) AS t, row_number() OVER (PARTITION BY conjunto, cod_alim ORDER BY month)
    <= floor(count(*) OVER (PARTITION BY conjunto, cod_alim) * CAST(0.9 AS DOUBLE)) AS is_train FROM panel)
, names(model) AS (VALUES ('mean'), ('median'), ('ols1'))
, fit AS (SELECT conjunto, cod_alim, avg(chi_total) AS mean, median(chi_total) AS median,
    regr_slope(chi_total, t) AS slope, regr_intercept(chi_total, t) AS start FROM split WHERE is_train GROUP BY conjunto, cod_alim)
, test_preds AS (SELECT s.conjunto, s.cod_alim, model, chi_total AS y,
    CASE model WHEN 'mean' THEN mean WHEN 'median' THEN median ELSE start + slope * t END AS pred
    FROM split s JOIN fit f ON s.conjunto = f.conjunto AND s.cod_alim = f.cod_alim CROSS JOIN names WHERE NOT is_train)
, scores AS (SELECT conjunto, cod_alim, model, CASE WHEN min(abs(y)) > 0 THEN avg(abs((y - pred) / y)) * 100 END AS mape,
    sqrt(avg(pow(y - pred, 2))) AS rmse FROM test_preds GROUP BY conjunto, cod_alim, model)
, champs AS (SELECT conjunto, cod_alim, model, mape, rmse FROM (SELECT *, row_number() OVER (PARTITION BY conjunto, cod_alim
    ORDER BY mape NULLS LAST, rmse, model) AS rn FROM scores) WHERE rn = 1)
"""
)

# Forecast of the champions, trained on the whole history.
FORECAST = (
    GOALS
    + MODELS
    + FUTURE
    + """
, refit AS (SELECT conjunto, cod_alim, avg(chi_total) AS mean, median(chi_total) AS median,
    regr_slope(chi_total, t) AS slope, regr_intercept(chi_total, t) AS start FROM split GROUP BY conjunto, cod_alim)
, forecast AS (SELECT f.conjunto, f.cod_alim, horizon, month, c.model,
    CASE c.model WHEN 'mean' THEN mean WHEN 'median' THEN median ELSE start + slope * (horizon - 1) END AS pred,
    chi_goal * feeder_effect AS goal_chi, feeder_effect AS effect
  FROM future f JOIN champs c ON f.conjunto = c.conjunto AND f.cod_alim = c.cod_alim
       JOIN refit r ON f.conjunto = r.conjunto AND f.cod_alim = r.cod_alim)
"""
)
FORECAST_USES = (*PANEL_USES, "runs")


def split_panel(data: Data) -> DataFrame:
    return cut(with_index(chrono_split(panel(data), SERIES, ["month"])), "split")


def shown(df: DataFrame, columns, digits=4) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


@check(
    "H3_prepared_features",
    """WITH d AS (SELECT o_orderkey, CAST(o_totalprice AS DOUBLE) AS x, CASE WHEN c_acctbal > 0 THEN CAST(c_acctbal AS DOUBLE) END AS b,
                      c_mktsegment AS s, strftime(o_orderdate, '%Y-%m') AS m FROM orders JOIN customer ON o_custkey = c_custkey),
            f AS (SELECT * EXCLUDE (b), coalesce(b, (SELECT avg(b) FROM d)) AS b FROM d),
            n AS (SELECT avg(x) AS mx, stddev_samp(x) AS sx, avg(b) AS mb, stddev_samp(b) AS sb FROM f)
       SELECT o_orderkey, round((x - mx) / sx, 5) AS total, round((b - mb) / sb, 5) AS balance,
              dense_rank() OVER (ORDER BY s) - 1 AS segment, dense_rank() OVER (ORDER BY m) - 1 AS month FROM f CROSS JOIN n""",
)
def _(data):
    """Numbers filled and scaled, low-cardinality text as 0/1 columns, the rest as codes."""
    df = data["orders"].join(data["customer"], F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey",
        "o_totalprice",
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("balance"),
        "c_mktsegment",
        F.date_format("o_orderdate", "yyyy-MM").alias("month"),
    )
    features = ["o_totalprice", "balance", "c_mktsegment", "month"]
    made = prepare(df, features).transform(df)
    parts = vector_to_array("__features")
    return made.withColumn("parts", parts).select(
        "o_orderkey",
        F.round(F.get("parts", F.lit(0)), 5).alias("total"),
        F.round(F.get("parts", F.lit(1)), 5).alias("balance"),
        # the place of the only 1 among the 0/1 columns
        (F.array_position(F.slice("parts", F.lit(3), F.size("parts") - 3), 1.0) - 1).alias("segment"),
        F.element_at("parts", -1).cast("bigint").alias("month"),
    )


@check(
    "H4_cardinality_split",
    """SELECT name, n_distinct, n_distinct > 11 AS high FROM (
         SELECT 'c_mktsegment' AS name, count(DISTINCT c_mktsegment) AS n_distinct FROM customer
         UNION ALL SELECT 'c_name', count(DISTINCT c_name) FROM customer
         UNION ALL SELECT 'c_nationkey', count(DISTINCT c_nationkey) FROM customer)""",
)
def _(data):
    return cardinality_split(data["customer"], ["c_mktsegment", "c_name", "c_nationkey"])


@check(
    "H5_candidate_counts",
    MODELS
    + f"""SELECT s.cod_alim, m.model, count(*) AS n FROM split s CROSS JOIN (VALUES {", ".join(f"('{n}')" for n in REGISTRY)}) m(model)
          WHERE NOT is_train GROUP BY s.cod_alim, m.model""",
    PANEL_USES,
)
def _(data):
    """Every registered model is tried on every feeder, on all months of its test part."""
    made = split_panel(data)
    scores = evaluate_models(made, SERIES, feature_columns(made), models=list(REGISTRY))
    return scores.select("cod_alim", "model", F.col("n").cast("bigint").alias("n"))


@check("H5_candidates_per_feeder")
def _(data):
    """Every registered model, tried on every feeder."""
    made = split_panel(data)
    scores = evaluate_models(made, SERIES, feature_columns(made), models=list(REGISTRY))
    kind = F.create_map(
        *[F.lit(x) for n, m in REGISTRY.items() for x in (n, type(m).__name__)]
    )
    return scores.select("cod_alim", "model", kind[F.col("model")].alias("kind"), "n", "mape", "rmse")


@check(
    "H6_scores_of_aggregate_models",
    MODELS + "SELECT conjunto, cod_alim, model, round(mape, 4) AS mape, round(rmse, 2) AS rmse FROM scores",
    PANEL_USES,
)
def _(data):
    made = split_panel(data)
    scores = evaluate_models(made, SERIES, feature_columns(made), models=SQL_MODELS)
    return scores.select("conjunto", "cod_alim", "model", F.round("mape", 4).alias("mape"), F.round("rmse", 2).alias("rmse"))


@check("H6_scores_of_series_models")
def _(data):
    made = split_panel(data)
    return evaluate_models(made, SERIES, feature_columns(made), models=SERIES_MODELS)


@check(
    "H6_champions",
    MODELS + "SELECT conjunto, cod_alim, model, round(mape, 4) AS mape, round(rmse, 2) AS rmse FROM champs",
    PANEL_USES,
)
def _(data):
    made = split_panel(data)
    best = champion(evaluate_models(made, SERIES, feature_columns(made), models=SQL_MODELS), SERIES)
    return best.select("conjunto", "cod_alim", "model", F.round("mape", 4).alias("mape"), F.round("rmse", 2).alias("rmse"))


def _future(data: Data, made: DataFrame) -> DataFrame:
    rows = future_rows(made, SERIES, F.col("months_ahead"), F.col("pred_month"), goals(data), RUN, [])
    return with_index(rows)


@check("H7_refit_and_predict")
def _(data):
    """Champions among the series models, trained on the whole history."""
    made = split_panel(data)
    features = feature_columns(made)
    best = champion(evaluate_models(made, SERIES, features, models=SERIES_MODELS), SERIES)
    return text_dates(refit_predict(made, _future(data, made), best, SERIES, features, models=SERIES_MODELS))


@check(
    "H7_refit_and_predict_aggregates",
    FORECAST + "SELECT conjunto, cod_alim, CAST(month AS VARCHAR) AS month, model, round(pred, 3) AS pred FROM forecast",
    FORECAST_USES,
)
def _(data):
    made = split_panel(data)
    features = feature_columns(made)
    best = champion(evaluate_models(made, SERIES, features, models=SQL_MODELS), SERIES)
    preds = refit_predict(made, _future(data, made), best, SERIES, features, models=SQL_MODELS)
    return text_dates(preds.select("conjunto", "cod_alim", "month", "model", F.round("pred", 3).alias("pred")))


@check(
    "H8_forecast_against_goal",
    """SELECT l_orderkey, l_linenumber, l_extendedprice, l_quantity - l_linenumber AS delta_chi,
              round_even((l_quantity - l_linenumber) / nullif(l_quantity - 1, 0), 2) AS shifted,
              round_even((l_quantity - l_linenumber) / l_quantity, 2) AS delta_chi_percent FROM lineitem""",
)
def _(data):
    lines = data["lineitem"].select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")
    plain = against_goal(lines, "l_quantity", "l_linenumber")
    lower = plain.withColumns({"goal": F.col("l_quantity") - 1, "made": F.col("l_linenumber") - 1, "percent": F.col("delta_chi_percent")})
    return against_goal(lower, "goal", "made").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "delta_chi",
        F.col("delta_chi_percent").alias("shifted"), F.col("percent").alias("delta_chi_percent"),
    )


@check(
    "H9_forecast",
    FORECAST
    + """SELECT conjunto, cod_alim, horizon, CAST(month AS VARCHAR) AS month, model, round(pred, 3) AS pred, round(goal_chi, 3) AS goal_chi,
                round(goal_chi - pred, 3) AS delta_chi, round_even((goal_chi - pred) / nullif(goal_chi, 0), 2) AS delta_chi_percent, round(effect, 8) AS effect
         FROM forecast""",
    FORECAST_USES,
)
def _(data):
    rows = forecast(panel(data), goals(data), SQL_MODELS).rows.drop("pred_month")
    rows = shown(shown(rows, ["pred", "goal_chi", "delta_chi"], 3), ["effect"], 8)
    return text_dates(rows)


@check("J3_forecast_with_all_series_models")
def _(data):
    return text_dates(forecast(panel(data), goals(data)).rows)


@check("J3_forecast_with_panel_models")
def _(data):
    names = [n for n, m in REGISTRY.items() if isinstance(m, PanelModel)]
    return text_dates(forecast(panel(data), goals(data), [*SQL_MODELS, *names]).rows)
