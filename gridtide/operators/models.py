"""Candidate models and how each kind is fitted.

Three kinds enter the same contest:

* `AggregateModel`: its parameters are aggregates of the history, its prediction is an expression.
  All of them are fitted in one `groupBy` for all series.
* `SeriesModel`: a small NumPy fit on the history of one series, inside a grouped map.
* `PanelModel`: one `pyspark.ml` fit over all series together.

`register_model` adds a candidate of any kind.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtide.operators import series_models
from gridtide.operators.ordering import places
from gridtide.session import cut, spread

HIGH_CARDINALITY = 11
MISSING = "missing"
SEED = 42
# Amounts are decimals with fewer digits than this before the point.
LARGEST = 1e17


@dataclass(frozen=True)
class AggregateModel:
    name: str
    params: Callable[[Column, Column], Mapping[str, Column]]
    predict: Callable[[Mapping[str, Column], Column], Column]


@dataclass(frozen=True)
class SeriesModel:
    name: str
    fit_predict: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]


@dataclass(frozen=True)
class PanelModel:
    name: str
    estimator: Callable[[], object]


Model = AggregateModel | SeriesModel | PanelModel
REGISTRY: dict[str, Model] = {}


def register_model(model: Model) -> Model:
    REGISTRY[model.name] = model
    return model


def models_named(names: Sequence[str] | None = None) -> list[Model]:
    """Registered models; without names all but the panel models, which train on all series."""
    if names is None:
        return [m for m in REGISTRY.values() if not isinstance(m, PanelModel)]
    unknown = set(names) - set(REGISTRY)
    if unknown:
        raise KeyError(f"no such model: {sorted(unknown)}")
    return [REGISTRY[n] for n in names]


# ---- aggregates -------------------------------------------------------------------------------

register_model(AggregateModel("mean", lambda y, t: {"level": F.avg(y)}, lambda p, t: p["level"]))
register_model(AggregateModel("median", lambda y, t: {"level": F.median(y)}, lambda p, t: p["level"]))
register_model(
    AggregateModel(
        "ols1",
        lambda y, t: {"slope": F.regr_slope(y, t), "start": F.regr_intercept(y, t)},
        lambda p, t: p["start"] + p["slope"] * t,
    )
)


def predict_aggregates(
    history: DataFrame, rows: DataFrame, keys: Sequence[str], label: str, time: str, models: Sequence[AggregateModel]
) -> DataFrame:
    """(columns of `rows`, model, pred) for every aggregate model."""
    y, t = F.col(label).cast("double"), F.col(time).cast("double")
    fitted = history.groupBy(*keys).agg(
        *[c.alias(f"__{m.name}_{p}") for m in models for p, c in m.params(y, t).items()]
    )

    def prediction(m: AggregateModel) -> Column:
        params = {p: F.col(f"__{m.name}_{p}") for p in m.params(y, t)}
        return F.struct(F.lit(m.name).alias("model"), m.predict(params, t).cast("double").alias("pred"))

    joined = rows.join(fitted, list(keys))
    return joined.select(*rows.columns, F.explode(F.array(*map(prediction, models))).alias("p")).select(
        *rows.columns, "p.model", "p.pred"
    )


# ---- one small fit per series -----------------------------------------------------------------


def design(train: pd.DataFrame, test: pd.DataFrame, features: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Both frames as matrices, prepared by what the training rows show.

    Numbers: gaps become the mean, then zero mean and unit spread; a column without any value is
    left out. Text: gaps become a category of their own; few categories give one 0/1 column each
    (all 0 for a new category), many give their place in sorted order (one past the end if new).
    """
    left, right = [], []
    for name in features:
        a, b = train[name], test[name]
        if pd.api.types.is_numeric_dtype(a) or pd.api.types.is_bool_dtype(a):
            known = a.to_numpy(float, na_value=np.nan)
            if np.isnan(known).all():
                continue
            mean = np.nanmean(known)
            pair = [np.where(np.isnan(v), mean, v) for v in (known, b.to_numpy(float, na_value=np.nan))]
            spread = pair[0].std() or 1.0
            cols = [((v - pair[0].mean()) / spread)[:, None] for v in pair]
        else:
            a, b = a.fillna(MISSING).astype(str), b.fillna(MISSING).astype(str)
            seen = np.sort(a.unique())
            if len(seen) > HIGH_CARDINALITY:
                place = {v: i for i, v in enumerate(seen)}
                cols = [v.map(lambda s: place.get(s, len(place))).to_numpy(float)[:, None] for v in (a, b)]
            else:
                cols = [(v.to_numpy()[:, None] == seen[None, :]).astype(float) for v in (a, b)]
        left.append(cols[0])
        right.append(cols[1])
    if not left:
        return np.zeros((len(train), 0)), np.zeros((len(test), 0))
    return np.hstack(left), np.hstack(right)


def _with_one(x: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(x)), x])


def _weighted_ridge(x: np.ndarray, y: np.ndarray, w: np.ndarray, alpha: float) -> np.ndarray:
    """Weighted least squares with a penalty on all coefficients but the constant."""
    a = _with_one(x)
    penalty = np.eye(a.shape[1]) * alpha
    penalty[0, 0] = 0.0
    return np.linalg.lstsq(a.T @ (a * w[:, None]) + penalty, a.T @ (w * y), rcond=None)[0]


def _linear(x, y, new):
    return _with_one(new) @ np.linalg.lstsq(_with_one(x), y, rcond=None)[0]


def _ridge(x, y, new):
    return _with_one(new) @ _weighted_ridge(x, y, np.ones(len(y)), 1.0)


def _nearest(x, y, new, k=5):
    far = ((new[:, None, :] - x[None, :, :]) ** 2).sum(axis=2)
    near = np.argsort(far, axis=1, kind="stable")[:, : min(k, len(y))]
    return y[near].mean(axis=1)


def _huber(x, y, new, cut=1.345, rounds=30):
    beta = _weighted_ridge(x, y, np.ones(len(y)), 1e-4)
    for _ in range(rounds):
        off = np.abs(y - _with_one(x) @ beta)
        scale = max(np.median(off) / 0.6745, 1e-9)
        beta = _weighted_ridge(x, y, np.minimum(1.0, cut * scale / np.maximum(off, 1e-12)), 1e-4)
    return _with_one(new) @ beta


def _poisson(x, y, new, rounds=30):
    if (y < 0).any() or not (y > 0).any():
        raise ValueError("counts must be 0 or more, and not all 0")
    beta = np.zeros(x.shape[1] + 1)
    beta[0] = np.log(y.mean())
    for _ in range(rounds):
        eta = np.clip(_with_one(x) @ beta, -50, 50)
        mu = np.exp(eta)
        beta = _weighted_ridge(x, eta + (y - mu) / mu, mu / mu.mean(), 1.0)
    return np.exp(np.clip(_with_one(new) @ beta, -50, 50))


for _name, _fit in [
    ("linear", _linear),
    ("ridge", _ridge),
    ("lasso", series_models.lasso),
    ("elastic_net", series_models.elastic_net),
    ("nearest", _nearest),
    ("huber", _huber),
    ("poisson", _poisson),
    ("tree", series_models.one_tree),
    ("forest", series_models.forest),
    ("boosted", series_models.boosted),
]:
    register_model(SeriesModel(_name, _fit))


def predict_series(
    history: DataFrame,
    rows: DataFrame,
    keys: Sequence[str],
    features: Sequence[str],
    label: str,
    row_id: str,
    models: Sequence[SeriesModel],
    chosen: str | None = None,
) -> DataFrame:
    """(keys, row_id, model, pred) for every series model, or for the one named in `chosen`.

    A group is the history of one series: one row per month. A model that fails on a series, or
    does not give finite numbers that an amount can hold, gives no rows for it.
    """
    keys, features = list(keys), list(features)
    schema = T.StructType(
        [history.schema[k] for k in keys]
        + [rows.schema[row_id], T.StructField("model", T.StringType()), T.StructField("pred", T.DoubleType())]
    )
    fits = {m.name: m.fit_predict for m in models}

    def contest(key: tuple, past: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(past) and len(new):
            past = past[past[label].notna()].sort_values("__time", kind="stable")
            x, fresh = design(past, new, features)
            y = past[label].to_numpy(float)
            wanted = fits if chosen is None else {n: fits[n] for n in new[chosen].unique() if n in fits}
            for name, fit in wanted.items():
                try:
                    with np.errstate(all="ignore"):
                        pred = np.asarray(fit(x, y, fresh), float)
                except Exception:  # noqa: BLE001, a registered model may fail in any way
                    continue
                if np.isfinite(pred).all() and np.abs(pred).max(initial=0) < LARGEST:
                    out.extend((*key, i, name, p) for i, p in zip(new[row_id], pred.tolist(), strict=True))
        return pd.DataFrame(out, columns=schema.names)

    def numeric(df: DataFrame) -> list[Column]:
        text = (T.StringType, T.DateType)
        return [
            F.col(f"`{f}`").cast("string" if isinstance(df.schema[f].dataType, text) else "double").alias(f)
            for f in features
        ]

    # new names for the keys: both sides may come from the same table
    own = [F.col(k).alias(k) for k in keys]
    past = history.select(*own, F.col("month").alias("__time"), F.col(label).cast("double").alias(label), *numeric(history))
    new = rows.select(*own, row_id, *([chosen] if chosen else []), *numeric(rows))
    sides = [spread(df, keys).groupBy(*keys) for df in (past, new)]
    return sides[0].cogroup(sides[1]).applyInPandas(contest, schema)


# ---- one fit over all series ------------------------------------------------------------------


def _register_panel_models() -> None:
    from pyspark.ml import regression as R

    common = {"labelCol": "__label", "featuresCol": "__features", "predictionCol": "pred"}
    linear = lambda reg, mix: lambda: R.LinearRegression(**common, regParam=reg, elasticNetParam=mix)
    glm = lambda family: lambda: R.GeneralizedLinearRegression(
        **common, family=family, link="log", regParam=0.01
    )
    for name, make in {
        "panel_linear": linear(0.0, 0.0),
        "panel_ridge": linear(1.0, 0.0),
        "panel_lasso": linear(1.0, 1.0),
        "panel_elastic_net": linear(1.0, 0.5),
        "panel_poisson": glm("poisson"),
        "panel_gamma": glm("gamma"),
        "panel_tree": lambda: R.DecisionTreeRegressor(**common, seed=SEED),
        "panel_forest": lambda: R.RandomForestRegressor(**common, seed=SEED),
        "panel_boosted": lambda: R.GBTRegressor(**common, seed=SEED),
        "panel_factors": lambda: R.FMRegressor(**common, seed=SEED),
    }.items():
        register_model(PanelModel(name, make))


_register_panel_models()


@dataclass(frozen=True)
class Prepared:
    """What training rows tell of the feature columns. Numbers are a mean and a spread each; the values of text
    columns stay in a table, numbered in order, however many there are."""

    numbers: Mapping[str, tuple[float, float]]
    sizes: Mapping[str, int]  # how many values a text column has
    codes: DataFrame  # name, value, code

    def transform(self, rows: DataFrame) -> DataFrame:
        """Adds `__features`: numbers, gaps filled by the mean, with zero mean and unit spread; text of few values as
        one 0/1 column each (all 0 for a new value); other text as its code (one past the end if new)."""
        flags, places = [], []
        for k, (name, size) in enumerate(self.sizes.items()):
            own = self.codes.where(F.col("name") == name).select(F.col("value").alias(f"__v{k}"), F.col("code").alias(f"__c{k}"))
            few = size <= HIGH_CARDINALITY  # at most so many rows
            rows = rows.join(F.broadcast(own) if few else own, F.col(f"`{name}`") == F.col(f"__v{k}"), "left")
            code = F.coalesce(F.col(f"__c{k}"), F.lit(size)).cast("double")
            if few:
                flags += [F.when(code == i, 1.0).otherwise(0.0) for i in range(size)]
            else:
                places.append(code)
        scaled = [
            (F.coalesce(F.nanvl(F.col(f"`{f}`").cast("double"), F.lit(None).cast("double")), F.lit(mean)) - mean) / spread if spread else F.lit(0.0)
            for f, (mean, spread) in self.numbers.items()
        ]
        parts = F.array(*scaled, *flags, *places) if scaled or flags or places else F.array().cast("array<double>")
        made = rows.withColumn("__features", array_to_vector(parts))
        return made.drop(*[c for k in range(len(self.sizes)) for c in (f"__v{k}", f"__c{k}")])


def prepare(train: DataFrame, features: Sequence[str]) -> Prepared:
    """One aggregate for the numbers and one numbered table for the values of all text columns."""
    text = [f for f in features if isinstance(train.schema[f].dataType, T.StringType)]
    numbers = [f for f in features if f not in text]
    known = {f: F.nanvl(F.col(f"`{f}`").cast("double"), F.lit(None).cast("double")) for f in numbers}
    stats = [[F.count(x), F.avg(x), F.var_pop(x)] for x in known.values()]
    row = train.agg(F.count("*"), *[c for some in stats for c in some]).first()
    spread = {}
    for f, (n, mean, variance) in zip(numbers, zip(*[iter(row[1:])] * 3)):
        if n:  # a column without any value is left out; filled gaps add nothing to the squares
            spread[f] = (mean, (variance * n / (row[0] - 1)) ** 0.5 if row[0] > 1 else 0.0)
    if not text:
        return Prepared(spread, {}, train.sparkSession.createDataFrame([], "name string, value string, code long"))
    pairs = F.array(*[F.struct(F.lit(f).alias("name"), F.col(f"`{f}`").alias("value")) for f in text])
    values = train.select(F.explode(pairs).alias("p")).select("p.*").where("value is not null").distinct()
    codes = places(values, ["name"], ["value"], name="place").select("name", "value", (F.col("place") - 1).alias("code"))
    codes = cut(codes, "codes")
    sizes = {r.name: r.n for r in codes.groupBy("name").agg(F.count("*").alias("n")).collect()}  # a row for each column
    return Prepared(spread, {f: sizes.get(f, 0) for f in text}, codes)


def predict_panel(
    history: DataFrame,
    rows: DataFrame,
    keys: Sequence[str],
    features: Sequence[str],
    label: str,
    row_id: str,
    models: Sequence[PanelModel],
    apart: str = "pred_month",
) -> DataFrame:
    """(keys, row_id, model, pred). Runs with different dates are fitted apart, so that no fit sees
    months after its own date. A model that fails gives no rows.
    """
    spark = history.sparkSession
    schema = T.StructType(
        [history.schema[k] for k in keys]
        + [rows.schema[row_id], T.StructField("model", T.StringType()), T.StructField("pred", T.DoubleType())]
    )
    out = spark.createDataFrame([], schema)

    def cast(df: DataFrame) -> DataFrame:
        numeric = [f for f in features if not isinstance(df.schema[f].dataType, T.StringType)]
        text = [f for f in features if f not in numeric]
        return df.withColumns(
            {f: F.col(f).cast("double") for f in numeric}
            | {f: F.coalesce(F.col(f), F.lit(MISSING)) for f in text}
        )

    past = cut(cast(history).withColumn("__label", F.col(label).cast("double")), "past")
    new = cut(cast(rows), "new")
    for (value,) in past.select(apart).distinct().collect():  # the dates of the requests
        train = past.where((F.col(apart) == F.lit(value)) & F.col("__label").isNotNull())
        prepared = prepare(train, features)
        # estimators pass over these many times, but only until they are fitted
        seen = prepared.transform(train).select("__features", "__label").persist()
        fresh = prepared.transform(new.where(F.col(apart) == F.lit(value)))
        fresh = cut(fresh.select(*keys, row_id, "__features"), "fresh")
        for model in models:
            try:
                fitted = model.estimator().fit(seen)
            except Exception:  # noqa: BLE001 - any failure of an estimator only drops that candidate
                continue
            pred = fitted.transform(fresh).select(*keys, row_id, F.lit(model.name).alias("model"), F.col("pred").cast("double"))
            out = out.unionByName(pred)
        seen.unpersist()
    return out
