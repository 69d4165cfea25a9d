"""Series, model search, attribution, yearly profiles, goals."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridtide.operators import models as M
from gridtide.operators import rows as R
from gridtide.operators import search
from gridtide.operators.attribution import attribute, service_columns
from gridtide.operators.goals import goal_totals, goal_window, goals_long, monthly_goals
from gridtide.operators.series import chrono_split, future_rows
from gridtide.operators.suggestions import suggest_volumes
from gridtide.operators.yearly import yearly_profile
from gridtide.plans.forecast import forecast
from gridtide.plans.panel import RUN, SERIES, build_panel, one_row_per_month


@pytest.mark.parametrize("n, train", [(1, 0), (2, 1), (9, 8), (10, 9), (11, 9), (20, 18)])
def test_split_sizes(spark, n, train):
    df = spark.range(n).withColumn("k", F.lit(1))
    assert chrono_split(df, ["k"], ["id"]).where("is_train").count() == train


def test_first_and_last(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, None), (1, 2, "b"), (2, 5, "x")], "k int, t int, v string")
    assert sorted(map(tuple, R.first_per(df, ["k"], ["t"]).collect())) == [(1, 1, None), (2, 5, "x")]
    assert sorted(map(tuple, R.last_per(df, ["k"], ["t"]).collect())) == [(1, 3, "c"), (2, 5, "x")]


def test_scores(spark):
    rows = [("a", 10.0, 9.0), ("a", 20.0, 22.0), ("zero", 0.0, 1.0), ("zero", 2.0, 2.0), ("gap", 1.0, None)]
    got = {r.k: r for r in search.score(spark.createDataFrame(rows, "k string, y double, p double"), ["k"], "y", "p").collect()}
    assert got["a"].mape == pytest.approx(10.0) and got["a"].rmse == pytest.approx(2.5**0.5)
    assert got["a"].r2 == pytest.approx(0.9)
    assert got["zero"].mape is None and got["zero"].rmse == pytest.approx(0.5**0.5)
    assert got["gap"].rmse is None


def test_champion_order(spark):
    rows = [("a", "m1", 5.0, 1.0), ("a", "m2", 4.0, 9.0), ("b", "m1", None, 1.0), ("b", "m2", 90.0, 5.0), ("c", "m2", 1.0, 1.0), ("c", "m1", 1.0, 1.0), ("d", "m1", 1.0, None)]
    got = search.champion(spark.createDataFrame(rows, "k string, model string, mape double, rmse double"), ["k"])
    assert {r.k: r.model for r in got.collect()} == {"a": "m2", "b": "m2", "c": "m1"}


def test_design_follows_the_training_rows():
    train = pd.DataFrame({"x": [1.0, 3.0, np.nan], "none": [np.nan] * 3, "c": ["a", None, "b"]})
    test = pd.DataFrame({"x": [np.nan, 5.0], "none": [1.0, 2.0], "c": ["new", "b"]})
    a, b = M.design(train, test, ["x", "none", "c"])
    assert a.shape == (3, 4) and b.shape == (2, 4)  # x and three categories
    assert a[:, 0].mean() == pytest.approx(0) and b[0, 0] == pytest.approx(0)
    assert b[0, 1:].sum() == 0 and b[1, 1:].sum() == 1
    many = pd.DataFrame({"c": [f"v{i:02d}" for i in range(12)]})
    codes, new = M.design(many, pd.DataFrame({"c": ["v03", "zz"]}), ["c"])
    assert codes[:, 0].tolist() == list(range(12)) and new[:, 0].tolist() == [3, 12]


@pytest.mark.parametrize("name", ["linear", "ridge", "nearest", "huber", "poisson"])
def test_series_models_follow_a_trend(name):
    x = np.linspace(-1, 1, 40)[:, None]
    y = 50 + 10 * x[:, 0]
    pred = M.REGISTRY[name].fit_predict(x, y, np.array([[-0.5], [0.5]]))
    assert pred == pytest.approx([45, 55], abs=2)


def raw_panel(spark, months=14, feeders=("f1", "f2"), level=lambda f, i: 100.0 + i):
    rows = []
    for f in feeders:
        for i in range(months):
            year, month = divmod(2018 * 12 + 11 + i, 12)
            rows.append((f, year, month + 1, level(f, i), 1000.0, 300.0, 100.0, 200.0, 10.0 + i, None if i == 3 else 5.0))
    return spark.createDataFrame(
        rows,
        "cod_alim string, ano int, mes int, chi_total double, cons_conjunto double, qtde_cliente_total double, "
        "qtde_cliente_ru double, qtde_cliente_ub double, dec_cj double, vlr_qtd_arvore double",
    )


def members(spark, *feeders):
    return spark.createDataFrame([("C", f) for f in feeders], "sigla_conjunto string, alimentador string")


def runs(spark, pred=dt.date(2020, 2, 1), ahead=2):
    return spark.createDataFrame([("C", pred, ahead)], "conjunto string, pred_month date, months_ahead int")


def window(spark, goal=500.0, pred=dt.date(2020, 2, 1), ahead=2):
    return spark.createDataFrame([("C", pred, h, goal) for h in range(1, ahead + 1)], "conjunto string, pred_month date, horizon int, chi_goal double")


def test_panel_ends_before_the_date(spark):
    made = build_panel(raw_panel(spark, 16), members(spark, "f1"), runs(spark))
    rows = made.orderBy("month").collect()
    assert len(rows) == 14 and rows[-1].month == dt.date(2020, 1, 1)
    assert rows[3].vlr_qtd_arvore == 0 and rows[0].feeder_effect == pytest.approx(0.3)
    assert [r.month_weighted for r in rows[:6]] == [2, 2, 2, 2, 1, 1]


def test_rows_of_the_same_month_are_merged(spark):
    df = raw_panel(spark, 2, ("f1",))
    twice = one_row_per_month(df.unionByName(df))
    assert {(r.mes, r.chi_total, r.cons_conjunto) for r in twice.collect()} == {(12, 200.0, 1000.0), (1, 202.0, 1000.0)}
    assert sorted(map(tuple, one_row_per_month(df).collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_future_rows(spark):
    made = build_panel(raw_panel(spark, 14, ("f1",)), members(spark, "f1"), runs(spark, ahead=3))
    rows = future_rows(made, SERIES, F.col("months_ahead"), F.col("pred_month"), window(spark, ahead=3), RUN, []).orderBy("horizon").collect()
    assert [(r.ano, r.mes, r.month_weighted, r.chi_total) for r in rows] == [(2020, 2, 2, 0.0), (2020, 3, 2, 0.0), (2020, 4, 1, 0.0)]
    # the goal per consumer times the share, and the mean of earlier Februaries (the third month)
    assert rows[0].dec_cj == pytest.approx((500 / 1000 * 0.3 + 12.0) / 2)


def test_forecast_of_a_straight_line(spark):
    made = forecast(build_panel(raw_panel(spark, 14), members(spark, "f1", "f2"), runs(spark)), window(spark), ["mean", "median", "ols1"])
    rows = {(r.cod_alim, r.horizon): r for r in made.rows.collect()}
    assert len(rows) == 4 and made.errors.count() == 0
    first = rows["f1", 1]
    assert first.model == "ols1" and first.pred == pytest.approx(114.0) and rows["f1", 2].pred == pytest.approx(115.0)
    assert first.goal_chi == pytest.approx(150.0) and first.delta_chi == pytest.approx(36.0)
    assert first.delta_chi_percent == pytest.approx(0.24) and first.effect == pytest.approx(0.3)


def test_feeder_with_one_month_is_an_error_and_others_go_on(spark):
    raw = raw_panel(spark, 14, ("f1",)).unionByName(raw_panel(spark, 1, ("young",)))
    made = forecast(build_panel(raw, members(spark, "f1", "young"), runs(spark)), window(spark))
    assert {r.cod_alim for r in made.rows.collect()} == {"f1"}
    assert [(r.cod_alim, r.reason) for r in made.errors.collect()] == [("young", "no candidate could be scored")]


def test_zero_goal_has_no_percentage(spark):
    made = forecast(build_panel(raw_panel(spark, 14, ("f1",)), members(spark, "f1"), runs(spark)), window(spark, 0.0), ["mean"])
    assert [r.delta_chi_percent for r in made.rows.collect()] == [None, None]


def test_own_model_and_metric(spark):
    M.register_model(M.SeriesModel("always_7", lambda x, y, new: np.full(len(new), 7.0)))
    M.register_model(M.SeriesModel("broken", lambda x, y, new: np.full(len(new), 1 / (len(y) - len(y)))))
    try:
        panel = build_panel(raw_panel(spark, 14, level=lambda f, i: 7.0), members(spark, "f1", "f2"), runs(spark))
        made = forecast(panel, window(spark), ["always_7", "broken"])
        assert {(r.model, r.pred) for r in made.rows.collect()} == {("always_7", 7.0)}
        split = chrono_split(made.panel, SERIES, ["month"])
        worst = {"worst": F.max(F.abs(F.col("y") - F.col("pred")))}
        scored = search.evaluate_models(split, SERIES, ["dec_cj"], models=["always_7"], metrics=worst)
        assert {r.worst for r in scored.collect()} == {0.0}
    finally:
        del M.REGISTRY["always_7"], M.REGISTRY["broken"]
    with pytest.raises(KeyError):
        M.models_named(["always_7"])


def test_panel_models_enter_the_contest(spark):
    raw = raw_panel(spark, 14).withColumn("kind", F.when(F.col("cod_alim") == "f1", "x"))
    panel = build_panel(raw, members(spark, "f1", "f2"), runs(spark))
    made = forecast(panel, window(spark), ["mean", "panel_ridge", "panel_tree"])
    assert {r.model for r in made.scores.collect()} == {"mean", "panel_ridge", "panel_tree"}
    assert made.rows.count() == 4


def outages(spark, rows):
    return spark.createDataFrame(rows, "f string, id_interrupcao int, chi_tot double, grupo string, tag_urb_rur string")


def test_attribution_weights_and_cut(spark):
    half, most, structure = "50% avores/ 50% outros", "70% arvore / 30% outros", "manutencao estruturas"
    rows = (
        [("f", i, 10.0, half, "U") for i in range(3)]  # 1.5 -> 1
        + [("f", 10 + i, 10.0, most, "U") for i in range(3)]  # 2.1 -> 2
        + [("f", 20, 1.0, structure, "U"), ("f", 20, 1.0, structure, "R"), ("f", 21, 1.0, structure, None)]  # 2 ids over all tags
        + [("f", 30, 5.0, "arvore", "R"), ("f", 30, 5.0, "arvore", "R"), ("f", 31, 5.0, "arvore", None), ("f", 32, 5.0, "else", "U")]
    )
    got = {r.service: (r.cnt, r.chi) for r in attribute(outages(spark, rows), ["f"]).collect()}
    assert got["poda"] == (3, pytest.approx(30 * 0.5 + 30 * 0.7))
    assert got["faixa"] == (1, pytest.approx(10.0))
    assert got["estruturas"] == (2, pytest.approx(3.0))
    assert got["total"] == (11, pytest.approx(60 + 3 + 20))


def test_feeder_without_outages_has_zeros(spark):
    none = spark.createDataFrame([("f", None, None, None)], "f string, service string, cnt bigint, chi double")
    row = service_columns(none, ["f"]).first()
    assert (row.cnt_total, row.cnt_poda, row.chi_faixa, row.avg_estruturas) == (0, 0, 0.0, 0.0)


def test_highest_year_tie_goes_to_the_earliest(spark):
    rows = [("f", "poda", 3, 5), ("f", "poda", 1, 5), ("f", "poda", 0, 4), ("g", None, None, None)]
    df = spark.createDataFrame(rows, "f string, service string, back int, value bigint")
    got = {r.f: r for r in yearly_profile(df, ["f"], F.lit(2020), ["poda"], "us").collect()}
    assert (got["f"].poda_max_us, got["f"].poda_max_year_us, got["f"].poda_avg_us) == (5.0, 2017, 3.33)
    assert got["f"].poda_cur_year_us == 4.0 and got["f"]["poda_year-2_us"] == 0.0
    assert (got["g"].poda_max_us, got["g"].poda_max_year_us) == (0.0, 2017)


def test_goals(spark):
    wide = spark.createDataFrame([("C", "x", 1.0, 2.0, None), ("C", "y", 10.0, 20.0, 5.0)], "SIGLA string, parte string, `1/1/2020` double, `1/2/2020` double, `1/3/2020` double")
    long = goals_long(wide)
    assert long.count() == 6
    window_ = goal_window(monthly_goals(long), runs(spark, dt.date(2020, 2, 1), 3))
    got = {r.horizon: r.chi_goal for r in window_.collect()}
    assert len(got) == 12 and float(got[0]) == 11 and float(got[1]) == 22 and got[2] is None and got[-1] is None
    total = goal_totals(window_, ["conjunto"]).first()
    assert total.goal_total is None and total.goal_gaps == 10
    long_run = goal_window(monthly_goals(long), runs(spark, dt.date(2020, 1, 1), 14))
    assert long_run.count() == 14


def test_volumes(spark):
    cols = "chi_pred double, chi_goal double, chi_diff double, cnt_total bigint, cnt_poda bigint, cnt_faixa bigint, cnt_estruturas bigint, avg_poda double, avg_faixa double, avg_estruturas double"
    rows = [(110.0, 10.0, 100.0, 10, 5, 3, 0, 3.0, 10.0, 0.0), (10.0, 110.0, -100.0, 10, 5, 3, 0, 3.0, 10.0, 0.0), (110.0, 10.0, 100.0, 0, 0, 0, 0, 0.0, 0.0, 0.0)]
    made = suggest_volumes(spark.createDataFrame(rows, cols), {"poda": 1.0, "faixa": 0.5, "estruturas": 1.0}).collect()
    assert [(r.poda_sugg, r.faixa_sugg, r.estruturas_sugg) for r in made] == [(16, 2, 0), (0, 0, 0), (0, 0, 0)]


def test_cardinality(spark):
    df = spark.createDataFrame([(f"v{i}", "x" if i % 2 else None) for i in range(12)], "a string, b string")
    got = {r.name: (r.n_distinct, r.high) for r in R.cardinality_split(df, ["a", "b"]).collect()}
    assert got == {"a": (12, True), "b": (1, False)}
    assert R.cardinality_split(df, []).count() == 0


def test_large_outages(spark):
    """Sums of amounts beyond nine digits of millionths stay exact."""
    from gridtide.operators.attribution import attribute

    rows = [("f", k, 5e12, "70% arvore / 30% outros", "U") for k in range(3)] + [("f", 9, 0.000001, "arvore", "U")]
    events = spark.createDataFrame(rows, "cod_alim string, id_interrupcao long, chi_tot double, grupo string, tag_urb_rur string")
    got = {r.service: (r.cnt, r.chi) for r in attribute(events, ["cod_alim"]).collect()}
    assert got == {"total": (4, 1.5e13 + 0.000001), "poda": (3, 1.05e13 + 0.000001)}


def test_trees_and_penalties():
    from gridtide.operators import series_models as S

    draw = np.random.default_rng(4)
    x, new = draw.normal(size=(60, 6)), draw.normal(size=(30, 6))
    truth = lambda a: 4 * (a[:, 1] > 0.2) + 2 * a[:, 0]
    y = truth(x)
    blind = np.sqrt(((truth(new) - y.mean()) ** 2).mean())
    for fit in (S.one_tree, S.forest, S.boosted, S.lasso, S.elastic_net):
        pred = fit(x, y, new)
        assert np.sqrt(((pred - truth(new)) ** 2).mean()) < 0.9 * blind
        assert (fit(x, y, new) == pred).all()
        assert fit(x[:1], y[:1], new[:2]) == pytest.approx([y[0]] * 2)
        assert fit(np.zeros((5, 0)), np.arange(5.0), np.zeros((2, 0))) == pytest.approx([2.0, 2.0], abs=1.0)
    feature, limit, low, high = S.grow(np.array([[1.0], [2.0], [3.0], [4.0]]), np.array([0.0, 0, 10, 10]), 3)
    assert (feature, limit, low, high) == (0, 2.5, 0.0, 10.0)
    plain = np.linalg.lstsq(np.column_stack([np.ones(60), x]), 2 * x[:, 0] + 1, rcond=None)[0]
    assert S.elastic_net(x, 2 * x[:, 0] + 1, x, alpha=0.0) == pytest.approx(np.column_stack([np.ones(60), x]) @ plain)


def test_metrics_and_test_predictions_reach_the_caller(spark):
    rows = [("C", dt.date(2020, 2, 1), "f", 1, dt.date(2018, 1 + k % 12, 1) if k < 12 else dt.date(2019, 1 + k % 12, 1), 100.0 + k, 0.5) for k in range(24)]
    panel = spark.createDataFrame(rows, "conjunto string, pred_month date, cod_alim string, months_ahead int, month date, chi_total double, feeder_effect double")
    panel = panel.withColumns({"ano": F.year("month"), "mes": F.month("month"), "cons_conjunto": F.lit(1.0), "qtde_cliente_total": F.lit(1.0), "qtde_cliente_ru": F.lit(1.0), "qtde_cliente_ub": F.lit(1.0), "DESCR_NOVO": F.lit("C"), "month_weighted": F.lit(1)})
    goals = spark.createDataFrame([("C", dt.date(2020, 2, 1), dt.date(2020, 2, 1), 1, 10.0)], "conjunto string, pred_month date, month date, horizon int, chi_goal double")
    made = forecast(panel, goals, ["mean", "tree"], metrics={"worst": F.max(F.abs(F.col("y") - F.col("pred")))})
    assert {r.model for r in made.tests.collect()} == {"mean", "tree"} and made.tests.count() == 6
    assert all(r.worst >= r.rmse for r in made.scores.collect())


def test_prepared_features(spark):
    """Numbers filled and scaled as by hand, few values as flags, many as codes from a table, new ones apart."""
    rows = [(float(i) if i % 5 else None, "ab"[i % 2], f"v{i:02d}", float("nan"), 3.0) for i in range(40)]
    schema = "x double, few string, many string, gap double, flat double"
    train = spark.createDataFrame(rows, schema)
    made = M.prepare(train, ["x", "few", "many", "gap", "flat"])
    assert made.sizes == {"few": 2, "many": 40} and set(made.numbers) == {"x", "flat"} and made.codes.count() == 42
    new = spark.createDataFrame([(None, "a", "v07", 1.0, 9.0), (12.0, "z", "other", 1.0, 3.0), (1.0, None, None, None, None)], schema)
    got = [r["__features"].toArray().tolist() for r in made.transform(new).collect()]
    known = [r[0] for r in rows if r[0] is not None]
    filled = np.array([r[0] if r[0] is not None else np.mean(known) for r in rows])
    scale = lambda v: (v - np.mean(known)) / filled.std(ddof=1)
    expected = [[0.0, 0.0, 1.0, 0.0, 7.0], [scale(12.0), 0.0, 0.0, 0.0, 40.0], [scale(1.0), 0.0, 0.0, 0.0, 40.0]]
    assert sorted(got) == [pytest.approx(e) for e in sorted(expected)]
    assert M.prepare(train, []).transform(new).first()["__features"].size == 0
