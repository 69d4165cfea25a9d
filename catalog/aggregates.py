"""E: aggregates, attribution and yearly statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import Data, check
from catalog.bindings import AHEAD, ASOF
from catalog.relational import GOALS, PANEL, PANEL_USES, goals, panel, text_dates
from gridtide.operators.attribution import SERVICES, attribute, service_columns, with_cause
from gridtide.operators.goals import goal_totals, goals_long, monthly_goals
from gridtide.operators.search import score
from gridtide.operators.suggestions import horizon_totals, recent_actuals
from gridtide.operators.yearly import MAINTENANCE_SERVICES, years_back, yearly_profile, yearly_units
from gridtide.plans.forecast import set_totals
from gridtide.plans.panel import first_months
from gridtide.plans.suggest import attributed_outages, maintenance_profile, outage_profile

FEEDER = ["pred_month", "cod_alim"]

# Outages with their cause group, and the cells they count in.
CAUSED = f"""
, caused AS (
  SELECT cod_alim, id_interrupcao, dat_inicio, chi_tot, tag_urb_rur,
         CASE cod_grupo WHEN 'ECONOMY' THEN 'arvore' WHEN 'LARGE' THEN 'manutencao estruturas'
              WHEN 'MEDIUM' THEN '50% avores/ 50% outros' WHEN 'PROMO' THEN '70% arvore / 30% outros'
              ELSE 'outros' END AS grupo
  FROM outages JOIN causes ON cod_grupo = num_idt_grupo_causas AND cod_causa = num_idt_causa_interrupcao)
, periods AS (
  SELECT *, 'trailing' AS period FROM caused WHERE dat_inicio >= DATE '{ASOF}' - INTERVAL 12 MONTH AND dat_inicio < DATE '{ASOF}'
  UNION ALL
  SELECT *, CAST(year(DATE '{ASOF}') - year(dat_inicio) AS VARCHAR) FROM caused
  WHERE year(DATE '{ASOF}') - year(dat_inicio) BETWEEN 1 AND 3)
, tagged AS (
  SELECT cod_alim, period, grupo, tag_urb_rur AS tag, count(DISTINCT id_interrupcao) AS n, sum(chi_tot) AS chi
  FROM periods GROUP BY cod_alim, period, grupo, tag_urb_rur
  UNION ALL
  SELECT cod_alim, period, grupo, '*', count(DISTINCT id_interrupcao), sum(chi_tot)
  FROM periods GROUP BY cod_alim, period, grupo)
, rules(grupo, tag, service, w) AS (VALUES
    ('arvore', 'U', 'poda', CAST(1.0 AS DECIMAL(4,2))), ('arvore', 'R', 'faixa', 1.0),
    ('manutencao estruturas', '*', 'estruturas', 1.0),
    ('50% avores/ 50% outros', 'U', 'poda', 0.5), ('50% avores/ 50% outros', 'R', 'faixa', 0.5),
    ('70% arvore / 30% outros', 'U', 'poda', 0.7), ('70% arvore / 30% outros', 'R', 'faixa', 0.7))
, attributed AS (
  SELECT cod_alim, period, service, CAST(sum(CAST(trunc(n * CAST(w AS DOUBLE)) AS BIGINT)) AS BIGINT) AS cnt,
         CAST(sum(chi * w) AS DOUBLE) AS chi
  FROM tagged JOIN rules USING (grupo, tag) GROUP BY cod_alim, period, service
  UNION ALL
  SELECT cod_alim, period, 'total', count(DISTINCT id_interrupcao), CAST(sum(chi_tot) AS DOUBLE)
  FROM periods GROUP BY cod_alim, period)
"""
CAUSED_USES = ("outages", "causes")


def feeders(data: Data):
    return data["feeders"].select(*FEEDER)


def trailing(data: Data):
    asof = F.lit(ASOF).cast("timestamp_ntz")
    start = F.add_months(asof, -12).cast("timestamp_ntz")
    recent = data["outages"].where((F.col("dat_inicio") >= start) & (F.col("dat_inicio") < asof))
    return with_cause(recent, data["causes"])


@check(
    "E1_trailing_totals",
    CAUSED + "SELECT cod_alim, cnt, chi FROM attributed WHERE period = 'trailing' AND service = 'total'",
    CAUSED_USES,
)
def _(data):
    return attribute(trailing(data), ["cod_alim"], rules=()).drop("service")


@check(
    "E2_weighted_attribution",
    CAUSED + "SELECT cod_alim, service, cnt, chi FROM attributed WHERE period = 'trailing'",
    CAUSED_USES,
)
def _(data):
    return attribute(trailing(data), ["cod_alim"])


@check(
    "E3_mean_impact",
    CAUSED
    + "SELECT cod_alim, "
    + ", ".join(
        f"max(CASE WHEN service = '{s}' THEN CASE WHEN cnt = 0 THEN CAST(0 AS DOUBLE) ELSE chi / cnt END END) AS avg_{s}"
        for s in SERVICES
    )
    + " FROM attributed WHERE period = 'trailing' GROUP BY cod_alim",
    CAUSED_USES,
)
def _(data):
    wide = service_columns(attribute(trailing(data), ["cod_alim"]), ["cod_alim"])
    return wide.select("cod_alim", *[f"avg_{s}" for s in SERVICES])


UNITS = f"""
, units AS (
  SELECT cod_alim, CASE grupo_dataset_servico WHEN 'PODA' THEN 'poda' WHEN 'FAIXA' THEN 'faixa' ELSE 'estruturas' END AS service,
         year(DATE '{ASOF}') - year(dat_execucao) AS back, sum(coalesce(us_pontos, 0) + coalesce(vlr_us_servico, 0)) AS value
  FROM maintenance WHERE year(DATE '{ASOF}') - year(dat_execucao) BETWEEN 0 AND 3 GROUP BY ALL)
"""


@check(
    "E4_yearly_units",
    UNITS + "SELECT cod_alim, service, back, CAST(value AS DOUBLE) AS value FROM units",
    ("maintenance",),
)
def _(data):
    names = F.create_map(*[F.lit(x) for pair in MAINTENANCE_SERVICES.items() for x in pair])
    yearly = yearly_units(
        data["maintenance"],
        ["cod_alim"],
        years_back(F.col("dat_execucao"), F.lit(ASOF).cast("date")),
        F.try_element_at(names, F.col("grupo_dataset_servico")),
    )
    return yearly.withColumn("value", F.col("value").cast("double"))


@check(
    "E5_yearly_attributed_events",
    CAUSED + "SELECT cod_alim, service, CAST(period AS INT) AS back, cnt FROM attributed WHERE period <> 'trailing'",
    CAUSED_USES,
)
def _(data):
    made = attributed_outages(data["outages"], data["causes"], feeders(data)).where("period <> 'trailing'")
    return made.select("cod_alim", "service", F.col("period").cast("int").alias("back"), "cnt")


def profile_sql(source: str, value: str, service: str, suffix: str, offsets, money: bool) -> list[str]:
    at = {k: f"coalesce(sum(CASE WHEN service = '{service}' AND back = {k} THEN {value} END), 0)" for k in offsets}
    shown = (lambda x: f"round_even(CAST({x} AS DOUBLE), 2)") if money else (lambda x: f"CAST({x} AS BIGINT)")
    best = f"greatest({', '.join(at.values())})"
    year = "CASE " + " ".join(f"WHEN {at[k]} = {best} THEN 2000 - {k}" for k in offsets) + " END"
    cols = [
        f"round_even(CAST({at[1]} + {at[2]} + {at[3]} AS DOUBLE) / 3, 2) AS \"{service}_avg_{suffix}\"",
        f"{shown(best)} AS \"{service}_max_{suffix}\"",
        f"{year} AS \"{service}_max_year_{suffix}\"",
    ]
    for k in offsets:
        name = f"{service}_cur_year_{suffix}" if k == 0 else f"{service}_year-{k}_{suffix}"
        cols.append(f'{shown(at[k])} AS "{name}"')
    return cols


UNIT_COLUMNS = [c for s in SERVICES for c in profile_sql("units", "value", s, "us", (3, 2, 1, 0), True)]
EVENT_COLUMNS = [c for s in SERVICES for c in profile_sql("attributed", "cnt", s, "interup", (3, 2, 1), False)]


@check(
    "E6_E7_unit_profile",
    UNITS + f"SELECT f.cod_alim, {', '.join(UNIT_COLUMNS)} FROM feeders f LEFT JOIN units u ON f.cod_alim = u.cod_alim GROUP BY f.cod_alim",
    ("maintenance", "feeders"),
)
def _(data):
    return maintenance_profile(data["maintenance"], feeders(data)).drop("pred_month")


@check(
    "E6_E7_event_profile",
    CAUSED
    + f", yearly AS (SELECT cod_alim, service, CAST(period AS INT) AS back, cnt FROM attributed WHERE period <> 'trailing') "
    f"SELECT f.cod_alim, {', '.join(EVENT_COLUMNS)} FROM feeders f LEFT JOIN yearly y ON f.cod_alim = y.cod_alim GROUP BY f.cod_alim",
    (*CAUSED_USES, "feeders"),
)
def _(data):
    made = attributed_outages(data["outages"], data["causes"], feeders(data))
    return outage_profile(made, feeders(data)).drop("pred_month")


@check(
    "E7_highest_year",
    """SELECT l_suppkey, max(v) AS best, min(CASE WHEN v = top THEN y END) AS best_year FROM (
         SELECT *, max(v) OVER (PARTITION BY l_suppkey) AS top FROM (
           SELECT l_suppkey, year(l_shipdate) AS y, count(*) // 20 AS v FROM lineitem
           WHERE year(l_shipdate) BETWEEN 1997 AND 2000 GROUP BY l_suppkey, year(l_shipdate))) GROUP BY l_suppkey""",
)
def _(data):
    """Counts in twenties, so that years tie."""
    back = F.lit(2000) - F.year("l_shipdate")
    yearly = data["lineitem"].select("l_suppkey", back.alias("back")).where(F.col("back").between(0, 3))
    yearly = yearly.groupBy("l_suppkey", "back").agg(F.floor(F.count("*") / 20).alias("value")).withColumn("service", F.lit("x"))
    made = yearly_profile(yearly, ["l_suppkey"], F.lit(2000), ["x"], "n", (3, 2, 1, 0), None)
    return made.select("l_suppkey", F.col("x_max_n").alias("best"), F.col("x_max_year_n").alias("best_year"))


@check(
    "E12_monthly_goals",
    GOALS + "SELECT conjunto, CAST(month AS VARCHAR) AS month, chi_goal FROM goals",
    ("goals_wide", "runs"),
)
def _(data):
    monthly = monthly_goals(goals_long(data["goals_wide"])).withColumnRenamed("SIGLA", "conjunto")
    return text_dates(monthly.withColumn("chi_goal", F.col("chi_goal").cast("double")))


@check(
    "E12_goal_totals",
    GOALS + "SELECT conjunto, CAST(sum(CAST(chi_goal AS DECIMAL(24,6))) AS DOUBLE) AS goal_total FROM goals GROUP BY conjunto",
    ("goals_wide", "runs"),
)
def _(data):
    return goal_totals(goals(data), ["conjunto"]).select("conjunto", F.col("goal_total").cast("double").alias("goal_total"))


# Prices stand for predictions, the line number for the horizon.
_PREDS = """, preds AS (SELECT l_suppkey % 5 AS conjunto, l_suppkey AS cod_alim, l_linenumber AS horizon,
     CAST(l_extendedprice AS DECIMAL(24,6)) AS pred FROM lineitem) """


def _preds(data: Data):
    return data["lineitem"].select(
        (F.col("l_suppkey") % 5).alias("conjunto"),
        F.lit(ASOF).cast("date").alias("pred_month"),
        F.col("l_suppkey").alias("cod_alim"),
        F.col("l_linenumber").alias("horizon"),
        F.col("l_extendedprice").alias("pred"),
    )


@check(
    "E13_horizon_totals",
    _PREDS + "SELECT cod_alim, CAST(sum(pred) AS DOUBLE) AS pred_total FROM preds GROUP BY cod_alim",
)
def _(data):
    return horizon_totals(_preds(data), ["cod_alim"])


@check(
    "E13_set_totals",
    _PREDS + "SELECT conjunto, horizon, CAST(sum(pred) AS DOUBLE) AS set_pred FROM preds GROUP BY conjunto, horizon",
)
def _(data):
    return set_totals(_preds(data)).drop("pred_month")


@check(
    "E14_recent_actuals",
    PANEL
    + f"""SELECT conjunto, cod_alim, CAST(coalesce(sum(CASE WHEN month >= pred_month - INTERVAL {12 - AHEAD} MONTH
            THEN CAST(chi_total AS DECIMAL(24,6)) END), 0) AS DOUBLE) AS actual_total FROM panel GROUP BY conjunto, cod_alim""",
    PANEL_USES,
)
def _(data):
    return recent_actuals(
        panel(data), ["conjunto", "pred_month", "cod_alim"], F.lit(AHEAD)
    ).drop("pred_month")


@check(
    "E15_first_month",
    PANEL + "SELECT conjunto, CAST(min(month) AS VARCHAR) AS first_month FROM panel GROUP BY conjunto",
    PANEL_USES,
)
def _(data):
    return text_dates(first_months(panel(data)).drop("pred_month"))


@check(
    "E16_error_metrics",
    """SELECT l_suppkey, count(*) AS n,
              CASE WHEN min(l_discount) > 0 THEN round(avg(abs((l_discount - l_tax) / nullif(l_discount, 0))) * 100, 6) END AS mape_discount,
              round(avg(abs((l_quantity - l_linenumber) / l_quantity)) * 100, 6) AS mape,
              round(sqrt(avg(pow(l_quantity - l_linenumber, 2))), 6) AS rmse,
              round(1 - sum(pow(l_quantity - l_linenumber, 2)) / (var_pop(l_quantity) * count(*)), 6) AS r2,
              round(1 - (sum(pow(l_quantity - l_linenumber, 2)) / (var_pop(l_quantity) * count(*))) * (count(*) - 1) / (count(*) - 4), 6) AS adj_r2,
              round(avg(abs(l_quantity - l_linenumber)), 6) AS mae
       FROM lineitem GROUP BY l_suppkey""",
)
def _(data):
    keys = ["l_suppkey"]
    mae = {"mae": F.avg(F.abs(F.col("l_quantity") - F.col("l_linenumber")))}
    own = score(data["lineitem"], keys, "l_quantity", "l_linenumber", 3, mae)
    zeros = score(data["lineitem"], keys, "l_discount", "l_tax").select(*keys, F.col("mape").alias("mape_discount"))
    shown = own.join(zeros, keys)
    return shown.select("l_suppkey", "n", *[F.round(c, 6).alias(c) for c in ("mape_discount", "mape", "rmse", "r2", "adj_r2", "mae")])
