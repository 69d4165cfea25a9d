"""J: whole jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import Data, check
from catalog.aggregates import CAUSED, CAUSED_USES, EVENT_COLUMNS, UNIT_COLUMNS, UNITS
from catalog.allocation import ELIGIBLE, MONTHS, RANK, US, month_sql, scaled_sql, volume_sql
from catalog.bindings import AHEAD, ASOF
from catalog.modelling import FORECAST, FORECAST_USES, SQL_MODELS
from catalog.relational import PANEL, PANEL_USES, goals, panel, text_dates
from catalog.sources import inspections
from gridtide.functions.text import feeder_code
from gridtide.operators.attribution import SERVICES
from gridtide.plans import envelope
from gridtide.plans.assign import assign, assignment_mode
from gridtide.plans.forecast import forecast
from gridtide.plans.panel import panel_with_weather
from gridtide.plans.requests import run_requests
from gridtide.plans.suggest import suggest
from gridtide.sources.tables import Tables

COEFS = {"poda": 1.5, "faixa": 0.5, "estruturas": 2.0}


@check(
    "J1_panel",
    PANEL
    + """SELECT conjunto, cod_alim, ano, mes, chi_total, cons_conjunto, qtde_cliente_total, qtde_cliente_ru, qtde_cliente_ub,
                dec_cj, vlr_qtd_arvore, CAST(month AS VARCHAR) AS month, DESCR_NOVO, feeder_effect, month_weighted FROM panel""",
    PANEL_USES,
)
def _(data):
    return text_dates(panel(data).drop("pred_month", "months_ahead"))


@check(
    "J1_panel_with_weather",
    PANEL
    + """, first AS (SELECT conjunto, min(month) AS first_month FROM panel GROUP BY conjunto)
         SELECT p.conjunto, cod_alim, ano, mes, chi_total, feeder_effect, CAST(0 AS DOUBLE) AS windvelo_mean FROM panel p JOIN first f ON p.conjunto = f.conjunto
         WHERE month >= first_month""",
    PANEL_USES,
)
def _(data):
    """Interpolation gives each month of the history, so the panel keeps all its rows."""
    points = data["feeder_points"].withColumnRenamed("code", "cod_alim")
    made, _errors = panel_with_weather(
        data["panel_raw"], data["feeder_set"], data["runs"], points, data["stations"], data["station_history"]
    )
    return made.select("conjunto", "cod_alim", "ano", "mes", "chi_total", "feeder_effect", "windvelo_mean")


def requests(data: Data):
    return data["runs"].withColumn("request_id", F.concat(F.lit("r:"), "conjunto"))


_TOTAL = {s: f"max(CASE WHEN service = '{s}' THEN cnt END)" for s in (*SERVICES, "total")}
_GAP = (
    FORECAST
    + CAUSED
    + UNITS
    + f"""
, cause_cols AS (SELECT cod_alim, {", ".join(f"coalesce(max(CASE WHEN service = '{s}' THEN cnt END), 0) AS cnt_{s}, coalesce(max(CASE WHEN service = '{s}' THEN chi END), 0) AS chi_{s}" for s in (*SERVICES, "total"))}
    FROM attributed WHERE period = 'trailing' GROUP BY cod_alim)
, pred_totals AS (SELECT conjunto, cod_alim, CAST(sum(CAST(pred AS DECIMAL(24,6))) AS DOUBLE) AS pred_total, max(effect) AS effect FROM forecast GROUP BY conjunto, cod_alim)
, actuals AS (SELECT conjunto, cod_alim, CAST(coalesce(sum(CASE WHEN month >= pred_month - INTERVAL {12 - AHEAD} MONTH THEN CAST(chi_total AS DECIMAL(24,6)) END), 0) AS DOUBLE) AS actual_total
    FROM panel GROUP BY conjunto, cod_alim)
, goal_sums AS (SELECT conjunto, CAST(sum(CAST(chi_goal AS DECIMAL(24,6))) AS DOUBLE) AS goal_total FROM goals GROUP BY conjunto)
, gap AS (SELECT p.conjunto, p.cod_alim, actual_total + pred_total AS chi_pred, goal_total * effect AS chi_goal,
     {", ".join(f"coalesce(cnt_{s}, 0) AS cnt_{s}, CASE WHEN coalesce(cnt_{s}, 0) = 0 THEN CAST(0 AS DOUBLE) ELSE chi_{s} / cnt_{s} END AS avg_{s}" for s in SERVICES)},
     coalesce(cnt_total, 0) AS cnt_total
  FROM pred_totals p JOIN actuals a ON p.conjunto = a.conjunto AND p.cod_alim = a.cod_alim JOIN goal_sums g ON p.conjunto = g.conjunto
       LEFT JOIN cause_cols c ON p.cod_alim = c.cod_alim)
, unit_cols AS (SELECT f.cod_alim, {', '.join(UNIT_COLUMNS)} FROM feeders f LEFT JOIN units u ON f.cod_alim = u.cod_alim GROUP BY f.cod_alim)
, yearly AS (SELECT cod_alim, service, CAST(period AS INT) AS back, cnt FROM attributed WHERE period <> 'trailing')
, event_cols AS (SELECT f.cod_alim, {', '.join(EVENT_COLUMNS)} FROM feeders f LEFT JOIN yearly y ON f.cod_alim = y.cod_alim GROUP BY f.cod_alim)
"""
)
SUGGEST_USES = (*FORECAST_USES, *CAUSED_USES, "maintenance")
SUGGEST = (
    _GAP
    + f"""SELECT concat('r:', conjunto) AS request_id, conjunto, gap.cod_alim, '1/2000' AS "from", '2/2000' AS "to",
       round_even(chi_pred, 2) AS chi_pred, round_even(chi_goal, 2) AS chi_goal, round_even(chi_pred - chi_goal, 2) AS chi_diff, 0 AS goal_gaps,
       {', '.join(f'{scaled_sql(volume_sql(s), c)} AS {s}_sugg' for s, c in COEFS.items())},
       unit_cols.* EXCLUDE (cod_alim), event_cols.* EXCLUDE (cod_alim)
FROM gap JOIN unit_cols ON gap.cod_alim = unit_cols.cod_alim JOIN event_cols ON gap.cod_alim = event_cols.cod_alim"""
)


def suggestions(data: Data):
    made = forecast(panel(data), goals(data), SQL_MODELS)
    window = goals(data).join(requests(data).select("request_id", "conjunto"), "conjunto")
    return suggest(
        requests(data), made.panel, made.rows, window, data["outages"], data["causes"], data["maintenance"], COEFS
    )


@check("J4_suggestions", SUGGEST, SUGGEST_USES)
def _(data):
    return suggestions(data)


@check(
    "I8_suggestion_periods",
    SUGGEST.replace("SELECT concat('r:', conjunto) AS request_id", "SELECT concat('r:', conjunto) AS request_id", 1).split("round_even(chi_pred, 2) AS chi_pred")[0]
    + "round_even(chi_pred, 2) AS chi_pred, round_even(chi_goal, 2) AS chi_goal, round_even(chi_pred - chi_goal, 2) AS chi_diff FROM gap",
    SUGGEST_USES,
)
def _(data):
    return suggestions(data).select(
        "request_id", "conjunto", "cod_alim", "from", "to", "chi_pred", "chi_goal", "chi_diff"
    )


@check("A9_suggestion_envelope")
def _(data):
    return envelope.suggestion_envelope(suggestions(data), F.lit("2000-01-01").cast("timestamp_ntz"))


@check(
    "I5_assignment_mode",
    FORECAST
    + """, totals AS (SELECT conjunto, horizon, CAST(sum(CAST(pred AS DECIMAL(24,6))) AS DOUBLE) AS set_pred FROM forecast GROUP BY conjunto, horizon)
         SELECT t.conjunto, t.horizon, CASE WHEN chi_goal >= set_pred THEN 1 ELSE 0 END AS by_feeder
         FROM totals t JOIN goals g ON t.conjunto = g.conjunto AND t.horizon = g.horizon""",
    FORECAST_USES,
)
def _(data):
    modes = assignment_mode(forecast(panel(data), goals(data), SQL_MODELS).rows, goals(data))
    return modes.select("conjunto", "horizon", F.col("by_feeder").cast("int").alias("by_feeder"))


# What both assignment jobs share, from the forecast to the plan of each month.
_PLAN = """
, totals AS (SELECT conjunto, horizon, CAST(sum(CAST(pred AS DECIMAL(24,6))) AS DOUBLE) AS set_pred FROM forecast GROUP BY conjunto, horizon)
, plan AS (SELECT f.conjunto, f.cod_alim AS feeder, f.horizon, effect, round_even((goal_chi - pred) / nullif(goal_chi, 0), 2) AS delta,
     chi_goal >= set_pred AS by_feeder FROM forecast f JOIN totals t ON f.conjunto = t.conjunto AND f.horizon = t.horizon
     JOIN goals g ON f.conjunto = g.conjunto AND f.horizon = g.horizon)
"""
_OPEN = ", us1 AS (SELECT r_name AS conjunto, CAST({} AS DOUBLE) AS us FROM region), open1 AS (SELECT * FROM eligible)"
_ASSIGN = (
    FORECAST
    + ELIGIBLE
    + _PLAN
    + _OPEN.format(US)
    + month_sql(1)
    + month_sql(2)
    + "/*recursive*/ "
    + " UNION ALL ".join(
        f"""SELECT concat('r:', conjunto) AS request_id, conjunto, p.feeder, p.idservico, {m} AS horizon, prioridade,
            status_servico AS "status servico", CAST(us_servico AS DOUBLE) AS "us servico", CAST(date_time AS VARCHAR) AS date_time
            FROM picks{m} p JOIN tasks t ON p.idservico = t.idservico"""
        for m in (1, 2)
    )
)


@check("J5_assigned_tasks", _ASSIGN, (*FORECAST_USES, "tasks", "feeder_set"))
def _(data):
    made = forecast(panel(data), goals(data), SQL_MODELS)
    asked = requests(data).drop("months_ahead").withColumn("us_services", F.lit(float(US)))
    tasks = data["tasks"].withColumnsRenamed({"status_servico": "status servico", "us_servico": "us servico"})
    picked = assign(asked, made.rows, goals(data), tasks, MONTHS)
    return text_dates(picked.withColumn("us servico", F.col("us servico").cast("double")))


def batch_tables(data: Data, times: int = 1, ghosts: bool = False, weather: bool = False) -> Tables:
    """All tables of a batch, feeders named by code as in the inspections.

    `times`: how often each inspection row is there; `ghosts` adds a feeder without rows to each set; `weather`
    binds the stations, too, and makes the panel one with weather.
    """
    named = lambda c: feeder_code(F.lit("F"), F.col(c))
    tasks = inspections(data).withColumns({"se": F.lit("F"), "alimentador": F.substring("se", 3, 9)})
    tasks = tasks.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(times)))).drop("copy")
    members = data["feeder_set"].withColumn("alimentador", named("alimentador"))
    if ghosts:
        members = members.unionByName(members.select("sigla_conjunto", F.lit("F99").alias("alimentador")).distinct())
    feeder = {n: data[n].withColumn("cod_alim", named("cod_alim")) for n in ("panel_raw", "outages", "maintenance")}
    sites = {n: data[n] for n in ("stations", "station_history")} if weather else {}
    points = {"feeder_points": data["feeder_points"].select(named("code").alias("cod_alim"), "longitude", "latitude")} if weather else {}
    return Tables(
        data.spark,
        sites
        | points
        | {
            "panel": feeder["panel_raw"],
            "feeder_set": members,
            "goals": data["goals_wide"],
            "outages": feeder["outages"],
            "causes": data["causes"],
            "maintenance": feeder["maintenance"],
            "inspections": tasks,
        },
    )


def batch(data: Data, repeated: int = 1, id_col: str | None = "id", models: list[str] | None = SQL_MODELS, **options):
    """A suggestion and a task assignment for every set, in one document, and a bad request."""
    item = F.concat(
        F.lit('{"algorithm":"suggestion","conjunto":"'), "r_name",
        F.lit(f'","pred_year":{ASOF[:4]},"pred_month":{int(ASOF[5:7])},"months_ahead":{AHEAD}}},'),
        F.lit('{"algorithm":"Prediction","conjunto":"'), "r_name",
        F.lit(f'","pred_year":{ASOF[:4]},"pred_month":"{int(ASOF[5:7])}","us_services":"150"}}'),
    )
    payloads = data["region"].select(
        F.col("r_regionkey").alias("id"),
        F.concat(F.lit('{"array":['), item, F.lit(',{"algorithm":"other"}]}')).alias("value"),
    )
    payloads = payloads.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(repeated)))).drop("copy")
    return run_requests(batch_tables(data, **options), payloads, COEFS, 60, id_col=id_col, models=models)


@check(
    "J6_batch_suggestions",
    SUGGEST.replace("concat('r:', conjunto) AS request_id, conjunto, gap.cod_alim,", "concat((SELECT r_regionkey FROM region WHERE r_name = conjunto), ':0') AS request_id, conjunto, concat('F', lpad(CAST(gap.cod_alim AS VARCHAR), 2, '0')) AS cod_alim,"),
    SUGGEST_USES,
)
def _(data):
    return batch(data).suggestions


@check(
    "J6_repeated_documents",
    SUGGEST.replace("concat('r:', conjunto) AS request_id, conjunto, gap.cod_alim,", "conjunto, concat('F', lpad(CAST(gap.cod_alim AS VARCHAR), 2, '0')) AS cod_alim,"),
    SUGGEST_USES,
)
def _(data):
    """Equal documents count once: the numbers are those of a single one."""
    return batch(data, repeated=3, id_col=None).suggestions.drop("request_id")


@check(
    "J6_repeated_task_rows",
    "SELECT r_name AS conjunto, 0 AS over_budget, 0 AS handed_out_twice FROM region",
)
def _(data):
    """Inspections that are there twice: no budget is exceeded, and no task is handed out twice."""
    sets = data["region"].select(F.col("r_name").alias("conjunto"))
    spent = batch(data, times=2).tasks.groupBy("conjunto").agg(
        F.sum(F.col("us servico").cast("decimal(24,6)")).alias("us"),
        (F.count("*") - F.count_distinct("feeder", "idservico")).alias("twice"),
    )
    over = (F.coalesce("us", F.lit(0)) > 150).cast("int").alias("over_budget")
    return sets.join(spent, "conjunto", "left").select("conjunto", over, F.coalesce("twice", F.lit(0)).cast("int").alias("handed_out_twice"))


@check(
    "J6_feeders_accounted_for",
    """SELECT sigla_conjunto AS conjunto, concat('F', lpad(CAST(alimentador AS VARCHAR), 2, '0')) AS cod_alim, 1 AS delivered, 0 AS reported FROM feeder_set
       UNION ALL SELECT DISTINCT sigla_conjunto, 'F99', 0, 1 FROM feeder_set""",
    ("feeder_set",),
)
def _(data):
    """Each feeder of a set is delivered or reported, never both and never neither."""
    made = batch(data, ghosts=True)
    feeder = ["conjunto", "cod_alim"]
    delivered = made.suggestions.select(*feeder, F.lit(1).alias("delivered"), F.lit(0).alias("reported"))
    reported = made.errors.where("cod_alim IS NOT NULL AND month IS NULL").select(*feeder, F.lit(0).alias("delivered"), F.lit(1).alias("reported"))
    return delivered.unionByName(reported).groupBy(*feeder).agg(*[F.sum(c).cast("int").alias(c) for c in ("delivered", "reported")])


@check(
    "J6_batch_with_everything",
    """SELECT sigla_conjunto AS conjunto, concat('F', lpad(CAST(alimentador AS VARCHAR), 2, '0')) AS cod_alim, 1 AS accounted, 0 AS over_budget FROM feeder_set
       UNION ALL SELECT DISTINCT sigla_conjunto, 'F99', 1, 0 FROM feeder_set""",
    ("feeder_set",),
)
def _(data):
    """Weather in the panel, all default candidates, suggestions and tasks in one job: every feeder is delivered or
    reported, once, and the tasks of no set cost more than its budget."""
    made = batch(data, models=None, ghosts=True, weather=True)
    feeder = ["conjunto", "cod_alim"]
    reported = made.errors.where("cod_alim IS NOT NULL AND month IS NULL").select(*feeder)
    counted = made.suggestions.select(*feeder).unionByName(reported).groupBy(*feeder).agg(F.count("*").cast("int").alias("accounted"))
    spent = made.tasks.groupBy("conjunto").agg(F.sum(F.col("us servico").cast("decimal(24,6)")).alias("us"))
    over = (F.coalesce("us", F.lit(0)) > 150).cast("int").alias("over_budget")
    return counted.join(spent, "conjunto", "left").select(*feeder, "accounted", over)


_BATCH_TASKS = (
    FORECAST
    + f"""
, eligible AS (SELECT sigla_conjunto AS conjunto, alimentador AS feeder, idservico, date_time, {RANK} AS prio, us FROM
   (SELECT CAST(substr(se, 3) AS INTEGER) AS nation, idservico, prioridade, status_servico,
       CAST(concat(data_cadastro, ' ', hora_do_cadastro) AS TIMESTAMP) AS date_time,
       CAST(replace(us_servico, ',', '.') AS DECIMAL(24,6)) AS us FROM inspections) i
   JOIN feeder_set ON nation = alimentador
   WHERE prioridade <> 'X' AND status_servico = 'PR' AND us <> 0
     AND date_time BETWEEN DATE '{ASOF}' - INTERVAL 59 MONTH AND DATE '{ASOF}')
"""
    + _PLAN
    + _OPEN.format(150)
    + month_sql(1)
    + month_sql(2)
    + "/*recursive*/ "
    + " UNION ALL ".join(
        f"""SELECT concat((SELECT r_regionkey FROM region WHERE r_name = p.conjunto), ':1') AS request_id, p.conjunto,
            concat('F', lpad(CAST(p.feeder AS VARCHAR), 2, '0')) AS feeder, p.idservico, {m} AS horizon, i.prioridade,
            CAST(p.us AS DOUBLE) AS us, CAST(e.date_time AS VARCHAR) AS date_time
            FROM picks{m} p JOIN inspections i ON p.idservico = i.idservico JOIN eligible e ON e.idservico = p.idservico"""
        for m in (1, 2)
    )
)


@check("J6_batch_tasks", _BATCH_TASKS, (*FORECAST_USES, "inspections", "feeder_set"))
def _(data):
    """What is handed out; the other columns of a task are those of J7."""
    tasks = batch(data).tasks.withColumn("us", F.col("us servico").cast("double"))
    return text_dates(tasks.select("request_id", "conjunto", "feeder", "idservico", "horizon", "prioridade", "us", "date_time"))


@check(
    "J6_batch_rejects",
    "SELECT concat(r_regionkey, ':2') AS request_id, 'unknown algorithm' AS reason FROM region",
)
def _(data):
    return batch(data).rejects.select("request_id", "reason")
