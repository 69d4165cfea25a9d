"""C, D, F, G: rows, joins, order, reshaping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog import Data, check
from catalog.bindings import ASOF, goal_months
from gridtide.functions.dates import within
from gridtide.functions.numbers import exact
from gridtide.operators import rows
from gridtide.operators.attribution import with_cause
from gridtide.operators.goals import goal_window, goals_long, monthly_goals
from gridtide.operators.series import chrono_split, climatology, future_rows, month_spine
from gridtide.operators.allocation import priority_rank
from gridtide.operators.ordering import places
from gridtide.operators.search import champion, feature_columns
from gridtide.plans.panel import (
    RUN,
    SERIES,
    attach_set,
    attach_weather,
    build_panel,
    clean_raw,
)
from gridtide.plans.weather import station_months
from gridtide.sources.tables import Tables

# The panel without weather, as SQL.
PANEL = f"""
, panel AS (
  SELECT conjunto, pred_month, months_ahead, p.cod_alim, ano, mes, chi_total, cons_conjunto, qtde_cliente_total,
         qtde_cliente_ru, qtde_cliente_ub, dec_cj, coalesce(vlr_qtd_arvore, 0) AS vlr_qtd_arvore,
         make_date(ano, mes, 1) AS month, conjunto AS DESCR_NOVO,
         qtde_cliente_total / cons_conjunto AS feeder_effect,
         CASE WHEN mes IN (1, 2, 3, 10, 11, 12) THEN 2 ELSE 1 END AS month_weighted
  FROM panel_raw p JOIN feeders f ON p.cod_alim = f.cod_alim
  WHERE mes IS NOT NULL AND qtde_cliente_ru IS NOT NULL AND make_date(ano, mes, 1) < pred_month)
"""
PANEL_USES = ("panel_raw", "feeders", "goals_wide")

_goal_cells = " UNION ALL ".join(
    f"SELECT SIGLA, make_date({y}, {m + 1}, 1) AS month, \"1/{m + 1}/{y}\" AS chi_goal FROM goals_wide"
    for y, m in goal_months()
)
GOALS = f"""
, goals_long AS ({_goal_cells})
, goals AS (SELECT conjunto, pred_month, month, datediff('month', pred_month, month) + 1 AS horizon, CAST(sum(chi_goal) AS DOUBLE) AS chi_goal
            FROM goals_long JOIN runs ON SIGLA = conjunto GROUP BY conjunto, pred_month, month)
"""


def panel(data: Data) -> DataFrame:
    return build_panel(data["panel_raw"], data["feeder_set"], data["runs"])


def goals(data: Data) -> DataFrame:
    return goal_window(monthly_goals(goals_long(data["goals_wide"])), data["runs"])


def text_dates(df: DataFrame) -> DataFrame:
    return df.withColumns({f: F.col(f).cast("string") for f, t in df.dtypes if t in ("date", "timestamp_ntz", "timestamp")})


# ---- C ----------------------------------------------------------------------------------------


@check("C1_drop_missing", "SELECT cod_alim, ano, chi_total FROM panel_raw WHERE mes IS NOT NULL", ("panel_raw",))
def _(data):
    return rows.complete_rows(data["panel_raw"], ["mes", "qtde_cliente_ru"]).select("cod_alim", "ano", "chi_total")


@check(
    "C2_fill_missing",
    """SELECT cod_alim, ano, mes, chi_total, coalesce(vlr_qtd_arvore, 0) AS vlr_qtd_arvore FROM panel_raw
       WHERE mes IS NOT NULL""",
    ("panel_raw",),
)
def _(data):
    return clean_raw(data["panel_raw"]).select("cod_alim", "ano", "mes", "chi_total", "vlr_qtd_arvore")


@check(
    "C3_membership",
    """SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
       AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""",
)
def _(data):
    good = data["customer"].where("c_acctbal > 0").select("c_custkey")
    named = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return Tables(data.spark, {"orders": data["orders"]}).read("orders", ["o_orderkey"], named, keys=("o_custkey", good))


@check(
    "C4_half_open_period",
    """SELECT o_orderkey, o_orderdate < TIMESTAMP '1997-01-01' AS early FROM orders
       WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'""",
)
def _(data):
    start, mid, end = (F.lit(f"{y}-01-01").cast("timestamp_ntz") for y in (1996, 1997, 1999))
    kept = data["orders"].where(within(F.col("o_orderdate"), start, end))
    return kept.select("o_orderkey", within(F.col("o_orderdate"), None, mid).alias("early"))


@check(
    "C5_closed_period_status",
    """SELECT idservico, feeder FROM tasks WHERE date_time BETWEEN TIMESTAMP '1999-08-01' AND TIMESTAMP '2000-01-01'
       AND status_servico = 'PR' AND us_servico <> 0""",
    ("tasks",),
)
def _(data):
    end = F.lit(ASOF).cast("timestamp_ntz")
    inside = F.col("date_time").between(F.add_months(end, -5).cast("timestamp_ntz"), end)
    return data["tasks"].where(inside & (F.col("status_servico") == "PR") & (F.col("us_servico") != 0)).select(
        "idservico", "feeder"
    )


@check("C6_columns_first", "SELECT o_orderkey, o_orderdate_text, o_custkey FROM (SELECT o_custkey, CAST(o_orderdate AS VARCHAR) AS o_orderdate_text, o_orderkey FROM orders)")
def _(data):
    df = data["orders"].select("o_custkey", F.col("o_orderdate").cast("string").alias("o_orderdate_text"), "o_orderkey")
    return rows.put_first(df, ["o_orderkey", "o_orderdate_text"])


@check(
    "C7_features_by_exclusion",
    """SELECT cod_alim, ano, mes, dec_cj, vlr_qtd_arvore, feeder_effect, month_weighted FROM panel""".replace(
        "SELECT", PANEL + "SELECT", 1
    ),
    PANEL_USES,
)
def _(data):
    made = panel(data)
    return made.select("cod_alim", "ano", "mes", *feature_columns(made))


@check("C8_set_label", "SELECT r_name AS DESCR_NOVO, n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey")
def _(data):
    return attach_set(data["nation"], data["feeder_set"], "n_nationkey").select(
        F.col("conjunto").alias("DESCR_NOVO"), "n_nationkey"
    )


@check(
    "C9_complete_station_months",
    """SELECT station_code, CAST(make_date(year, month, 1) AS VARCHAR) AS month, temp_max, temp_min, precipitation
       FROM station_history WHERE temp_max IS NOT NULL""",
    ("station_history",),
)
def _(data):
    return text_dates(station_months(data["station_history"])).select(
        "station_code", "month", "temp_max", "temp_min", "precipitation"
    )


@check(
    "C10_first_per_key",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
       ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1""",
)
def _(data):
    df = data["orders"].select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return rows.first_per(df, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@check(
    "C11_last_per_key",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
       ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""",
)
def _(data):
    df = data["orders"].select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return rows.last_per(df, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@check("C12_distinct", "SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def _(data):
    return data["orders"].select("o_custkey", "o_orderstatus").distinct()


# ---- D ----------------------------------------------------------------------------------------


@check(
    "D1_panel_with_weather",
    """SELECT p.cod_alim, ano, mes, chi_total, temp_max, precipitation FROM panel_raw p JOIN station_history h
       ON p.cod_alim = h.station_code AND p.ano = h.year AND p.mes = h.month""",
    ("panel_raw", "station_history"),
)
def _(data):
    weather = data["station_history"].withColumnsRenamed({"station_code": "cod_alim", "year": "ano", "month": "mes"})
    return attach_weather(data["panel_raw"], weather, ["cod_alim", "ano", "mes"]).select(
        "cod_alim", "ano", "mes", "chi_total", "temp_max", "precipitation"
    )


@check(
    "D2_feeder_to_set",
    "SELECT conjunto, cod_alim, ano, chi_total FROM panel_raw JOIN (SELECT sigla_conjunto AS conjunto, alimentador FROM feeder_set) ON cod_alim = alimentador",
    ("panel_raw", "feeder_set"),
)
def _(data):
    return attach_set(data["panel_raw"], data["feeder_set"]).select("conjunto", "cod_alim", "ano", "chi_total")


@check(
    "D3_outage_causes",
    """SELECT id_interrupcao, cod_alim, cod_grupo, CAST(chi_tot AS DOUBLE) AS chi_tot,
              CASE cod_grupo WHEN 'ECONOMY' THEN 'arvore' WHEN 'LARGE' THEN 'manutencao estruturas'
                   WHEN 'MEDIUM' THEN '50% avores/ 50% outros' WHEN 'PROMO' THEN '70% arvore / 30% outros'
                   ELSE 'outros' END AS grupo
       FROM outages JOIN causes ON cod_grupo = num_idt_grupo_causas AND cod_causa = num_idt_causa_interrupcao""",
    ("outages", "causes"),
)
def _(data):
    return with_cause(data["outages"], data["causes"]).select(
        "id_interrupcao", "cod_alim", "cod_grupo", F.col("chi_tot").cast("double").alias("chi_tot"), "grupo"
    )


@check(
    "D4_semi_join",
    """SELECT idservico FROM tasks WHERE feeder IN (SELECT alimentador FROM feeder_set WHERE sigla_conjunto <> 'ASIA')""",
    ("tasks", "feeder_set"),
)
def _(data):
    wanted = data["feeder_set"].where("sigla_conjunto <> 'ASIA'").select("alimentador")
    return Tables(data.spark, {"tasks": data["tasks"]}).read("tasks", ["idservico"], keys=("feeder", wanted))


@check(
    "D5_anti_join",
    "SELECT idservico FROM tasks WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = idservico AND l_returnflag = 'R')",
    ("tasks",),
)
def _(data):
    done = data["lineitem"].where("l_returnflag = 'R'").select("l_orderkey")
    return data["tasks"].join(done, F.col("idservico") == F.col("l_orderkey"), "left_anti").select("idservico")


@check(
    "D9_goals_of_sets",
    GOALS + "SELECT conjunto, CAST(month AS VARCHAR) AS month, horizon, chi_goal FROM goals",
    ("goals_wide", "runs"),
)
def _(data):
    made = goals(data).withColumn("chi_goal", F.col("chi_goal").cast("double"))
    return text_dates(made.select("conjunto", "month", "horizon", "chi_goal"))


# ---- F ----------------------------------------------------------------------------------------


@check(
    "F1_chronological_split",
    PANEL
    + """SELECT cod_alim, ano, mes, CASE WHEN row_number() OVER (PARTITION BY conjunto, cod_alim ORDER BY month)
         <= CAST(floor(count(*) OVER (PARTITION BY conjunto, cod_alim) * CAST(0.9 AS DOUBLE)) AS INT) THEN 1 ELSE 0 END AS is_train FROM panel""",
    PANEL_USES,
)
def _(data):
    split = chrono_split(panel(data), SERIES, ["month"])
    return split.select("cod_alim", "ano", "mes", F.col("is_train").cast("int").alias("is_train"))


@check(
    "F2_champion",
    """SELECT l_partkey, model, mape, rmse FROM (
         SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY mape NULLS LAST, rmse, model) AS rn FROM (
           SELECT l_partkey, concat('m', l_suppkey, '-', l_orderkey, '-', l_linenumber) AS model,
                  nullif(l_discount, 0) AS mape, l_extendedprice AS rmse FROM lineitem)) WHERE rn = 1""",
)
def _(data):
    name = F.concat(F.lit("m"), "l_suppkey", F.lit("-"), "l_orderkey", F.lit("-"), "l_linenumber")
    scores = data["lineitem"].select(
        "l_partkey", name.alias("model"), F.nullif("l_discount", F.lit(0.0)).alias("mape"), F.col("l_extendedprice").alias("rmse")
    )
    return champion(scores, ["l_partkey"])


@check(
    "F3_feeder_ranking",
    """SELECT n_nationkey, n_regionkey, place FROM (SELECT n_nationkey, n_regionkey, row_number() OVER (PARTITION BY n_regionkey ORDER BY delta NULLS LAST, n_nationkey) AS place
       FROM nation LEFT JOIN (SELECT c_nationkey, CASE WHEN c_nationkey % 6 = 5 THEN NULL ELSE round_even(avg(CAST(c_acctbal AS DECIMAL(18,2))), -3) END AS delta
                        FROM customer GROUP BY c_nationkey) ON n_nationkey = c_nationkey)""",
)
def _(data):
    delta = F.bround(F.avg(exact(F.col("c_acctbal"))).cast("double"), -3)
    per = data["customer"].groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(delta.alias("d"))
    per = per.withColumn("d", F.when(F.col("n_nationkey") % 6 != 5, F.col("d")))
    nations = data["nation"].join(per, "n_nationkey", "left").withColumn("last", F.col("d").isNull())
    return places(nations, ["n_regionkey"], ["last", "d", "n_nationkey"]).select("n_nationkey", "n_regionkey", "place")


@check(
    "F4_task_order",
    """SELECT feeder, idservico, row_number() OVER (PARTITION BY feeder ORDER BY
         CASE prioridade WHEN 'U' THEN 1 WHEN 'A' THEN 2 WHEN 'B' THEN 3 WHEN 'C' THEN 4 END, date_time, idservico) AS place
       FROM tasks WHERE prioridade <> 'X'""",
    ("tasks",),
)
def _(data):
    served = data["tasks"].withColumn("prio", priority_rank(F.col("prioridade"))).where("prio is not null")
    return places(served, ["feeder"], ["prio", "date_time", "idservico"]).select("feeder", "idservico", "place")


@check(
    "F5_periods_in_order",
    PANEL + "SELECT conjunto, cod_alim, ano, mes FROM panel ORDER BY conjunto, cod_alim, ano, mes",
    PANEL_USES,
)
def _(data):
    return panel(data).select("conjunto", "cod_alim", "ano", "mes").orderBy("conjunto", "cod_alim", "ano", "mes")


# ---- G ----------------------------------------------------------------------------------------


@check(
    "G1_goals_wide_to_long",
    GOALS + "SELECT SIGLA, CAST(month AS VARCHAR) AS month, CAST(chi_goal AS DOUBLE) AS chi_goal FROM goals_long",
    ("goals_wide", "runs"),
)
def _(data):
    long = goals_long(data["goals_wide"])
    return text_dates(long.withColumn("chi_goal", F.col("chi_goal").cast("double")))


@check(
    "G2_month_spine",
    """SELECT c_nationkey, CAST(CAST(month AS DATE) AS VARCHAR) AS month FROM (
         SELECT c_nationkey, unnest(generate_series(date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)) AS month
         FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey)""",
)
def _(data):
    joined = data["orders"].join(data["customer"], F.col("o_custkey") == F.col("c_custkey"))
    spans = joined.groupBy("c_nationkey").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
    spine = month_spine(spans, F.trunc("a", "month"), F.trunc("b", "month"))
    return text_dates(spine.select("c_nationkey", "month"))


FUTURE = """
, clim AS (SELECT conjunto, cod_alim, mes, avg(dec_cj) AS dec_mean FROM panel GROUP BY conjunto, cod_alim, mes)
, last_rows AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY conjunto, cod_alim ORDER BY month DESC) AS rn FROM panel) WHERE rn = 1)
, consumers AS (SELECT conjunto, cons_conjunto AS consumers FROM (SELECT conjunto, cons_conjunto,
      row_number() OVER (PARTITION BY conjunto ORDER BY month DESC, cod_alim DESC) AS rn FROM panel) WHERE rn = 1)
, future AS (
  SELECT l.conjunto, l.cod_alim, g.horizon, g.month, year(g.month) AS ano, month(g.month) AS mes,
         CASE WHEN month(g.month) IN (1, 2, 3, 10, 11, 12) THEN 2 ELSE 1 END AS month_weighted,
         CAST(0 AS DOUBLE) AS chi_total, l.vlr_qtd_arvore, l.feeder_effect, g.chi_goal,
         CASE WHEN c.mes IS NOT NULL THEN (g.chi_goal / consumers * l.feeder_effect + c.dec_mean) / 2 ELSE l.dec_cj END AS dec_cj
  FROM last_rows l JOIN goals g ON l.conjunto = g.conjunto AND g.horizon >= 1 JOIN consumers k ON k.conjunto = l.conjunto
       LEFT JOIN clim c ON c.conjunto = l.conjunto AND c.cod_alim = l.cod_alim AND c.mes = month(g.month))
"""


@check(
    "G3_future_rows",
    GOALS
    + PANEL
    + FUTURE
    + """SELECT cod_alim, horizon, CAST(month AS VARCHAR) AS month, ano, mes, month_weighted, chi_total, vlr_qtd_arvore, feeder_effect, round(dec_cj, 6) AS dec_cj
         FROM future""",
    (*PANEL_USES, "runs"),
)
def _(data):
    future = future_rows(panel(data), SERIES, F.col("months_ahead"), F.col("pred_month"), goals(data), RUN, [])
    return text_dates(
        future.select(
            "cod_alim", "horizon", "month", "ano", "mes", "month_weighted", "chi_total", "vlr_qtd_arvore",
            "feeder_effect", F.round("dec_cj", 6).alias("dec_cj"),
        )
    )


@check(
    "G5_vertical_concat",
    """SELECT 'c' AS side, c_custkey AS id, c_acctbal AS balance FROM customer
       UNION ALL SELECT 's', s_suppkey, s_acctbal FROM supplier""",
)
def _(data):
    c = data["customer"].select(F.lit("c").alias("side"), F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"))
    s = data["supplier"].select(F.col("s_acctbal").alias("balance"), F.lit("s").alias("side"), F.col("s_suppkey").alias("id"))
    return c.unionByName(s)


@check(
    "G6_one_row_per_feeder",
    """SELECT c_nationkey, count(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS building,
              count(*) FILTER (WHERE c_mktsegment = 'MACHINERY') AS machinery FROM customer GROUP BY c_nationkey""",
)
def _(data):
    long = data["customer"].groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("n"))
    pick = lambda s: F.coalesce(F.sum(F.when(F.col("c_mktsegment") == s, F.col("n"))), F.lit(0))
    return long.groupBy("c_nationkey").agg(pick("BUILDING").alias("building"), pick("MACHINERY").alias("machinery"))


@check(
    "E10_climatology",
    """SELECT c_nationkey, month(o_orderdate) AS mes, round(avg(o_totalprice), 4) AS price FROM orders
       JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey, month(o_orderdate)""",
)
def _(data):
    joined = data["orders"].join(data["customer"], F.col("o_custkey") == F.col("c_custkey"))
    joined = joined.select("c_nationkey", F.month("o_orderdate").alias("mes"), F.col("o_totalprice").alias("price"))
    return climatology(joined, ["c_nationkey"], "mes", ["price"]).withColumn("price", F.round("price", 4))
