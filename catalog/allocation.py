"""I: budgeted assignment."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import Data, check
from catalog.bindings import ASOF
from catalog.sources import cleaned
from gridtide.operators.allocation import (
    assign_month,
    assign_tasks,
    eligible_tasks,
    greedy_pick,
    priority_rank,
)
from gridtide.operators.suggestions import scaled, suggest_volumes

RANK = "CASE prioridade WHEN 'U' THEN 1 WHEN 'A' THEN 2 WHEN 'B' THEN 3 WHEN 'C' THEN 4 END"


def walk_sql(items: str, body: str) -> str:
    """Item-by-item walk of `items` (wallet, budget, rn, us, ...) as a recursive query."""
    return f"""{items}
, walk AS (
  SELECT wallet, CAST(0 AS BIGINT) AS rn, CAST(max(budget) AS DECIMAL(24,6)) AS remaining, FALSE AS taken FROM items GROUP BY wallet
  UNION ALL
  SELECT i.wallet, i.rn, CAST(CASE WHEN i.us <= w.remaining THEN w.remaining - i.us ELSE w.remaining END AS DECIMAL(24,6)), i.us <= w.remaining
  FROM walk w JOIN items i ON i.wallet = w.wallet AND i.rn = w.rn + 1)
/*recursive*/ {body}"""


_ALL_TASKS = f"""
, items AS (SELECT feeder AS wallet, idservico, us_servico AS us, CAST(20000000 + feeder * 1000000 AS DECIMAL(24,6)) AS budget,
       row_number() OVER (PARTITION BY feeder ORDER BY {RANK}, date_time, idservico) AS rn FROM tasks WHERE prioridade <> 'X')
"""


def _served(data: Data):
    return data["tasks"].withColumn("prio", priority_rank(F.col("prioridade"))).where("prio is not null")


def _budgets(data: Data):
    return data["nation"].select(
        F.col("n_nationkey").alias("feeder"), (F.lit(20000000) + F.col("n_nationkey") * 1000000).alias("budget")
    )


@check(
    "I1_greedy_pick",
    walk_sql(
        _ALL_TASKS,
        """SELECT i.wallet AS feeder, idservico, CAST(us AS DOUBLE) AS us FROM items i
           JOIN walk w ON w.wallet = i.wallet AND w.rn = i.rn WHERE taken""",
    ),
    ("tasks",),
)
def _(data):
    picks = greedy_pick(
        _served(data), ["feeder"], ["prio", "date_time", "idservico"], "us_servico", _budgets(data)
    )
    return picks.select("feeder", "idservico", F.col("us_servico").cast("double").alias("us"))


@check(
    "I1_greedy_pick_of_large_groups",
    walk_sql(
        f"""
, items AS (SELECT 1 AS wallet, idservico, us_servico AS us, CAST(123456789 AS DECIMAL(24,6)) AS budget,
       row_number() OVER (ORDER BY {RANK}, date_time, idservico) AS rn FROM tasks WHERE prioridade <> 'X')
""",
        """SELECT idservico, CAST(us AS DOUBLE) AS us FROM items i JOIN walk w ON w.rn = i.rn WHERE taken""",
    ),
    ("tasks",),
)
def _(data):
    """All tasks in one group, which is more than one aggregate may hold."""
    items = _served(data).withColumn("wallet", F.lit(1))
    budget = data.spark.range(1).select(F.lit(1).alias("wallet"), F.lit(123456789).alias("budget"))
    picks = greedy_pick(items, ["wallet"], ["prio", "date_time", "idservico"], "us_servico", budget)
    return picks.select("idservico", F.col("us_servico").cast("double").alias("us"))


MONTHS = 60

ELIGIBLE = f"""
, eligible AS (SELECT sigla_conjunto AS conjunto, feeder, idservico, date_time, {RANK} AS prio, us_servico AS us
   FROM tasks JOIN feeder_set ON feeder = alimentador
   WHERE prioridade <> 'X' AND status_servico = 'PR' AND us_servico <> 0
     AND date_time BETWEEN DATE '{ASOF}' - INTERVAL {MONTHS - 1} MONTH AND DATE '{ASOF}')
"""


def eligible(data: Data):
    feeders = data["feeders"].select("conjunto", F.col("cod_alim").alias("feeder"), "pred_month")
    return eligible_tasks(
        data["tasks"], feeders, MONTHS, status="status_servico", cost="us_servico"
    )


@check(
    "I2_eligible_tasks",
    ELIGIBLE
    + "SELECT conjunto, feeder, idservico, prio, CAST(date_time AS VARCHAR) AS date_time, CAST(us AS DOUBLE) AS us FROM eligible",
    ("tasks", "feeder_set"),
)
def _(data):
    return eligible(data).select(
        "conjunto", "feeder", "idservico", "prio", F.col("date_time").cast("string").alias("date_time"), F.col("us").cast("double").alias("us")
    )


# A feeder's share and its gap to the goal, derived from its customers.
FORECAST = """
, effects AS (SELECT conjunto, feeder, delta, CAST(n AS DOUBLE) / CAST(total AS DOUBLE) AS effect FROM (
     SELECT sigla_conjunto AS conjunto, alimentador AS feeder, n, sum(n) OVER (PARTITION BY sigla_conjunto) AS total,
            CASE WHEN alimentador % 7 = 0 THEN NULL ELSE CAST((n % 11) - 5 AS DOUBLE) / 10 END AS delta
     FROM feeder_set JOIN (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY c_nationkey) ON c_nationkey = alimentador))
"""
US = 9000000


def forecast(data: Data, by_feeder):
    n = data["customer"].groupBy(F.col("c_nationkey").alias("feeder")).agg(F.count("*").alias("n"))
    per = data["feeders"].select("conjunto", F.col("cod_alim").alias("feeder")).join(n, "feeder")
    total = per.groupBy("conjunto").agg(F.sum("n").alias("total"))
    delta = F.when(F.col("feeder") % 7 != 0, ((F.col("n") % 11) - 5).cast("double") / 10)
    return per.join(total, "conjunto").select(
        "conjunto",
        "feeder",
        (F.col("n").cast("double") / F.col("total").cast("double")).alias("effect"),
        delta.alias("delta_chi_percent"),
        by_feeder.alias("by_feeder"),
    )


def wallets(data: Data):
    return data["region"].select(F.col("r_name").alias("conjunto"), F.lit(float(US)).alias("us_services"))


@check(
    "I3_per_feeder_budgets",
    walk_sql(
        ELIGIBLE
        + FORECAST
        + f""", items AS (SELECT e.feeder AS wallet, e.conjunto, idservico, us, CAST(round_even(effect * {US}, 3) AS DECIMAL(24,6)) AS budget,
             row_number() OVER (PARTITION BY e.feeder ORDER BY prio, date_time, idservico) AS rn
             FROM eligible e JOIN effects f ON e.feeder = f.feeder)""",
        """SELECT conjunto, i.wallet AS feeder, idservico, CAST(us AS DOUBLE) AS us FROM items i
           JOIN walk w ON w.wallet = i.wallet AND w.rn = i.rn WHERE taken""",
    ),
    ("tasks", "feeder_set"),
)
def _(data):
    tasks = eligible(data).drop("pred_month")
    picks, _left = assign_month(tasks, forecast(data, F.lit(True)), wallets(data), key="conjunto")
    return picks.withColumn("us", F.col("us").cast("double"))


_SHARED = ELIGIBLE + FORECAST + f"""
, items AS (SELECT e.conjunto AS wallet, e.feeder, idservico, us, CAST({US} AS DECIMAL(24,6)) AS budget,
     row_number() OVER (PARTITION BY e.conjunto ORDER BY CASE WHEN prio <= 2 THEN 0 ELSE 1 END, delta NULLS LAST, e.feeder, prio, date_time, idservico) AS rn
     FROM eligible e JOIN effects f ON e.feeder = f.feeder)"""


@check(
    "I4_shared_budget",
    walk_sql(
        _SHARED,
        """SELECT i.wallet AS conjunto, feeder, idservico, CAST(us AS DOUBLE) AS us FROM items i
           JOIN walk w ON w.wallet = i.wallet AND w.rn = i.rn WHERE taken""",
    ),
    ("tasks", "feeder_set"),
)
def _(data):
    tasks = eligible(data).drop("pred_month")
    picks, _left = assign_month(tasks, forecast(data, F.lit(False)), wallets(data), key="conjunto")
    return picks.withColumn("us", F.col("us").cast("double"))


@check(
    "I4_budget_left",
    walk_sql(
        _SHARED,
        """SELECT r_name AS conjunto, coalesce(us_services, CAST(9000000 AS DOUBLE)) AS us_services FROM region LEFT JOIN
           (SELECT wallet, CAST(min(remaining) AS DOUBLE) AS us_services FROM walk GROUP BY wallet) ON wallet = r_name""",
    ),
    ("tasks", "feeder_set"),
)
def _(data):
    tasks = eligible(data).drop("pred_month")
    return assign_month(tasks, forecast(data, F.lit(False)), wallets(data), key="conjunto")[1]


def month_sql(m: int) -> str:
    """One month for all sets: `plan`, budgets `us{m}` and tasks `open{m}` give `picks{m}` and `us{m + 1}`."""
    return f"""
, shares{m} AS (SELECT f.conjunto, f.feeder, delta, by_feeder,
     CASE WHEN by_feeder THEN concat(f.conjunto, ':', f.feeder) ELSE f.conjunto END AS wallet,
     CAST(CASE WHEN by_feeder THEN round_even(effect * us, 3) ELSE us END AS DECIMAL(24,6)) AS budget
   FROM plan f JOIN us{m} u ON f.conjunto = u.conjunto WHERE horizon = {m})
, items{m} AS (SELECT s.wallet, s.conjunto, o.feeder, idservico, us, budget, row_number() OVER (PARTITION BY s.wallet
     ORDER BY CASE WHEN by_feeder OR prio <= 2 THEN 0 ELSE 1 END, delta NULLS LAST, o.feeder, prio, date_time, idservico) AS rn
   FROM open{m} o JOIN shares{m} s ON o.feeder = s.feeder)
, walk{m} AS (
  SELECT wallet, CAST(0 AS BIGINT) AS rn, CAST(max(budget) AS DECIMAL(24,6)) AS remaining, FALSE AS taken FROM items{m} GROUP BY wallet
  UNION ALL
  SELECT i.wallet, i.rn, CAST(CASE WHEN i.us <= w.remaining THEN w.remaining - i.us ELSE w.remaining END AS DECIMAL(24,6)), i.us <= w.remaining
  FROM walk{m} w JOIN items{m} i ON i.wallet = w.wallet AND i.rn = w.rn + 1)
, picks{m} AS (SELECT i.* FROM items{m} i JOIN walk{m} w ON w.wallet = i.wallet AND w.rn = i.rn WHERE taken)
, open{m + 1} AS (SELECT * FROM open{m} WHERE idservico NOT IN (SELECT idservico FROM picks{m}))
, us{m + 1} AS (SELECT conjunto, CAST(sum(budget - coalesce(spent, 0)) AS DOUBLE) AS us FROM
     (SELECT DISTINCT conjunto, wallet, budget FROM shares{m}) b LEFT JOIN (SELECT wallet, sum(us) AS spent FROM picks{m} GROUP BY wallet) p
     ON b.wallet = p.wallet GROUP BY conjunto)
"""


@check(
    "I5_months_in_a_chain",
    ELIGIBLE
    + FORECAST
    + ", plan AS (SELECT conjunto, feeder, m AS horizon, effect, delta, (length(conjunto) + m) % 2 = 0 AS by_feeder "
    + "FROM effects CROSS JOIN (VALUES (1), (2), (3)) v(m)) "
    + f", us1 AS (SELECT r_name AS conjunto, CAST({US} AS DOUBLE) AS us FROM region), open1 AS (SELECT * FROM eligible) "
    + "".join(map(month_sql, (1, 2, 3)))
    + "/*recursive*/ "
    + " UNION ALL ".join(
        f"SELECT conjunto, feeder, idservico, CAST(us AS DOUBLE) AS us, {m} AS horizon FROM picks{m}" for m in (1, 2, 3)
    ),
    ("tasks", "feeder_set"),
)
def _(data):
    """Three months; in each, some sets have their goal covered and the others share the budget."""
    months = []
    for month in (1, 2, 3):
        covered = (F.length("conjunto") + month) % 2 == 0
        months.append(forecast(data, covered).withColumn("horizon", F.lit(month)))
    plan = months[0].unionByName(months[1]).unionByName(months[2])
    picks = assign_tasks(eligible(data).drop("pred_month"), plan, wallets(data), 3, key="conjunto")
    return picks.withColumn("us", F.col("us").cast("double"))


# Gap between forecast and goal, and attributed outages, from orders per customer.
_GAP = """
, gap AS (SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS chi_pred, CAST(2000000 AS DOUBLE) AS chi_goal,
    count(*) FILTER (WHERE o_orderstatus = 'F') AS cnt_poda, count(*) FILTER (WHERE o_orderstatus = 'O') AS cnt_faixa,
    count(*) FILTER (WHERE o_orderstatus = 'P') AS cnt_estruturas, count(*) FILTER (WHERE o_orderstatus <> 'F' OR o_orderpriority <> '5-LOW') AS cnt_total,
    CAST(coalesce(min(o_totalprice) FILTER (WHERE o_orderstatus = 'F'), 0) AS DOUBLE) AS avg_poda,
    CAST(coalesce(min(o_totalprice) FILTER (WHERE o_orderstatus = 'O'), 0) AS DOUBLE) AS avg_faixa,
    CAST(coalesce(min(o_totalprice) FILTER (WHERE o_orderstatus = 'P'), 0) AS DOUBLE) AS avg_estruturas FROM orders GROUP BY o_custkey)
"""
COEFS = {"poda": 1.5, "faixa": 0.5, "estruturas": 2.0}


def volume_sql(s: str) -> str:
    return (
        f"CASE WHEN chi_pred - chi_goal > 0 AND cnt_total > 0 AND avg_{s} <> 0 "
        f"THEN CAST(trunc((chi_pred - chi_goal) * (CAST(cnt_{s} AS DOUBLE) / CAST(cnt_total AS DOUBLE)) / avg_{s}) AS BIGINT) ELSE 0 END"
    )


def scaled_sql(volume: str, coef: float) -> str:
    return f"CAST(round_even({volume} * CAST({coef} AS DOUBLE), 0) AS BIGINT)"


@check(
    "I6_I7_suggested_volumes",
    _GAP
    + "SELECT o_custkey, "
    + ", ".join(f"{scaled_sql(volume_sql(s), c)} AS {s}_sugg" for s, c in COEFS.items())
    + ", round_even(chi_pred, 2) AS chi_pred, chi_goal, round_even(chi_pred - chi_goal, 2) AS chi_diff FROM gap",
)
def _(data):
    orders = data["orders"]

    def of(status, value):
        return F.when(F.col("o_orderstatus") == status, value)

    named = dict(zip(COEFS, "FOP", strict=True))
    chi = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double")
    counted = (F.col("o_orderstatus") != "F") | (F.col("o_orderpriority") != "5-LOW")
    gap = orders.groupBy("o_custkey").agg(
        chi.alias("chi_pred"),
        F.lit(2000000.0).alias("chi_goal"),
        F.count(F.when(counted, 1)).alias("cnt_total"),
        *[F.count(of(x, 1)).alias(f"cnt_{s}") for s, x in named.items()],
        *[F.coalesce(F.min(of(x, F.col("o_totalprice"))), F.lit(0.0)).alias(f"avg_{s}") for s, x in named.items()],
    )
    made = suggest_volumes(gap.withColumn("chi_diff", F.col("chi_pred") - F.col("chi_goal")), COEFS)
    return made.select("o_custkey", *[f"{s}_sugg" for s in COEFS], "chi_pred", "chi_goal", "chi_diff")


@check(
    "I7_scaled_half_even",
    "SELECT l_orderkey, l_linenumber, l_extendedprice, CAST(round_even(l_quantity * 0.5, 0) AS BIGINT) AS n FROM lineitem",
)
def _(data):
    return data["lineitem"].select("l_orderkey", "l_linenumber", "l_extendedprice", scaled(F.col("l_quantity"), 0.5).alias("n"))


@check(
    "J7_clean_inspections",
    """SELECT idservico, concat(se, CASE WHEN length(alimentador) < 2 THEN '0' ELSE '' END, alimentador) AS feeder,
              CAST(replace(quantidade, ',000', '') AS BIGINT) AS quantidade, CAST(replace(us_servico, ',', '.') AS DOUBLE) AS us_servico,
              concat(data_cadastro, ' ', hora_do_cadastro) AS date_time, CAST(substr(data_cadastro, 1, 4) AS INT) AS year,
              CAST(substr(data_cadastro, 6, 2) AS INT) AS month, concat('inspecao ', lower(substr(descricao, 11))) AS descricao,
              concat('caida de ', lower(substr(descricao_da_causa, 10))) AS descricao_da_causa FROM inspections""",
    ("inspections",),
)
def _(data):
    return cleaned(data).select(
        "idservico", "feeder", "quantidade", F.col("us servico").alias("us_servico"),
        F.col("date_time").cast("string").alias("date_time"), "year", "month", "descricao",
        F.col("descricao da causa").alias("descricao_da_causa"),
    )
