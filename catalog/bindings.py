"""Domain tables derived from the test tables, in SQL that both engines read."""

from __future__ import annotations

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# The date and horizon of the requests.
ASOF, AHEAD = "2000-01-01", 2


def goal_months() -> list[tuple[int, int]]:
    """The 12 months around `ASOF`: `AHEAD` from it on, the others before it."""
    first = 2000 * 12 - (12 - AHEAD)
    return [divmod(first + i, 12) for i in range(12)]


def _fixed(body: str):
    return lambda quote: body


def _goals(quote: str) -> str:
    cells = ",\n".join(
        f"sum(CASE WHEN year(o_orderdate) = {y} AND month(o_orderdate) = {m + 1} "
        f"THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END) AS {quote}1/{m + 1}/{y}{quote}"
        for y, m in goal_months()
    )
    return f"""
SELECT r_name AS SIGLA, o_orderstatus AS parte, {cells}
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
     JOIN region ON n_regionkey = r_regionkey
GROUP BY r_name, o_orderstatus"""


# name: (tables and bindings it reads, text by identifier quote)
BINDINGS = {
    "feeder_set": (
        ["nation", "region"],
        _fixed("""
SELECT r_name AS sigla_conjunto, n_nationkey AS alimentador
FROM nation JOIN region ON n_regionkey = r_regionkey"""),
    ),
    "runs": (
        ["region"],
        _fixed(f"SELECT r_name AS conjunto, DATE '{ASOF}' AS pred_month, {AHEAD} AS months_ahead FROM region"),
    ),
    "feeders": (
        ["feeder_set", "runs"],
        _fixed("""
SELECT conjunto, pred_month, months_ahead, alimentador AS cod_alim
FROM runs JOIN feeder_set ON conjunto = sigla_conjunto"""),
    ),
    "panel_raw": (
        ["orders", "customer", "nation"],
        _fixed("""
WITH cust AS (SELECT c_custkey, c_nationkey, n_regionkey, c_mktsegment
              FROM customer JOIN nation ON c_nationkey = n_nationkey),
     per_set AS (SELECT n_regionkey, count(*) AS cons_conjunto FROM cust GROUP BY n_regionkey),
     per_feeder AS (SELECT c_nationkey, n_regionkey, count(*) AS qtde_cliente_total,
                           sum(CASE WHEN c_mktsegment = 'MACHINERY' THEN 1 ELSE 0 END) AS qtde_cliente_ru
                    FROM cust GROUP BY c_nationkey, n_regionkey),
     m AS (SELECT c_nationkey, year(o_orderdate) AS ano, month(o_orderdate) AS mes,
                  sum(CAST(o_totalprice AS DECIMAL(18,2))) AS chi_total, count(*) AS n
           FROM orders JOIN cust ON o_custkey = c_custkey
           GROUP BY c_nationkey, year(o_orderdate), month(o_orderdate))
SELECT m.c_nationkey AS cod_alim, CASE WHEN n % 31 = 30 THEN NULL ELSE mes END AS mes, ano,
       CAST(chi_total AS DOUBLE) AS chi_total, CAST(cons_conjunto AS DOUBLE) AS cons_conjunto,
       CAST(qtde_cliente_total AS DOUBLE) AS qtde_cliente_total,
       CAST(qtde_cliente_ru AS DOUBLE) AS qtde_cliente_ru,
       CAST(qtde_cliente_total - qtde_cliente_ru AS DOUBLE) AS qtde_cliente_ub,
       CAST(n AS DOUBLE) / 8 AS dec_cj,
       CASE WHEN n % 7 = 0 THEN NULL ELSE CAST(n AS DOUBLE) END AS vlr_qtd_arvore
FROM m JOIN per_feeder f ON m.c_nationkey = f.c_nationkey
       JOIN per_set s ON f.n_regionkey = s.n_regionkey"""),
    ),
    "outages": (
        ["lineitem", "orders", "customer", "part"],
        _fixed("""
SELECT c_nationkey AS cod_alim, l_orderkey AS id_interrupcao, l_shipdate AS dat_inicio,
       p_type AS cod_grupo, p_size % 3 AS cod_causa,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS chi_tot,
       CASE WHEN l_linestatus = 'O' THEN 'U' ELSE 'R' END AS tag_urb_rur
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
              JOIN customer ON o_custkey = c_custkey
              JOIN part ON l_partkey = p_partkey"""),
    ),
    "causes": (
        ["part"],
        _fixed("""
SELECT DISTINCT p_type AS num_idt_grupo_causas, p_size % 3 AS num_idt_causa_interrupcao,
       CASE p_type WHEN 'ECONOMY' THEN ' Árvore' WHEN 'LARGE' THEN 'Manutenção Estruturas'
                   WHEN 'MEDIUM' THEN '50% avores/ 50% outros'
                   WHEN 'PROMO' THEN '70% árvore / 30% outros ' ELSE 'outros' END AS grupo
FROM part WHERE p_type <> 'STANDARD'"""),
    ),
    "maintenance": (
        ["lineitem", "supplier"],
        _fixed("""
SELECT s_nationkey AS cod_alim, l_shipdate AS dat_execucao,
       CASE l_returnflag WHEN 'A' THEN 'PODA' WHEN 'N' THEN 'FAIXA' ELSE 'ESTRUTURA' END AS grupo_dataset_servico,
       CAST(l_quantity AS DECIMAL(18,2)) AS us_pontos,
       CASE WHEN l_linenumber = 3 THEN NULL ELSE CAST(l_tax * 100 AS DECIMAL(18,2)) END AS vlr_us_servico
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey"""),
    ),
    "tasks": (
        ["orders", "customer"],
        _fixed("""
SELECT c_nationkey AS feeder, o_orderkey AS idservico, o_orderdate AS date_time,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'U' WHEN '2-HIGH' THEN 'A'
                            WHEN '3-MEDIUM' THEN 'B' WHEN '4-NOT SPECIFIED' THEN 'C' ELSE 'X' END AS prioridade,
       CASE WHEN o_orderstatus = 'P' THEN 'PR' ELSE o_orderstatus END AS status_servico,
       CAST(o_totalprice AS DECIMAL(18,2)) AS us_servico
FROM orders JOIN customer ON o_custkey = c_custkey"""),
    ),
    "inspections": (
        ["orders", "customer"],
        _fixed("""
SELECT o_orderkey AS idservico, concat('M', CAST(o_orderkey AS VARCHAR(20))) AS idnsmanut,
       CASE WHEN o_orderstatus = 'P' THEN 'PR' ELSE o_orderstatus END AS status_servico,
       c_mktsegment AS dispositivo, concat('SE', CAST(c_nationkey AS VARCHAR(20))) AS se,
       CAST(o_custkey % 120 AS VARCHAR(20)) AS alimentador,
       concat(' Inspeção ', o_orderpriority) AS descricao,
       concat(CAST(o_orderkey % 50 AS VARCHAR(20)), ',000') AS quantidade,
       concat(CAST(o_orderkey % 9 AS VARCHAR(20)), ',5') AS us_servico,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'U' WHEN '2-HIGH' THEN 'A'
                            WHEN '3-MEDIUM' THEN 'B' WHEN '4-NOT SPECIFIED' THEN 'C' ELSE 'X' END AS prioridade,
       concat(CAST(year(o_orderdate) AS VARCHAR(20)), '-',
              lpad(CAST(month(o_orderdate) AS VARCHAR(20)), 2, '0'), '-',
              lpad(CAST(day(o_orderdate) AS VARCHAR(20)), 2, '0')) AS data_cadastro,
       concat(lpad(CAST(o_orderkey % 24 AS VARCHAR(20)), 2, '0'), ':',
              lpad(CAST(o_orderkey % 60 AS VARCHAR(20)), 2, '0'), ':00') AS hora_do_cadastro,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_custkey % 40 AS DOUBLE) END AS causa,
       concat('CAÍDA DE ', c_mktsegment) AS descricao_da_causa, 'ciga' AS causa_ciga
FROM orders JOIN customer ON o_custkey = c_custkey"""),
    ),
    "stations": (
        ["supplier"],
        _fixed("""
SELECT s_suppkey AS station_code,
       -60 + CAST((s_suppkey * 37) % 1009 AS DOUBLE) / 50 AS longitude,
       -25 + CAST((s_suppkey * 53) % 1009 AS DOUBLE) / 50 AS latitude, s_nationkey AS state_initials
FROM supplier"""),
    ),
    "feeder_points": (
        ["customer", "orders"],
        _fixed("""
WITH k AS (SELECT c_nationkey AS code, c_custkey AS id FROM customer WHERE c_nationkey < 13
           UNION ALL
           SELECT c_nationkey, o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey
           WHERE c_nationkey >= 13)
SELECT code,
       -58 + CAST(code % 5 AS DOUBLE) * 3.5 + CAST((id * 7919) % 1000 AS DOUBLE) / 1000 *
         CAST(CASE code % 3 WHEN 0 THEN 0.05 WHEN 1 THEN 0.2 ELSE 0.6 END AS DOUBLE) AS longitude,
       -23 + CAST(code % 7 AS DOUBLE) * 2.5 + CAST((id * 104729) % 997 AS DOUBLE) / 997 *
         CAST(CASE code % 3 WHEN 0 THEN 0.05 WHEN 1 THEN 0.2 ELSE 0.6 END AS DOUBLE) AS latitude
FROM k"""),
    ),
    "station_history": (
        ["lineitem"],
        _fixed("""
SELECT l_suppkey AS station_code, year(l_shipdate) AS year, month(l_shipdate) AS month,
       CASE WHEN (l_suppkey + month(l_shipdate)) % 17 = 0 THEN NULL ELSE max(l_quantity) END AS temp_max,
       min(l_quantity) AS temp_min,
       CAST(avg(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS temp_mean,
       CAST(sum(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) AS precipitation,
       min(l_tax) AS humidity_min,
       CAST(avg(CAST(l_tax AS DECIMAL(18,2))) AS DOUBLE) AS humidity_mean,
       CAST(0.0 AS DOUBLE) AS windvelo_mean
FROM lineitem
WHERE NOT (year(l_shipdate) = 1998 AND month(l_shipdate) = 3)
GROUP BY l_suppkey, year(l_shipdate), month(l_shipdate)"""),
    ),
    "goals_wide": (["orders", "customer", "nation", "region"], _goals),
}


def _needed(names) -> list[str]:
    order: list[str] = []
    for name in names:
        parts = [p for p in BINDINGS[name][0] if p in BINDINGS]
        for part in [*_needed(parts), name]:
            if part not in order:
                order.append(part)
    return order


def with_bindings(names, body: str) -> str:
    """`body` preceded by the named tables. A body may go on with CTEs of its own by starting with
    a comma."""
    ctes = ",\n".join(f"{n} AS ({BINDINGS[n][1](chr(34))})" for n in _needed(names))
    body = body.strip()
    if not ctes:
        return "WITH " + body[1:] if body.startswith(",") else body
    recursive = "RECURSIVE " if "/*recursive*/" in body else ""
    return f"WITH {recursive}{ctes}\n{body}"
