"""I: greedy assignment."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gridtide.operators import allocation as A
from gridtide.operators.ordering import places


def brute(items, budget):
    taken = []
    for order, cost in items:
        if cost <= budget:
            budget -= cost
            taken.append(order)
    return taken


def picked(spark, rows, budgets, **options):
    items = spark.createDataFrame(rows, "g int, o int, c double")
    money = spark.createDataFrame(budgets, "g int, budget double")
    return {(r.g, r.o) for r in A.greedy_pick(items, ["g"], ["o"], "c", money, **options).collect()}


def test_walk_skips_what_does_not_fit(spark):
    rows = [(1, 1, 5.0), (1, 2, 4.0), (1, 3, 2.0), (1, 4, 9.0), (1, 5, 1.0)]
    assert picked(spark, rows, [(1, 8.0)]) == {(1, 1), (1, 3), (1, 5)}


@pytest.mark.parametrize("seed", [1, 2])
def test_large_groups_take_the_same_items(spark, seed):
    random.seed(seed)
    rows, budgets, expected = [], [], set()
    for g in range(6):
        budget = random.choice([0, 10, 300, 5000, 10**6])
        shapes = [
            lambda: random.randint(1, 30),
            lambda: random.randint(1, max(1, budget)),
            lambda: budget // 2 + random.randint(0, 1),
            lambda: random.choice([0, budget, budget + 1]),
        ]
        items = [(o, float(random.choice(shapes)())) for o in range(random.choice([0, 1, 7, 150, 300]))]
        rows += [(g, o, c) for o, c in items]
        budgets.append((g, float(budget)))
        expected |= {(g, o) for o in brute(items, budget)}
    assert picked(spark, rows, budgets, fold_limit=8, chunk_rows=60) == expected


def test_halving_worst_case(spark):
    """Each small item is followed by one that just no longer fits."""
    rows, left = [], 64.0
    for i in range(40):
        rows += [(1, 2 * i, 0.5), (1, 2 * i + 1, left)]
        left -= 0.5
    expected = {(1, o) for o in brute([(o, c) for _, o, c in rows], 64.0)}
    assert picked(spark, rows, [(1, 64.0)], fold_limit=2, chunk_rows=10) == expected


def test_costs_about_powers_of_two(spark):
    """Costs of 0, at and just beside a power of two, and amounts beyond what a double holds exactly."""
    random.seed(4)
    for budget in (0, 64, 10**15 + 0.5, 96.000001):
        choices = [0, 1, 0.999999, 32, 31.999999, 32.000001, 64, 63.999999, 2**49, 2**49 + 0.000001, 10**15, 10**15 - 0.000001]
        items = [(o, Decimal(str(random.choice(choices)))) for o in range(160)]
        rows = spark.createDataFrame([(1, o, c) for o, c in items], "g int, o int, c decimal(24,6)")
        money = spark.createDataFrame([(1, Decimal(str(budget)))], "g int, b decimal(24,6)")
        got = A.greedy_pick(rows, ["g"], ["o"], "c", money, "b", fold_limit=3, chunk_rows=9).collect()
        assert {r.o for r in got} == set(brute(items, Decimal(str(budget))))


def test_zone_map(spark):
    lined = spark.createDataFrame([(1, 0, Decimal(c)) for c in ("0", "0.5", "3", "2", "4")] + [(1, 1, Decimal("4"))], "g int, chunk int, cost decimal(24,6)")
    got = {(r.chunk, r.power): (r.n, r.total, r.least) for r in A.zone_map(lined, ["g"]).collect()}
    assert got == {(0, -1000): (1, 0, 0), (0, -1): (1, Decimal("0.5"), Decimal("0.5")), (0, 1): (2, 5, 2), (0, 2): (1, 4, 4), (1, 2): (1, 4, 4)}


def test_negative_cost_is_an_error(spark):
    with pytest.raises(PySparkException):
        picked(spark, [(1, 1, -1.0)], [(1, 5.0)])


def test_group_without_budget_row_takes_nothing(spark):
    assert picked(spark, [(1, 1, 1.0), (2, 1, 1.0)], [(2, 5.0)]) == {(2, 1)}


def test_places_across_ranges(spark):
    rows = [(i % 7 == 0, (i * 7919) % 1000) for i in range(1000)]
    df = spark.createDataFrame(rows, "g boolean, o int")
    got = {(r.g, r.o): r.place for r in places(df, ["g"], ["o"], ranges=9).collect()}
    for g in (True, False):
        order = sorted(o for x, o in rows if x == g)
        assert [got[g, o] for o in order] == list(range(1, len(order) + 1))


NOW = dt.date(2020, 6, 1)


def tasks(spark, rows):
    fields = "feeder string, idservico int, date_time timestamp_ntz, prioridade string, `status servico` string, `us servico` double"
    return spark.createDataFrame(rows, fields)


def test_eligible_tasks(spark):
    day = lambda m, d=1: dt.datetime(2020, m, d)
    rows = [
        ("a", 1, day(1), "U", "PR", 1.0),  # first day of the window of 6 months
        ("a", 2, dt.datetime(2019, 12, 31, 23), "U", "PR", 1.0),  # too old
        ("a", 3, day(6), "C", "PR", 1.0),  # the date itself counts
        ("a", 4, day(6, 2), "C", "PR", 1.0),  # too late
        ("a", 5, day(3), "U", "EX", 1.0),  # not open
        ("a", 6, day(3), "X", "PR", 1.0),  # no such priority
        ("a", 7, day(3), "B", "PR", 0.0),  # nothing to do
        ("a", 8, day(4), "B", "PR", 2.0),
        ("a", 8, day(3), "B", "PR", 3.0),  # same id: the earlier one
        ("b", 9, day(3), "A", "PR", 1.0),  # not asked for
    ]
    feeders = spark.createDataFrame([("r", "a", NOW)], "request_id string, feeder string, pred_month date")
    got = A.eligible_tasks(tasks(spark, rows), feeders, 6).collect()
    assert {(r.idservico, r.prio, float(r.us)) for r in got} == {(1, 1, 1.0), (3, 4, 1.0), (8, 3, 3.0)}
    assert A.eligible_tasks(tasks(spark, rows), feeders.limit(0), 6).count() == 0


def month(spark, by_feeder, budget, rows, effects=(("a", 0.5, -0.2), ("b", 0.5, -0.5)), carry="sum"):
    lines = spark.createDataFrame(
        [("r", f, i, p, dt.datetime(2020, 1, d), u) for f, i, p, d, u in rows],
        "request_id string, feeder string, idservico int, prio int, date_time timestamp_ntz, us double",
    ).withColumn("us", F.col("us").cast("decimal(24,6)"))
    feeders = spark.createDataFrame(
        [("r", f, e, d, by_feeder) for f, e, d in effects],
        "request_id string, feeder string, effect double, delta_chi_percent double, by_feeder boolean",
    )
    money = spark.createDataFrame([("r", budget)], "request_id string, us_services double")
    picks, left = A.assign_month(lines, feeders, money, carry=carry)
    return {r.idservico for r in picks.collect()}, {r.request_id: r.us_services for r in left.collect()}


LINES = [("a", 1, 1, 2, 3.0), ("a", 2, 1, 1, 4.0), ("a", 3, 4, 1, 1.0), ("b", 4, 2, 1, 5.0), ("b", 5, 3, 1, 2.0)]


def test_times_of_closed_tasks_are_not_parsed(spark, capsys):
    """What only compares is tried before what parses a time, and a time is parsed once."""
    cells = ["idservico", "idnsmanut", "status servico", "dispositivo", "se", "alimentador", "descricao", "quantidade", "us servico", "prioridade", "data cadastro", "hora do cadastro", "causa", "descricao da causa", "causa ciga"]
    raw = spark.createDataFrame([(1, *["x"] * 14)], ", ".join(f"`{c}` {'long' if c == 'idservico' else 'string'}" for c in cells))
    feeders = spark.createDataFrame([("r", "F1", dt.date(2020, 1, 1))], "request_id string, feeder string, pred_month date")
    A.eligible_tasks(A.clean_inspections(raw), feeders, 6).explain()
    kept = next(x for x in capsys.readouterr().out.splitlines() if " Filter " in x and "status servico" in x)
    assert kept.index("status servico") < kept.index("data cadastro")
    assert kept.count("yyyy-MM-dd H:mm:ss") <= 1


def test_own_budget_per_feeder(spark):
    # 5 units each: a takes 2 (earlier), not 1, then 3; b takes 4 and nothing more
    assert month(spark, True, 10.0, LINES) == ({2, 3, 4}, {"r": 0.0})
    assert month(spark, True, 12.0, LINES, carry="last") == ({2, 3, 4}, {"r": 1.0})
    assert month(spark, True, 12.0, LINES, carry="sum") == ({2, 3, 4}, {"r": 2.0})


def test_shared_budget_serves_urgent_first(spark):
    # b has the lower delta: 4 first, then a's urgent ones, then b's and a's others
    assert month(spark, False, 9.0, LINES) == ({4, 2}, {"r": 0.0})
    assert month(spark, False, 12.0, LINES) == ({4, 2, 1}, {"r": 0.0})
    assert month(spark, False, 14.5, LINES) == ({4, 2, 1, 5}, {"r": 0.5})
    missing = (("a", 0.5, 0.9), ("b", 0.5, None))  # no delta comes last
    assert month(spark, False, 7.0, LINES, missing)[0] == {2, 1}


def test_chain_never_assigns_twice(spark):
    lines = spark.createDataFrame(
        [("r", "a", i, 1, dt.datetime(2020, 1, 1), 3.0) for i in range(6)],
        "request_id string, feeder string, idservico int, prio int, date_time timestamp_ntz, us double",
    ).withColumn("us", F.col("us").cast("decimal(24,6)"))
    plan = spark.createDataFrame(
        [("r", "a", h, 1.0, 0.0, h == 1) for h in (1, 2, 3)],
        "request_id string, feeder string, horizon int, effect double, delta_chi_percent double, by_feeder boolean",
    )
    money = spark.createDataFrame([("r", 10.0)], "request_id string, us_services double")
    got = [(r.idservico, r.horizon) for r in A.assign_tasks(lines, plan, money, 3).collect()]
    assert sorted(got) == [(0, 1), (1, 1), (2, 1)]  # 1 unit is left and fits nothing


def test_clean_inspections(spark):
    raw = spark.createDataFrame(
        [(1, "PR", "S", "7", " Árvore", "12,000", "3,5", "2020-01-31", "04:05:06", "CAÍDA"), (2, "PR", "S", "123", "x", "1,000", None, "2020-02-01", "00:00:00", "y")],
        "`IDServico` int, `Status Serviço` string, SE string, Alimentador string, `Descrição` string, Quantidade string, "
        "`US Serviço` string, `Data Cadastro` string, `Hora do Cadastro` string, `Descrição da Causa` string",
    )
    first, second = A.clean_inspections(raw).orderBy("idservico").collect()
    assert first["date_time"] == dt.datetime(2020, 1, 31, 4, 5, 6) and (first.year, first.month) == (2020, 1)
    assert (first.feeder, first.descricao, first.quantidade, first["us servico"]) == ("S07", "arvore", 12, 3.5)
    assert (second.feeder, second["us servico"], first["descricao da causa"]) == ("S123", 0.0, "caida")


def test_large_amounts_walked_and_jumped(spark):
    """The answer does not depend on the size of a group."""
    rows = [(1, k, 1e13) for k in range(5)] + [(2, 1, 3e13), (2, 2, 0.000001), (2, 3, 1e13)]
    budgets = [(1, 3e13), (2, 3e13)]
    walked = picked(spark, rows, budgets)
    assert walked == picked(spark, rows, budgets, fold_limit=1, chunk_rows=2) == {(1, 0), (1, 1), (1, 2), (2, 1)}
