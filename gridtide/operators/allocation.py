"""Budgeted assignment of ordered tasks."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, time, timedelta
from decimal import localcontext
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtide.functions.numbers import exact, half_even
from gridtide.functions.text import comma_decimal, feeder_code, plain_columns, plain_text, quantity
from gridtide.functions.dates import at_time
from gridtide.operators.ordering import lined_up
from gridtide.session import cut

# Task priorities in the order in which they are served.
PRIORITIES = ("U", "A", "B", "C")
# The status of a task that can be assigned; priorities of the first pass over a set.
OPEN_STATUS = "PR"
FIRST_PASS = ("U", "A")

# A group of up to this many candidates is walked item by item.
FOLD_LIMIT = 10_000
# Rows per chunk of a larger group.
CHUNK_ROWS = 50_000
# Up to this many chunks are named in a scan.
LISTED = 1000


def greedy_pick(
    items: DataFrame,
    groups: Sequence[str],
    order: Sequence[str],
    cost: str,
    budgets: DataFrame,
    budget: str = "budget",
    fold_limit: int = FOLD_LIMIT,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """The items taken when each group is walked in `order` and an item is taken if and only if it
    still fits in what is left of the group's `budget`. Returns (groups, order, cost) rows.

    `order` must be total within a group and costs positive (an item of cost 0 is taken too).

    What fits depends on everything taken before, which looks strictly sequential. It is not: let R
    be what is left, and call items small whose costs are of a lower power of two. In a chunk of the
    ordered items where all small ones fit and the cheapest other one does not, the small ones are
    taken and nothing else. A zone map (count, sum and minimum of each chunk's costs, by power of
    two) tells how far that goes. The first chunk where it does not is walked item by item, after
    which R is of a lower power of two, unless the cheapest item just no longer fitted when its turn
    came. So a jump reads the map and one chunk, and no chunk is walked twice. When a group has no
    more than `fold_limit` candidates left, they are walked together. No group is ever gathered
    whole, however many of the rows it holds.
    """
    groups, order = list(groups), list(order)
    money = budgets.select(*groups, exact(F.col(budget)).alias("left"))
    wanted = items.select(*groups, *order, exact(F.col(cost)).alias("cost")).join(money, groups)
    bad = F.raise_error(F.lit("greedy_pick needs costs of 0 or more"))
    wanted = wanted.withColumn("cost", F.when(F.col("cost") < 0, bad).otherwise(F.col("cost")))
    fitting = cut(wanted.where("cost <= left"), "fitting")

    sizes = fitting.groupBy(*groups).agg(F.count("*").alias("n"))
    stats = sizes.agg(F.max("n"), F.sum("n")).first()
    if (stats[0] or 0) <= fold_limit:
        picked = _walk(fitting, groups, order)
    else:
        few = sizes.where(F.col("n") <= fold_limit).select(*groups)
        many = sizes.where(F.col("n") > fold_limit).select(*groups)
        ranges = max(
            int(fitting.sparkSession.conf.get("spark.sql.shuffle.partitions")), stats[1] // chunk_rows + 1
        )
        picked = _walk(fitting.join(few, groups, "left_semi"), groups, order).unionByName(
            _jump(fitting.join(many, groups, "left_semi"), groups, order, ranges, fold_limit)
        )
    return picked.select(*groups, *order, F.col("cost").alias(cost))


@F.pandas_udf(T.ArrayType(T.BooleanType()))
def _fits(costs: pd.Series, left: pd.Series) -> pd.Series:
    """Whether each cost fits when its turn comes, in exact decimals. An array is walked once; a fold
    in SQL would copy the list of taken items for every item."""
    out = []
    with localcontext(prec=60):
        for line, rest in zip(costs, left, strict=True):
            flags = []
            for cost in line:
                fits = cost <= rest
                if fits:
                    rest -= cost
                flags.append(fits)
            out.append(flags)
    return pd.Series(out, dtype=object)


def _walk(items: DataFrame, groups: list[str], order: list[str]) -> DataFrame:
    """Item-by-item walk of groups of bounded size."""
    gathered = items.groupBy(*groups).agg(
        F.sort_array(F.collect_list(F.struct(*order, "cost"))).alias("line"),
        # more than the sum of all costs is as good as the sum
        F.least(F.max("left"), F.sum("cost")).alias("left"),
    )
    fits = _fits(F.col("line.cost"), F.col("left"))
    pairs = gathered.select(*groups, F.explode(F.arrays_zip("line", fits.alias("fits"))).alias("p"))
    return pairs.where("p.fits").select(*groups, "p.line.*")


def _power(amount: Column, none: int) -> Column:
    """The power of two of an amount; a larger amount never has a smaller one."""
    return F.coalesce(F.floor(F.log2(amount.cast("double"))).cast("int"), F.lit(none))


def _money(amount: Column) -> Column:
    return amount.cast("decimal(38,6)")


def zone_map(lined: DataFrame, groups: list[str]) -> DataFrame:
    """Count, sum and minimum of the costs of each chunk of a group, by their power of two; 0 is below all."""
    power = _power(F.col("cost"), -1000).alias("power")
    return lined.groupBy(*groups, "chunk", power).agg(F.count("*").alias("n"), F.sum("cost").alias("total"), F.min("cost").alias("least"))


def _jump(items: DataFrame, groups: list[str], order: list[str], ranges: int, fold_limit: int) -> DataFrame:
    lined = lined_up(items.drop("left"), groups, order, ranges)
    zones = cut(zone_map(lined, groups), "zones")
    spot = [*groups, "chunk"]
    state = items.groupBy(*groups).agg(_money(F.max("left")).alias("left")).withColumn("start", F.lit(0))
    before = Window.partitionBy(*groups).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    small = F.col("power") < F.col("limit")
    picked: list[DataFrame] = []
    skipped: list[DataFrame] = []
    while True:
        own = state.withColumn("limit", _power(F.col("left"), -999))
        ahead = zones.join(own, groups).where(F.col("chunk") >= F.col("start"))
        chunks = ahead.groupBy(*spot, "start", "left", "limit").agg(
            F.coalesce(F.sum(F.when(small, F.col("total"))), F.lit(0)).alias("small"),
            F.min(F.when(~small, F.col("least"))).alias("least"),
            F.sum(F.when(F.col("power") <= F.col("limit"), F.col("n"))).alias("n"),
        )
        # what is left where a chunk starts, if only small items are taken up to there
        rest = _money(F.col("left") - F.coalesce(F.sum("small").over(before), F.lit(0)))
        chunks = chunks.withColumn("rest", rest).withColumn("few", F.sum("n").over(Window.partitionBy(*groups)) <= fold_limit)
        stop = (F.col("small") > F.col("rest")) | F.coalesce(F.col("least") <= F.col("rest"), F.lit(False))
        chunks = cut(chunks.withColumn("stop", stop & ~F.col("few")), "jump")
        # the chunks to be walked, and whether groups are walked to their end
        asked = chunks.where("stop").groupBy(*groups).agg(F.min("chunk").alias("chunk"))
        named = [r.chunk for r in asked.select("chunk").distinct().limit(LISTED + 1).collect()]
        if not chunks.where("few").isEmpty():
            few = chunks.where("few").groupBy(*groups).agg(F.first("start").alias("start"), F.first("left").alias("left"))
            last = lined.join(few, groups).where((F.col("chunk") >= F.col("start")) & (F.col("cost") <= F.col("left")))
            picked.append(cut(_walk(last, groups, order), "walked"))
        over = chunks.where("not few").join(asked.withColumnRenamed("chunk", "at"), groups, "left")
        skipped.append(over.where("at is null or chunk < at").select(*spot, "limit"))
        if not named:
            break
        here = chunks.join(asked, spot, "left_semi").select(*spot, F.col("rest").alias("left"))
        rows = lined.where(F.col("chunk").isin(named)) if len(named) <= LISTED else lined
        fitting = rows.join(here, spot).where(F.col("cost") <= F.col("left"))
        picked.append(cut(_walk(fitting, groups, order), "walked"))
        spent = picked[-1].groupBy(*groups).agg(F.sum("cost").alias("spent"))
        left = _money(F.col("left") - F.coalesce(F.col("spent"), F.lit(0))).alias("left")
        state = here.join(spent, groups, "left").select(*groups, left, (F.col("chunk") + 1).alias("start"))
    # a row for each skipped chunk at most
    limits = reduce(DataFrame.unionByName, skipped)
    taken = lined.join(limits, spot).where(_power(F.col("cost"), -1000) < F.col("limit")).select(*groups, *order, "cost")
    return reduce(DataFrame.unionByName, picked, taken)


def clean_inspections(raw: DataFrame) -> DataFrame:
    """Inspection tasks with plain column names, parsed numbers and times, and the feeder code."""
    df = plain_columns(raw)
    if isinstance(df.schema["data cadastro"].dataType, T.StringType):
        day = F.coalesce(
            F.col("data cadastro").try_cast("timestamp_ntz"),
            F.try_to_timestamp("data cadastro", F.lit("d/M/yyyy")).cast("timestamp_ntz"),
        )
    else:  # a stored date can be compared in the scan
        day = F.col("data cadastro").cast("timestamp_ntz")
    return (
        df.withColumn("data cadastro", day)
        .withColumn("date_time", at_time(F.col("data cadastro"), F.col("hora do cadastro")))
        .withColumns(
            {
                "year": F.year("date_time"),
                "month": F.month("date_time"),
                "descricao": plain_text(F.col("descricao")),
                "descricao da causa": plain_text(F.col("descricao da causa")),
                "quantidade": quantity(F.col("quantidade")),
                "us servico": F.coalesce(comma_decimal(F.col("us servico")), F.lit(0.0)),
                "feeder": feeder_code(F.col("se"), F.col("alimentador")),
            }
        )
    )


def priority_rank(priority, priorities: Sequence[str] = PRIORITIES):
    """Place of a priority in the order of service; NULL for one that is not served."""
    place = F.array_position(F.lit(list(priorities)), priority)
    return F.when(place > 0, place.cast("int"))


def eligible_tasks(
    tasks: DataFrame,
    feeders: DataFrame,
    months: int,
    feeder: str = "feeder",
    id: str = "idservico",
    when: str = "date_time",
    priority: str = "prioridade",
    status: str = "status servico",
    cost: str = "us servico",
    asof: str = "pred_month",
    day: str = "data cadastro",
) -> DataFrame:
    """Open tasks of the feeders registered in the `months` months up to `asof`, one row per
    feeder, id and further column of `feeders`, with `prio`, `date_time`, `idservico`, `us`.

    `feeders` has the columns `feeder`, `asof` and any keys to carry along.
    """
    extra = [c for c in feeders.columns if c != feeder]
    rank = priority_rank(F.col(priority))
    # conditions are tried in this order: what only compares comes before what parses a time
    known = tasks.where((F.col(status) == OPEN_STATUS) & rank.isNotNull() & (F.col(cost) != 0))
    # the span of all requests is one row; as a literal it reaches the scan of a stored day
    span = feeders.agg(F.min(F.add_months(asof, 1 - months)), F.max(asof)).first()
    if span[0] is None:
        known = known.where(F.lit(False))
    else:
        if day in tasks.columns:  # `inside` sees to the hours, each time is parsed once
            low, high = (datetime.combine(d, time()) for d in (span[0] - timedelta(days=1), span[1] + timedelta(days=1)))
            known = known.where((F.col(day) >= F.lit(low).cast("timestamp_ntz")) & (F.col(day) < F.lit(high).cast("timestamp_ntz")))
        else:
            known = known.where(F.col(when).between(F.lit(span[0]), F.lit(span[1])))
    known = known.select(
        F.col(feeder).alias("feeder"),
        F.col(id).alias("idservico"),
        F.col(when).alias("date_time"),
        rank.alias("prio"),
        exact(F.col(cost)).alias("us"),
    )
    mine = feeders.withColumnRenamed(feeder, "feeder")
    inside = F.col("date_time").between(F.add_months(asof, 1 - months).cast("timestamp_ntz"), F.col(asof).cast("timestamp_ntz"))
    near = known.join(mine, "feeder").where(inside)
    return (
        near.groupBy(*extra, "feeder", "idservico")
        .agg(F.min(F.struct("prio", "date_time", "us")).alias("t"))
        .select(*extra, "feeder", "idservico", "t.*")
    )


ORDER = ["pass", "last", "delta", "feeder", "prio", "date_time", "idservico"]


def assign_month(
    eligible: DataFrame,
    feeders: DataFrame,
    budgets: DataFrame,
    key: str = "request_id",
    carry: str = "sum",
    fold_limit: int = FOLD_LIMIT,
) -> tuple[DataFrame, DataFrame]:
    """One month of assignments for all requests together.

    `feeders`: (key, feeder, effect, delta_chi_percent, by_feeder). Where `by_feeder` holds, each
    feeder spends its share of the budget by itself; elsewhere the set shares the budget, first for
    the urgent priorities over all feeders from the lowest delta up, then for the others. Both are
    the same greedy walk with different groups and order.

    Returns the picks (key, feeder, idservico, us) and the budgets left (key, us_services).
    `carry="last"` keeps only what the last feeder left, instead of the sum over the feeders.
    """
    shares = feeders.join(budgets.select(key, "us_services"), key).withColumns(
        {
            "wallet": F.when(F.col("by_feeder"), F.col("feeder").cast("string")).otherwise(F.lit("")),
            "budget": exact(
                F.when(F.col("by_feeder"), half_even(F.col("effect") * F.col("us_services"), 3)).otherwise(
                    F.col("us_services")
                )
            ),
        }
    )
    shares = cut(shares, "shares")
    own = F.when(F.col("by_feeder"), F.col("feeder")).alias("owner")
    wallets = shares.select(key, "wallet", own, "budget").distinct()
    lines = eligible.join(
        shares.select(key, "feeder", "wallet", "by_feeder", "delta_chi_percent"), [key, "feeder"]
    ).withColumns(
        {
            "pass": F.when(F.col("by_feeder") | (F.col("prio") <= len(FIRST_PASS)), 0).otherwise(1),
            "last": F.col("delta_chi_percent").isNull(),
            "delta": F.coalesce(F.col("delta_chi_percent"), F.lit(0.0)),
        }
    )
    picks = greedy_pick(lines, [key, "wallet"], ORDER, "us", wallets.drop("owner"), fold_limit=fold_limit)
    picks = cut(picks.select(key, "wallet", "feeder", "idservico", "us"), "picks")
    spent = picks.groupBy(key, "wallet").agg(F.sum("us").alias("spent"))
    left = wallets.join(spent, [key, "wallet"], "left").withColumn(
        "left", (F.col("budget") - F.coalesce(F.col("spent"), F.lit(0))).cast("double")
    )
    if carry == "last":
        after = left.groupBy(key).agg(F.max_by("left", F.struct("owner")).alias("us_services"))
    else:
        after = left.groupBy(key).agg(F.sum(exact(F.col("left"))).cast("double").alias("us_services"))
    return picks.drop("wallet"), cut(after, "budgets")


def assign_tasks(
    eligible: DataFrame,
    forecast: DataFrame,
    budgets: DataFrame,
    months: int,
    key: str = "request_id",
    carry: str = "sum",
) -> DataFrame:
    """Picks of all months (key, feeder, idservico, us, horizon).

    `forecast`: (key, feeder, horizon, effect, delta_chi_percent, by_feeder). What a month leaves
    of the budget goes to the next one, and a task is assigned once. The loop runs over months, a
    handful; every step covers all requests.
    """
    eligible = cut(eligible, "eligible")
    picked: list[DataFrame] = []
    for month in range(1, months + 1):
        open_tasks = eligible
        if picked:
            taken = reduce(DataFrame.unionByName, picked).select(key, "feeder", "idservico")
            open_tasks = eligible.join(taken, [key, "feeder", "idservico"], "left_anti")
        now = forecast.where(F.col("horizon") == month).drop("horizon")
        picks, budgets = assign_month(open_tasks, now, budgets, key, carry)
        picked.append(picks.withColumn("horizon", F.lit(month)))
    return reduce(DataFrame.unionByName, picked)
