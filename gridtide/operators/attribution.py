"""Outages attributed to maintenance services by cause, with weights."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtide.functions.numbers import ratio
from gridtide.functions.text import plain_text
from gridtide.session import cut

# Cause group (text after clean-up, spelling as stored), urban/rural tag (None: the
# group is counted over all tags together), service, weight.
RULES = [
    ("arvore", "U", "poda", "1.0"),
    ("arvore", "R", "faixa", "1.0"),
    ("manutencao estruturas", None, "estruturas", "1.0"),
    ("50% avores/ 50% outros", "U", "poda", "0.5"),
    ("50% avores/ 50% outros", "R", "faixa", "0.5"),
    ("70% arvore / 30% outros", "U", "poda", "0.7"),
    ("70% arvore / 30% outros", "R", "faixa", "0.7"),
]
SERVICES = ("poda", "faixa", "estruturas")
TOTAL = "total"
MILLION = 1_000_000


def with_cause(
    events: DataFrame,
    causes: DataFrame,
    on: Sequence[tuple[str, str]] = (
        ("cod_grupo", "num_idt_grupo_causas"),
        ("cod_causa", "num_idt_causa_interrupcao"),
    ),
    group: str = "grupo",
) -> DataFrame:
    """Events that have a known cause, with the clean cause group. The size of the cause table
    decides between a broadcast and a sort-merge join at run time."""
    dim = causes.select(*[F.col(r).alias(f"__{r}") for _, r in on], plain_text(F.col(group)).alias(group))
    match = [events[left] == dim[f"__{right}"] for left, right in on]
    return events.join(dim, match, "inner").drop(*[f"__{right}" for _, right in on])


def attribute(
    events: DataFrame,
    keys: Sequence[str],
    id: str = "id_interrupcao",
    value: str = "chi_tot",
    group: str = "grupo",
    tag: str = "tag_urb_rur",
    rules=RULES,
    periods: Column | None = None,
) -> DataFrame:
    """(keys, period, service, cnt, chi); service `total` counts every event.

    Per rule, distinct ids are counted, weighted and cut to a whole number; the rules of a service
    are then added. Amounts are summed in millionths, as whole decimals, so that order does not
    matter; only a sum beyond 1e17 is an error. `periods` is an array column: an event counts in each
    period listed there.

    The events are written once with the rules they meet. Amounts are summed per (keys, period), a few
    groups that each task reduces before the shuffle. Only the rules met are reduced to one row per (keys,
    period, id); that shuffle is spread by id, so a key with a large part of all events does not end in
    one task, and its rows are short. The rules are a short literal list: conditions, not a join.
    """
    rules = list(rules)
    met = [
        (F.col(group) == g) if t is None else (F.col(group) == g) & (F.col(tag) == t) for g, t, _s, _w in rules
    ]
    bits = [F.when(m, F.lit(1 << i).cast("bigint")).otherwise(F.lit(0).cast("bigint")) for i, m in enumerate(met)]
    rows = events.select(
        *keys,
        (F.lit("") if periods is None else F.explode(periods)).alias("period"),
        F.col(id).alias("__id"),
        F.col(value).cast("double").alias("__amount"),
        reduce(add, bits, F.lit(0).cast("bigint")).alias("__met"),
    )
    rows = cut(rows, "met")
    span = [*keys, "period"]
    numbers = range(len(rules))

    def under(i: int, c: str) -> Column:
        """`c` where rule `i` is met."""
        return F.when(F.col("__met").bitwiseAND(F.lit(1 << i).cast("bigint")) != 0, F.col(c))

    amounts = rows.withColumn("__value", F.round(F.col("__amount") * MILLION).cast("decimal(38,0)"))
    totals = amounts.groupBy(*span).agg(
        F.sum("__value").alias("__value"),
        F.bit_or("__met").alias("__met"),
        *[F.sum(under(i, "__value")).alias(f"__value{i}") for i in numbers],
    )
    per_id = rows.groupBy(*span, "__id").agg(F.bit_or("__met").alias("__met"))
    counts = per_id.groupBy(*span).agg(
        F.count("__id").alias("__n"), *[F.count(under(i, "__id")).alias(f"__n{i}") for i in numbers]
    )
    # one row of each for every key, null keys too
    both = totals.unionByName(counts, allowMissingColumns=True)
    wide = both.groupBy(*span).agg(*[F.max(c).alias(c) for c in both.columns if c not in span])

    def chi(c: str, weight: str) -> Column:
        """The weighted amount in hundredths of millionths; these widths keep every step exact."""
        hundredths = F.lit(int(Decimal(weight) * 100)).cast("decimal(3,0)")
        return F.coalesce(F.col(c), F.lit(0)).cast("decimal(23,0)") * hundredths

    def line(service: str, cnt: Column, amount: Column, known: Column) -> Column:
        return F.struct(
            F.lit(service).alias("service"),
            cnt.cast("bigint").alias("cnt"),
            (amount.cast("decimal(29,0)") * F.lit("0.00000001").cast("decimal(8,8)")).cast("double").alias("chi"),
            known.alias("known"),
        )

    lines = [line(TOTAL, F.col("__n"), chi("__value", "1"), F.lit(True))]
    for service in dict.fromkeys(r[2] for r in rules):
        own = [(i, r[3]) for i, r in enumerate(rules) if r[2] == service]
        counts = [(F.col(f"__n{i}") * F.lit(float(w))).cast("bigint") for i, w in own]
        amounts = [chi(f"__value{i}", w) for i, w in own]
        mask = F.lit(sum(1 << i for i, _w in own)).cast("bigint")
        lines.append(line(service, reduce(add, counts), reduce(add, amounts), F.col("__met").bitwiseAND(mask) != 0))
    out = wide.select(*span, F.explode(F.array(*lines)).alias("l")).where("l.known")
    out = out.select(*span, "l.service", "l.cnt", "l.chi")
    return out if periods is not None else out.drop("period")


def service_columns(attributed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: count and value of each service, 0 where there is none, plus the mean
    value per counted event."""
    names = (*SERVICES, TOTAL)
    sums = [
        F.coalesce(F.sum(F.when(F.col("service") == s, F.col(c))), F.lit(zero)).alias(f"{c}_{s}")
        for s in names
        for c, zero in (("cnt", 0), ("chi", 0.0))
    ]
    wide = attributed.groupBy(*keys).agg(*sums)
    return wide.select("*", *[ratio(F.col(f"chi_{s}"), F.col(f"cnt_{s}")).alias(f"avg_{s}") for s in SERVICES])
