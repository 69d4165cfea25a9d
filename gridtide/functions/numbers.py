"""Rounding, ratios and exact sums."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sums of doubles depend on row order, so amounts are summed as decimals.
EXACT = "decimal(24,6)"


def exact(c: Column) -> Column:
    return c.cast(EXACT)


def half_even(c: Column, digits: int = 0) -> Column:
    return F.bround(c, digits)


def whole(c: Column) -> Column:
    """Cut toward zero."""
    return c.cast("bigint")


def ratio(top: Column, bottom: Column) -> Column:
    """`top / bottom`, and 0 where the bottom is 0."""
    return F.when(bottom == 0, F.lit(0.0)).otherwise(top.cast("double") / bottom.cast("double"))


def share(part: Column, total: Column) -> Column:
    """`part / total`, and NULL where the total is 0."""
    return F.try_divide(part.cast("double"), total.cast("double"))
