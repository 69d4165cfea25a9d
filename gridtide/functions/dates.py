"""Dates, months and periods."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Months that weigh 2 in the seasonal weight (October to March).
HEAVY_MONTHS = (10, 11, 12, 1, 2, 3)

DAY_FIRST = (
    "d/M/yyyy H:mm:ss",
    "d/M/yyyy H:mm",
    "d/M/yyyy",
    "d-M-yyyy H:mm:ss",
    "d-M-yyyy",
    "yyyy-M-d H:mm:ss",
    "yyyy-M-d",
)


def parse_date(c: Column, pattern: str = "d/M/yyyy") -> Column:
    """Text to timestamp by one pattern; anything else becomes NULL."""
    return F.try_to_timestamp(c, F.lit(pattern)).cast("timestamp_ntz")


def parse_day_first(c: Column) -> Column:
    """Text to timestamp, reading an ambiguous date day first; bad text becomes NULL."""
    return F.coalesce(*[parse_date(c, p) for p in DAY_FIRST])


def at_time(day: Column, clock: Column) -> Column:
    """A date plus a `HH:mm:ss` time of day."""
    text = F.concat_ws(" ", F.date_format(day, "yyyy-MM-dd"), clock)
    return F.when(
        day.isNotNull() & clock.isNotNull(), F.try_to_timestamp(text, F.lit("yyyy-MM-dd H:mm:ss"))
    ).cast("timestamp_ntz")


def month_of(year: Column, month: Column) -> Column:
    return F.make_date(year.cast("int"), month.cast("int"), F.lit(1))


def month_start(c: Column) -> Column:
    return F.trunc(c, "month")


def within(c: Column, start: Column | None, end: Column | None) -> Column:
    """Half-open `[start, end)`; either bound may be absent."""
    keep = F.lit(True)
    if start is not None:
        keep = keep & (c >= start)
    if end is not None:
        keep = keep & (c < end)
    return keep


def month_label(c: Column) -> Column:
    """`m/yyyy`, no zero padding."""
    return F.concat(F.month(c).cast("string"), F.lit("/"), F.year(c).cast("string"))


def season_weight(month_number: Column) -> Column:
    return F.when(month_number.isin(*HEAVY_MONTHS), 2).otherwise(1)
