"""Text clean-up and localised number text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The accented letters that are folded, and the letter each becomes.
ACCENTED = "àäãâáéêíõóôç"
FOLDED = "aaaaaeeioooc"
# The ASCII white space removed from both ends of a text.
BLANKS = " \t\n\r\x0b\x0c"

NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
INFINITE = r"^[+-]?(?i:inf|infinity)$"


def plain_text(c: Column) -> Column:
    """Lower case, outer blanks removed, accents folded."""
    return F.translate(F.btrim(F.lower(c), F.lit(BLANKS)), ACCENTED, FOLDED)


def plain_name(name: str) -> str:
    """A column name in lower case with accents folded; blanks stay."""
    return name.lower().translate(str.maketrans(ACCENTED, FOLDED))


def plain_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*map(plain_name, df.columns))


def text_length(c: Column) -> Column:
    return F.char_length(c)


def to_float(c: Column) -> Column:
    """Text to double; anything that is not a number becomes NULL."""
    t = F.btrim(c.cast("string"), F.lit(BLANKS))
    return F.when(t.rlike(NUMBER) | t.rlike(INFINITE), t.try_cast("double"))


def to_int(c: Column) -> Column:
    """Text to bigint by way of a double, cutting the fraction; bad text becomes NULL."""
    t = F.btrim(c.cast("string"), F.lit(BLANKS))
    return F.when(t.rlike(NUMBER), t.try_cast("double").try_cast("bigint"))


def quantity(c: Column) -> Column:
    """`12,000` (three zero decimals) to 12."""
    return F.replace(c.cast("string"), F.lit(",000"), F.lit("")).try_cast("bigint")


def comma_decimal(c: Column) -> Column:
    """`3,5` to 3.5."""
    return F.replace(c.cast("string"), F.lit(","), F.lit(".")).try_cast("double")


def number_text(c: Column, scale: int = 2, sep: str = ",") -> Column:
    """A number as text: at least one and at most `scale` decimals, never an exponent."""
    digits = c.cast(f"decimal(38,{scale})").cast("string")
    return F.replace(F.regexp_replace(digits, r"(\.\d+?)0+$", "$1"), F.lit("."), F.lit(sep))


def feeder_code(substation: Column, number: Column) -> Column:
    """Substation code followed by the feeder number, zero-padded to two characters."""
    n = number.cast("string")
    return F.concat(substation, F.when(F.length(n) < 2, F.lpad(n, 2, "0")).otherwise(n))
