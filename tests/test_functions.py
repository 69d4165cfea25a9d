"""B: column expressions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridtide.functions import dates, geo, numbers, text


def one(spark, expr, *values, names="abcdef"):
    types = {int: "bigint", float: "double", str: "string", type(None): "string"}
    schema = ", ".join(f"{n} {types[type(v)]}" for n, v in zip(names, values))
    return spark.createDataFrame([values], schema).select(expr.alias("x")).first().x


@pytest.mark.parametrize(
    "raw, plain",
    [("MaÇã", "maca"), ("pÉ", "pe"), ("pêra", "pera"), ("híFeN", "hifen"), (" \tÀÄÃÂÁ óôõ\n", "aaaaa ooo"), ("über ñ", "über ñ")],
)
def test_plain_text(spark, raw, plain):
    assert one(spark, text.plain_text(F.col("a")), raw) == plain


def test_plain_name_keeps_blanks(spark):
    assert text.plain_name(" MaÇã B") == " maca b"
    assert text.plain_columns(spark.range(1).toDF("Descrição da Causa")).columns == ["descricao da causa"]


@pytest.mark.parametrize("raw, n", [("123", 123), ("3.14", 3), ("-3.9", -3), ("abc", None), ("1.0d", None), ("inf", None), ("1e3", 1000), (" 7 ", 7), (None, None)])
def test_to_int(spark, raw, n):
    assert one(spark, text.to_int(F.col("a")), raw) == n


@pytest.mark.parametrize("raw, x", [("3.14", 3.14), ("abc", None), ("1.0d", None), (".5", 0.5), ("5.", 5.0), ("-inf", float("-inf"))])
def test_to_float(spark, raw, x):
    assert one(spark, text.to_float(F.col("a")), raw) == x


@pytest.mark.parametrize("raw, n", [("abcdefg", 7), ("", 0), (None, None)])
def test_text_length(spark, raw, n):
    assert one(spark, text.text_length(F.col("a")), raw) == n


def test_parse_date(spark):
    assert one(spark, dates.parse_date(F.col("a")), "03/12/2019") == dt.datetime(2019, 12, 3)
    assert one(spark, dates.parse_date(F.col("a")), "2019-09-23") is None
    assert one(spark, dates.parse_date(F.col("a"), "yyyy-MM-dd"), "2019-09-23") == dt.datetime(2019, 9, 23)


@pytest.mark.parametrize(
    "raw, when",
    [
        ("03/12/2019 04:05:06", dt.datetime(2019, 12, 3, 4, 5, 6)),
        ("3/12/2019", dt.datetime(2019, 12, 3)),
        ("2019-12-03", dt.datetime(2019, 12, 3)),
        ("31/31/2019", None),
    ],
)
def test_parse_day_first(spark, raw, when):
    assert one(spark, dates.parse_day_first(F.col("a")), raw) == when


@pytest.mark.parametrize("number, code", [("7", "SE07"), ("12", "SE12"), ("123", "SE123")])
def test_feeder_code(spark, number, code):
    assert one(spark, text.feeder_code(F.lit("SE"), F.col("a")), number) == code


def test_numbers_in_local_form(spark):
    assert one(spark, text.quantity(F.col("a")), "12,000") == 12
    assert one(spark, text.quantity(F.col("a")), "x") is None
    assert one(spark, text.comma_decimal(F.col("a")), "3,5") == 3.5
    shown = [(3.0, "3,0"), (3.5, "3,5"), (3.25, "3,25"), (123456789.5, "123456789,5"), (-0.1, "-0,1"), (100.0, "100,0")]
    for x, s in shown:
        assert one(spark, text.number_text(F.col("a")), x) == s


@pytest.mark.parametrize("x, digits, y", [(2.5, 0, 2.0), (3.5, 0, 4.0), (0.125, 2, 0.12), (-2.5, 0, -2.0)])
def test_half_even(spark, x, digits, y):
    assert one(spark, numbers.half_even(F.col("a"), digits), x) == y


def test_ratio_and_share(spark):
    assert one(spark, numbers.ratio(F.col("a"), F.col("b")), 1.0, 0.0) == 0
    assert one(spark, numbers.ratio(F.col("a"), F.col("b")), 1, 4) == 0.25
    assert one(spark, numbers.share(F.col("a"), F.col("b")), 1, 0) is None


def test_months(spark):
    month = dates.month_of(F.col("a"), F.col("b"))
    assert one(spark, month, 2020, 2) == dt.date(2020, 2, 1)
    assert one(spark, dates.month_label(month), 2020, 2) == "2/2020"
    weights = [one(spark, dates.season_weight(F.col("a")), m) for m in range(1, 13)]
    assert weights == [2, 2, 2, 1, 1, 1, 1, 1, 1, 2, 2, 2]


def test_distance(spark):
    quarter = geo.haversine(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.col("a"))
    assert one(spark, quarter, 90.0) == pytest.approx(6371 * 3.141592653589793 / 2)
    mi = geo.haversine(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.col("a"), unit="mi")
    assert one(spark, mi, 90.0) == pytest.approx(3959 * 3.141592653589793 / 2)
    assert one(spark, geo.haversine(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.col("a"), unit="?"), 180.0) == pytest.approx(20015.0868)
    swapped = geo.haversine(F.lit(50.0), F.lit(-20.0), F.lit(50.0), F.col("a"), axis_order="legacy")
    straight = geo.haversine(F.lit(-20.0), F.lit(50.0), F.col("a"), F.lit(50.0))
    assert one(spark, swapped, -21.0) == pytest.approx(one(spark, straight, -21.0))
