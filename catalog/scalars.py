"""B: column expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import check
from gridtide.functions import dates, geo, numbers, text

# The same clean-up as DuckDB text.
_BLANKS = "concat(' ', chr(9), chr(10), chr(13), chr(11), chr(12))"


def plain_sql(c: str) -> str:
    return f"translate(trim(lower({c}), {_BLANKS}), 'àäãâáéêíõóôç', 'aaaaaeeioooc')"


@check("B1_plain_text", f"SELECT doc_id, {plain_sql('text')} AS plain FROM documents")
def _(data):
    return data["documents"].select("doc_id", text.plain_text(F.col("text")).alias("plain"))


@check(
    "B2_plain_column_names",
    "SELECT s_suppkey AS \"codigo da estacao\", s_name AS descricao, s_acctbal AS \"uniao\" FROM supplier",
)
def _(data):
    df = data["supplier"].select("s_suppkey", "s_name", "s_acctbal")
    return text.plain_columns(df.toDF("Código da Estação", "DESCRIÇÃO", "União"))


_DATE_TEXT = """CASE o_orderpriority WHEN '1-URGENT' THEN strftime(o_orderdate, '%Y-%m-%d')
    WHEN '2-HIGH' THEN 'no date' ELSE strftime(o_orderdate, '%d/%m/%Y') END"""


@check(
    "B3_parse_date",
    """SELECT o_orderkey, CASE WHEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH')
              THEN CAST(o_orderdate AS VARCHAR) END AS day,
              CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(o_orderdate AS VARCHAR) END AS iso_day FROM orders""",
)
def _(data):
    shown = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(F.col("o_orderpriority") == "2-HIGH", "no date")
        .otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    )
    return data["orders"].select(
        "o_orderkey",
        dates.parse_date(shown).cast("string").alias("day"),
        dates.parse_date(shown, "yyyy-MM-dd").cast("string").alias("iso_day"),
    )


@check(
    "B4_parse_day_first",
    """SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN CAST(date_trunc('day', ts) AS VARCHAR)
              ELSE CAST(date_trunc('second', ts) AS VARCHAR) END AS at FROM events""",
)
def _(data):
    shown = (
        F.when(F.col("event_type") == "error", F.concat(F.lit("at "), F.col("props")))
        .when(F.col("event_type") == "view", F.date_format("ts", "d/M/yyyy"))
        .when(F.col("event_type") == "click", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.date_format("ts", "dd/MM/yyyy H:mm:ss"))
    )
    at = dates.parse_day_first(shown)
    return data["events"].select("event_id", F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("at"))


# Numbers as text in several shapes, some of them bad.
_NUMBER_TEXT = """CASE event_type WHEN 'error' THEN props
    WHEN 'view' THEN concat(' ', CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR), ' ')
    WHEN 'click' THEN concat(CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR), 'd')
    ELSE concat('-', CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR), 'e2') END"""


def _number_text():
    money = F.col("value").cast("decimal(18,2)").cast("string")
    return (
        F.when(F.col("event_type") == "error", F.col("props"))
        .when(F.col("event_type") == "view", F.concat(F.lit(" "), money, F.lit(" ")))
        .when(F.col("event_type") == "click", F.concat(money, F.lit("d")))
        .otherwise(F.concat(F.lit("-"), money, F.lit("e2")))
    )


@check(
    "B5_to_int",
    f"SELECT event_id, CAST(trunc(TRY_CAST(trim({_NUMBER_TEXT}) AS DOUBLE)) AS BIGINT) AS n FROM events",
)
def _(data):
    return data["events"].select("event_id", text.to_int(_number_text()).alias("n"))


@check("B6_to_float", f"SELECT event_id, TRY_CAST(trim({_NUMBER_TEXT}) AS DOUBLE) AS x FROM events")
def _(data):
    return data["events"].select("event_id", text.to_float(_number_text()).alias("x"))


@check(
    "B7_text_length",
    """SELECT doc_id, length(text) AS n, length(nullif(lang, 'en')) AS n_lang FROM documents""",
)
def _(data):
    return data["documents"].select(
        "doc_id",
        text.text_length(F.col("text")).alias("n"),
        text.text_length(F.nullif(F.col("lang"), F.lit("en"))).alias("n_lang"),
    )


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str, radius: int = 6371) -> str:
    return (
        f"({2 * radius} * asin(sqrt(least(1.0, pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + "
        f"cos(radians({lat1})) * cos(radians({lat2})) * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2)))))"
    )


_HERE = ("latitude", "longitude", "CAST(-23.55 AS DOUBLE)", "CAST(-46.63 AS DOUBLE)")


@check(
    "B8_great_circle_distance",
    f"""SELECT station_code, round({haversine_sql(*_HERE)}, 6) AS km, round({haversine_sql(*_HERE, 3959)}, 6) AS mi,
        round({haversine_sql(_HERE[1], _HERE[0], _HERE[3], _HERE[2])}, 6) AS legacy_km FROM stations""",
    ("stations",),
)
def _(data):
    here = (F.col("latitude"), F.col("longitude"), F.lit(-23.55), F.lit(-46.63))
    return data["stations"].select(
        "station_code",
        F.round(geo.haversine(*here), 6).alias("km"),
        F.round(geo.haversine(*here, unit="mi"), 6).alias("mi"),
        F.round(geo.haversine(*here, axis_order="legacy"), 6).alias("legacy_km"),
    )


@check(
    "B9_feeder_code",
    """SELECT c_custkey, concat('SE', c_nationkey, CASE WHEN c_custkey % 120 < 10 THEN '0' ELSE '' END, c_custkey % 120) AS code
       FROM customer""",
)
def _(data):
    code = text.feeder_code(F.concat(F.lit("SE"), F.col("c_nationkey").cast("string")), F.col("c_custkey") % 120)
    return data["customer"].select("c_custkey", code.alias("code"))


@check(
    "B10_first_of_month",
    "SELECT o_orderkey, CAST(make_date(year(o_orderdate), month(o_orderdate), 1) AS VARCHAR) AS month FROM orders",
)
def _(data):
    month = dates.month_of(F.year("o_orderdate"), F.month("o_orderdate"))
    return data["orders"].select("o_orderkey", month.cast("string").alias("month"))


@check(
    "B11_date_plus_time",
    """SELECT event_id, CAST(date_trunc('second', ts) AS VARCHAR) AS at, year(ts) AS y, month(ts) AS m FROM events""",
)
def _(data):
    at = dates.at_time(F.col("ts").cast("date"), F.date_format("ts", "HH:mm:ss"))
    return (
        data["events"]
        .select("event_id", at.alias("at"))
        .select("event_id", F.col("at").cast("string").alias("at"), F.year("at").alias("y"), F.month("at").alias("m"))
    )


@check(
    "B12_parse_local_numbers",
    """SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS quantity, l_discount AS discount, l_extendedprice
       FROM lineitem""",
)
def _(data):
    quantity = F.concat(F.col("l_quantity").cast("bigint").cast("string"), F.lit(",000"))
    discount = F.replace(F.col("l_discount").cast("string"), F.lit("."), F.lit(","))
    return data["lineitem"].select(
        "l_orderkey",
        "l_linenumber",
        text.quantity(quantity).alias("quantity"),
        text.comma_decimal(discount).alias("discount"),
        "l_extendedprice",
    )


@check(
    "B13_format_local_numbers",
    r"""SELECT o_orderkey, replace(regexp_replace(CAST(CAST(o_totalprice * 100 AS DECIMAL(18,2)) AS VARCHAR), '0$', ''), '.', ',')
        AS amount FROM orders""",
)
def _(data):
    return data["orders"].select("o_orderkey", text.number_text(F.col("o_totalprice") * 100).alias("amount"))


@check(
    "B14_month_arithmetic",
    """SELECT o_orderkey, CAST(CAST(o_orderdate + INTERVAL 1 MONTH AS DATE) AS VARCHAR) AS next,
              CAST(CAST(o_orderdate - INTERVAL 11 MONTH AS DATE) AS VARCHAR) AS before FROM orders""",
)
def _(data):
    return data["orders"].select(
        "o_orderkey",
        F.add_months("o_orderdate", 1).cast("string").alias("next"),
        F.add_months("o_orderdate", -11).cast("string").alias("before"),
    )


@check(
    "B15_season_weight",
    "SELECT o_orderkey, CASE WHEN month(o_orderdate) IN (1, 2, 3, 10, 11, 12) THEN 2 ELSE 1 END AS weight FROM orders",
)
def _(data):
    return data["orders"].select("o_orderkey", dates.season_weight(F.month("o_orderdate")).alias("weight"))


@check(
    "B16_round_half_even",
    """SELECT l_orderkey, l_linenumber, l_extendedprice, round_even(l_quantity / 2, 0) AS whole,
              round_even(l_quantity / 8, 2) AS cents FROM lineitem""",
)
def _(data):
    return data["lineitem"].select(
        "l_orderkey",
        "l_linenumber",
        "l_extendedprice",
        numbers.half_even(F.col("l_quantity") / 2).alias("whole"),
        numbers.half_even(F.col("l_quantity") / 8, 2).alias("cents"),
    )


@check("B17_cut_fraction", "SELECT o_orderkey, CAST(trunc(o_totalprice - 250000) AS BIGINT) AS n FROM orders")
def _(data):
    return data["orders"].select("o_orderkey", numbers.whole(F.col("o_totalprice") - 250000).alias("n"))


@check("B18_month_label", "SELECT o_orderkey, concat(month(o_orderdate), '/', year(o_orderdate)) AS label FROM orders")
def _(data):
    return data["orders"].select("o_orderkey", dates.month_label(F.col("o_orderdate")).alias("label"))


@check(
    "B19_ratio_or_zero",
    """SELECT l_orderkey, l_linenumber, l_extendedprice,
              CASE WHEN l_tax = 0 THEN CAST(0 AS DOUBLE) ELSE l_discount / l_tax END AS r FROM lineitem""",
)
def _(data):
    return data["lineitem"].select(
        "l_orderkey", "l_linenumber", "l_extendedprice", numbers.ratio(F.col("l_discount"), F.col("l_tax")).alias("r")
    )


@check(
    "B20_feeder_effect",
    """SELECT cod_alim, ano, chi_total, qtde_cliente_total / nullif(cons_conjunto, 0) AS effect,
              qtde_cliente_total / nullif(vlr_qtd_arvore - 10, 0) AS guarded FROM panel_raw""",
    ("panel_raw",),
)
def _(data):
    total = F.col("qtde_cliente_total")
    return data["panel_raw"].select(
        "cod_alim",
        "ano",
        "chi_total",
        numbers.share(total, F.col("cons_conjunto")).alias("effect"),
        numbers.share(total, F.col("vlr_qtd_arvore") - 10).alias("guarded"),
    )
