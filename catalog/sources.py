"""A: scans, requests, envelopes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog import Data, check
from gridtide.functions.text import plain_text
from gridtide.plans import envelope
from gridtide.plans.requests import format_tasks, parse_requests, unserved
from gridtide.session import fresh_path
from gridtide.sources import files
from gridtide.sources.tables import Tables, csv, parquet


def inspections(data: Data) -> DataFrame:
    """Inspections under their stored names."""
    df = data["inspections"]
    return df.toDF(
        *[c.replace("_", " ") if c.split("_")[0] in ("status", "us", "data", "hora", "descricao", "causa") else c for c in df.columns]
    )


@check(
    "A1_scan_columns_where",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 1000",
)
def _(data):
    tables = Tables(data.spark, {"orders": parquet(data.path("orders"))})
    return tables.read("orders", ["o_orderkey", "o_totalprice"], "o_orderstatus = 'P' AND o_totalprice > 1000")


@check(
    "A2_scan_by_keys",
    """SELECT o_orderkey, o_custkey FROM orders
       WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')""",
)
def _(data):
    tables = Tables(data.spark, {"orders": parquet(data.path("orders"))})
    keys = data["customer"].where("c_mktsegment = 'MACHINERY'").select("c_custkey")
    return tables.read("orders", ["o_orderkey", "o_custkey"], keys=("o_custkey", keys))


def _as_csv(df: DataFrame, label: str, **options) -> str:
    path = fresh_path(df.sparkSession, label)
    df.write.options(header=True, **options).csv(path)
    return path


@check(
    "A3_scan_csv",
    "SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate FROM orders",
)
def _(data):
    df = data["orders"].select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    back = files.read_csv(data.spark, _as_csv(df, "orders-csv"), df.schema)
    return back.withColumn("o_orderdate", F.col("o_orderdate").cast("string"))


@check(
    "A4_scan_csv_latin1",
    """SELECT o_orderkey, concat(' Inspeção ', o_orderpriority, ' à mão') AS descricao,
              concat('inspecao ', lower(o_orderpriority), ' a mao') AS plain FROM orders""",
)
def _(data):
    text = F.concat(F.lit(" Inspeção "), F.col("o_orderpriority"), F.lit(" à mão"))
    df = data["orders"].select("o_orderkey", text.alias("descricao"))
    path = _as_csv(df, "latin-csv", encoding=files.LATIN, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    back = files.read_csv(data.spark, path, df.schema, files.LATIN)
    return back.withColumn("plain", plain_text(F.col("descricao")))


@check(
    "A5_scan_files_by_state",
    "SELECT s_suppkey, s_acctbal, CAST(s_nationkey AS VARCHAR) AS state FROM supplier",
)
def _(data):
    df = data["supplier"].select("s_suppkey", "s_acctbal", F.col("s_nationkey").alias("state"))
    path = fresh_path(data.spark, "states-csv")
    df.write.partitionBy("state").option("header", True).csv(path)
    states = [str(n) for n in range(25)]  # as files are named; a state without a file is passed over
    schema = T.StructType(df.schema.fields[:2])
    return files.read_states(data.spark, path, schema, states, "state={state}/*.csv")


@check(
    "A6_source_switch",
    """SELECT source, count(*) AS n, CAST(sum(CAST(s_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
       FROM supplier CROSS JOIN (VALUES ('csv'), ('frame'), ('parquet')) v(source)
       WHERE s_acctbal > 0 GROUP BY source""",
)
def _(data):
    df = data["supplier"]
    tables = Tables(
        data.spark,
        {"parquet": parquet(data.path("supplier")), "csv": csv(_as_csv(df, "supplier-csv"), df.schema), "frame": df},
    )
    parts = [
        tables.read(name, ["s_acctbal"], F.col("s_acctbal") > 0).withColumn("source", F.lit(name))
        for name in ("parquet", "csv", "frame")
    ]
    balance = F.sum(F.col("s_acctbal").cast("decimal(18,2)")).cast("double")
    return parts[0].union(parts[1]).union(parts[2]).groupBy("source").agg(F.count("*").alias("n"), balance.alias("balance"))


def payloads(data: Data) -> DataFrame:
    """One request document per order; which fields are good depends on its columns."""
    year, month = F.year("o_orderdate").cast("string"), F.month("o_orderdate").cast("string")
    algorithm = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "Suggestion")
        .when(F.col("o_orderpriority") == "2-HIGH", "PREDICTION")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "prediction")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "suggestion")
        .otherwise("unknown")
    )
    item = F.concat(
        F.lit('{"algorithm":"'), algorithm, F.lit('","conjunto":"C'), F.col("o_custkey").cast("string"),
        F.lit('","pred_year":'), F.when(F.col("o_orderstatus") == "F", F.concat(F.lit('"'), year, F.lit('"'))).otherwise(year),
        F.lit(',"pred_month":'), month,
        F.when(F.col("o_orderstatus") != "O", F.lit(',"months_ahead":3,"us_services":"12.5"')).otherwise(F.lit("")),
        F.lit("}"),
    )
    listed = F.when(F.col("o_orderstatus") == "P", item).otherwise(F.concat(F.lit("["), item, F.lit("]")))
    return data["orders"].select(
        F.col("o_orderkey").alias("id"), F.concat(F.lit('{"array":'), listed, F.lit("}")).alias("value")
    )


_REQUESTS = """
, req AS (SELECT concat(CAST(o_orderkey AS VARCHAR), ':0') AS request_id,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'suggestion' WHEN '2-HIGH' THEN 'prediction'
            WHEN '3-MEDIUM' THEN 'prediction' WHEN '4-NOT SPECIFIED' THEN 'suggestion' ELSE 'unknown' END AS algorithm,
       concat('C', CAST(o_custkey AS VARCHAR)) AS conjunto, o_orderstatus, o_orderdate FROM orders)
"""


@check(
    "A7_parse_requests",
    _REQUESTS
    + """SELECT request_id, algorithm, conjunto, CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS pred_month,
                CASE WHEN algorithm = 'suggestion' THEN 3 ELSE 2 END AS months_ahead,
                CASE WHEN algorithm = 'prediction' THEN CAST(12.5 AS DOUBLE) END AS us_services
         FROM req WHERE algorithm <> 'unknown' AND o_orderstatus <> 'O'""",
)
def _(data):
    valid, _rejects = parse_requests(payloads(data), id_col="id")
    return valid.withColumn("pred_month", F.col("pred_month").cast("string"))


@check(
    "A7_rejected_requests",
    _REQUESTS
    + """SELECT request_id, CASE WHEN algorithm = 'unknown' THEN 'unknown algorithm'
                WHEN algorithm = 'suggestion' THEN 'months_ahead is missing or not a number'
                ELSE 'us_services is missing or not a number' END AS reason
         FROM req WHERE algorithm = 'unknown' OR o_orderstatus = 'O'""",
)
def _(data):
    _valid, rejects = parse_requests(payloads(data), id_col="id")
    return rejects.select("request_id", "reason")


def cleaned(data: Data) -> DataFrame:
    from gridtide.operators.allocation import clean_inspections

    return clean_inspections(inspections(data))


_PLAIN_TASK = """
, t AS (SELECT idservico, idnsmanut, status_servico, dispositivo, se, alimentador,
       concat('inspecao ', lower(substr(descricao, 11))) AS descricao, replace(quantidade, ',000', '') AS quantidade,
       us_servico, prioridade, data_cadastro, hora_do_cadastro,
       CAST(CAST(coalesce(causa, 0) AS BIGINT) AS VARCHAR) AS causa,
       concat('caida de ', lower(substr(descricao_da_causa, 10))) AS descricao_da_causa, causa_ciga
       FROM inspections)
"""


@check(
    "A8_task_envelope",
    _PLAIN_TASK
    + "SELECT concat('{\"@noun\":\"PREDICTIVE_ALGORITHM_RESULT\",\"CellsData\":[', '{\"@index\":0,\"@value\":', CAST(idservico AS VARCHAR), '}', "
    + ", ".join(
        f"',{{\"@index\":{i},\"@value\":\"', {c}, '\"}}'"
        for i, c in enumerate(
            "idnsmanut status_servico dispositivo se alimentador descricao quantidade us_servico prioridade "
            "data_cadastro hora_do_cadastro causa descricao_da_causa causa_ciga".split(),
            start=1,
        )
    )
    + ", ',{\"@index\":15,\"@value\":\"2000-01-01 00:00:00\"}]}') AS value FROM t",
    ("inspections",),
)
def _(data):
    return envelope.task_envelope(format_tasks(cleaned(data)), F.lit("2000-01-01").cast("timestamp_ntz"))


@check("A10_documents", _PLAIN_TASK + "SELECT idservico, causa FROM t", ("inspections",))
def _(data):
    """Documents written, then read back row by row."""
    path = fresh_path(data.spark, "documents")
    rows = envelope.task_envelope(format_tasks(cleaned(data)))
    envelope.write_documents(rows, envelope.TASK_NOUN, path)
    lines = data.spark.read.text(path).select(F.regexp_replace("value", "^,", "").alias("value"))
    cells = F.from_json("value", "struct<CellsData:array<struct<`@index`:int,`@value`:string>>>")["CellsData"]
    return (
        lines.where(F.col("value").startswith('{"@noun"'))
        .select(cells.alias("c"))
        .select(F.col("c")[0]["@value"].cast("bigint").alias("idservico"), F.col("c")[12]["@value"].alias("causa"))
    )


@check(
    "A11_format_tasks",
    _PLAIN_TASK + "SELECT idservico, data_cadastro, us_servico, quantidade, causa FROM t",
    ("inspections",),
)
def _(data):
    return format_tasks(cleaned(data)).select(
        "idservico",
        F.col("data cadastro").alias("data_cadastro"),
        F.col("us servico").alias("us_servico"),
        "quantidade",
        "causa",
    )


@check(
    "A12_results_and_ignored",
    """SELECT CAST(c_custkey AS VARCHAR) AS request_id, CASE WHEN c_custkey % 2 = 0 THEN 'suggestion' ELSE 'prediction' END AS algorithm, c_mktsegment AS conjunto
       FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P' OR o_orderpriority = '1-URGENT')""",
)
def _(data):
    """Requests that neither kind of result has rows for; a result may have many rows of a request."""
    key = F.col("c_custkey").cast("string").alias("request_id")
    kind = F.when(F.col("c_custkey") % 2 == 0, "suggestion").otherwise("prediction").alias("algorithm")
    asked = data["customer"].select(key, kind, F.col("c_mktsegment").alias("conjunto"))
    owner = F.col("o_custkey").cast("string").alias("request_id")
    suggestions = data["orders"].where("o_orderstatus = 'P'").select(owner, "o_orderkey")
    tasks = data["orders"].where("o_orderpriority = '1-URGENT'").select(owner, "o_totalprice")
    return unserved(asked, suggestions, tasks)
