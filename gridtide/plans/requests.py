"""A batch of requests: parsed, run for all sets together, written as envelopes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridtide.functions.text import number_text, to_float, to_int
from gridtide.operators.allocation import clean_inspections
from gridtide.operators.goals import goal_window, goals_long, monthly_goals
from gridtide.plans.assign import MONTHS_AHEAD, assign
from gridtide.plans.forecast import forecast
from gridtide.plans.panel import SERIES, build_panel, feeders_of, panel_with_weather, runs_of
from gridtide.plans.suggest import suggest
from gridtide.session import cut
from gridtide.sources.tables import Tables

# Algorithm names and the fields of a request.
SUGGESTION, PREDICTION = "suggestion", "prediction"
FIELDS = ("algorithm", "conjunto", "pred_year", "pred_month", "months_ahead", "us_services")


def parse_requests(df: DataFrame, json_col: str = "value", id_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid, rejects) from JSON documents `{"array": [...]}`; a single object stands for a list.

    Valid rows: `request_id, algorithm, conjunto, pred_month` (first of the month), `months_ahead`,
    `us_services`. Rejects have `request_id`, the text and a reason; they never stop a batch.

    Without `id_col` equal documents are one; with it, documents that share an id are rejected.
    """
    if id_col:
        doc = F.col(id_col).cast("string")
        same_id = F.count("*").over(Window.partitionBy(doc)) > 1
    else:
        df = df.select(json_col).distinct()
        doc, same_id = F.sha2(json_col, 256), F.lit(False)
    text = F.get_json_object(json_col, "$.array")
    listed = F.when(text.startswith("["), text).otherwise(F.concat(F.lit("["), text, F.lit("]")))
    items = F.from_json(listed, "array<string>")
    df = df.select(doc.alias("doc"), same_id.alias("same_id"), json_col)
    rows = df.select("doc", "same_id", F.col(json_col).alias("doc_text"), F.posexplode_outer(items).alias("n", "item"))
    # json_tuple is a generator: each request is parsed once, however often its fields are used
    rows = rows.select(
        F.concat_ws(":", "doc", F.coalesce("n", F.lit(0))).alias("request_id"),
        F.coalesce("item", "doc_text").alias("request"),
        F.col("n").isNull().alias("unreadable"),
        "same_id",
        F.json_tuple("item", *FIELDS).alias(*[f"f_{f}" for f in FIELDS]),
    )
    typed = rows.select(
        "request_id",
        "request",
        "unreadable",
        "same_id",
        F.lower("f_algorithm").alias("algorithm"),
        F.col("f_conjunto").alias("conjunto"),
        to_int(F.col("f_pred_year")).cast("int").alias("y"),
        to_int(F.col("f_pred_month")).cast("int").alias("m"),
        to_int(F.col("f_months_ahead")).cast("int").alias("h"),
        to_float(F.col("f_us_services")).alias("us_services"),
    )
    suggestion, prediction = F.col("algorithm") == SUGGESTION, F.col("algorithm") == PREDICTION
    reason = (
        F.when(F.col("same_id"), "the id of the document is repeated")
        .when(F.col("unreadable"), "not readable")
        .when(~F.coalesce(suggestion | prediction, F.lit(False)), "unknown algorithm")
        .when(F.col("conjunto").isNull(), "conjunto is missing")
        .when(F.col("y").isNull(), "pred_year is missing or not a number")
        .when(~F.coalesce(F.col("y").between(1, 9998), F.lit(False)), "pred_year is out of range")
        .when(F.col("m").isNull(), "pred_month is missing or not a number")
        .when(~F.col("m").between(1, 12), "pred_month is out of range")
        .when(suggestion & F.col("h").isNull(), "months_ahead is missing or not a number")
        .when(suggestion & (F.col("h") < 1), "months_ahead is out of range")
        .when(prediction & F.col("us_services").isNull(), "us_services is missing or not a number")
    )
    judged = typed.withColumn("reason", reason)
    valid = judged.where("reason is null").select(
        "request_id",
        "algorithm",
        "conjunto",
        F.make_date("y", "m", F.lit(1)).alias("pred_month"),
        F.when(suggestion, F.col("h")).otherwise(F.lit(MONTHS_AHEAD)).alias("months_ahead"),
        F.when(prediction, F.col("us_services")).alias("us_services"),
    )
    return valid, judged.where("reason is not null").select("request_id", "request", "reason")


def format_tasks(tasks: DataFrame, sep: str = ",") -> DataFrame:
    """Assigned tasks with dates and numbers as text; no cause means 0."""
    return tasks.withColumns(
        {
            "data cadastro": F.date_format("data cadastro", "yyyy-MM-dd"),
            "us servico": number_text(F.col("us servico"), 6, sep),
            "quantidade": F.col("quantidade").cast("string"),
            "causa": F.coalesce(F.col("causa"), F.lit(0)).cast("bigint").cast("string"),
        }
    )


@dataclass(frozen=True)
class Results:
    suggestions: DataFrame
    tasks: DataFrame
    ignored: DataFrame
    rejects: DataFrame
    errors: DataFrame
    scores: DataFrame
    tests: DataFrame


def lost_feeders(asked: DataFrame, panel: DataFrame, errors: DataFrame) -> DataFrame:
    """Feeders of the sets that the panel lacks and that no error accounts for yet."""
    lost = asked.select(*SERIES).join(panel.select(*SERIES).distinct(), SERIES, "left_anti")
    known = errors.where(F.col("month").isNull() & F.col("cod_alim").isNotNull())
    lost = lost.withColumn("cod_alim", F.col("cod_alim").cast("string"))
    lost = lost.join(known.where(F.col("conjunto").isNull()).select("cod_alim").distinct(), "cod_alim", "left_anti")
    lost = lost.join(known.select(*SERIES).distinct(), SERIES, "left_anti")
    return lost.select(*SERIES, F.lit("panel").alias("stage"), F.lit("no rows before the date").alias("reason"))


def unserved(asked: DataFrame, *served: DataFrame) -> DataFrame:
    """Valid requests that none of the results has rows for."""
    ids = reduce(DataFrame.unionByName, [s.select("request_id") for s in served]).distinct()
    return asked.join(ids, "request_id", "left_anti").select("request_id", "algorithm", "conjunto")


def run_requests(
    tables: Tables,
    payloads: DataFrame,
    coefs: Mapping[str, float],
    inspection_months: int,
    json_col: str = "value",
    id_col: str | None = None,
    models: Sequence[str] | None = None,
    carry: str = "sum",
    metrics: Mapping[str, Column] | None = None,
    states: Sequence[str] | None = None,
    axis_order: str = "lat_lon",
) -> Results:
    """Everything a batch asks for. Panel, weather and forecast are made once per set and date, no
    matter how many requests need them. Without bound stations the panel has no weather.

    `states` keeps the stations of these states only; `metrics` adds scores of the candidates.
    """
    valid, rejects = parse_requests(payloads, json_col, id_col)
    valid = cut(valid, "requests")
    runs = cut(runs_of(valid), "runs")
    raw, members = tables.read("panel"), tables.read("feeder_set")
    no_errors = "conjunto string, pred_month date, cod_alim string, month date, stage string, reason string"
    errors = tables.spark.createDataFrame([], no_errors)
    if "stations" in tables:
        points = tables.read("feeder_points")
        points = points.toDF(*["cod_alim" if c in ("code", "ctmt") else c for c in points.columns])
        stations = tables.read("stations")
        if states is not None:
            stations = stations.where(F.col("state_initials").isin(list(states)))
        panel, weather_errors = panel_with_weather(
            raw, members, runs, points, stations, tables.read("station_history"), axis_order=axis_order
        )
        weather_errors = weather_errors.withColumn("cod_alim", F.col("cod_alim").cast("string"))
        errors = errors.unionByName(weather_errors, allowMissingColumns=True)
    else:
        panel = build_panel(raw, members, runs)
    monthly = cut(monthly_goals(goals_long(tables.read("goals"))), "goals")
    goals = cut(goal_window(monthly, runs), "goal_window")
    made = forecast(panel, goals, models, metrics=metrics)
    errors = errors.unionByName(made.errors.withColumn("cod_alim", F.col("cod_alim").cast("string")), allowMissingColumns=True)
    errors = errors.unionByName(lost_feeders(feeders_of(runs, members), made.panel, errors), allowMissingColumns=True)
    no_goal = goals.where(F.col("chi_goal").isNull() & (F.col("horizon") >= 1)).select("conjunto", "pred_month").distinct()
    errors = errors.unionByName(
        no_goal.withColumns({"stage": F.lit("goals"), "reason": F.lit("a month has no goal")}),
        allowMissingColumns=True,
    )

    asked = valid.where(F.col("algorithm") == SUGGESTION).drop("algorithm", "us_services")
    suggestions = suggest(
        asked,
        made.panel,
        made.rows,
        goal_window(monthly, asked),
        tables.read("outages"),
        tables.read("causes"),
        tables.read("maintenance"),
        coefs,
    )
    suggestions = cut(suggestions, "suggestions")
    tasks = assign(
        valid.where(F.col("algorithm") == PREDICTION).drop("algorithm", "months_ahead"),
        made.rows,
        goals,
        clean_inspections(tables.read("inspections")),
        inspection_months,
        carry,
    )
    tasks = cut(tasks, "tasks")
    return Results(suggestions, tasks, unserved(valid, suggestions, tasks), rejects, errors, made.scores, made.tests)
