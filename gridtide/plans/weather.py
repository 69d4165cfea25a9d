"""Station weather interpolated onto the area of each feeder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtide.functions.dates import month_of
from gridtide.operators.kriging import fit_kriging, predict_kriging
from gridtide.operators.rows import complete_rows, first_per
from gridtide.operators.series import fill_by_calendar_month, month_spine
from gridtide.operators.spatial import bounding_boxes, grid_lattices, ring_neighbours
from gridtide.schemas import WEATHER
from gridtide.session import cut

SERIES = ["conjunto", "pred_month", "cod_alim"]


def station_months(history: DataFrame, variables=WEATHER, order: list[str] | None = None) -> DataFrame:
    """One row per station and month (the first by `order`), kept only if no variable is missing."""
    one = first_per(
        history.select("station_code", "year", "month", *variables),
        ["station_code", "year", "month"],
        order or list(variables),
    )
    return complete_rows(one, variables).select(
        "station_code", month_of(F.col("year"), F.col("month")).alias("month"), *variables
    )


def station_samples(neighbours: DataFrame, months: DataFrame, spans: DataFrame, key: str) -> DataFrame:
    """Values of each area's stations in the months from `start` to `end`.

    `neighbours`: (key, station_code, lon, lat); `spans`: (key, start, end).
    """
    return (
        neighbours.join(spans, key)
        .join(months, "station_code")
        .where(F.col("month").between(F.col("start"), F.col("end")))
        .drop("start", "end")
    )


def interpolate_weather(
    points: DataFrame,
    stations: DataFrame,
    history: DataFrame,
    spans: DataFrame,
    key: str = "cod_alim",
    variables=WEATHER,
    axis_order: str = "lat_lon",
) -> tuple[DataFrame, DataFrame]:
    """(key, month, variables) where stations have values, and (key, month, stage, reason) errors.

    `points`: (key, longitude, latitude); `spans`: (key, start, end).
    """
    wanted = points.join(spans.select(key), key, "left_semi")
    boxes = cut(bounding_boxes(wanted, key, axis_order=axis_order), "boxes")
    near = cut(ring_neighbours(boxes, stations, key, axis_order=axis_order), "near")
    places = near.select(key, "station_code", "longitude", "latitude")
    samples = station_samples(places, station_months(history, variables), spans, key)
    fitted = cut(fit_kriging(samples, [key, "month"], ("longitude", "latitude"), variables), "fitted")
    grid = boxes.select(key, grid_lattices().alias("lattices"))
    values = predict_kriging(fitted, grid, [key, "month"], variables, [key])
    no_month = F.lit(None).cast("date").alias("month")
    stage = F.lit("weather").alias("stage")
    located = spans.select(key).join(boxes.select(key), key, "left_semi")
    errors = (
        fitted.where(F.col("error").isNotNull())
        .select(key, "month", stage, F.col("error").alias("reason"))
        .unionByName(
            spans.join(boxes, key, "left_anti").select(key, no_month, stage, F.lit("no coordinates").alias("reason"))
        )
        .unionByName(
            located.join(fitted.where(F.col("error").isNull()), key, "left_anti").select(
                key, no_month, stage, F.lit("no station near has values").alias("reason")
            )
        )
    )
    return values, errors


def weather_of_runs(
    points: DataFrame, stations: DataFrame, history: DataFrame, spans: DataFrame, variables=WEATHER, **options
) -> tuple[DataFrame, DataFrame]:
    """Weather of every month from the set's first month to the run's date, gaps filled.

    `spans`: (set, date, feeder, first_month). A feeder that several runs ask for is interpolated
    once over all their months; gaps are filled per run, from the months that run may see.
    """
    spans = cut(spans, "spans")
    once = spans.groupBy("cod_alim").agg(F.min("first_month").alias("start"), F.max("pred_month").alias("end"))
    values, errors = interpolate_weather(points, stations, history, once, variables=variables, **options)
    values = cut(values, "weather")
    located = spans.join(values.select("cod_alim").distinct(), "cod_alim", "left_semi")
    spine = month_spine(located, F.col("first_month"), F.col("pred_month")).drop("first_month")
    full = spine.join(values, ["cod_alim", "month"], "left")
    return fill_by_calendar_month(full, SERIES, "month", variables), errors
