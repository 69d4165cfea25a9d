"""Spatial operators and kriging."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import Data, check
from catalog.relational import text_dates
from catalog.scalars import haversine_sql
from gridtide.operators.kriging import FieldStore, field_at, fit_kriging, predict_kriging
from gridtide.operators.series import fill_by_calendar_month
from gridtide.operators.spatial import bounding_boxes, eval_grid, grid_lattices, pairs_within, ring_neighbours
from gridtide.plans.weather import interpolate_weather, station_months, station_samples, weather_of_runs
from gridtide.schemas import WEATHER
from gridtide.session import fresh_path

BOXES = f"""
, edges AS (SELECT code, min(longitude) AS min_lon, max(longitude) AS max_lon, min(latitude) AS min_lat,
                   max(latitude) AS max_lat, count(*) AS n_points FROM feeder_points GROUP BY code)
, sides AS (SELECT *, (max_lon - min_lon) / 2 + min_lon AS c_lon, (max_lat - min_lat) / 2 + min_lat AS c_lat,
       {haversine_sql('max_lat', 'min_lon', 'max_lat', 'max_lon')} AS width_km,
       {haversine_sql('max_lat', 'min_lon', 'min_lat', 'min_lon')} AS height_km FROM edges)
, boxes AS (SELECT *, sqrt(width_km * width_km + height_km * height_km) AS diagonal_km,
       ceil(sqrt(width_km * width_km + height_km * height_km) / 2) AS r0 FROM sides)
"""
POINTS = ("feeder_points",)


def boxes(data: Data):
    return bounding_boxes(data["feeder_points"], "code")


def rounded(df, columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@check(
    "E8_bounding_boxes",
    BOXES + "SELECT code, min_lon, max_lon, min_lat, max_lat, n_points FROM boxes",
    POINTS,
)
def _(data):
    return boxes(data).select("code", "min_lon", "max_lon", "min_lat", "max_lat", "n_points")


_GEOMETRY = ["c_lon", "c_lat", "width_km", "height_km", "diagonal_km"]


@check(
    "E9_box_geometry",
    BOXES + f"SELECT code, {', '.join(f'round({c}, 6) AS {c}' for c in _GEOMETRY)}, r0 FROM boxes",
    POINTS,
)
def _(data):
    return rounded(boxes(data).select("code", *_GEOMETRY, "r0"), _GEOMETRY)


@check(
    "G4_evaluation_grid",
    BOXES
    + """, counted AS (SELECT *, CAST(floor(width_km / 10) AS INT) + 1 AS nx, CAST(floor(height_km / 10) AS INT) + 1 AS ny FROM boxes)
, points AS (
  SELECT code, c_lon AS lon, c_lat AS lat FROM counted
  UNION ALL SELECT code, c_lon, max_lat FROM counted WHERE nx * ny <= 4 AND n_points >= 100
  UNION ALL SELECT code, min_lon, c_lat FROM counted WHERE nx * ny <= 4 AND n_points >= 100
  UNION ALL SELECT code, max_lon, c_lat FROM counted WHERE nx * ny <= 4 AND n_points >= 100
  UNION ALL SELECT code, c_lon, min_lat FROM counted WHERE nx * ny <= 4 AND n_points >= 100
  UNION ALL
  SELECT code, min_lon + i * CASE WHEN nx > 1 THEN (max_lon - min_lon) / (nx - 1) ELSE 0 END,
         max_lat + j * CASE WHEN ny > 1 THEN (min_lat - max_lat) / (ny - 1) ELSE 0 END
  FROM (SELECT *, unnest(range(nx)) AS i FROM counted WHERE nx * ny > 4), LATERAL (SELECT unnest(range(ny)) AS j))
SELECT code, round(lon, 6) AS lon, round(lat, 6) AS lat FROM points""",
    POINTS,
)
def _(data):
    return rounded(eval_grid(boxes(data), "code").drop("point"), ["lon", "lat"])


_DIST = haversine_sql("c_lat", "c_lon", "latitude", "longitude")


@check(
    "D6_stations_within_reach",
    BOXES
    + f"""SELECT code, station_code, round({_DIST}, 6) AS dist_km FROM boxes CROSS JOIN stations
         WHERE {_DIST} <= r0 + 250""",
    (*POINTS, "stations"),
)
def _(data):
    centres = boxes(data).withColumn("radius", F.col("r0") + 250)
    near = pairs_within(centres, data["stations"], "radius")
    return rounded(near.select("code", "station_code", "dist_km"), ["dist_km"])


NEAR = (
    BOXES
    + f"""
, far AS (SELECT code, station_code, longitude, latitude, r0, {_DIST} AS d FROM boxes CROSS JOIN stations)
, third AS (SELECT code, r0, d AS d3 FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY d) AS rn FROM far WHERE d > r0) WHERE rn = 3)
, near AS (SELECT f.code, f.station_code, longitude, latitude, d, f.r0 + 10 * ceil((d3 - f.r0) / 10) AS radius_km
           FROM far f JOIN third t ON f.code = t.code WHERE d <= f.r0 + 10 * ceil((d3 - f.r0) / 10))
"""
)


@check(
    "D7_ring_neighbours",
    NEAR + "SELECT code, station_code, round(d, 6) AS dist_km, radius_km FROM near",
    (*POINTS, "stations"),
)
def _(data):
    near = ring_neighbours(boxes(data), data["stations"], "code")
    return rounded(near.select("code", "station_code", "dist_km", "radius_km"), ["dist_km"])


def samples(data: Data):
    near = ring_neighbours(boxes(data), data["stations"], "code")
    spans = boxes(data).select("code", F.lit("1995-01-01").cast("date").alias("start"), F.lit("1999-12-01").cast("date").alias("end"))
    return station_samples(
        near.select("code", "station_code", "longitude", "latitude"), station_months(data["station_history"]), spans, "code"
    )


@check(
    "D8_station_months_of_feeders",
    NEAR
    + """SELECT code, n.station_code, CAST(make_date(year, month, 1) AS VARCHAR) AS month, longitude, latitude, temp_max, temp_min, windvelo_mean
         FROM near n JOIN station_history h ON n.station_code = h.station_code
         WHERE temp_max IS NOT NULL AND make_date(year, month, 1) BETWEEN DATE '1995-01-01' AND DATE '1999-12-01'""",
    (*POINTS, "stations", "station_history"),
)
def _(data):
    return text_dates(samples(data)).select(
        "code", "station_code", "month", "longitude", "latitude", "temp_max", "temp_min", "windvelo_mean"
    )


@check(
    "E11_fill_by_calendar_month",
    """, spine AS (SELECT station_code, CAST(m AS DATE) AS month FROM (SELECT DISTINCT station_code FROM station_history),
           LATERAL (SELECT unnest(generate_series(DATE '1996-01-01', DATE '2000-12-01', INTERVAL 1 MONTH)) AS m))
       , full_rows AS (SELECT s.station_code, s.month, temp_max, temp_min FROM spine s LEFT JOIN station_history h
           ON s.station_code = h.station_code AND s.month = make_date(h.year, h.month, 1))
       SELECT station_code, CAST(month AS VARCHAR) AS month,
              round(coalesce(temp_max, avg(temp_max) OVER (PARTITION BY station_code, month(month))), 6) AS temp_max,
              round(coalesce(temp_min, avg(temp_min) OVER (PARTITION BY station_code, month(month))), 6) AS temp_min FROM full_rows""",
    ("station_history",),
)
def _(data):
    from gridtide.functions.dates import month_of
    from gridtide.operators.series import month_spine

    history = data["station_history"]
    known = history.select("station_code", month_of(F.col("year"), F.col("month")).alias("month"), "temp_max", "temp_min")
    first, last = (F.lit(d).cast("date") for d in ("1996-01-01", "2000-12-01"))
    spine = month_spine(history.select("station_code").distinct(), first, last)
    full = spine.join(known, ["station_code", "month"], "left")
    filled = fill_by_calendar_month(full, ["station_code"], "month", ["temp_max", "temp_min"])
    return text_dates(rounded(filled, ["temp_max", "temp_min"])).select("station_code", "month", "temp_max", "temp_min")


def lattices(data: Data):
    return boxes(data).select("code", grid_lattices().alias("lattices"))


@check("H1_kriging_fit")
def _(data):
    fitted = fit_kriging(samples(data), ["code", "month"], ("longitude", "latitude"), WEATHER)
    return fitted.select("code", "month", "variable", "trend", "scale_lon", "scale_lat", F.size("weights").alias("n"), "error")


@check("E17_H2_field_means")
def _(data):
    fitted = fit_kriging(samples(data), ["code", "month"], ("longitude", "latitude"), WEATHER)
    return predict_kriging(fitted, lattices(data), ["code", "month"], WEATHER, ["code"])


@check(
    "H2_all_zero_variable",
    NEAR
    + """SELECT DISTINCT code, CAST(make_date(year, month, 1) AS VARCHAR) AS month, CAST(0 AS DOUBLE) AS windvelo_mean
         FROM near n JOIN station_history h ON n.station_code = h.station_code
         WHERE temp_max IS NOT NULL AND make_date(year, month, 1) BETWEEN DATE '1995-01-01' AND DATE '1999-12-01'""",
    (*POINTS, "stations", "station_history"),
)
def _(data):
    """Which feeder-months have a field at all, and that an all-zero variable stays 0."""
    fitted = fit_kriging(samples(data), ["code", "month"], ("longitude", "latitude"), WEATHER)
    made = predict_kriging(fitted, lattices(data), ["code", "month"], WEATHER, ["code"])
    return text_dates(made.select("code", "month", "windvelo_mean"))


_AT_STATIONS = ["temp_max", "temp_min", "precipitation", "humidity_min"]


@check(
    "H1_fields_at_stations",
    NEAR
    + """SELECT code, n.station_code, CAST(make_date(year, month, 1) AS VARCHAR) AS month, """
    + ", ".join(f"round({v}, 2) AS {v}" for v in _AT_STATIONS)
    + """ FROM near n JOIN station_history h ON n.station_code = h.station_code
         WHERE temp_max IS NOT NULL AND make_date(year, month, 1) BETWEEN DATE '1995-01-01' AND DATE '1999-12-01'""",
    (*POINTS, "stations", "station_history"),
)
def _(data):
    """A field passes through the values of all its stations."""
    known = samples(data)
    fitted = fit_kriging(known, ["code", "month"], ("longitude", "latitude"), _AT_STATIONS)
    value = F.round(field_at(F.col("longitude"), F.col("latitude")), 2)
    at = known.select("code", "month", "station_code", "longitude", "latitude").join(fitted, ["code", "month"])
    made = at.groupBy("code", "month", "station_code").agg(*[F.max(F.when(F.col("variable") == v, value)).alias(v) for v in _AT_STATIONS])
    return text_dates(made)


_ONE_STATION = (
    NEAR
    + """, known AS (SELECT n.code, make_date(year, month, 1) AS month, h.* EXCLUDE (year, month)
           FROM near n JOIN station_history h ON n.station_code = h.station_code
           WHERE temp_max IS NOT NULL AND make_date(year, month, 1) BETWEEN DATE '1995-01-01' AND DATE '1999-12-01')
    SELECT code, CAST(month AS VARCHAR) AS month, """
    + ", ".join(f"round(max({v}), 6) AS {v}" for v in WEATHER)
    + " FROM known GROUP BY code, month HAVING count(*) = 1"
)


@check("E17_fields_of_one_station", _ONE_STATION, (*POINTS, "stations", "station_history"))
def _(data):
    """Where a month has one station only, the field is its value everywhere."""
    alone = samples(data).groupBy("code", "month").agg(F.count("*").alias("n")).where("n = 1").drop("n")
    chosen = samples(data).join(alone, ["code", "month"], "left_semi")
    fitted = fit_kriging(chosen, ["code", "month"], ("longitude", "latitude"), WEATHER)
    made = predict_kriging(fitted, lattices(data), ["code", "month"], WEATHER, ["code"])
    return text_dates(rounded(made, WEATHER)).select("code", "month", *WEATHER)


def of_nearest_station(data: Data):
    """Samples of the station nearest to each area's centre."""
    near = ring_neighbours(boxes(data), data["stations"], "code")
    first = near.groupBy("code").agg(F.min(F.struct("dist_km", "station_code")).alias("first"))
    return samples(data).join(first.select("code", "first.station_code"), ["code", "station_code"], "left_semi")


_NEAREST = (
    NEAR
    + """, first AS (SELECT code, station_code FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY d, station_code) AS rn FROM near) WHERE rn = 1)
    SELECT code, CAST(make_date(year, month, 1) AS VARCHAR) AS month, """
    + ", ".join(f"round({v}, 6) AS {v}" for v in WEATHER)
    + """ FROM first n JOIN station_history h ON n.station_code = h.station_code
         WHERE temp_max IS NOT NULL AND make_date(year, month, 1) BETWEEN DATE '1995-01-01' AND DATE '1999-12-01'"""
)


@check("E17_fields_of_the_nearest_station", _NEAREST, (*POINTS, "stations", "station_history"))
def _(data):
    fitted = fit_kriging(of_nearest_station(data), ["code", "month"], ("longitude", "latitude"), WEATHER)
    made = predict_kriging(fitted, lattices(data), ["code", "month"], WEATHER, ["code"])
    return text_dates(rounded(made, WEATHER)).select("code", "month", *WEATHER)


def stored(data: Data, known):
    """Fields of all variables: the months up to 1996 are stored first, then a second run adds what is lacking."""
    store = FieldStore(data.spark, fresh_path(data.spark, "fields"))
    args = (["code", "month"], ("longitude", "latitude"), WEATHER)
    store.fields(known.where("month < date '1997-01-01'"), *args)
    return predict_kriging(store.fields(known, *args), lattices(data), ["code", "month"], WEATHER, ["code"])


@check("A13_stored_fields")
def _(data):
    return stored(data, samples(data))


@check("A13_stored_fields_of_the_nearest_station", _NEAREST, (*POINTS, "stations", "station_history"))
def _(data):
    return text_dates(rounded(stored(data, of_nearest_station(data)), WEATHER)).select("code", "month", *WEATHER)


def weather(data: Data):
    """Weather of all runs from 1995 on."""
    spans = data["feeders"].select("conjunto", "pred_month", "cod_alim", F.lit("1995-01-01").cast("date").alias("first_month"))
    points = data["feeder_points"].withColumnRenamed("code", "cod_alim")
    return weather_of_runs(points, data["stations"], data["station_history"], spans)


@check("J2_interpolated_weather")
def _(data):
    return weather(data)[0]


@check(
    "J2_months_with_weather",
    """SELECT conjunto, cod_alim, CAST(CAST(m AS DATE) AS VARCHAR) AS month FROM feeders,
       LATERAL (SELECT unnest(generate_series(DATE '1995-01-01', pred_month, INTERVAL 1 MONTH)) AS m)""",
    ("feeders",),
)
def _(data):
    """Every month of the span is there exactly once."""
    return text_dates(weather(data)[0].select("conjunto", "cod_alim", "month"))
